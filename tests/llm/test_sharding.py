import itertools
import zlib
from collections import defaultdict

import numpy as np

from siltline.llm.sharding import difference, shards


def verify(docs, rows, bins=8):
    got = [(r["doc_id"], r["size"], r["text_crc32"], r["law"], r["grown_shard"]) for r in rows]
    want = [(k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "bytes", None) for k, t in docs]
    assert sorted(map(str, got)) == sorted(map(str, want))
    slots, total, groups = defaultdict(list), [0] * bins, defaultdict(lambda: [0, set()])
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        total[r["shard"]] += r["size"]
        group = groups[r["size"], r["text_crc32"]]
        group[0] += r["size"]
        group[1].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(bins))
    assert all(len(g[1]) == 1 for g in groups.values())
    return total, max((g[0] for g in groups.values()), default=0)


def test_difference_is_near_the_best():
    r = np.random.default_rng(1)
    for _ in range(20):
        sizes = r.integers(1, 100, 8).tolist()
        at = difference([[s, 0, 0] for s in sizes], 3)[:, 0]
        spread = lambda at: max(x := [sum(s for s, b in zip(sizes, at, strict=True) if b == k) for k in range(3)]) - min(x)
        best = min(spread(p) for p in itertools.product(range(3), repeat=8))
        assert spread(at) <= best + 25
    assert difference([], 3).shape == (0, 3)
    # combined partial partitions keep every bin apart
    out = difference([[5, 3, 1], [4, 4, 4], [9, 0, 0]], 3)
    assert all(sorted(row) == [0, 1, 2] for row in out.tolist())


def test_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(6)
    total, largest = verify([(r["doc_id"], r["text"]) for r in docs.collect()], shards(docs).collect())
    assert max(total) - min(total) <= max(0.001 * sum(total), 64) or max(total) <= largest


def test_odd_rows(spark):
    rows = [(1, "a", 5), (1, "a", 5), (None, None, 5), (None, "x", 5), (2, "", None), (3, "word " * 90_000, 5), (4, "é", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    total, largest = verify([r[:2] for r in rows], shards(docs).collect())
    assert max(total) == largest
    verify([r[:2] for r in rows], shards(docs, bins=2).collect(), 2)
    assert shards(docs.limit(0)).count() == 0
