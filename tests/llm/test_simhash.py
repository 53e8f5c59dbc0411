import random

import numpy as np
import pytest
import xxhash

from siltline.llm import simhash
from siltline.llm.simhash import fingerprint, near_duplicates, trie_pairs


def slow_print(text, width=3):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    width = min(width, len(words))
    h = [xxhash.xxh64_intdigest(" ".join(words[k : k + width]).encode(), seed=42) for k in range(len(words) - width + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(ids, prints, most=3):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= most:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return [least[find(i)] for i in range(len(ids))]


@pytest.mark.parametrize("hot", [1 << 16, 1])
def test_equals_brute_force(spark, hot):
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdeFGé ") for _ in range(r.randint(1, 6)))
    texts = [None, "", "  \t", "one", "One", "two words", "a b c"]
    for _ in range(40):
        base = [word() for _ in range(60)]
        texts.append(" ".join(base))
        for _ in range(r.randint(0, 4)):
            base[r.randrange(60)] = word()
            texts.append("\n".join(base))
    texts += texts[5:9]
    ids = list(range(100, 100 + len(texts)))
    r.shuffle(ids)
    docs = spark.createDataFrame([(d, t, "x") for d, t in zip(ids, texts, strict=True)], "doc_id long, text string, fingerprint string")
    got = {x["doc_id"]: (x["fingerprint"], x["component_id"]) for x in near_duplicates(docs, hot=hot).collect()}
    prints = [slow_print(t) for t in texts]
    want = {d: (f"{p:016x}", c) for d, p, c in zip(ids, prints, slow_components(ids, prints), strict=True)}
    assert got == want
    assert len({c for _, c in want.values()}) < len(texts) - 10


def test_trie_join_equals_all_pairs():
    r = np.random.default_rng(2)
    keys = []
    for _ in range(30):
        base = int(r.integers(0, 2**63))
        keys += [base] + [base ^ sum(1 << b for b in {int(b) for b in r.integers(0, 64, r.integers(1, 5))}) for _ in range(20)]
    keys = np.unique(np.array(keys, np.uint64))
    half = len(keys) // 2
    pairs = set()
    for x, y in trie_pairs(keys, np.array([0, half]), np.array([half, len(keys)]), 3):
        pairs |= set(zip(x.tolist(), y.tolist(), strict=True))
    want = {(i, j) for j in range(len(keys)) for i in range(j) if (i < half) == (j < half) and int(keys[i] ^ keys[j]).bit_count() <= 3}
    assert pairs == want and want


def test_very_long_text():
    text = "word other thing " * 20_000
    assert fingerprint(text.encode()) == slow_print(text)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert simhash.BITS == 64


@pytest.mark.parametrize("rows", [0, 10_000])
def test_heavy_keys_change_nothing(spark, monkeypatch, rows):
    from siltline.llm import common
    from siltline.llm.components import components
    from siltline.llm.sharding import shards

    monkeypatch.setattr(common, "HEAVY_ROWS", rows)
    monkeypatch.setattr(common, "HEAVY_PART", 4)
    star = spark.createDataFrame([(1, k) for k in range(2, 60)] + [(100 + k, 101 + k) for k in range(20)] + [(59, 100), (7, 7)], "a long, b long")
    assert {tuple(r) for r in components(star).collect()} == {(k, 1) for k in [*range(1, 60), *range(100, 121)]}
    texts = ["same words here"] * 30 + [f"other {k} words {k * k}" for k in range(20)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()}
    assert len(got) == 52 and {got[k] for k in range(30)} == {0} and got[50] == got[51] == 50
    placed = shards(docs, bins=3).collect()
    assert len(placed) == 52 and len({r["shard"] for r in placed if r["doc_id"] < 30}) == 1
    assert all(sorted(r["slot"] for r in placed if r["shard"] == b) == list(range(sum(r["shard"] == b for r in placed))) for b in range(3))


def test_groups_pass_one_after_another(spark, monkeypatch):
    """However few fingerprints are joined at once, groups stay whole: components are those of all pairs."""
    from siltline.llm import simhash
    from siltline.llm.components import components

    r = np.random.default_rng(12)
    prints = r.integers(0, 1 << 63, 300, dtype=np.uint64)
    near = np.concatenate([prints, *(prints[:100] ^ (np.uint64(1) << r.integers(0, 63, 100).astype(np.uint64)) for _ in range(3))])
    near = np.unique(near)
    df = spark.createDataFrame([(int(x),) for x in near.view(np.int64)], "f long").repartition(3)
    got = []
    for most in (1 << 18, 1):
        monkeypatch.setattr(simhash, "_JOINED", most)
        got.append(sorted(map(tuple, components(simhash.fingerprint_links(df, 3, hot=50)).collect())))
    root = {int(x): int(x) for x in near.view(np.int64)}
    for a in range(len(near)):
        for b in np.flatnonzero(np.bitwise_count(near ^ near[a]) <= 3).tolist():
            x, y = int(near.view(np.int64)[a]), int(near.view(np.int64)[b])
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            root[max(x, y)] = min(x, y)

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    sizes = {}
    for x in root:
        sizes.setdefault(top(x), []).append(x)
    assert got[0] == got[1] == sorted((x, k) for k, own in sizes.items() if len(own) > 1 for x in own)


def test_columns_of_any_name(spark):
    """Other columns, called as the operator calls its own, change nothing."""
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "quite other words here now"), (4, None), (5, "")]
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    extra = spark.createDataFrame([(*x, 0, 0, 0, 0, 0, 0, "x", "y") for x in rows], "doc_id long, text string, f long, g long, node long, root long, least long, _n long, t string, component_id string")
    assert sorted(map(tuple, near_duplicates(extra).collect())) == sorted(map(tuple, near_duplicates(plain).collect()))
