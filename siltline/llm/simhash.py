"""SimHash near-duplicates by a self-join of binary tries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.llm.common import LOWER, checkpointed, freeing, joined_evenly, tune, utf8
from siltline.llm.components import components

BITS = 64
#: Node pairs taken up at once, and products of node sizes that are compared outright.
_FRONT, _SMALL = 1 << 16, 16
#: Distinct fingerprints with one band in common; larger groups meet by a second band as well.
HOT = 1 << 16


def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """The SimHash of a text's word shingles, repeats included; 0 without words."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    width = min(width, len(words))
    begin = (end - size)[: len(words) - width + 1].tolist()
    end = end[width - 1 :].tolist()
    one = xxhash.xxh64_intdigest
    h = np.array([one(joined[a:b], seed) for a, b in zip(begin, end, strict=True)], np.uint64)
    counts = np.zeros(BITS, np.int64)
    for lo in range(0, len(h), 4096):
        counts += np.unpackbits(h[lo : lo + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(h), bitorder="little").tobytes(), "little")


def _fingerprints(width: int):
    @freeing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = np.array([fingerprint(t, width) for t in utf8(batch.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(f)], ["id", "f"])

    return rows


def _split(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Where the keys of each trie node (a range of sorted keys) turn from 0 to 1 at its bit."""
    lo, hi = lo.copy(), hi.copy()
    one = np.uint64(1)
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) >> 1
        set_ = (keys[mid] >> bit[open_].astype(np.uint64)) & one == one
        hi[open_] = np.where(set_, mid, hi[open_])
        lo[open_] = np.where(set_, lo[open_], mid + 1)
    return lo


def trie_pairs(keys: np.ndarray, begin: np.ndarray, end: np.ndarray, most: int, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places of keys in one group, begin to end (sorted, distinct), that differ in 1 to most bits.

    Pairs of trie nodes are followed down together; a pair is dropped once the bits
    in which its nodes differ exceed most. A node is a range of the sorted keys.
    """
    stack = [(begin, end, begin, end, np.full(len(begin), bits - 1), np.zeros(len(begin), np.int64))]
    while stack:
        lo1, hi1, lo2, hi2, bit, off = stack.pop()
        if len(lo1) > _FRONT:
            stack += [tuple(x[k : k + _FRONT] for x in (lo1, hi1, lo2, hi2, bit, off)) for k in range(0, len(lo1), _FRONT)]
            continue
        n1, n2 = hi1 - lo1, hi2 - lo2
        few = (n1 * n2 <= _SMALL) | (bit < 0)
        if few.any():
            a, b, m = lo1[few], lo2[few], n2[few]
            n = n1[few] * m
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            m = np.repeat(m, n)
            x, y = np.repeat(a, n) + at // m, np.repeat(b, n) + at % m
            ok = (x < y) & (np.bitwise_count(keys[x] ^ keys[np.minimum(y, len(keys) - 1)]) <= most)
            yield x[ok], y[ok]
        go = ~few
        if not go.any():
            continue
        lo1, hi1, lo2, hi2, bit, off = (x[go] for x in (lo1, hi1, lo2, hi2, bit, off))
        mid1, mid2 = _split(keys, lo1, hi1, bit), _split(keys, lo2, hi2, bit)
        same = (lo1 == lo2) & (hi1 == hi2)
        parts = (
            (lo1, mid1, lo2, mid2, off, None), (mid1, hi1, mid2, hi2, off, None),
            (lo1, mid1, mid2, hi2, off + 1, None), (mid1, hi1, lo2, mid2, off + 1, same),
        )
        found = []
        for a, b, c, d, o, not_ in parts:
            ok = (a < b) & (c < d) & (o <= most)
            if not_ is not None:
                ok &= ~not_
            found.append(tuple(x[ok] for x in (a, b, c, d, bit - 1, o)))
        stack.append(tuple(np.concatenate(x) for x in zip(*found, strict=True)))


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least place that links reach from each of n places."""
    root = np.arange(n)
    for x, y in pairs:
        while True:
            a, b = root[x], root[y]
            open_ = a != b
            if not open_.any():
                break
            x, y, a, b = x[open_], y[open_], a[open_], b[open_]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
    return root



#: Fingerprints of whole groups that are joined at once; a larger group stands alone.
_JOINED = 1 << 18


def _links(most: int):
    """Over rows of group g and fingerprint f, sorted so: links that join what each group's tries join. Groups pass one after another."""

    def joined(g: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((f, g))  # tries hold fingerprints as unsigned numbers
        g, f = g[order], f[order]
        begin = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
        end = np.append(begin[1:], len(g))
        more = end - begin > 1
        root = forest(len(f), trie_pairs(f, begin[more], end[more], most))
        moved = np.flatnonzero(root != np.arange(len(f)))
        for k in range(0, len(moved), 50_000):
            m = moved[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(f[root[m]].view(np.int64)), pa.array(f[m].view(np.int64))], ["a", "b"])

    @freeing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, prints, held = [], [], 0
        for batch in batches:
            g, f = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            groups.append(g)
            prints.append(f)
            held += len(g)
            if held >= _JOINED and g[0] != g[-1]:  # all but the last group are whole
                g, f = np.concatenate(groups), np.concatenate(prints)
                cut = int(np.flatnonzero(g != g[-1])[-1]) + 1
                yield from joined(g[:cut], f[:cut])
                groups, prints, held = [g[cut:].copy()], [f[cut:].copy()], len(g) - cut
        if held:
            yield from joined(np.concatenate(groups), np.concatenate(prints))

    return rows


def fingerprint_links(prints: DataFrame, most: int, hot: int = HOT) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints f exactly as all pairs with at most most differing bits do.

    Cut into most + 1 bands, such a pair agrees in a band whole: fingerprints meet
    under each of their bands and each group is joined with itself as a trie. Groups
    of more than hot are cut once more: the bits outside the band form most + 1 bands
    again, of which the pair agrees in one too.
    """
    bands = most + 1
    cuts = [BITS * k // bands for k in range(bands + 1)]
    masks = [((1 << cuts[k + 1]) - (1 << cuts[k])) for k in range(bands)]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    value = lambda m: F.col("f").bitwiseAND(F.lit(signed(m)))
    group = lambda k, *m: F.xxhash64(F.lit(k), *m)
    met = prints.select("f", F.explode(F.array(*(F.struct(F.lit(k).alias("k"), group(k, value(m)).alias("g")) for k, m in enumerate(masks)))).alias("x")).select("f", "x.k", "x.g")
    sizes = met.groupBy("g").agg(F.count("*").alias("n")).where(F.col("n") > hot)
    cool = met.join(sizes, "g", "left_anti").select("g", "f")
    again = []
    for k, m in enumerate(masks):
        rest = [b for b in range(BITS) if not m >> b & 1]
        parts = [sum(1 << b for b in rest[len(rest) * j // bands : len(rest) * (j + 1) // bands]) for j in range(bands)]
        again.append(F.when(F.col("k") == k, F.array(*(group(bands + k * bands + j, value(m), value(p)) for j, p in enumerate(parts)))))
    large = met.join(sizes, "g", "left_semi").select(F.explode(F.coalesce(*again)).alias("g"), "f")
    return cool.unionAll(large).repartition("g").sortWithinPartitions("g").mapInArrow(_links(most), "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, most: int = 3, hot: int = HOT
) -> DataFrame:
    """Every row's fingerprint (16 lowercase hex digits) and component_id, the least id that links reach.

    Words are what stands between white space, A-Z lower-cased; shingles of width words
    (all words of a shorter text), repeats included, hashed by XXH64 (seed 42); a bit
    is set if it is in over half of them. Fingerprints link at most differing bits or fewer.

    Null, empty and blank texts have fingerprint zero and link like any other. Rows
    of equal text, or equal ids, share fingerprint and component; a null id is in its
    component but never names one unless it holds nothing else (then null).
    Very long texts are hashed whole, a few thousand shingles at a time. Of links that tie, all
    count. An empty table gives no rows; other columns are not read.
    """
    tune(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    rows = checkpointed(rows.mapInArrow(_fingerprints(width), f"id {kind}, f long"))
    prints = checkpointed(rows.groupBy("f").agg(F.min("id").alias("least"), F.count("*").alias("_n")))
    roots = components(fingerprint_links(prints.select("f"), most, hot))
    prints = prints.join(roots, F.col("f") == F.col("node"), "left").select("f", "least", "_n", F.coalesce("root", "f").alias("root"))
    prints = checkpointed(prints)
    sizes = prints.agg(F.count("*"), F.sum("_n")).first()
    named = checkpointed(prints.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("_n")))
    prints = checkpointed(joined_evenly(prints.withColumnRenamed("_n", "rows"), named, "root", sizes[0]).select("f", "component_id", F.col("rows").alias("_n")))
    return joined_evenly(rows, prints, "f", sizes[1] or 0).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id"
    )
