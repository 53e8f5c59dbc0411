"""How far sources depart from each other and from their language, by terms counted in radix tries."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltline.llm import bpe
from siltline.llm.common import LOWER, checkpointed, freeing, shared_folder, tune
from siltline.shared import ranked, remove

#: Leaves and bytes of terms after which a task's tries are handed on and begun anew. Bounds memory, never results.
LEAVES, TRIE_BYTES = 1 << 17, 16 << 20
#: Groups whose pairs are summed in one round, from each of two blocks; and numbers in one matrix.
BLOCK, CELLS = 1024, 1 << 20
#: Up to so many groups a table of their numbers is broadcast; beyond, it is joined by a shuffle.
FEW_GROUPS = 1 << 16

_LOWER = np.frombuffer(LOWER, np.uint8)
_TERM = np.array([c >= 0x80 or 65 <= c <= 90 or 97 <= c <= 122 for c in range(256)])


class Trie:
    """A radix trie over bytes. Each leaf has a number, under which counters are kept for each source."""

    def __init__(self):
        self.root: dict[int, list] = {}  # by first byte: [label, leaf number or -1, edges below]
        self.leaves = self.bytes = 0
        self.counters: list[np.ndarray] = []  # rows (leaf, source, places, documents)

    def leaf(self, term: bytes) -> int:
        """The number of a term's leaf, which is made where there is none."""
        edges, at, end = self.root, 0, len(term)
        while True:
            edge = edges.get(term[at])
            if edge is None:
                edges[term[at]] = edge = [term[at:], -1, {}]
                self.bytes += end - at
                break
            label = edge[0]
            if term.startswith(label, at):
                at += len(label)
                if at == end:
                    break
                edges = edge[2]
                continue
            n = 1
            while at + n < end and n < len(label) and label[n] == term[at + n]:
                n += 1
            below = [label[n:], edge[1], edge[2]]
            edge[0], edge[1], edge[2] = label[:n], -1, {label[n]: below}
            at += n
            if at == end:
                break
            edges = edge[2]
        if edge[1] < 0:
            edge[1], self.leaves = self.leaves, self.leaves + 1
        return edge[1]

    def add(self, leaf: np.ndarray, source: np.ndarray, places: np.ndarray, documents: np.ndarray) -> None:
        self.counters.append(np.stack([leaf, source, places, documents], 1))
        if sum(map(len, self.counters)) > 4 * LEAVES:
            self.counters = [_summed(np.concatenate(self.counters))]

    def walk(self) -> Iterator[tuple[bytes, int]]:
        """Terms and the numbers of their leaves, in the order of their bytes, which is that of UTF-8."""
        stack = [(b"", self.root[c]) for c in sorted(self.root, reverse=True)]
        while stack:
            head, (label, leaf, edges) = stack.pop()
            term = head + label
            if leaf >= 0:
                yield term, leaf
            stack += [(term, edges[c]) for c in sorted(edges, reverse=True)]


def _summed(rows: np.ndarray) -> np.ndarray:
    """Rows (leaf, source, places, documents) with one for each leaf and source, in their order."""
    order = np.lexsort((rows[:, 1], rows[:, 0]))
    rows = rows[order]
    first = np.flatnonzero(np.append(True, (np.diff(rows[:, :2], axis=0) != 0).any(1))) if len(rows) else np.zeros(0, np.int64)
    return np.concatenate([rows[first, :2], np.add.reduceat(rows[:, 2:], first)], 1) if len(first) else rows


def _binaries(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _numbers(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in packed binaries, one after another, and how many each holds."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(kind) if data else np.zeros(0, kind)), np.diff(ends) // np.dtype(kind).itemsize


_LEAF = ["lang", "term", "documents", "sources", "places"]
_LEAF_DDL = "lang string, term binary, documents long, sources binary, places binary"


def _leaves(lang: list[str] | pa.Array, terms: list[bytes] | pa.Array, rows: np.ndarray) -> pa.RecordBatch:
    """Leaves in order as rows; rows: (place among them, source, places, documents), each leaf at least once, in order."""
    first = np.flatnonzero(np.append(True, rows[1:, 0] != rows[:-1, 0]))
    ends = np.append(first, len(rows))
    columns = [pa.array(lang, pa.string()), pa.array(terms, pa.binary()), pa.array(np.add.reduceat(rows[:, 3], first)), _binaries(rows[:, 1].astype(np.int32), ends), _binaries(rows[:, 2], ends)]
    return pa.RecordBatch.from_arrays(columns, _LEAF)


def terms(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All terms of UTF-8 texts without nulls, lower-cased, and the text of each."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if texts.buffers()[2] else np.zeros(0, np.uint8)
    inside = _TERM[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    starts = offsets[:-1][np.diff(offsets) > 0] - offsets[0]
    begin[starts] = inside[starts]  # terms end with their text
    begin = np.flatnonzero(begin)
    of = np.searchsorted(offsets - offsets[0], begin, "right") - 1
    ends = np.append(np.cumsum(inside)[begin] - 1, inside.sum()) if len(begin) else np.zeros(1, np.int64)
    found = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(_LOWER[data[inside]])])
    return found.dictionary_encode(), of


def _count(leaves: int, most_bytes: int):
    """Over rows (lang, group, text): the leaves of each task's tries, in order for each language."""

    def handed(tries: dict[str, Trie]) -> Iterator[pa.RecordBatch]:
        for lang in sorted(tries):
            trie = tries[lang]
            ordered = list(trie.walk())
            place = np.empty(trie.leaves, np.int64)
            place[[n for _, n in ordered]] = np.arange(len(ordered))
            rows = np.concatenate(trie.counters)
            rows[:, 0] = place[rows[:, 0]]
            rows = _summed(rows)
            cut = np.searchsorted(rows[:, 0], np.arange(0, len(ordered) + 4096, 4096))
            for k, (lo, hi) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
                if hi > lo:
                    own = [t for t, _ in ordered[4096 * k : 4096 * (k + 1)]]
                    yield _leaves([lang] * len(own), own, rows[lo:hi])
        tries.clear()

    @freeing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries: dict[str, Trie] = {}
        gc.disable()  # tries hold no cycles, and looking for some in them takes long; freeing looks again when the task ends
        try:
            yield from counted(batches, tries)
        finally:
            gc.enable()

    def counted(batches: Iterator[pa.RecordBatch], tries: dict[str, Trie]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(1)], ["lang", "text", "group"])
            for part in bpe.parts(some):
                found, text = terms(part.column(1))
                if not len(found):
                    continue
                groups, langs = part.column(2).to_numpy(), part.column(0).to_pylist()
                # a row for each term and text, then for each term and group
                pair, n = np.unique(found.indices.to_numpy().astype(np.int64) * len(part) + text, return_counts=True)
                term, text = pair // len(part), pair % len(part)
                each = _summed(np.stack([term, groups[text], n, np.ones(len(n), np.int64)], 1))
                lang_of = {g: lang for g, lang in zip(groups.tolist(), langs, strict=True)}
                number = {lang: k for k, lang in enumerate(sorted(set(lang_of.values())))}
                known = np.array(sorted(lang_of))
                language = np.array([number[lang_of[g]] for g in known.tolist()])[np.searchsorted(known, each[:, 1])]
                for lang, k in number.items():
                    own = each[language == k]
                    if not len(own):
                        continue
                    trie = tries.setdefault(lang, Trie())
                    which, back = np.unique(own[:, 0], return_inverse=True)
                    words = found.dictionary.take(pa.array(which))
                    order = pc.array_sort_indices(words)  # neighbours share most of their way through the trie
                    leaf = np.empty(len(which), np.int64)
                    leaf[order.to_numpy()] = np.fromiter(map(trie.leaf, words.take(order).to_pylist()), np.int64, len(which))
                    trie.add(leaf[back], own[:, 1], own[:, 2], own[:, 3])
                if sum(t.leaves for t in tries.values()) >= leaves or sum(t.bytes for t in tries.values()) >= most_bytes:
                    yield from handed(tries)
        yield from handed(tries)

    return rows


def _merge(least: int):
    """Over leaves of many tries by language and term: those of one term as one, where at least least documents hold it."""

    def merged(rows_: pa.RecordBatch, new: np.ndarray) -> pa.RecordBatch:
        which = np.cumsum(new) - 1
        sources, n = _numbers(rows_.column(3), np.int32)
        each = np.repeat(np.arange(len(rows_)), n)
        documents = np.zeros(len(sources), np.int64)
        documents[np.cumsum(n) - n] = rows_.column(2).to_numpy()  # of the row as a whole
        rows = _summed(np.stack([which[each], sources, _numbers(rows_.column(4), np.int64)[0], documents], 1))
        first = pa.array(np.flatnonzero(new))
        return _leaves(rows_.column(0).take(first), rows_.column(1).take(first), rows)

    @freeing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not len(batch):
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            lang, term = (batch.column(k).dictionary_encode().indices.to_numpy() for k in (0, 1))
            new = np.append(True, (lang[1:] != lang[:-1]) | (term[1:] != term[:-1]))
            out = merged(batch, new)
            held = out.slice(len(out) - 1)
            done = out.slice(0, len(out) - 1)
            yield done.filter(pc.greater_equal(done.column(2), least))
        if held is not None:
            yield held.filter(pc.greater_equal(held.column(2), least))

    return rows


@freeing
def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over (sources, places) of leaves: the places of each group in this task."""
    totals = np.zeros((0, 2), np.int64)
    for batch in batches:
        source, places = _numbers(batch.column(0), np.int32)[0], _numbers(batch.column(1), np.int64)[0]
        rows = np.concatenate([totals, np.stack([source, places], 1)])
        known, back = np.unique(rows[:, 0], return_inverse=True)
        sums = np.zeros(len(known), np.int64)
        np.add.at(sums, back, rows[:, 1])
        totals = np.stack([known, sums], 1)
    yield pa.RecordBatch.from_arrays([pa.array(totals[:, 0]), pa.array(totals[:, 1])], ["group", "total"])


#: Up to so many places their product with SHARES fits 64 bits.
SHARES, _SAFE = 1_000_000_000, (1 << 63) // 1_000_000_000 - 4


def shares(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(SHARES (count + 2) / total), exactly; total is at least 2 and at least count + 2."""
    if count.max(initial=0) <= _SAFE:
        return 1 + SHARES * (count + 2) // total
    return (1 + SHARES * (count.astype(object) + 2) // total).astype(np.int64)


def departure(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q))."""
    return (p - q) ** 2 // (p + q)


def _compare(plan_of, ranks: int):
    """Over kept leaves by language and term: the sums of each pair of the round's groups, and each group's first candidates.

    The plan holds for each language the groups of two blocks with their smoothed totals and the language's.
    Rows (group, other, null, sum) and (group, null, term, value).
    """
    schema = pa.schema([("group", pa.int64()), ("other", pa.int64()), ("term", pa.binary()), ("value", pa.int64())])

    @freeing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, alike = plan_of.value
        sums = {lang: np.zeros((len(one), len(two)), np.int64) for lang, (one, _, two, _, _) in plan.items()}
        best: dict[int, list[tuple[int, bytes]]] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            change = [0, *(k for k in range(1, len(langs)) if langs[k] != langs[k - 1]), len(langs)] if langs else []
            for lo, hi in zip(change[:-1], change[1:], strict=True):
                if langs[lo] not in plan:
                    continue
                one, total_one, two, total_two, total = plan[langs[lo]]
                step = max(1, CELLS // max(len(one) * len(two), len(one) + len(two)))
                for at in range(lo, hi, step):
                    part = batch.slice(at, min(step, hi - at))
                    source, n = _numbers(part.column(3), np.int32)
                    places = _numbers(part.column(4), np.int64)[0]
                    row = np.repeat(np.arange(len(part)), n)

                    def counted(groups: np.ndarray, source=source, row=row, places=places, n=len(part)) -> np.ndarray:
                        out = np.zeros((n, len(groups)), np.int64)
                        k = np.minimum(np.searchsorted(groups, source), len(groups) - 1)
                        own = groups[k] == source
                        out[row[own], k[own]] = places[own]
                        return out

                    count = counted(one)
                    p = shares(count, total_one)
                    q = p if alike else shares(counted(two), total_two)
                    sums[langs[lo]] += departure(p[:, :, None], q[:, None, :]).sum(0)
                    if alike:
                        whole = shares(np.add.reduceat(places, np.cumsum(n) - n), total)[:, None]
                        value = np.where((count > 0) & (p > whole), departure(p, whole), -1)
                        names = part.column(1).to_pylist()
                        order = np.argsort(-value, axis=0, kind="stable")[:ranks]  # of equal values the term that comes first
                        for g, own, top in zip(one.tolist(), order.T.tolist(), np.take_along_axis(value, order, 0).T.tolist(), strict=True):
                            if top[0] >= 0:
                                more = [(v, names[k]) for k, v in zip(own, top, strict=True) if v >= 0]
                                best[g] = sorted(best.get(g, []) + more, key=lambda x: -x[0])[:ranks]
        for lang, (one, _, two, _, _) in plan.items():
            a, b, s = np.repeat(one, len(two)), np.tile(two, len(one)), sums[lang].ravel()
            keep = (s > 0) & (a != b)
            if keep.any():
                n = int(keep.sum())
                yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep]), pa.nulls(n, pa.binary()), pa.array(s[keep])], schema=schema)
        found = [(g, t, v) for g, own in best.items() for v, t in own]
        if found:
            g, t, v = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.nulls(len(g), pa.int64()), pa.array(t, pa.binary()), pa.array(v, pa.int64())], schema=schema)

    return rows


def source_divergence(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least: int = 10,
    ranks: int = 10,
    block: int = BLOCK,
    leaves: int = LEAVES,
) -> DataFrame:
    """For each source of a language: how far it departs from each other source, and the terms by which it departs most from the language.

    Terms are [^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+ of the text with A-Z lower-cased; a language keeps those
    in at least least of its documents, V of them. In a group (a source, or the language) a kept term that
    stands there count times has p = 1 + floor(10^9 (count + 2) / (N + 2 V)), N the sum of counts; and
    f = floor((p - q)^2 / (p + q)). Returns lang, source, part, item, value and rank (from 1 for each source and
    part, by value from the largest, then by the bytes of item): part pair has each other source of the language
    with f summed over all kept terms; part term has the first ranks kept terms of the source with p above
    the language's, with f.

    Each task counts in one radix trie of bytes for each language, whose leaves hold counters for each source, and
    hands its leaves on in their order. Ranges of prefixes, dealt by Spark's range partitioning of (language,
    term), are merged by adding the counters of equal leaves as they pass in order. A second walk over the kept
    leaves, with a total for each group, adds up pairs and keeps each group's first candidates; the term that
    comes first in UTF-8 stays ahead of equal ones. Pairs are summed in rounds of two blocks of block groups,
    so that memory is bounded; a table with up to block groups takes one round.

    Null text, lang and source count as ''. A group without terms has p from counts of 0; a language without
    kept terms gives pairs of value 0. Repeated rows are documents each; empty tables give no rows; other
    columns are not read.
    """
    tune(docs.sparkSession)
    spark = docs.sparkSession
    text, lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text_col, lang_col, source_col))
    rows = docs.select(lang.alias("lang"), source.alias("source"), text.alias("text"))
    groups = ranked(rows.select("lang", "source").distinct(), "lang", "source").select("lang", "source", (F.col("rank") - 1).cast("long").alias("group"))
    groups = checkpointed(groups)
    n_groups = groups.count()
    named = rows.join(F.broadcast(groups) if n_groups <= FEW_GROUPS else groups, ["lang", "source"])
    folder = f"{shared_folder(spark)}/divergence-{uuid.uuid4().hex}"

    def table(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{folder}/{name}")

    counted = table(named.select("lang", "group", "text").mapInArrow(_count(leaves, TRIE_BYTES), _LEAF_DDL), "leaves")
    dealt = counted.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    kept = table(dealt.mapInArrow(_merge(least), _LEAF_DDL), "kept")
    remove(spark, f"{folder}/leaves")
    totals = kept.select("sources", "places").mapInArrow(_totals, "group long, total long").groupBy("group").agg(F.sum("total").alias("total"))
    terms_of = kept.groupBy("lang").agg(F.count("*").alias("n_terms"))
    known = groups.join(totals, "group", "left").join(terms_of, "lang", "left").fillna(0, ["total", "n_terms"])
    whole = F.sum("total").over(Window.partitionBy("lang"))
    known = checkpointed(known.withColumn("whole", whole))

    def block_of(k: int) -> list:
        return known.where((F.col("group") >= k * block) & (F.col("group") < (k + 1) * block)).orderBy("group").collect()  # block rows

    parts = []
    blocks = -(-n_groups // block)
    for k in range(blocks):
        one = block_of(k)
        for j in range(k, blocks):
            two = one if j == k else block_of(j)
            if two[0]["lang"] != one[-1]["lang"] and j > k:
                break  # groups are in order of languages
            plan = {}
            for name in sorted({r["lang"] for r in one} & {r["lang"] for r in two}):
                sides = []
                for side in (one, two):
                    own = [r for r in side if r["lang"] == name]
                    sides += [np.array([r["group"] for r in own]), np.array([r["total"] + 2 * r["n_terms"] for r in own])]
                    whole_total = own[0]["whole"] + 2 * own[0]["n_terms"]
                plan[name] = (*sides, whole_total)
            shared = spark.sparkContext.broadcast((plan, j == k))
            part = kept.where(F.col("lang").between(min(plan), max(plan))) if plan else kept.limit(0)
            part = part.mapInArrow(_compare(shared, ranks), "group long, other long, term binary, value long")
            if j > k:
                part = part.unionAll(part.select(F.col("other").alias("group"), F.col("group").alias("other"), "term", "value"))
            parts.append(checkpointed(part) if blocks > 1 else part)
    names = groups.select("lang", "source", "group")
    found = checkpointed(reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], "group long, other long, term binary, value long"))
    remove(spark, folder)
    sums = found.where("other IS NOT NULL").groupBy("group", "other").agg(F.sum("value").alias("value"))
    others = names.select("lang", F.col("source").alias("item"), F.col("group").alias("other"))
    pairs = names.join(others, "lang").where("group != other").join(sums, ["group", "other"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    best = found.where("other IS NULL").select("group", F.col("term").cast("string").alias("item"), "value")
    best = best.join(names, "group").select("lang", "source", F.lit("term").alias("part"), "item", "value")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.col("item").cast("binary"))
    out = pairs.unionByName(best).withColumn("rank", F.row_number().over(order).cast("int"))
    return out.where((F.col("part") == "pair") | (F.col("rank") <= ranks)).select("lang", "source", "part", "item", "value", "rank")
