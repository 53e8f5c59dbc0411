"""Benchmark decontamination by suffix arrays of the training texts."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltline.llm.common import ALNUM, checkpointed, freeing, in_chunks, tune, utf8, with_fields

#: Bits of a word number in a packed key and words in one key.
_WORD_BITS, _PACKED = 31, 2
#: Words of one round's probe, about, which bound its windows; and of one piece in which an item's words travel.
ROUND_WORDS, PIECE_WORDS = 1 << 18, 4096
#: Items of texts that are listed at once, and words of a text whose longest matches are looked for at once.
_LISTED, _BLOCK = 1 << 20, 1 << 18


@dataclass
class Stretches:
    """The items of at least a window as one row of words with a suffix array, in which any stretch of theirs is found by binary search.

    names[k][i] says which of the different stretches of 2^k words stands at i, in their order; 0: none within one item.
    """

    words: np.ndarray  # word numbers, a 0 after each item
    item: np.ndarray  # for each place its item's number in order of ids, and the words before it there
    before: np.ndarray
    names: list[np.ndarray]
    pairs: list[np.ndarray]  # the two halves of each stretch of 2^(k + 1) words, packed and sorted, and its name
    named: list[np.ndarray]
    suffixes: np.ndarray  # places in order of what follows them, within a window of their item's end left out

    @classmethod
    def of(cls, texts: Sequence[tuple[int, int, np.ndarray]], width: int) -> Stretches:
        """Of (item, words before, word numbers) texts."""
        row = lambda parts: np.concatenate([*parts, np.zeros(0, np.int64)])
        words = row([np.append(ids, 0) for _, _, ids in texts])
        item = row([np.full(len(ids) + 1, k) for k, _, ids in texts])
        before = row([lo + np.arange(len(ids) + 1) for _, lo, ids in texts])
        left = row([np.arange(len(ids), -1, -1) for _, _, ids in texts])
        n, most = len(words), int(left.max(initial=0))
        rank, names, pairs, named, step = words.astype(np.int64), [words.astype(np.int32)], [], [], 1
        while step < most:
            after = np.zeros(n, np.int64)
            after[: n - step] = rank[step:]
            _, rank = np.unique((rank << 32) | after, return_inverse=True)
            rank = rank + 1
            now = np.where(left >= 2 * step, rank, 0).astype(np.int32)
            whole = np.flatnonzero(now)
            key, at = np.unique((names[-1][whole].astype(np.int64) << 32) | names[-1][whole + step], return_index=True)
            names.append(now)
            pairs.append(key)
            named.append(now[whole[at]])
            step *= 2
        order = np.argsort(rank, kind="stable")
        return cls(words, item, before, names, pairs, named, order[left[order] >= width])

    def named_in(self, ids: np.ndarray) -> list[np.ndarray]:
        """The names of the stretches at each place of a text, with zeros after it."""
        out = [ids.astype(np.int32)]
        for k, (pairs, named) in enumerate(zip(self.pairs, self.named, strict=True)):
            now, step = np.zeros(len(ids), np.int32), 1 << k
            at = np.flatnonzero((out[-1][:-step] > 0) & (out[-1][step:] > 0)) if len(ids) > step else np.zeros(0, np.int64)
            if len(at) and len(pairs):
                key = (out[-1][at].astype(np.int64) << 32) | out[-1][at + step]
                found = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
                now[at] = np.where(pairs[found] == key, named[found], 0)
            out.append(now)
        return out

    def common(self, text: list[np.ndarray], at: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How many words go on alike from places of a text (its names) and of the items, pair by pair."""
        out, n, m = np.zeros(len(at), np.int64), len(text[0]), len(self.words)
        for k in reversed(range(len(self.names))):
            a, b = at + out, places + out
            name = text[k][np.minimum(a, n - 1)]
            out += ((name > 0) & (a < n) & (b < m) & (name == self.names[k][np.minimum(b, m - 1)])).astype(np.int64) << k
        return out

    def longest(self, ids: np.ndarray, at: np.ndarray) -> tuple[int, int, int, int] | None:
        """Of the stretches from places at of a text that go on alike in an item: the words of the longest, its place, the item and the words before it there.

        Of equally long ones the first in the text, then the least item, then the first there.
        """
        if not len(at) or not len(self.suffixes):
            return None
        text = self.named_in(np.append(ids, np.zeros(1, ids.dtype)))
        lo, hi = np.zeros(len(at), np.int64), np.full(len(at), len(self.suffixes), np.int64)
        while (open_ := np.flatnonzero(lo < hi)).size:  # how many suffixes stand before each
            mid = (lo[open_] + hi[open_]) >> 1
            place = self.suffixes[mid]
            n = self.common(text, at[open_], place)
            a = text[0][np.minimum(at[open_] + n, len(ids))]
            less = self.words[place + n] < a
            lo[open_], hi[open_] = np.where(less, mid + 1, lo[open_]), np.where(less, hi[open_], mid)
        near = np.stack([np.maximum(lo - 1, 0), np.minimum(lo, len(self.suffixes) - 1)])
        length = np.stack([self.common(text, at, self.suffixes[k]) for k in near]).max(0)
        best = int(length.argmax())
        p, n, k = at[best], int(length[best]), int(lo[best])
        alike = lambda k: 0 <= k < len(self.suffixes) and int(self.common(text, p[None], self.suffixes[k : k + 1])[0]) >= n
        first, last = self._edge(alike, k if alike(k) else k - 1, -1), self._edge(alike, k if alike(k) else k - 1, 1)
        places = self.suffixes[first : last + 1]
        item = int(self.item[places].min())
        return n, int(p), item, int(self.before[places[self.item[places] == item]].min())

    @staticmethod
    def _edge(holds: Callable[[int], bool], k: int, step: int) -> int:
        """The last k in a direction for which holds, which is true for a run around the first k: steps double, then halve."""
        jump = step
        while holds(k + jump):
            k, jump = k + jump, 2 * jump
        while jump := int(jump / 2):
            if holds(k + jump):
                k += jump
        return k


@dataclass
class Probe:
    """The test suffixes that matter: each distinct window of the benchmark, as word numbers (0 pads)."""

    words: dict[bytes, int]
    windows: np.ndarray  # windows x width
    lengths: np.ndarray
    first: np.ndarray  # window w stands in the items that holders[first[w] : first[w + 1]] numbers
    holders: np.ndarray
    names: list[str]  # the items' ids, sorted
    pairs: np.ndarray  # the first two word numbers of windows, packed and sorted; one-word windows apart
    singles: np.ndarray
    stretches: Stretches

    @cached_property
    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest key that starts with each window."""
        top = np.where(np.arange(self.windows.shape[1]) < self.lengths[:, None], self.windows, (1 << _WORD_BITS) - 1)
        return packed(self.windows), packed(top)

    @cached_property
    def pair_of(self) -> np.ndarray:
        """The place in pairs of each window's first two words; one beyond the last for one-word windows."""
        if not len(self.pairs):
            return np.zeros(len(self.windows), np.int64)
        pair = (self.windows[:, 0] << _WORD_BITS) | self.windows[:, 1]
        return np.where(self.lengths > 1, np.searchsorted(self.pairs, pair), len(self.pairs))


def packed(columns: np.ndarray) -> np.ndarray:
    """Rows of word numbers as a few 64-bit numbers each, in the same order."""
    n, width = columns.shape
    out = np.zeros((n, -(-width // _PACKED)), np.uint64)
    for c in range(width):
        out[:, c // _PACKED] |= columns[:, c].astype(np.uint64) << np.uint64(_WORD_BITS * (_PACKED - 1 - c % _PACKED))
    return out


def _texts(items: Sequence[tuple[str, int, int, str | None]], words: dict[bytes, int], width: int) -> Iterator[tuple[str, int, np.ndarray]]:
    """(name, words before, word numbers) of the texts, whose pieces overlap by a window less one word; new words are numbered."""
    held: list = [None, 0, 0, []]
    for name, unit, before, text in sorted(items, key=lambda x: (x[0], x[1], x[2])):
        ids = [words.setdefault(w, len(words) + 1) for w in (text or "").encode().translate(ALNUM).split()]
        if held[0] == (name, unit) and before == held[1] + len(held[3]) - width + 1:
            held[3] += ids[width - 1 :]
            continue
        if held[3]:
            yield held[0][0], held[1], np.array(held[3], np.int64)
        held = [(name, unit), before, 0, ids]
    if held[3]:
        yield held[0][0], held[1], np.array(held[3], np.int64)


def build_probe(items: Sequence[tuple[str, int, int, str | None]], width: int) -> Probe:
    """The probe of (item_id, text number, words before it, text) rows; a text of fewer than width words is one window."""
    words: dict[bytes, int] = {}
    names = sorted({name for name, *_ in items})
    number = {name: k for k, name in enumerate(names)}
    texts = [(number[name], before, ids) for name, before, ids in _texts(items, words, width)]
    rows = [np.zeros((0, width + 1), np.int64)]
    for k, _, ids in texts:
        some = np.lib.stride_tricks.sliding_window_view(ids, width) if len(ids) >= width else np.append(ids, np.zeros(width - len(ids), np.int64))[None]
        rows.append(np.concatenate([some, np.full((len(some), 1), k)], 1))
    held = np.concatenate(rows)
    keys = packed(held)  # the item comes last
    held = held[np.lexsort(keys.T[::-1])]
    held = held[np.append(True, (held[1:] != held[:-1]).any(1))] if len(held) else held
    first = np.flatnonzero(np.append(True, (held[1:, :-1] != held[:-1, :-1]).any(1))) if len(held) else np.zeros(0, np.int64)
    table = held[first, :-1]
    lengths = (table > 0).sum(1)
    pairs = np.unique((table[lengths > 1, 0] << _WORD_BITS) | table[lengths > 1, 1]) if width > 1 else np.zeros(0, np.int64)
    whole = Stretches.of([x for x in texts if len(x[2]) >= width], width)
    return Probe(words, table, lengths, np.append(first, len(held)), held[:, -1], names, pairs, np.unique(table[lengths == 1, 0]), whole)


def suffix_array(ids: np.ndarray, probe: Probe) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in ids whose suffixes could start with a test window, in the order of their first words; their keys; windows to look up."""
    n, width = len(ids), probe.windows.shape[1]
    follow = np.append(ids[1:], 0)
    pair = (ids << _WORD_BITS) | follow
    start = np.flatnonzero(ids)
    keep = np.zeros(len(start), bool)
    seen = np.zeros(len(probe.pairs) + 1, bool)
    if len(probe.pairs):
        k = np.minimum(np.searchsorted(probe.pairs, pair[start]), len(probe.pairs) - 1)
        keep |= probe.pairs[k] == pair[start]
        seen[k[keep]] = True
    if len(probe.singles):
        keep |= np.isin(ids[start], probe.singles)
        seen[-1] = True
    start = start[keep]
    padded = np.append(ids, np.zeros(width, ids.dtype))
    keys = packed(padded[start[:, None] + np.arange(width)])
    order = np.lexsort(keys.T[::-1])
    return start[order], keys[order], np.flatnonzero(seen[probe.pair_of])


def _bound(keys: np.ndarray, want: np.ndarray, or_equal: bool = False) -> np.ndarray:
    """For each wanted key the number of sorted keys before it (or equal): one binary search for all at once."""
    lo, hi = np.zeros(len(want), np.int64), np.full(len(want), len(keys), np.int64)
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) >> 1
        a, b = keys[mid], want[open_]
        before, same = np.zeros(len(open_), bool), np.ones(len(open_), bool)
        for c in range(keys.shape[1]):
            before |= same & (a[:, c] < b[:, c])
            same &= a[:, c] == b[:, c]
        if or_equal:
            before |= same
        lo[open_] = np.where(before, mid + 1, lo[open_])
        hi[open_] = np.where(before, hi[open_], mid)
    return lo


def occurrences(ids: np.ndarray, probe: Probe) -> tuple[np.ndarray, np.ndarray]:
    """(window, place in ids) for each place where a test window stands, by binary search in a suffix array."""
    start, keys, asked = suffix_array(ids, probe)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    least, most = probe.bounds
    lo, hi = _bound(keys, least[asked]), _bound(keys, most[asked], or_equal=True)
    n = hi - lo
    window = np.repeat(asked, n)
    return window, start[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]


def _holders(window: np.ndarray, doc: np.ndarray, n: int, probe: Probe) -> Iterator[tuple[int, int, list[list[str]]]]:
    """For ranges of the n texts, the items that hold their windows. A window counts once in a text, so a text lists each place of the benchmark once at most."""
    seen = np.unique(doc * len(probe.windows) + window)
    doc, window = seen // max(1, len(probe.windows)), seen % max(1, len(probe.windows))
    lo = np.searchsorted(doc, np.arange(n + 1))
    size = np.append(0, np.cumsum(np.diff(probe.first)[window]))
    for a, b in in_chunks((size[lo[1:]] - size[lo[:-1]] + 1).tolist(), _LISTED):
        out = []
        for d in range(a, b):
            own = window[lo[d] : lo[d + 1]]
            some = np.unique(np.concatenate([probe.holders[probe.first[w] : probe.first[w + 1]] for w in own.tolist()])) if len(own) else ()
            out.append([probe.names[k] for k in some])
        yield a, b, out


#: Words, place in the text, item and place in the item of a text's longest match.
Match = tuple[int, int, str, int]


def _longest(ids: np.ndarray, window: np.ndarray, at: np.ndarray, width: int, probe: Probe) -> Match | None:
    """The longest match of a text, from where windows stand in it: of those of a full window what goes on alike, else the longest shorter item."""
    full = np.unique(at[probe.lengths[window] == width])
    if len(full):
        best, reach = None, int(probe.stretches.before.max(initial=0)) + width
        for lo in range(0, len(full), _BLOCK):
            own = full[lo : lo + _BLOCK]
            part = ids[own[0] : own[-1] + reach]
            found = probe.stretches.longest(part, own - own[0])
            if found and (best is None or found[0] > best[0]):
                best = (found[0], found[1] + int(own[0]), probe.names[found[2]], found[3])
        return best
    if not len(at):
        return None
    k = np.lexsort((probe.holders[probe.first[window]], at, -probe.lengths[window]))[0]
    return int(probe.lengths[window[k]]), int(at[k]), probe.names[probe.holders[probe.first[window[k]]]], 0


def _chunks(batch: pa.RecordBatch, probe: Probe, width: int):
    """Of each part of a batch: its range of rows, their sizes and begins in words, the hit words, each row's items and its longest match."""
    get = probe.words.get
    texts = utf8(batch.column(batch.num_columns - 1))
    for lo, hi in in_chunks([len(t) for t in texts]):
        words = [t.translate(ALNUM).split() for t in texts[lo:hi]]
        size = np.array([len(w) for w in words], np.int64)
        begin = np.cumsum(size + width) - size - width  # width zeros between texts: no match crosses
        ids = np.zeros(int(begin[-1] + size[-1]), np.int64)
        for b, w in zip(begin.tolist(), words, strict=True):
            ids[b : b + len(w)] = [get(x, 0) for x in w]
        del words
        window, at = occurrences(ids, probe)
        cover = np.zeros(len(ids) + 1, np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + probe.lengths[window], -1)
        hits = np.cumsum(cover[:-1]) > 0
        order = np.argsort(at, kind="stable")
        window, at = window[order], at[order]
        doc = np.searchsorted(begin, at, "right") - 1
        part = np.searchsorted(doc, np.arange(hi - lo + 1))
        for a, b, held in _holders(window, doc, hi - lo, probe):
            best = [_longest(ids[begin[d] : begin[d] + size[d]], window[part[d] : part[d + 1]], at[part[d] : part[d + 1]] - begin[d], width, probe) if held[d - a] else None for d in range(a, b)]
            yield lo + a, lo + b, size[a:b], begin[a:b], hits, held, best


def _item_columns(held: list[list[str]]) -> list[pa.Array]:
    return [
        pa.array([len(x) for x in held], pa.int64()), pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in held], pa.string()),
        pa.array(held, pa.list_(pa.string())),
    ]


def _match_columns(best: list[Match | None]) -> list[pa.Array]:
    """Words, item, place in the text and place in the item of each row's longest match."""
    n, p, name, q = zip(*(x or (0, None, None, None) for x in best), strict=True) if best else ([], [], [], [])
    return [pa.array(n, pa.int64()), pa.array(name, pa.string()), pa.array(p, pa.int64()), pa.array(q, pa.int64())]


_NAMES = ["n_words", "n_hit", "n_items", "items_sha256", "items", "longest_match", "match_item", "match_start", "match_item_start"]
_MATCH = pa.struct([("n", pa.int64()), ("p", pa.int64()), ("item", pa.string()), ("q", pa.int64())])


def _search(probe_of, width: int):
    """Rows with their counts, from one probe that holds the whole benchmark."""

    @freeing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, size, begin, hits, held, best in _chunks(batch, probe_of.value, width):
                hit = np.append(0, np.cumsum(hits))
                n_hit = hit[begin + size] - hit[begin]
                more = [pa.array(size), pa.array(n_hit), *_item_columns(held), *_match_columns(best)]
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in batch.columns[:-1]), *more], [*batch.schema.names[:-1], *_NAMES])

    return rows


def _round(probe_of, width: int):
    """Over rows (r, text): of those with hits, the ranges of hit words (begin, end, begin, ...), the items and the longest match of one round."""

    @freeing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, size, begin, hits, held, best in _chunks(batch, probe_of.value, width):
                some = [d for d in range(hi - lo) if held[d]]
                spans = [np.flatnonzero(np.diff(np.concatenate([[0], hits[b : b + n].view(np.int8), [0]]))) for b, n in zip(begin[some], size[some], strict=True)]
                met = [dict(zip(("n", "p", "item", "q"), best[d], strict=True)) if best[d] else None for d in some]
                columns = [batch.column(0).slice(lo, hi - lo).take(pa.array(some, pa.int64())), pa.array(spans, pa.list_(pa.int64())), pa.array([held[d] for d in some], pa.list_(pa.string())), pa.array(met, _MATCH)]
                yield pa.RecordBatch.from_arrays(columns, ["r", "spans", "found", "met"])

    return rows


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = [len(t.translate(ALNUM).split()) for t in utf8(batch.column(batch.num_columns - 1))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n, pa.int64())], [*batch.schema.names[:-1], "n_words"])


def _merge():
    """Over rows whose last columns are n_words and the rounds' spans, items and longest matches: the counts over all rounds."""

    @freeing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            n_hit, held, best = [], [], []
            for rounds, found, met in zip(*(batch.column(batch.num_columns - k).to_pylist() for k in (3, 2, 1)), strict=True):
                total = end = 0
                for lo, hi in sorted((s[k], s[k + 1]) for s in rounds or () for k in range(0, len(s), 2)):
                    total += max(0, hi - max(lo, end))
                    end = max(end, hi)
                n_hit.append(total)
                held.append(sorted({x for items in found or () for x in items}))
                best.append(min(((m["n"], m["p"], m["item"], m["q"]) for m in met or ()), key=lambda x: (-x[0], *x[1:]), default=None))
            more = [batch.column(batch.num_columns - 4), pa.array(n_hit, pa.int64()), *_item_columns(held), *_match_columns(best)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-4], *more], [*batch.schema.names[:-4], *_NAMES])

    return rows


def _pieces(width: int):
    """Over rows (item, text): the items' words in pieces that overlap so far that each window is in one, with the text's number and the words before."""
    kind = pa.schema([("item", pa.string()), ("u", pa.int64()), ("before", pa.int64()), ("t", pa.string()), ("n", pa.int64())])

    @freeing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                words = text.translate(ALNUM).split()
                unit = xxhash.xxh3_64_intdigest(b"%s %s" % (str(item).encode(), b" ".join(words))) - (1 << 63)
                last = max(1, len(words) - width + 1) if words else 0
                for lo in range(0, last, PIECE_WORDS):
                    part = words[lo : lo + PIECE_WORDS + width - 1]
                    yield pa.RecordBatch.from_pydict({"item": [item], "u": [unit], "before": [lo], "t": [b" ".join(part).decode()], "n": [len(part)]}, kind)

    return rows


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = 13,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """How far each row repeats the benchmark verbatim.

    Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text with A-Z lower-cased. A
    window is width consecutive words of an item (an item of fewer words, but not none,
    is one window). Each task keeps its texts as shards of some MB with a suffix array
    of the places where a test suffix could begin, and looks every test suffix up by
    binary search. A word inside a window's occurrence is hit. Returns the id, n_words,
    n_hit, n_items (items with such windows), items_sha256 (of their ids as text,
    sorted, comma-joined), items (those ids), contaminated (n_hit > 0 and 20 * n_hit >=
    n_words), the columns named in carry, and the longest verbatim match of a window or more
    with one item: longest_match (words, 0 for none), match_item, match_start and match_item_start
    (words before it in the text and in the item; of equally long ones the first in the text,
    then by id as text and the first in the item).

    A benchmark of over ROUND_WORDS words is dealt by a hash to rounds of about so many,
    each broadcast and searched in turn, and their hit words, items and longest matches are merged for
    each row. No more than a round is in memory at once. An item stays in one round; one of over ROUND_WORDS
    words is cut into parts of so many, and a longest match with it is told within such a part.
    What a text holds in memory grows with its own words only, however often they stand in items.
    A null or empty text has no words and no hits; items without words never match;
    items of one id count once; a null item_id is the id None. Repeated rows and null ids are rows like any other; an
    empty table on either side is defined. Very long texts are searched whole. Other columns are not read.
    """
    tune(docs.sparkSession)
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("t"))
    pieces = checkpointed(items.mapInArrow(_pieces(width), "item string, u long, before long, t string, n long").distinct())
    rounds = -(-(pieces.agg(F.sum("n")).first()[0] or 0) // ROUND_WORDS)
    number = F.pmod(F.xxhash64("item", "u", F.floor(F.col("before") / ROUND_WORDS)), F.lit(max(1, rounds)))

    def probe(k: int):
        part = [(str(i), u, before, t) for i, u, before, t in pieces.where(number == k).select("item", "u", "before", "t").collect()]  # about ROUND_WORDS
        return spark.sparkContext.broadcast(build_probe(part, width))

    carried = [F.col(c).alias(f"c{k}") for k, c in enumerate(carry)]
    rows = docs.select(F.col(id_col).alias("id"), *carried, F.col(text_col).cast("string").alias("t"))
    fields = rows.schema.fields[:-1]
    more = "n_words long, n_hit long, n_items long, items_sha256 string, items array<string>, longest_match long, match_item string, match_start long, match_item_start long"
    if rounds <= 1:
        out = rows.mapInArrow(_search(probe(0), width), with_fields(fields, more))
    else:
        rows = checkpointed(rows.select(F.monotonically_increasing_id().alias("r"), "*"))
        merged = None
        for k in range(rounds):
            now = probe(k)
            found = checkpointed(rows.select("r", "t").mapInArrow(_round(now, width), "r long, spans array<long>, found array<string>, met struct<n: long, p: long, item: string, q: long>"))
            now.destroy()
            merged = found if merged is None else merged.unionAll(found)
        merged = merged.groupBy("r").agg(F.collect_list("spans").alias("spans"), F.collect_list("found").alias("found"), F.collect_list("met").alias("met"))
        out = rows.mapInArrow(_count_words, with_fields([T.StructField("r", T.LongType()), *fields], "n_words long")).join(merged, "r", "left").drop("r")
        out = out.mapInArrow(_merge(), with_fields(fields, more))
    flag = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    carried = [F.col(f"c{k}").alias(c) for k, c in enumerate(carry)]
    return out.select(F.col("id").alias(id_col), *carried, "n_words", "n_hit", "n_items", "items_sha256", "items", "longest_match", "match_item", "match_start", "match_item_start", flag.alias("contaminated"))
