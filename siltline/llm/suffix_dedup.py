"""Removal of long repeated byte strings, decided by a hash-compared suffix sort.

A suffix sort of everything at once would have to hold every suffix of the corpus,
so Spark first brings together what may be equal. Every window of `span` bytes
picks the `GRAM`-byte string in it with the least hash as its anchor: equal windows
hold equal anchors at the same place, so a window need be compared only with those of
equal anchors. Consecutive windows with one anchor form a piece. The pieces of an anchor
meet in one task with their bytes, each different one once, and their suffixes are sorted:
prefix polynomial hashes and binary search give the common extension of two suffixes, a
mergesort orders them, neighbours with `span` common bytes repeat, and their bytes are
compared. Pieces that are equal as a whole are compared byte by byte with the one that is
sorted for them. Hashes only choose what is compared; no repeat rests on one.

An anchor with very many different pieces is divided: its pieces are cut anew by longer
anchors, so long that only equal windows share them in the end.

Passages of a number of words, whatever bytes they take, are found in the same way: each
word of a text becomes a code of `CODE` bytes, and the texts of codes are searched.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltline.llm.common import CHUNK_BYTES, freeing, in_chunks, mix64, tune, utf8

#: Bytes of an anchor.
GRAM = 128
#: Anchors with more different pieces than this are divided by longer anchors.
HOT = 2000
#: Different pieces sorted at once, in bytes; and pieces that a task remembers, in bytes.
SORT_BYTES, MEMORY_BYTES = 1 << 20, 16 << 20
#: Bytes of a word's code; and words whose codes a task remembers.
CODE, CODES = 8, 1 << 18
#: What separates words.
_GAP = re.compile(rb"[\x09-\x0D\x20]")
_IS_GAP = np.array([_GAP.match(bytes([c])) is not None for c in range(256)])

_BASE = 0x9E3779B97F4A7C15 | 1
_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n-1) modulo 2**64; grown as needed and kept."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        n = max(n, CHUNK_BYTES + (1 << 16))
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps)
    return have[:n]


class Hashes:
    """Prefix polynomial hashes of a buffer; equal strings have equal hashes wherever they stand."""

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        self.up = _power(_BASE, n + 1)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUES[buf] * _power(pow(_BASE, -1, 1 << 64), n + 1)[:n], out=self.prefix[1:])

    def of(self, at: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return (self.prefix[at + size] - self.prefix[at]) * self.up[at]


def _reach(pos: np.ndarray, val: np.ndarray, region: np.ndarray, lo: np.ndarray, hi: np.ndarray, wide: int):
    """For each candidate, the first and last window (of wide positions, inside lo..hi) whose leftmost least it is."""
    n, far = len(pos), np.int64(1) << 40
    before, after = np.full(n, -far), np.full(n, far)
    for step, bound, stops in ((-1, before, np.less_equal), (1, after, np.less)):
        active, t = np.arange(n), step
        while active.size:
            j = active + t
            ok = (j >= 0) & (j < n)
            active, j = active[ok], j[ok]
            ok = (region[j] == region[active]) & (np.abs(pos[j] - pos[active]) < wide)
            active, j = active[ok], j[ok]
            hit = stops(val[j], val[active])
            bound[active[hit]] = pos[j[hit]]
            active = active[~hit]
            t += step
    first = np.maximum(np.maximum(before + 1, pos - wide + 1), lo[region])
    last = np.minimum(np.minimum(pos, after - wide), hi[region])
    return first, last


def pieces(buf: np.ndarray, begin: np.ndarray, end: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, ...]:
    """The pieces of texts that stand in buf from begin to end: text, anchor hash, place of the anchor, first and last window."""
    wide = span - gram + 1
    empty = np.zeros(0, np.int64)
    if len(buf) < span:
        return empty, np.zeros(0, np.uint64), empty, empty, empty
    hashes = Hashes(buf)
    grams = (hashes.prefix[gram:] - hashes.prefix[:-gram]) * hashes.up[: len(buf) - gram + 1]
    few = np.flatnonzero(grams * np.uint64(0xD6E8FEB86659FD93) < np.uint64(1 << 60))  # one in 16, by content
    text = np.searchsorted(begin, few, "right") - 1
    ok = few <= end[text] - gram
    few, text = few[ok], text[ok]
    first, last = _reach(few, mix64(grams[few]), text, begin, end - span, wide)
    ok = first <= last
    few, text, first, last = few[ok], text[ok], first[ok], last[ok]
    # windows without such a candidate take the least of all their grams
    whole = np.flatnonzero(end - begin >= span)
    edge_text = np.concatenate([text, whole, whole])
    edge_lo = np.concatenate([first, begin[whole], end[whole] - span + 1])
    edge_hi = np.concatenate([last, begin[whole] - 1, end[whole] - span + 1])
    order = np.lexsort((edge_hi, edge_lo, edge_text))
    t, lo, hi = edge_text[order], edge_lo[order], edge_hi[order]
    gap = np.flatnonzero((t[1:] == t[:-1]) & (hi[:-1] + 1 < lo[1:]))
    if gap.size:
        gap_lo, gap_hi, gap_text = hi[gap] + 1, lo[gap + 1] - 1, t[gap]
        n = gap_hi - gap_lo + wide
        region = np.repeat(np.arange(len(n)), n)
        pos = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(gap_lo, n)
        g_first, g_last = _reach(pos, mix64(grams[pos]), region, gap_lo, gap_hi, wide)
        ok = g_first <= g_last
        few, text = np.concatenate([few, pos[ok]]), np.concatenate([text, gap_text[region[ok]]])
        first, last = np.concatenate([first, g_first[ok]]), np.concatenate([last, g_last[ok]])
    return text, mix64(grams[few]), few, first, last


def _parts(texts: list[bytes], span: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Buffers of some MB: the bytes, and for each text in it its number, begin, end and place in the whole text.

    A longer text is cut into parts that overlap by span - 1 bytes, so each window is in one of them.
    """
    for lo, hi in in_chunks([len(t) for t in texts]):
        if hi - lo == 1 and len(texts[lo]) > 2 * CHUNK_BYTES:
            for at in range(0, len(texts[lo]) - span + 1, CHUNK_BYTES):
                buf = np.frombuffer(texts[lo], np.uint8)[at : at + CHUNK_BYTES + span - 1]
                yield buf, np.array([lo]), np.array([0]), np.array([len(buf)]), np.array([at])
        else:
            size = np.array([len(t) for t in texts[lo:hi]], np.int64)
            ends = np.cumsum(size)
            yield np.frombuffer(b"".join(texts[lo:hi]), np.uint8), np.arange(lo, hi), ends - size, ends, np.zeros_like(size)


class Codes(dict):
    """The codes of words, as unsigned numbers: their XXH3. Of the words met since it was last full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CODES:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


def in_codes(texts: pa.Array) -> list[bytes]:
    """Each text of a column as the codes of its words, a long one read in parts; null counts as empty."""
    codes, out = Codes(), []
    for text in utf8(texts):
        own, at = [], 0
        while at < len(text):
            gap = _GAP.search(text, at + CHUNK_BYTES)
            end = gap.start() if gap else len(text)
            own.append(np.array([codes[w] for w in text[at:end].split()], np.uint64).tobytes())
            at = end
        out.append(b"".join(own))
    return out


def in_bytes(text: bytes, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words that spans of the text of codes cover stand in the text, and their bytes with what is between them."""
    gap = np.append(True, _IS_GAP[np.frombuffer(text, np.uint8)])
    gap = np.append(gap, True)
    begin, end = np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])
    whole = _covered(CODE * len(begin), at, size).reshape(-1, CODE).all(axis=1)
    edge = np.diff(np.concatenate([[False], whole, [False]]).astype(np.int8))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    return begin[first], end[last] - begin[first]


def _covered(n: int, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether spans cover each of n places."""
    cover = np.zeros(n + 1, np.int32)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + size, -1)
    return np.cumsum(cover[:-1]) > 0


class Seen:
    """The different strings a task has met, in two generations of bounded size: what is met often stays."""

    def __init__(self, most: int):
        self.most, self.held, self.now, self.old = most, 0, {}, {}

    def first(self, data: bytes, mine: list) -> list:
        """What was noted where data was first met, or mine, which is noted then."""
        found = self.now.get(data)
        if found is None:
            found = self.old.get(data, mine)
            self.now[data] = found
            self.held += len(data) + 200
            if self.held > self.most:
                self.old, self.now, self.held = self.now, {}, 0
        return found


class Rows:
    """Pieces on their way: anchor (any number for repeats that are settled), piece hash, text, place, size, and whether it is settled."""

    KINDS = {"g": pa.int64(), "p": pa.int64(), "r": pa.int64(), "at": pa.int32(), "size": pa.int32(), "known": pa.bool_()}

    def __init__(self, seen: Seen):
        self.seen, self.columns, self.spans = seen, {k: [] for k in self.KINDS}, {}

    def add(self, g: int, r: int, at: int, data: bytes) -> bool:
        """Notes a piece; False if an equal one has been met, which settles both."""
        mine = [r, at, False]
        found = self.seen.first(data, mine)
        if found is mine:
            for x, value in zip(self.columns.values(), (g, xxhash.xxh3_64_intdigest(data) - (1 << 63), r, at, len(data), False), strict=True):
                x.append(value)
            return True
        self.settled(r, at, len(data))
        if not found[2]:
            found[2] = True
            self.settled(found[0], found[1], len(data))
        return False

    def settled(self, r: int, at: int, size: int) -> None:
        spans = self.spans.setdefault(r, [])
        if spans and spans[-1][0] <= at <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], at + size)
        else:
            spans.append([at, at + size])

    def batch(self) -> dict[str, list]:
        """The columns so far, with settled spans under numbers that spread them over tasks; then empty again."""
        out, self.columns = self.columns, {k: [] for k in self.KINDS}
        for r, spans in self.spans.items():
            for lo, hi in spans:
                for x, value in zip(out.values(), (xxhash.xxh3_64_intdigest(b"%d %d" % (r, lo)) - (1 << 63), lo, r, lo, hi - lo, True), strict=True):
                    x.append(value)
        self.spans = {}
        return out


def _piece_rows(span: int, gram: int, read: Callable = utf8):
    """Over rows r, ..., text: their pieces; each different one of a task once, and spans that it has seen repeat."""

    @freeing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(Seen(MEMORY_BYTES))
        for batch in batches:
            r = batch.column(0).to_pylist()
            for buf, number, begin, end, shift in _parts(read(batch.column(batch.num_columns - 1)), span):
                text, a, _, first, last = pieces(buf, begin, end, span, gram)
                order = np.lexsort((first, text))
                text, a, first, last = text[order], a[order].view(np.int64), first[order], last[order] + span
                own, at, raw = number[text], first - begin[text] + shift[text], buf.tobytes()
                for g, d, k, x, y in zip(a.tolist(), own.tolist(), at.tolist(), first.tolist(), last.tolist(), strict=True):
                    out.add(g, r[d], k, raw[x:y])
                yield pa.RecordBatch.from_pydict(out.batch(), pa.schema(Rows.KINDS.items()))

    return rows


class SuffixSorter:
    """Suffixes of contexts in one buffer, compared by hashes in logarithmic time."""

    def __init__(self, buf: np.ndarray, hashes: Hashes):
        self.buf, self.hashes = buf, hashes

    def common(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The common extension of the suffixes at x and y, at most most, by binary search."""
        lo, hi = np.zeros_like(most), most.copy()
        while True:
            open_ = lo < hi
            if not open_.any():
                return lo
            mid = (lo + hi + 1) >> 1
            same = self.hashes.of(x, mid) == self.hashes.of(y, mid)
            lo, hi = np.where(open_ & same, mid, lo), np.where(open_ & ~same, mid - 1, hi)

    def less(self, x: np.ndarray, y: np.ndarray, x_end: np.ndarray, y_end: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Whether the suffix at x is before that at y, or as ties where they are equal."""
        most = np.minimum(x_end - x, y_end - y)
        n = self.common(x, y, most)
        inside = n < most
        last = len(self.buf) - 1
        cx, cy = self.buf[np.minimum(x + n, last)], self.buf[np.minimum(y + n, last)]
        size = (x_end - x) - (y_end - y)
        return np.where(inside, cx < cy, (size < 0) | ((size == 0) & ties))

    def sort(self, x: np.ndarray, end: np.ndarray, group: np.ndarray) -> np.ndarray:
        """The order of the suffixes at x in each group (groups stand together): a mergesort of all groups at once."""
        n = len(x)
        order = np.arange(n)
        begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        size = np.diff(np.append(begin, n))
        g0, gs = np.repeat(begin, size), np.repeat(size, size)
        width = 1
        while n and width < size.max():
            i = np.flatnonzero(gs > width)
            rank = i - g0[i]
            block = rank // width
            lo = sib = np.minimum(g0[i] + (block ^ 1) * width, g0[i] + gs[i])
            hi = np.minimum(sib + width, g0[i] + gs[i])
            own, right = order[i], (block & 1) == 1
            while (open_ := np.flatnonzero(lo < hi)).size:
                mid = (lo[open_] + hi[open_]) >> 1
                other, mine = order[mid], own[open_]
                before = self.less(x[other], x[mine], end[other], end[mine], right[open_])
                lo, hi = lo.copy(), hi.copy()
                lo[open_] = np.where(before, mid + 1, lo[open_])
                hi[open_] = np.where(before, hi[open_], mid)
            order[g0[i] + (block >> 1) * 2 * width + rank - block * width + lo - sib] = own
            width *= 2
        return order


def repeated_windows(contexts: list[bytes], group: np.ndarray, span: int) -> list[tuple[int, int, int]]:
    """(context, first, last) for each run of windows that some other window of the same group equals."""
    size = np.array([len(c) for c in contexts], np.int64)
    begin = np.cumsum(size) - size
    buf = np.frombuffer(b"".join(contexts), np.uint8)
    hashes = Hashes(buf)
    n = size - span + 1
    owner = np.repeat(np.arange(len(n)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + begin[owner]
    end = (begin + size)[owner]
    key = mix64(hashes.of(at, span) ^ mix64(group[owner].astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    new = np.append(True, key[order][1:] != key[order][:-1])
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(order)))
    class_first, class_last = np.empty_like(at), np.empty_like(at)
    class_first[order], class_last[order] = np.repeat(order[head], count), np.repeat(order[head + count - 1], count)
    # a window whose hash no other has equals no other; the rest is proved by sorting
    open_ = class_first != class_last
    proved = np.zeros(len(at), bool)
    sorter = SuffixSorter(buf, hashes)
    while open_.any():
        first = open_.copy()
        first[1:] &= ~(open_[:-1] & (owner[1:] == owner[:-1]))
        heads = np.flatnonzero(first)
        partner = np.where(class_first[heads] != heads, class_first[heads], class_last[heads])
        front = np.unique(np.concatenate([heads, partner]))
        front = front[np.argsort(group[owner[front]], kind="stable")]
        g = group[owner[front]]
        front = front[sorter.sort(at[front], end[front], g)]
        x, y = front[:-1], front[1:]
        ok = g[1:] == g[:-1]
        x, y = x[ok], y[ok]
        common = sorter.common(at[x], at[y], np.minimum(end[x] - at[x], end[y] - at[y]))
        ok = common >= span
        x, y, common = x[ok], y[ok], common[ok]
        raw = buf.tobytes()
        same = np.array([raw[i : i + c] == raw[j : j + c] for i, j, c in zip(at[x].tolist(), at[y].tolist(), common.tolist(), strict=True)], bool)
        x, y, common = x[same], y[same], common[same]
        cover = np.zeros(len(at) + 1, np.int64)
        for z in (x, y):
            np.add.at(cover, z, 1)
            np.add.at(cover, z + common - span + 1, -1)
        proved |= np.cumsum(cover[:-1]) > 0
        odd = heads[~proved[heads]]
        for h in odd.tolist():  # two strings with one hash: compare the bytes of all with that hash
            mates = order[np.searchsorted(key[order], key[h]) :]
            mates = mates[: np.searchsorted(key[mates], key[h], "right")]
            own = raw[at[h] : at[h] + span]
            proved[h] = any(m != h and raw[at[m] : at[m] + span] == own for m in mates.tolist())
        open_ &= ~proved
        open_[odd] = False
    runs = []
    hit = np.flatnonzero(proved)
    if hit.size:
        cut = np.flatnonzero((np.diff(hit) != 1) | (owner[hit][1:] != owner[hit][:-1]))
        for lo, hi in zip(hit[np.append(0, cut + 1)].tolist(), hit[np.append(cut, len(hit) - 1)].tolist(), strict=True):
            o = owner[lo]
            runs.append((int(o), int(at[lo] - begin[o]), int(at[hi] - begin[o])))
    return runs


_CONTEXT = {"g": pa.int64(), "p": pa.int64(), "r": pa.int64(), "at": pa.int32(), "size": pa.int32(), "data": pa.binary()}


def _contexts(span: int, gram: int, hot: int, read: Callable = utf8):
    """Over rows r, ..., text, and their pieces: the pieces with their bytes, those of busy anchors cut by longer ones, and settled spans without bytes."""

    @freeing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        again = Rows(Seen(MEMORY_BYTES))
        for batch in batches:
            texts, wanted = read(batch.column(batch.num_columns - 2)), batch.column(batch.num_columns - 1)
            counts = wanted.value_lengths().to_numpy()
            flat = wanted.flatten()
            own = np.repeat(np.arange(len(batch)), counts).tolist()
            r, fields = batch.column(0).to_pylist(), [flat.field(k).to_pylist() for k in ("g", "p", "at", "size", "known", "v")]
            out: dict[str, list] = {k: [] for k in _CONTEXT}
            held = 0
            for d, g, p, at, size, known, v in zip(own, *fields, strict=True):
                data = None if known else texts[d][at : at + size]
                if v > hot and not known:
                    longer = span - ((span - gram) >> (v // hot).bit_length())
                    _divide(again, out, g, r[d], at, data, span, longer)
                else:
                    for x, value in zip(out.values(), (g, p, r[d], at, size, data), strict=True):
                        x.append(value)
                held += size
                if held > CHUNK_BYTES:
                    yield _packed(out, again)
                    out, held = {k: [] for k in _CONTEXT}, 0
            yield _packed(out, again)

    return rows


def _divide(again: Rows, out: dict[str, list], g: int, r: int, at: int, data: bytes, span: int, gram: int) -> None:
    """Adds the pieces of a piece under longer anchors; equal windows of one anchor share the longer one too."""
    buf = np.frombuffer(data, np.uint8)
    _, a, _, first, last = pieces(buf, np.array([0]), np.array([len(buf)]), span, gram)
    a = mix64(a ^ mix64(np.full(len(a), g, np.int64).view(np.uint64))).view(np.int64)
    for h, x, y in zip(a.tolist(), first.tolist(), (last + span).tolist(), strict=True):
        if again.add(h, r, at + x, data[x:y]):
            row = {k: column.pop() for k, column in again.columns.items()} | {"data": data[x:y]}
            for k, column in out.items():
                column.append(row[k])


def _packed(out: dict[str, list], again: Rows) -> pa.RecordBatch:
    """Contexts and what has been settled meanwhile."""
    more = again.batch()
    columns = {k: out[k] + (more[k] if k != "data" else [None] * len(more["r"])) for k in _CONTEXT}
    return pa.RecordBatch.from_pydict(columns, pa.schema(_CONTEXT.items()))


def _windows(span: int):
    """Over contexts: each window by itself, under a number of its own string."""

    @freeing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        again = Rows(Seen(MEMORY_BYTES))
        for batch in batches:
            for k in range(len(batch)):
                g, _, r, at, size, data = (c[k].as_py() for c in batch.columns)
                out: dict[str, list] = {k: [] for k in _CONTEXT}
                if data is None:
                    again.settled(r, at, size)
                else:
                    _divide(again, out, g, r, at, data, span, span)
                yield _packed(out, again)

    return rows


def _resolve(span: int):
    """Over contexts with those of an anchor together: the spans that repeat."""

    @freeing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = Rows(Seen(0))
        group, contexts, where, total = [], [], [], 0
        now, heads = None, {}

        def settle() -> None:
            # an anchor with one piece has nothing to sort: its copies are compared already
            n = {}
            for g in group:
                n[g] = n.get(g, 0) + 1
            take = [k for k, g in enumerate(group) if n[g] > 1]
            if take:
                ids = {g: k for k, g in enumerate(dict.fromkeys(group))}
                numbers = np.array([ids[group[k]] for k in take], np.int64)
                for o, lo, hi in repeated_windows([contexts[k] for k in take], numbers, span):
                    r, at = where[take[o]]
                    spans.settled(r, at + lo, hi - lo + span)

        for batch in batches:
            for g, r, at, size, data in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4, 5)), strict=True):
                if data is None:
                    spans.settled(r, at, size)
                    continue
                if g != now:
                    if total >= SORT_BYTES:
                        settle()
                        group, contexts, where, total = [], [], [], 0
                    now, heads = g, {}
                mine = [r, at, False]
                head = heads.setdefault(data, mine)
                if head is mine:
                    group.append(g)
                    contexts.append(data)
                    where.append((r, at))
                    total += size
                else:
                    spans.settled(r, at, size)
                    if not head[2]:
                        head[2] = True
                        spans.settled(head[0], head[1], size)
            out = spans.batch()
            yield pa.RecordBatch.from_arrays([pa.array(out[k], Rows.KINDS[k]) for k in ("r", "at", "size")], ["r", "at", "size"])
        settle()
        out = spans.batch()
        yield pa.RecordBatch.from_arrays([pa.array(out[k], Rows.KINDS[k]) for k in ("r", "at", "size")], ["r", "at", "size"])

    return rows


def repeated_spans(placed: DataFrame, span: int, gram: int, hot: int, read: Callable = utf8) -> DataFrame:
    """(r, at, size) of the strings that repeat in the texts of placed, as read gives them: r first, the text last, dealt out by r."""
    piece = "g long, p long, r long, at int, size int"
    own, within = Window.partitionBy("g"), Window.partitionBy("g").orderBy("p")

    def varied(rows: DataFrame) -> DataFrame:
        """Adds n, the rows of an anchor, and v, its different pieces."""
        return rows.withColumn("_d", F.dense_rank().over(within)).withColumns({"v": F.max("_d").over(own), "n": F.count("*").over(own)}).drop("_d")

    found = varied(placed.mapInArrow(_piece_rows(span, gram, read), piece + ", known boolean")).where("known or n > 1")
    wanted = found.groupBy("r").agg(F.collect_list(F.struct("g", "p", "at", "size", "known", "v")).alias("wanted"))
    met = placed.join(wanted.withColumnRenamed("r", "_r"), F.col("r") == F.col("_r")).drop("_r")
    contexts = varied(met.mapInArrow(_contexts(span, gram, hot, read), piece + ", data binary"))
    cool = contexts.where(F.col("v") <= hot).drop("v", "n").mapInArrow(_resolve(span), "r long, at int, size int")
    busy = contexts.where(F.col("v") > hot).drop("v", "n").mapInArrow(_windows(span), piece + ", data binary")
    return cool.unionAll(busy.repartition("g").sortWithinPartitions("g").mapInArrow(_resolve(span), "r long, at int, size int"))


def _spans(spans: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Place and size of the spans of each row."""
    ends = np.cumsum(pc.fill_null(spans.value_lengths(), 0).to_numpy())
    flat = spans.flatten()
    at, size = flat.field("at").to_numpy().astype(np.int64), flat.field("size").to_numpy()
    for lo, hi in zip([0, *ends.tolist()], ends.tolist(), strict=False):
        yield at[lo:hi], size[lo:hi]


@freeing
def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that end with the text, its spans and those of its codes: n_bytes, n_removed, n_spans, kept_sha256 and what is kept instead."""
    for batch in batches:
        texts, spans, coded = batch.columns[-3:]
        n_bytes, removed, runs, digest, kept = [], [], [], [], []
        for text, (at, size), (coded_at, coded_size) in zip(utf8(texts), _spans(spans), _spans(coded), strict=True):
            rest, gone, n = text, 0, 0
            if len(coded_at):
                more_at, more_size = in_bytes(text, coded_at, coded_size)
                at, size = np.append(at, more_at), np.append(size, more_size)
            if len(at):
                out = _covered(len(text), at, size)
                gone = int(out.sum())
                n = int(out[0]) + int((out[1:] & ~out[:-1]).sum())
                rest = np.frombuffer(text, np.uint8)[~out].tobytes()
            n_bytes.append(len(text))
            removed.append(gone)
            runs.append(n)
            digest.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest.decode("utf-8", "ignore"))
        more = [*(pa.array(x, pa.int64()) for x in (n_bytes, removed, runs)), pa.array(digest, pa.string()), pa.array(kept, pa.string())]
        names = [*batch.schema.names[:-3], "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-3], *more], names)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 400, gram: int = GRAM, hot: int = HOT,
    carry: tuple[str, ...] = (), words: int | None = None,
) -> DataFrame:
    """Every row with the bytes of its text that no repeated string of span bytes covers.

    A byte goes if some string of span bytes over it also starts anywhere else: in
    another row or in the same text, overlaps counted, judged on the texts as given.
    Matches never cross rows. Where words is given, each word that is covered by a passage of so
    many words that also starts anywhere else goes as well, whatever bytes the passage takes and
    white space (ASCII) is in it, and so does what is between two such words; words count as the
    same where their 64-bit codes are, and a text of over 2**28 words is refused. Returns a struct key (the id and the columns named in carry, as
    they are) and n_bytes, n_removed, n_spans (runs of removed bytes), kept_sha256 (hex, of the
    remaining bytes) and kept_text: what remains, without characters that were cut in half.

    Rows are told apart by a number given where texts are dealt out, not by their ids: docs must come in
    the same order when a lost part is read again, as tables do; checkpoint what a shuffle has made. A null
    text counts as empty. Rows that repeat as a whole, or under one id or a null id, are
    rows of their own and lose what they share. Texts shorter than span keep
    everything. An empty table gives no rows. Very long texts are read in parts.
    """
    tune(docs.sparkSession)
    if not 1 <= gram <= span:
        raise ValueError("gram must be from 1 to span")
    if words is not None and words < 1:
        raise ValueError("words must be 1 or more")
    placed = docs.select(
        F.monotonically_increasing_id().alias("r"), F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in (id_col, *carry))).alias("key"), F.col(text_col).cast("string").alias("t")
    ).repartition("r")  # texts are dealt out once; all three readers below use that
    found = repeated_spans(placed, span, gram, hot).withColumn("coded", F.lit(False))
    if words:
        passages = repeated_spans(placed, CODE * words, CODE * max(1, words * gram // span), hot, in_codes)
        found = found.unionAll(passages.withColumn("coded", F.lit(True)))
    kinds = {"spans": ~F.col("coded"), "passages": F.col("coded")}
    spans = found.groupBy(F.col("r").alias("_r")).agg(*(F.collect_list(F.when(own, F.struct("at", "size"))).alias(name) for name, own in kinds.items()))
    joined = placed.join(spans, F.col("r") == F.col("_r"), "left").select("key", "t", "spans", "passages")
    more = [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")] + [T.StructField(c, T.StringType()) for c in ("kept_sha256", "kept_text")]
    return joined.mapInArrow(_cut, T.StructType([placed.schema["key"], *more]))
