"""Exact token ids of a byte-level BPE vocabulary, remembered for chunks of text.

The vocabulary's pattern lets white space stand only at the head of a pre-token, and ends a run of
letters where something else follows. A text can so be cut before white space that follows something
else and after a word, and its ids are those of its chunks one after another, each different chunk
of a part encoded once. Cuts stand between characters whose class is sure; special strings stay in one chunk.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from tokenizers import Tokenizer

from siltline.llm.bpe import MEMORY_BYTES, _Memo

#: The vocabulary, and the same one as ranks, which another library merges faster.
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: What both libraries split alike: ASCII without control characters, and Latin letters. All else is left to the vocabulary's own.
_PLAIN = regex.compile(r"[\t\n\r\x20-\x7EÀ-ÖØ-öø-ſ]*")
_SPACE, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _after_wide_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each place is white space beyond ASCII, by its UTF-8 bytes."""
    a, b, c = (data[np.maximum(at - k, 0)] for k in (3, 2, 1))
    two = (b == 0xC2) & ((c == 0x85) | (c == 0xA0))
    three = ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80)) | ((a == 0xE2) & (b == 0x81) & (c == 0x9F))
    return two | three | ((a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)))


def _latin(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each place is a two-byte Latin letter."""
    b, c = data[np.maximum(at - 2, 0)], data[at - 1]
    return ((b == 0xC3) & (c != 0x97) & (c != 0xB7) & (c >= 0x80)) | (((b == 0xC4) | (b == 0xC5)) & (c >= 0x80))


def chunks(texts: pa.Array, special: Sequence[bytes] = ()) -> tuple[pa.Array, np.ndarray]:
    """The chunks of UTF-8 texts without nulls, one after another, and how many stand before each text (and in all)."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = texts.buffers()[2]
    data = np.frombuffer(whole, np.uint8)[offsets[0] : offsets[-1]] if whole else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    space, letter, wide = _SPACE[data], _LETTER[data], data >= 0x80
    bound = np.zeros(len(data) + 1, bool)
    bound[1:-1] = (space[1:] & ~space[:-1] & ~wide[:-1]) | (letter[:-1] & ~letter[1:] & ~wide[1:])
    at = np.flatnonzero(wide[:-1] & ~wide[1:] & ~letter[1:]) + 1  # after a character beyond ASCII
    bound[at] = np.where(space[at], ~_after_wide_space(data, at), _latin(data, at))
    for mark in special:
        held, k = data.tobytes(), -1
        while (k := held.find(mark, k + 1)) >= 0:
            bound[k + 1 : k + len(mark)] = False
    bound[offsets] = True
    bounds = np.flatnonzero(bound)
    parts = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    return parts, np.searchsorted(bounds, offsets)


def _words(chunks: pa.Array) -> np.ndarray:
    """Which chunks are one space and then Latin letters only: these stay apart however they are joined."""
    bounds = np.frombuffer(chunks.buffers()[1], np.int64)[chunks.offset : chunks.offset + len(chunks) + 1]
    if not len(chunks):
        return np.zeros(0, bool)
    data = np.frombuffer(chunks.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    head = np.append((data[:-1] >= 0xC3) & (data[:-1] <= 0xC5), False)
    at = np.flatnonzero(head) + 2
    head[at - 2] = _latin(data, at)
    sure = _LETTER[data] | head
    sure[1:] |= head[:-1]
    other = np.add.reduceat(~sure, bounds[:-1] - bounds[0], dtype=np.int64)
    return (data[bounds[:-1] - bounds[0]] == 32) & (other == 1) & (np.diff(bounds) > 1)


class ByteEncoder:
    """Ids of texts as the vocabulary's library gives them; special strings are its own ids."""

    def __init__(self, vocabulary: str = VOCABULARY, ranks: str = RANKS):
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        with open(public_tokenizers.path(ranks), "rb") as f:
            merged = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.merge = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merged, special_tokens={}).encode_ordinary
        self.width = np.zeros(max(merged.values()) + 1, np.int64)
        self.width[list(merged.values())] = [len(k) for k in merged]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = _Memo(self._chunk, MEMORY_BYTES)

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return array("I", self.merge(text)).tobytes()
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _each(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where those of each chunk begin and how many they are. Words are merged in one call and told apart by their bytes."""
        word = _words(chunks)
        words = chunks.filter(pa.array(word))
        bounds = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
        joined = words.buffers()[2].to_pybytes()[bounds[0] : bounds[-1]].decode() if len(words) else ""
        ids = np.array(self.merge(joined), np.uint32)
        ends = np.append(0, np.cumsum(self.width[ids]))
        split = np.searchsorted(ends, bounds - bounds[0])
        others = [self.known[c] for c in chunks.filter(pa.array(~word)).to_pylist()]
        size, begin = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        size[word], begin[word] = np.diff(split), split[:-1]
        size[~word] = n = np.fromiter(map(len, others), np.int64, len(others)) >> 2
        begin[~word] = len(ids) + np.cumsum(n) - n
        return np.concatenate([ids, np.frombuffer(b"".join(others), "<u4")]), begin, size

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of whole texts, one after another, and where each text's begin (and the last end)."""
        parts, first = chunks(texts, [s.encode() for s in self.special])
        flat = parts.dictionary_encode()
        ids, begin, size = self._each(flat.dictionary)
        which = flat.indices.to_numpy()
        n = size[which]
        ends = np.append(0, np.cumsum(n))
        return ids[np.repeat(begin[which] - ends[:-1], n) + np.arange(ends[-1])], ends[first]


_encoders: dict[tuple[str, str], ByteEncoder] = {}


def encoder(vocabulary: str = VOCABULARY, ranks: str = RANKS) -> ByteEncoder:
    """One encoder for each vocabulary and Python worker."""
    key = vocabulary, ranks
    if key not in _encoders:
        _encoders[key] = ByteEncoder(*key)
    return _encoders[key]
