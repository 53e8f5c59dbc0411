"""Exact token ids of a word-end BPE vocabulary, with a whole-token shortcut.

White space never reaches the model and no special string holds any, so a text's
ids are those of its white-space-separated chunks, one after another. A chunk is
split into pre-tokens; a pre-token that is known to encode alone as one token
needs no merging, and only the rest is merged by the library.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from siltline.llm.common import in_chunks

VOCABULARY = "word_bpe_49k.json"
#: Bytes, about, in a generation of a worker's two memories, and of the longest string kept there. Bounds memory, never results.
MEMORY_BYTES, LONGEST = 28 << 20, 1 << 12
#: Text encoded at once, in bytes.
PART_BYTES = 4 << 20

#: Characters whose case mapping and normal form are the same in every library:
#: Latin, without those that change length or compose.
_PLAIN = regex.compile(r"[\x21-\x7E¡-įı-ž]+")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + k) for k, b in enumerate(rest)}


def whole_tokens(path: str) -> dict[str, int]:
    """The vocabulary strings that encode alone as exactly their own token.

    Each candidate is run through the library's whole encoding, so a string that
    the merges, the pre-tokenizer or the normalizer would change is left out.
    """
    tokenizer = Tokenizer.from_file(path)
    back = {c: b for b, c in _byte_letters().items()}
    out = {}
    for token, k in tokenizer.get_vocab(with_added_tokens=False).items():
        if not token.endswith("</w>"):
            continue
        try:
            text = bytes(back[c] for c in token[:-4]).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if text and tokenizer.encode(text, add_special_tokens=False).ids == [k]:
            out[text] = k
    return out


class _Memo(dict):
    """A memory of find's answers in two generations: what is asked often stays when it is full."""

    def __init__(self, find: Callable, most: int):
        super().__init__()
        self.find, self.most, self.held, self.old = find, most, 0, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.find(key)
        size = len(key) + len(value) + 200
        if size > LONGEST:
            return value
        if self.held + size > self.most:
            self.old, self.held = dict(self), 0
            self.clear()
        self.held += size
        self[key] = value
        return value


class ChunkEncoder:
    """Ids of white-space-separated chunks, as little-endian unsigned 32-bit numbers in bytes."""

    def __init__(self, path: str, whole: dict[str, int]):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        self.letters = _byte_letters()
        self.whole = {w: k.to_bytes(4, "little") for w, k in whole.items()}
        self.words = _Memo(self._word, MEMORY_BYTES)
        self.chunks = _Memo(self.encode_chunk, MEMORY_BYTES)

    def _word(self, word: str) -> bytes:
        ids = self.whole.get(word)
        if ids is not None:
            return ids
        if not word.isascii():
            word = "".join(map(self.letters.__getitem__, word.encode()))
        return array("I", [t.id for t in self.tokenize(word)]).tobytes()

    def encode_chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if not text:
            return b""
        if not (text.isprintable() if text.isascii() else _PLAIN.fullmatch(text)) or (
            b"<" in chunk and any(s in chunk for s in self.special)
        ):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        text = text.lower()
        if text.isalpha():
            return self.words[text]
        words = self.words
        if text[-1] in ".," and text[:-1].isalpha():
            return words[text[:-1]] + words[text[-1]]
        return b"".join([words[w] for w in self.split(text)])

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of whole texts, one after another, and where each text's begin (and the last end)."""
        chunks = pc.ascii_split_whitespace(texts)
        flat = chunks.flatten().dictionary_encode()
        known = [self.chunks[c] for c in flat.dictionary.cast(pa.binary()).to_pylist()]
        which = flat.indices.to_numpy()
        size = np.fromiter(map(len, known), np.int64, len(known)) >> 2
        ids = np.frombuffer(b"".join(known), "<u4")
        n = size[which]
        ends = np.concatenate([[0], np.cumsum(n)])
        begin = (np.cumsum(size) - size)[which]
        out = ids[np.repeat(begin - ends[:-1], n) + np.arange(ends[-1])]
        offsets = chunks.offsets.to_numpy().astype(np.int64)
        return out, ends[offsets - offsets[0]]

    def count(self, texts: pa.StringArray) -> np.ndarray:
        """The number of ids of each text."""
        chunks = pc.ascii_split_whitespace(texts)
        flat = chunks.flatten().dictionary_encode()
        known = [len(self.chunks[c]) >> 2 for c in flat.dictionary.cast(pa.binary()).to_pylist()]
        ends = np.concatenate([[0], np.cumsum(np.array(known, np.int64)[flat.indices.to_numpy()])])
        offsets = chunks.offsets.to_numpy().astype(np.int64)
        return np.diff(ends[offsets - offsets[0]])


def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts by the bytes of its second column; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
    return (batch.slice(lo, hi - lo) for lo, hi in in_chunks(sizes, PART_BYTES))


_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str, whole: dict[str, int]) -> ChunkEncoder:
    """One encoder for each vocabulary and Python worker."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path, whole)
    return _encoders[path]


def vocabulary_path(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)
