"""Sum-of-squares packing against the tokenizer's library, the rule taken literally, and bounds of what packing can reach."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from siltline.llm import byte_bpe
from siltline.llm.best_fit import OpenBins, pack_whole
from siltline.llm.queries import op11_best_fit_packing

ODD = [
    "", " ", "a  b", "a   b", "x   y　 z", "\n\n a\t\tb ", "<|endoftext|>", "abc<|endoftext|>def  <|endoftext|", "été  à la  \n", "日本語 テキスト  です",
    "don't  I'll 've", "\x1c \x1d a", "a\u0085 b", "ab\x00 cd", "１２３ ٣ ½ x²", "ſ ﬁ ŉ ĳ ª º µ", "🙂 🙂  🙂", "    q", "a×b÷c, é. É1 é1a2", "word—. ï.", "x’s İ.a ſ.", "é   b", "﻿ x",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(byte_bpe.VOCABULARY))


def test_ids_are_the_librarys(spark, library):
    texts = ODD + [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    ids, begin = byte_bpe.ByteEncoder().encode(pa.array(texts).slice(0))
    for k, text in enumerate(texts):
        assert ids[begin[k] : begin[k + 1]].tolist() == library.encode(text, add_special_tokens=False).ids
    again, at = byte_bpe.ByteEncoder().encode(pa.array(["skipped é ", *texts]).slice(1))
    assert again.tolist() == ids.tolist() and at.tolist() == begin.tolist()


def test_places_by_the_rule():
    """Each item goes where the sum of squares, counted anew for every choice, is least."""
    rng, most = np.random.default_rng(3), 24
    bins, gaps = OpenBins(most), {}
    for size in rng.integers(1, most + 1, 400).tolist():
        sums = {}
        for g in sorted({g for g in gaps.values() if g >= size}):
            after = list(gaps.values())
            after[after.index(g)] = g - size
            sums[g] = sum(after.count(x) ** 2 for x in range(1, most))
        want = min(sums, key=lambda g: (sums[g], g)) if sums else most
        number, at = bins.place(size)
        assert gaps.get(number, most) == want and at == most - want
        gaps[number] = want - size


def packed(df, text_of, library, most, end_id=0):
    """Checks every rule of the result and returns the number of sequences and the ids in all."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in df.collect():
        docs[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert docs.keys() == text_of.keys()
    total = 0
    for key, rows in docs.items():
        ids = [*library.encode(text_of[key] or "", add_special_tokens=False).ids, end_id]
        rows.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in rows] == list(range(-(-len(ids) // most)))
        assert [r["length"] for r in rows[1:]] == [most] * (len(rows) - 1)
        at = 0
        for r in rows:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
        total += at
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= most
    return len(sequences), total


def test_whole_table(spark, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    df = op11_best_fit_packing(spark, "/root/testdata/sf0.01")
    assert dict(df.dtypes) == {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"}
    n, total = packed(df, docs, library, 2048)
    assert n <= -(-total // 2048) + 3


def test_odd_rows(spark, library):
    """Null, empty and very long texts, texts of exactly the size, ties, clashing names, several groups and tasks."""
    words = " word" * 2047
    texts = [None, *ODD, "x " * 20000, words, words + " word", "tie", "tie", " a" * 5000] + ["text %d" % k * (k % 90) for k in range(300)]
    rows = [(k, t, "s", 1) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, part string, sequence_id int").repartition(5)
    n, total = packed(pack_whole(df, group=64), dict(enumerate(texts)), library, 2048)
    assert n <= total / 2048 + 8
    n, _ = packed(pack_whole(df.withColumnRenamed("doc_id", "id").withColumnRenamed("id", "doc_id"), most=64, group=100), dict(enumerate(texts)), library, 64)


def test_repeated_and_null_ids_and_no_rows(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (7, "c"), (7, "c")], "doc_id long, text string")
    got = pack_whole(df).collect()
    assert sorted((str(r["doc_id"]), r["length"]) for r in got) == [("7", 2), ("7", 2), ("None", 3), ("None", 3)]
    assert sorted(r["offset"] for r in got) == [0, 3, 6, 8] and len({r["sequence_id"] for r in got}) == 1
    assert pack_whole(df.where("doc_id = 1")).collect() == []
