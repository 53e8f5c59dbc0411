import struct
import zlib
from collections import defaultdict

from tokenizers import Tokenizer

from siltline.llm import bpe
from siltline.llm.packing import binary_lengths, pack


def verify(docs, pieces):
    """Whether the pieces are what the texts of docs [(id, text)] must give."""
    library = Tokenizer.from_file(bpe.vocabulary_path())
    want = sorted((str(k), [*library.encode(t or "", add_special_tokens=False).ids, 1]) for k, t in docs)
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[str(p["doc_id"]), p["doc_tokens"]].append(p)
    cut = []
    for k, ids in want:
        own = by_doc[k, len(ids)]
        at = 0
        for n in binary_lengths(len(ids), 2048):
            crc = zlib.crc32(struct.pack(f"<{n}I", *ids[at : at + n]))
            p = next(p for p in own if (p["start"], p["length"], p["ids_crc32"]) == (at, n, crc))
            own.remove(p)
            cut.append(p)
            at += n
    assert not any(by_doc.values())
    assert sorted(p["sequence_id"] for p in cut) == list(range(len(cut)))
    assert {p["offset"] for p in cut} <= {0}
    order = sorted(cut, key=lambda p: p["sequence_id"])
    assert [p["length"] for p in order] == sorted(p["length"] for p in order)  # bucket after bucket


def test_binary_lengths():
    assert binary_lengths(1, 8) == [1]
    assert binary_lengths(23, 8) == [8, 8, 4, 2, 1]
    assert binary_lengths(16, 8) == [8, 8]
    assert all(sum(binary_lengths(n, 2048)) == n for n in range(1, 5000, 7))


def test_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    verify([(r["doc_id"], r["text"]) for r in docs.collect()], pack(docs).collect())


def test_odd_rows(spark):
    rows = [(1, "a b c", 5), (1, "a b c", 5), (None, None, 5), (None, "x", 5), (2, "", 5), (3, "word " * 9000, 5), (4, "<|endoftext|> é", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    verify([r[:2] for r in rows], pack(docs).collect())
    verify([r[:2] for r in rows], pack(docs.repartition(5)).collect())
    assert pack(docs.limit(0)).count() == 0
