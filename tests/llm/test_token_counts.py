import pytest
from tokenizers import Tokenizer

from siltline.llm import bpe
from siltline.llm.token_counts import token_counts

ODD = [
    "", " ", "\n\t\r", "a", "It's Done, DON'T!", "<|endoftext|>", "x<|startoftext|>y <|endoftext|> z", "< |endoftext|>", "über Straße ÉCOLE İstanbul ſ ß",
    "é Å ﬁ Ⅷ ²", "中文字 かな 한글", "🙂🙂 👩‍👩‍👧 ‍", "a b c d\u0085e\x1cf\x0bg", "\x00\x01 a\x7f", "12345 6,789.0 3rd", "___ --- !!! ...", "word " * 3000, "z" * 5000, "<|" * 50, "naïve café; a.b,c",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.vocabulary_path())


def test_whole_tokens_encode_alone(library):
    whole = bpe.whole_tokens(bpe.vocabulary_path())
    assert len(whole) > 10_000
    for word in ["the", "language", "and"]:
        assert library.encode(word, add_special_tokens=False).ids == [whole[word]]


def test_ids_equal_the_library(library):
    import pyarrow as pa

    encoder = bpe.ChunkEncoder(bpe.vocabulary_path(), bpe.whole_tokens(bpe.vocabulary_path()))
    for _ in range(2):  # the second time from memory
        ids, at = encoder.encode(pa.array(ODD))
        for k, text in enumerate(ODD):
            assert ids[at[k] : at[k + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_small_memories_change_nothing(library, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(bpe, "MEMORY_BYTES", 700)
    encoder = bpe.ChunkEncoder(bpe.vocabulary_path(), bpe.whole_tokens(bpe.vocabulary_path()))
    assert encoder.count(pa.array(ODD)).tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in ODD]


def test_counts_of_all_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r["doc_id"]: r for r in token_counts(docs).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        n = len(library.encode(r["text"] or "", add_special_tokens=False).ids)
        assert (got[r["doc_id"]]["n_bytes"], got[r["doc_id"]]["n_tokens"], got[r["doc_id"]]["over_limit"]) == (len((r["text"] or "").encode()), n, n > 2048)


def test_odd_rows(spark, library):
    rows = [(k, t, 7) for k, t in enumerate(ODD)] + [(None, None, 1), (None, "twice here", 1), (0, "", 1), (1, "a", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in token_counts(docs).collect())
    assert got == sorted((str(k), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for k, t, _ in rows)
    assert token_counts(docs.limit(0)).count() == 0
