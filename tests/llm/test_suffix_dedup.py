import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from siltline.llm import suffix_dedup
from siltline.llm.suffix_dedup import Hashes, SuffixSorter, remove_repeats, repeated_windows


def brute(texts, span):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[s : s + span] for d in data for s in range(len(d) - span + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for s in range(len(d) - span + 1):
            if seen[d[s : s + span]] > 1:
                gone[s : s + span] = True
        runs = sum(1 for i in range(len(d)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeéß") for _ in range(r.randint(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(30) for _ in range(4)]
    texts = [None, "", "x", "ab" * 60, "ab" * 60, "z" * 300, text(200)]
    for _ in range(30):
        parts = [text(r.randint(0, 20)) for _ in range(3)]
        texts.append(parts[0] + r.choice(passages)[r.randint(0, 9) :] + parts[1] + r.choice(passages)[: r.randint(30, 90)] + parts[2])
    base = text(60)
    for _ in range(12):
        k = r.randrange(len(base))
        texts.append(base[:k] + "#" + base[k + 1 :])
    return texts + [texts[8]] * 3


@pytest.mark.parametrize("seed,hot", [(1, 2000), (2, 2), (3, 1), (4, 2000)])
def test_equals_brute_force(spark, seed, hot):
    texts = corpus(seed)
    rows = [(k if k % 9 else None, t, "n", 1.5) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_bytes string, n double").repartition(3)
    got = remove_repeats(docs, span=40, gram=12, hot=hot)
    got = got.select("key.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    want = [(r[0], *b) for r, b in zip(rows, brute(texts, 40), strict=True)]
    assert Counter(map(tuple, got)) == Counter(want)


def test_kept_texts_and_carried_columns(spark):
    same = "é" * 30
    docs = spark.createDataFrame([(1, "a" + same + "b", "x"), (2, "cd" + same, "y"), (3, None, None)], "doc_id long, text string, lang string")
    got = remove_repeats(docs, span=25, gram=7, carry=("lang",))
    assert got.columns == ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
    assert sorted((*x["key"], x["kept_text"]) for x in got.collect()) == [(1, "x", "ab"), (2, "y", "cd"), (3, None, "")]


def test_long_texts_are_read_in_parts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 500)
    texts = corpus(4)
    texts.append("".join(texts[7:20]))
    from siltline.llm.suffix_dedup import _parts, pieces

    for buf, _, begin, end, _ in _parts([t.encode() for t in texts if t], 40):
        text, _, anchor, first, last = pieces(buf, begin, end, 40, 12)
        cover = np.zeros(len(buf) + 1, int)
        for a, b, p in zip(first, last, anchor, strict=True):
            cover[a : b + 1] += 1
            assert a <= p and p + 12 <= b + 40 and p + 12 <= a + 40 and p >= b
        want = np.zeros(len(buf) + 1, int)
        for b, e in zip(begin, end, strict=True):
            want[b : max(b, e - 39)] = 1
        assert (cover == want).all()


def test_suffix_order():
    r = random.Random(5)
    raw = bytes(r.choice(b"ab") for _ in range(300))
    buf = np.frombuffer(raw, np.uint8)
    x = np.arange(300)
    end = np.where(x < 150, 150, 300)
    group = (x >= 150).astype(np.int64)
    order = SuffixSorter(buf, Hashes(buf)).sort(x, end, group)
    want = sorted(range(150), key=lambda i: raw[i:150]) + sorted(range(150, 300), key=lambda i: raw[i:300])
    assert order.tolist() == want


def test_equal_hashes_are_verified(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_VALUES", np.full(256, 7, np.uint64))  # every string of a length collides
    contexts = [b"abcdefgh", b"abcdxxxx", b"zzzzzzzz"]
    runs = repeated_windows(contexts, np.array([1, 1, 1]), 4)
    got = {(o, k) for o, lo, hi in runs for k in range(lo, hi + 1)}
    assert got == {(0, 0), (1, 0), *((2, k) for k in range(5))}  # abcd in two, zzzz within itself


@pytest.mark.parametrize("hot", [1000, 1])
@pytest.mark.parametrize("collide", [False, True])
def test_every_branch_compares_bytes(monkeypatch, hot, collide):
    """The tasks' functions one after another, with all hashes equal: pieces, longer anchors and single windows."""
    if collide:
        monkeypatch.setattr(suffix_dedup, "_VALUES", np.full(256, 7, np.uint64))
        monkeypatch.setattr(suffix_dedup.xxhash, "xxh3_64_intdigest", lambda data: 1 << 63)
    r = random.Random(7)
    same = bytes(r.choice(b"abc") for _ in range(30))
    texts = [same, b"xy" + same[3:] + b"z", same[:20] + b"q" + same[20:], bytes(r.choice(b"abc") for _ in range(40)), same]
    span, gram = 12, 4

    def together(tables):
        t = pa.Table.from_batches(tables).to_pandas().sort_values(["g", "p"], kind="stable")
        t["v"] = t.groupby("g")["p"].transform("nunique") if not collide else t.groupby("g")["g"].transform("size")
        t["n"] = t.groupby("g")["g"].transform("size")
        return t

    rows = pa.RecordBatch.from_pydict({"r": list(range(5)), "t": [t.decode() for t in texts]})
    found = together(list(suffix_dedup._piece_rows(span, gram)(iter([rows]))))
    found = found[found.known | (found.n > 1)]
    wanted = [found[found.r == k][["g", "p", "at", "size", "known", "v"]].to_dict("records") for k in range(5)]
    kind = pa.list_(pa.struct([("g", pa.int64()), ("p", pa.int64()), ("at", pa.int32()), ("size", pa.int32()), ("known", pa.bool_()), ("v", pa.int64())]))
    met = pa.RecordBatch.from_arrays([*rows.columns, pa.array(wanted, kind)], ["r", "t", "wanted"])
    contexts = together(list(suffix_dedup._contexts(span, gram, hot)(iter([met]))))
    schema = pa.schema(suffix_dedup._CONTEXT.items())
    batch = lambda t: pa.RecordBatch.from_pandas(t[schema.names], schema, preserve_index=False)
    spans = list(suffix_dedup._resolve(span)(iter([batch(contexts[contexts.v <= hot])])))
    busy = contexts[contexts.v > hot]
    assert len(busy) if hot == 1 and collide else True
    if len(busy):
        windows = together(list(suffix_dedup._windows(span)(iter([batch(busy)]))))
        spans += list(suffix_dedup._resolve(span)(iter([batch(windows)])))
    gone = [np.zeros(len(t), bool) for t in texts]
    for b in spans:
        for k, at, size in zip(*(c.to_pylist() for c in b.columns), strict=True):
            gone[k][at : at + size] = True
    want = brute([t.decode() for t in texts], span)
    assert [int(x.sum()) for x in gone] == [w[1] for w in want]
    assert [hashlib.sha256(np.frombuffer(t, np.uint8)[~x].tobytes()).hexdigest() for t, x in zip(texts, gone, strict=True)] == [w[3] for w in want]


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_columns_of_any_name(spark):
    """Other columns, called as the operator calls its own, change nothing, carried ones neither."""
    passage = "".join(chr(97 + k * k % 23) for k in range(500))
    rows = [(1, "x" + passage), (2, passage + "y"), (3, "short"), (4, None)]
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    extra = spark.createDataFrame([(*x, 7, "k", "t", 1, b"d", "s") for x in rows], "doc_id long, text string, r long, key string, t string, g long, data binary, spans string")
    take = lambda df, **more: sorted((x["key"]["doc_id"], x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in remove_repeats(df, **more).collect())
    assert take(extra, carry=("r", "key", "t", "g", "data", "spans")) == take(extra) == take(plain)
    assert sum(x[2] for x in take(plain)) == 1000


def brute_words(texts, span, words):
    """What is left of each text, without repeated strings of span bytes and passages of words that repeat."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[s : s + span] for d in data for s in range(len(d) - span + 1))
    places = [[m.span() for m in re.finditer(rb"[^\x09-\x0D\x20]+", d)] for d in data]
    said = [[d[a:b] for a, b in p] for d, p in zip(data, places, strict=True)]
    met = Counter(tuple(w[k : k + words]) for w in said for k in range(len(w) - words + 1))
    out = []
    for d, p, w in zip(data, places, said, strict=True):
        gone = bytearray(len(d))
        for k in range(len(d) - span + 1):
            if seen[d[k : k + span]] > 1:
                gone[k : k + span] = b"\1" * span
        hit = {j for k in range(len(w) - words + 1) if met[tuple(w[k : k + words])] > 1 for j in range(k, k + words)}
        for j in hit:  # with what is between words that both go
            a, b = p[j][0], p[j + 1][0] if j + 1 in hit else p[j][1]
            gone[a:b] = b"\1" * (b - a)
        out.append(bytes(c for c, g in zip(d, gone, strict=True) if not g).decode("utf-8", "ignore"))
    return out


@pytest.mark.parametrize("words,hot,chunk", [(5, 2000, 1 << 20), (9, 2, 1 << 20), (7, 1, 100), (1, 2000, 100)])
def test_passages_of_words_equal_brute_force(spark, monkeypatch, words, hot, chunk):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", chunk)
    r = random.Random(words)
    texts = ["\n".join((t or "").split(" ")) if k % 5 == 0 else t for k, t in enumerate(corpus(words))]
    texts += ["a " * 50, " a\ta\n" * 40, "b " * (words - 1), "\u00a0x \x0bx " * 9, "c" * 700 + " d" * 3, " \t\n"]
    texts += [" ".join(r.choice("xyz") for _ in range(40)) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {x["key"]["doc_id"]: x["kept_text"] for x in remove_repeats(docs, span=60, gram=16, hot=hot, words=words).collect()}
    assert [got[k] for k in range(len(texts))] == brute_words(texts, 60, words)


def test_planted_passages_of_over_50_words(spark):
    """51 words in under 400 bytes go where words are asked for, 50 stay; bytes alone take neither."""
    r = random.Random(3)
    text = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n))
    long, short = text(51), text(50)
    own = [text(30) for _ in range(8)]
    rows = [(1, f"{own[0]} {long} {own[1]}"), (2, f"{own[2]}\n{long}\n{own[3]}"), (3, f"{own[4]} {short} {own[5]}"), (4, f"{own[6]} {short}"), (5, own[7])]
    assert len(long) < 400
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = lambda words: {x["key"]["doc_id"]: x["kept_text"] for x in remove_repeats(docs, words=words).collect()}
    assert left(None) == dict(rows)
    assert left(51) == {k: t.replace(long, "") for k, t in rows}
