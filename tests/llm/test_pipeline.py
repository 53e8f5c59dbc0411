"""The stages of the pipeline against brute force, each on what the one before it kept."""

from collections import Counter

import corpus_pipeline
from siltline.llm.quality import quality_scores

from test_packing import verify

SF = "/root/testdata/sf0.001"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def least_reachable(prints):
    """The least id that links of 3 or fewer differing bits reach, by comparing all pairs."""
    root = {k: k for k in prints}
    while True:
        new = {a: min(root[b] for b in prints if (prints[a] ^ prints[b]).bit_count() <= 3) for a in prints}
        if new == root:
            return root
        root = new


def without_repeats(texts, span=400):
    """Each text without the bytes of strings of span bytes that start anywhere else."""
    seen = Counter(t[k : k + span] for t in texts for k in range(len(t) - span + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - span + 1):
            if seen[t[k : k + span]] > 1:
                gone[k : k + span] = b"\1" * span
        out.append(bytes(c for c, g in zip(t, gone, strict=True) if not g))
    return out


def words_of(text):
    return "".join(c if c >= "\x80" or c.isalnum() else " " for c in (text or "").translate(UPPER)).split(" ")


def contaminated(text, windows):
    words = [w for w in words_of(text) if w]
    hit = set()
    for n in {len(w) for w in windows}:
        for k in range(len(words) - n + 1):
            if tuple(words[k : k + n]) in windows:
                hit.update(range(k, k + n))
    return bool(hit) and 20 * len(hit) >= len(words)


def test_stages(spark, tmp_path):
    from siltline.llm.simhash import fingerprint

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    stages, at = dict(corpus_pipeline.STAGES), {}
    assert list(stages) == ["quality", "near_dedup", "repeats", "decontaminate", "packing"]
    at["input"] = docs.collect()
    for name, stage in stages.items():
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert name == "packing" or docs.columns == columns
        at[name] = docs.collect()
    by_id = lambda name: {r["doc_id"]: r["text"] for r in at[name]}

    scores = quality_scores(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")).collect()
    texts = by_id("input")
    assert by_id("quality") == {r["doc_id"]: texts[r["doc_id"]] for r in scores if r["score"] >= 0.7}

    texts = by_id("quality")
    root = least_reachable({k: fingerprint((t or "").encode()) for k, t in texts.items()})
    assert by_id("near_dedup") == {k: t for k, t in texts.items() if root[k] == k}

    texts = by_id("near_dedup")
    cut = without_repeats([(t or "").encode() for t in texts.values()])
    assert by_id("repeats") == {k: c.decode("utf-8", "ignore") for k, c in zip(texts, cut, strict=True)}
    assert all(r["n_chars"] == len(r["text"]) for r in at["repeats"])

    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        words = [w for w in words_of(r["text"]) if w]
        windows |= {tuple(words[k : k + 13]) for k in range(max(1, len(words) - 12))} if words else set()
    texts = by_id("repeats")
    assert by_id("decontaminate") == {k: t for k, t in texts.items() if not contaminated(t, windows)}
    assert 0 < len(at["decontaminate"]) < len(at["repeats"]) < len(at["quality"]) < len(at["input"])

    verify([(r["doc_id"], r["text"]) for r in at["decontaminate"]], at["packing"])


def test_run_is_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and got.count() > 0


def test_repeated_rows_and_null_ids_keep_one_document(spark):
    import random

    r = random.Random(6)
    text = lambda: " ".join(f"w{r.randint(0, 10**9)}" for _ in range(80))
    a, b, c, d, e = (text() for _ in range(5))
    rows = [(5, a), (5, a), (None, a), (7, a), (None, b), (None, b), (None, c), (5, d), (9, e), (9, e)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    one = corpus_pipeline.near_dedup(spark, docs, SF)
    want = sorted([(5, a), (None, b), (None, c), (5, d), (9, e)], key=str)
    assert one.columns == docs.columns and sorted(map(tuple, one.collect()), key=str) == want
    # what is kept once loses nothing as a repeat
    assert sorted(map(tuple, corpus_pipeline.repeats(spark, one, SF).collect()), key=str) == want


CLASHING = "doc_id long, text string, `score` double, predicted int, held_out boolean, _row string, _key long, kept_text string, contaminated boolean, n_bytes long, `a.b c` string, n_chars int, r long, t string, key string, spans int, fingerprint int, component_id int"


def test_stages_with_clashing_columns_nulls_and_repeated_rows(spark):
    lone = [None, "", " \n", "short one", "word " * 400]
    texts = {k: f"{k} " + " ".join(f"x{k * 977 + j * j}" for j in range(90)) for k in range(4)}
    rows = [(None, t) for t in lone] + [(1, t) for t in lone] + [(k, t) for k, t in texts.items()] + [(0, texts[0]), (None, texts[1])]
    more = (1.5, 0, True, "row", 7, "kept", False, 9, "odd", 3, 1, "t", "key", 2, 4, 5)
    docs = spark.createDataFrame([(*x, *more) for x in rows], CLASHING).repartition(3)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns, name
        found = got.collect()
        assert all(r["a.b c"] == "odd" and r["score"] == 1.5 and r["fingerprint"] == 4 for r in found), name
        if name == "near_dedup":  # the three blank texts are one group, as is each text given twice
            assert Counter(r["text"] for r in found if r["text"] and r["text"].strip()) == Counter([*lone[3:], *texts.values()])
            assert len(found) == len(texts) + 3 and {r["doc_id"] for r in found} == {0, 1, 2, 3}
        if name == "repeats":
            assert len(found) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in found)
        if name == "decontaminate":
            assert len(found) == len(rows)
    pieces = corpus_pipeline.packing(spark, docs, SF).collect()
    assert sum(r["doc_tokens"] == 1 for r in pieces) == 6  # blank texts have their end id alone


def test_stages_on_an_empty_table(spark):
    docs = spark.createDataFrame([], CLASHING)
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, SF)
        assert got.count() == 0 and (name == "packing" or got.columns == docs.columns)
