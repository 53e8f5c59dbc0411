import zlib

import numpy as np

from siltline.llm.language_id import grams, language_ids


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_ids(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [x for x in got if x["held_out"]]
    assert all(x["held_out"] == (zlib.crc32(str(x["doc_id"]).encode()) % 4 == 2) for x in got)
    assert np.mean([x["lang_pred"] == x["lang"] for x in held]) > 0.97
    assert len(got) == docs.count() and all(0 <= x["score"] <= 1 for x in got)


def test_odd_rows(spark):
    rows = [(k, "ab cd " * 5, "xx", "a") for k in range(8)] + [(k + 8, "ééé ñ", "yy", "b") for k in range(8)]
    rows += [(50, None, "xx", "c"), (51, "", "yy", "c"), (52, "12 .. 3", "xx", "c"), (None, "ab", None, "c"), (53, "é " * 50_000, None, "c"), (1, "ab", "xx", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = {x["doc_id"]: x for x in language_ids(docs).collect()}
    assert [got[k]["lang_pred"] for k in (50, 51, 52)] == ["und"] * 3 and got[52]["score"] == 0
    assert got[None]["lang_pred"] == "xx" and got[53]["lang_pred"] == "yy" and got[None]["held_out"] is False
    assert language_ids(docs).count() == len(rows)
    assert {x["lang_pred"] for x in language_ids(docs.where("lang is null")).collect()} == {"und"}
    assert language_ids(docs.limit(0)).count() == 0


def test_grams_do_not_cross_texts():
    both, owner, _ = grams(["abc", "déf 1"])
    one, _, lettered = grams(["déf 1"])
    assert sorted(both[owner == 1]) == sorted(one) and lettered.all()


def test_share_of_very_many_rows():
    from siltline.llm import language_id

    assert language_id.share(10**12, 20_000) > 0 and language_id.share(10, 20) == language_id._UNITS
    assert abs(language_id.share(10**15, 20_000) / language_id._UNITS * 10**15 - 20_000) < 1


def test_equals_brute_force(spark):
    """Naive counts with dictionaries, a text at a time."""
    import math
    import random
    from collections import Counter, defaultdict

    from siltline.llm.language_id import ALPHA, BUCKETS, LENGTHS

    def naive(text):
        s = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
        while "  " in s:
            s = s.replace("  ", " ")
        for n in LENGTHS:
            for k in range(len(s) - n + 1):
                g = s[k : k + n]
                if any(c.isalpha() for c in g):
                    h = n
                    for c in g:
                        h = ((h ^ ord(c)) * 0x9E3779B97F4A7C15) % 2**64
                        h ^= h >> 29
                    yield (h >> 20) % BUCKETS

    r = random.Random(3)
    words = {"xx": ["abba", "cad", "dab"], "yy": ["été", "ñu", "dab"], "zz": ["Öl", "abba", "zz"]}
    rows = [(k, " ".join(r.choice(words[x]) for _ in range(r.randint(1, 9))) + r.choice(["", "!", " 12"]), x) for k in range(60) for x in [r.choice("xyz") * 2]]
    rows += [(100, "AB  ab", None), (101, "ßü", None), (102, "abba", None), (102, "abba", None)]
    counts, prior = defaultdict(Counter), Counter()
    for k, text, lang in rows:
        if lang and zlib.crc32(str(k).encode()) % 4 != 2:
            prior[lang] += 1
            counts[lang].update(naive(text))
    got = Counter((x["doc_id"], x["lang_pred"], round(x["score"], 4)) for x in language_ids(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect())
    want = Counter()
    for k, text, _ in rows:
        total = {x: math.log(prior[x] / sum(prior.values())) + sum(math.log((counts[x][g] + ALPHA) / (sum(counts[x].values()) + ALPHA * BUCKETS)) for g in naive(text)) for x in prior}
        best = max(sorted(total), key=total.get)
        want[k, best, round(1 / sum(math.exp(t - total[best]) for t in total.values()), 4)] += 1
    assert got == want


def test_many_languages_in_rounds(spark, monkeypatch):
    """Languages beyond one matrix are predicted too, with the shares of one matrix of all."""
    from siltline.llm import language_id

    rows = [(10 * n + k, f"w{chr(97 + n)}{chr(100 + n)} " * (3 + k) + "ab", f"l{n:02d}") for n in range(11) for k in range(6)] + [(900, None, "l00"), (901, "..", None), (902, "wdg ab", None), (902, "wdg ab", None), (None, "ab", None)]
    docs = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, lang string, r int").repartition(3)
    take = lambda: sorted((str(x["doc_id"]), x["held_out"], x["lang_pred"], round(x["score"], 5)) for x in language_ids(docs).collect())
    whole = take()
    monkeypatch.setattr(language_id, "LANGUAGES", 4)
    assert take() == whole
    assert {x[2] for x in whole} == {"und", *(f"l{n:02d}" for n in range(11))}
