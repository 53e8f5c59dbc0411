import hashlib
import random
import re

from siltline.llm.decontamination import contamination


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items, width=13):
    out = []
    for d, text in docs:
        w = words(text)
        hit, found = [False] * len(w), set()
        for i, t in items:
            v = words(t)
            for k in range(max(1, len(v) - width + 1) if v else 0):
                win = v[k : k + width]
                for at in range(len(w) - len(win) + 1):
                    if w[at : at + len(win)] == win:
                        found.add(str(i))
                        hit[at : at + len(win)] = [True] * len(win)
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), sum(hit), len(found), sha, sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return out


def test_equals_brute_force(spark):
    r = random.Random(3)
    text = lambda n: " ".join(r.choice(["a", "b", "Ça", "d9", "e-f", "g"]) + r.choice(["", ",", "."]) for _ in range(n))
    items = [(k, text(r.choice([20, 30]))) for k in range(12)] + [(100, text(5)), (9, "solo"), (101, None), (102, ""), (103, "..."), (10, text(14))]
    items.append((104, items[0][1]))
    docs = [(None, None), (1, ""), (2, "solo SOLO x"), (3, "  ")]
    for k in range(60):
        item = r.choice(items)[1] or ""
        docs.append((10 + k, text(r.randint(0, 60)) + " " + item.upper().replace("Ç", "Ç")[: r.randint(0, 200)] + " " + text(r.randint(0, 300))))
    docs += docs[10:13]
    d = spark.createDataFrame([(*x, "i") for x in docs], "doc_id long, text string, item_id string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(d, b).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    key = lambda x: tuple(map(str, x))
    assert sorted(map(tuple, got), key=key) == sorted(brute(docs, items), key=key)
    assert any(x["contaminated"] for x in got) and not all(x["contaminated"] for x in got)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(d, none).first()["n_hit"] == 0
    assert contamination(d.limit(0), none).count() == 0


def test_very_long_text(spark):
    passage = " ".join(f"w{k}" for k in range(20))
    d = spark.createDataFrame([(1, "filler words " * 300_000 + passage)], "doc_id long, text string")
    b = spark.createDataFrame([(7, passage)], "item_id long, text string")
    x = contamination(d, b).first()
    assert (x["n_words"], x["n_hit"], x["items"], x["longest_match"], x["match_start"], x["contaminated"]) == (600_020, 20, ["7"], 20, 600_000, False)


def test_rounds_equal_brute_force(spark, monkeypatch):
    from siltline.llm import decontamination

    r = random.Random(4)
    text = lambda n: " ".join(r.choice(["a", "b", "Ça", "d9", "g"]) for _ in range(n))
    items = [(k, text(30)) for k in range(12)] + [(20, text(5)), (21, "solo"), (22, None), (3, text(40)), (None, text(14))]
    docs = [(None, None), (1, ""), (2, "solo SOLO x")]
    docs += [(10 + k % 20, f"{text(20)} {r.choice(items)[1]} {r.choice(items)[1]} {text(40)}") for k in range(40)]
    d = spark.createDataFrame([(*x, k) for k, x in enumerate(docs)], "doc_id long, text string, k int").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    whole = contamination(d, b, carry=("k",)).collect()
    monkeypatch.setattr(decontamination, "ROUND_WORDS", 90)
    monkeypatch.setattr(decontamination, "PIECE_WORDS", 7)
    split = contamination(d, b, carry=("k",)).collect()
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    by_k = {x["k"]: tuple(x[n] for n in names) for x in split}
    assert [by_k[k] for k in range(len(docs))] == brute(docs, items)
    assert sorted(map(str, split)) == sorted(map(str, whole))


def longest(text, items, width=13):
    """The longest common stretch of a window or more, by comparing every place with every place of every item."""
    w, best = words(text), (0, None, None, None)
    for name, t in items:
        v = words(t)
        least = min(width, len(v))
        for p in range(len(w)):
            for q in range(len(v)):
                n = 0
                while p + n < len(w) and q + n < len(v) and w[p + n] == v[q + n]:
                    n += 1
                if v and n >= least and (-n, p, str(name), q) < (-best[0], *(best[1:] if best[0] else (0, "", 0))):
                    best = (n, p, str(name), q)
    return best[0], best[2], best[1], best[3]


def test_longest_matches_equal_brute_force(spark, monkeypatch):
    from siltline.llm import decontamination

    r = random.Random(8)
    text = lambda n: " ".join(r.choice("abcdefgh") + r.choice("xy") for _ in range(n))
    items = [(k, text(r.choice([13, 20, 45]))) for k in range(8)] + [(20, "short item"), (21, "ax " * 30)]
    items.append((22, items[0][1] + " " + text(5)))
    docs = [(0, f"q {items[0][1]} {items[1][1]}"), (1, f"{text(9)} {items[2][1][3:]} short item"), (2, "ax " * 40), (3, None), (4, "short item short item")]
    docs += [(10 + k, f"{text(5)} {r.choice(items)[1][r.randint(0, 20) :]} {r.choice(items)[1]} {text(6)}") for k in range(25)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {k: longest(t, items) for k, t in docs}
    assert want[0][0] < 13 + 13 + 45  # neighbours of two items are no match with one
    for rounds in (False, True):
        if rounds:
            monkeypatch.setattr(decontamination, "ROUND_WORDS", 60)
            monkeypatch.setattr(decontamination, "PIECE_WORDS", 7)
        got = {x["doc_id"]: (x["longest_match"], x["match_item"], x["match_start"], x["match_item_start"]) for x in contamination(d, b).collect()}
        assert got == want


def test_repeated_words_stay_within_memory(spark):
    """A text of one word against items of that word: matches are found without spelling out places times places."""
    import resource

    import pyarrow as pa

    from siltline.llm import decontamination

    items = [("1", 1, 0, "x " * 10_000), ("2", 2, 0, "x " * 9_000 + "y"), ("3", 3, 0, "x x x")]
    probe = decontamination.build_probe(items, 13)
    batch = pa.record_batch([pa.array([0, 1, 2]), pa.array(["x " * 500_000, "z x x x z", "x " * 40 + "y"])], ["id", "t"])
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    found = [(held, best, int(hits[b : b + n].sum())) for _, _, size, begin, hits, held, best in decontamination._chunks(batch, probe, 13) for held, best, b, n in zip(held, best, begin, size, strict=True)]
    assert found == [(["1", "2", "3"], (10_000, 0, "1", 0), 500_000), (["3"], (3, 1, "3", 0), 3), (["1", "2", "3"], (41, 0, "2", 8_960), 41)]
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024 < 500


def test_repeated_words_equal_brute_force(spark, monkeypatch):
    from siltline.llm import decontamination

    r = random.Random(11)
    text = lambda n, of: " ".join(r.choice(of) for _ in range(n))
    items = [(k, text(r.choice([13, 14, 20, 33]), "xy")) for k in range(6)] + [(7, "x " * 40), (8, "x " * 17 + "y"), (9, "y x"), (7, "x " * 15), (10, "")]
    docs = [(0, "x " * 60), (1, "x " * 15), (2, "x y"), (3, "x " * 30 + "y " + "x " * 30)] + [(10 + k, text(r.randint(0, 90), "xxy")) for k in range(25)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for rounds in (False, True):
        if rounds:
            monkeypatch.setattr(decontamination, "ROUND_WORDS", 60)
            monkeypatch.setattr(decontamination, "PIECE_WORDS", 7)
        monkeypatch.setattr(decontamination, "_BLOCK", 5)
        rows = {x["doc_id"]: x for x in contamination(d, b).collect()}
        assert {k: (x["longest_match"], x["match_item"], x["match_start"], x["match_item_start"]) for k, x in rows.items()} == {k: longest(t, items) for k, t in docs}
        assert sorted((x["doc_id"], x["n_words"], x["n_hit"], x["n_items"], x["items_sha256"], x["contaminated"]) for x in rows.values()) == brute(docs, items)
