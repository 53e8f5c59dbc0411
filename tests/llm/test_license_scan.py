import random
import re

from siltline.llm.license_scan import BASE, TEMPLATES, WHOLE, Index, license_scan


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def base(text):
    w = words(text)
    at = [(k, label) for p, label in BASE.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
    starts = [k for k, _ in at]
    return len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))


def exact(text):
    joined = f" {' '.join(words(text))} "
    return {n for n, own in TEMPLATES.items() for t, _ in own if f" {t} " in joined}


def naive(text):
    """Each label's best share by the definition: every window of every wording, by a table of common subsequences."""
    w, out = words(text), {}
    for name, own in TEMPLATES.items():
        for t, keys in own:
            v = t.split()
            span = len(v) + -(-len(v) // 5)
            for k in range(max(1, len(w) - span + 1)):
                window = w[k : k + span]
                joined = f" {' '.join(window)} "
                if any(f" {p} " not in joined for p in keys):
                    continue
                row = [0] * (len(v) + 1)
                for x in window:
                    old = 0
                    for j, y in enumerate(v):
                        old, row[j + 1] = row[j + 1], old + 1 if x == y else max(row[j + 1], row[j])
                if row[-1] >= 0.8 * len(v) - 1e-9:
                    out[name] = max(out.get(name, 0), row[-1] / len(v))
    return out


def test_equals_brute_force(spark):
    r = random.Random(1)
    bits = ["MIT", "License", "license", "apache", "general", "public", "x", "é", "lorem", "ipsum", "licence,"]
    texts = [None, "", "...", "MIT License", "the MIT-license", "é" * 10]
    texts += [" ".join(r.choice(bits) for _ in range(r.randint(1, 40))) for _ in range(60)]
    texts += [f"{' '.join(r.choice(bits) for _ in range(5))} {t.title()}. tail words" for own in TEMPLATES.values() for t, _ in own]
    texts.append("lorem ipsum " * 50_000 + TEMPLATES["bsd"][0][0])
    texts += texts[3:5]
    docs = spark.createDataFrame([(k, t, "l") for k, t in enumerate(texts)], "doc_id long, text string, labels string").repartition(3)
    got = {x["doc_id"]: x for x in license_scan(docs).collect()}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        x = got[k]
        assert (x["n_words"], x["n_base"], x["first_word"], x["last_word"], x["base_labels"]) == base(t)
        labels = set(filter(None, x["labels"].split(",")))
        assert exact(t) | set(filter(None, x["base_labels"].split(","))) <= labels
        assert 0 <= x["score"] <= 1 and (x["score"] > 0) == bool(labels) and list(sorted(labels)) == [y for y in x["labels"].split(",") if y]
    assert "bsd" in got[len(texts) - 3]["labels"]


def test_near_template_and_missing_key_phrase(spark):
    near = TEMPLATES["bsd"][0][0].replace("with or without", "with and without")
    broken = TEMPLATES["bsd"][0][0].replace("source", "sauce")
    docs = spark.createDataFrame([(1, near), (2, broken), (None, near)], "doc_id long, text string")
    got = {x["doc_id"]: x["labels"] for x in license_scan(docs).collect()}
    assert got == {1: "bsd", 2: "", None: "bsd"}
    assert license_scan(docs.limit(0)).count() == 0


def test_several_notices_in_one_text(spark):
    r = random.Random(2)
    names = sorted(TEMPLATES)
    rows = [["bsd", "mit-notice"], ["bsd", "cc-by-nc"], *(r.sample(names, k) for k in (2, 3, 4, 5) for _ in range(15)), names]
    # words that stand in no other text must not push common ones out
    texts = [" filler ".join(r.choice(TEMPLATES[n])[0] for n in x) for x in rows] + ["this work is under the license"] * 50
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: set(x["labels"].split(",")) for x in license_scan(docs).collect()}
    for k, x in enumerate(rows):
        assert set(x) <= got[k], (k, x, got[k])


def test_labels_and_scores_equal_brute_force(spark):
    r = random.Random(5)
    names, texts = sorted(TEMPLATES), []
    for _ in range(50):
        out = []
        for n in r.sample(names, r.randint(1, 6)):
            for w in r.choice(TEMPLATES[n])[0].split():
                x = r.random()
                out += [w] if x < 0.9 else [] if x < 0.94 else [w, r.choice(["also", "the", "license"])]
            out += r.choices(["filler", "the", "software", "license"], k=r.randint(0, 5))
        texts.append(" ".join(out))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {x["doc_id"]: x for x in license_scan(docs).collect()}
    for k, t in enumerate(texts):
        want, labels = naive(t), set(filter(None, base(t)[4].split(",")))
        assert got[k]["labels"] == ",".join(sorted(want.keys() | labels)), k
        assert abs(got[k]["score"] - max([*want.values(), 1.0 if labels else 0.0])) < 1e-9, k


def test_published_notices(spark):
    notices = {
        "apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at',
        "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "lgpl": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License",
        "cc-by-nc": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "bsd": "Redistribution and use in source and binary forms, with or also without modification, are permitted provided that the following conditions are met:",
        "isc": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted",
    }
    docs = spark.createDataFrame(list(notices.items()), "doc_id string, text string")
    for x in license_scan(docs).collect():
        assert x["doc_id"] in x["labels"].split(","), x


def test_every_three_notices(spark):
    from itertools import combinations

    rows = list(combinations(sorted(TEMPLATES), 3))
    docs = spark.createDataFrame([(k, " and ".join(TEMPLATES[n][0][0] for n in x)) for k, x in enumerate(rows)], "doc_id long, text string")
    got = {x["doc_id"]: set(x["labels"].split(",")) for x in license_scan(docs).collect()}
    assert all(set(x) <= got[k] for k, x in enumerate(rows))


def test_whole_licences(spark):
    """Whole licences with their titles, names and small changes; half a licence has no label of a whole one."""
    r, rows = random.Random(9), []
    for name, [(text, keys)] in sorted(WHOLE.items()):
        v = text.split()
        held = text
        for key in keys:  # key phrases stay as they are
            held = held.replace(key, key.replace(" ", "_"))
        rows.append((name, True, "Copyright (c) 2020 Some One\n" + text.upper() + " tail"))
        rows.append((name, True, " ".join(w if r.random() < 0.97 else w + " also" for w in held.split()).replace("_", " ")))
        rows.append((name, False, " ".join(v[: len(v) // 2])))
    docs = spark.createDataFrame([(k, t) for k, (_, _, t) in enumerate(rows)], "doc_id long, text string")
    got = {x["doc_id"]: x["labels"].split(",") for x in license_scan(docs).collect()}
    for k, (name, there, _) in enumerate(rows):
        assert (name in got[k]) == there, (k, name)


def test_votes_come_from_places():
    """Words of a template in another order, or far apart, give no start; in order they give one that holds the match's."""
    index = Index({"x": [("a b c d e f g h i j", [])]}, {})
    index.rarest({})
    chosen = sorted(k for own in index.postings.values() for _, k in own)
    assert len(chosen) == 10 - index.least[0] + index.votes[0] == 4
    assert index.starts(0, [(0, [100]), (1, [500]), (2, [900])]) == []
    assert index.starts(0, [(0, [120]), (1, [103]), (2, [90])]) == []
    [(lo, hi)] = index.starts(0, [(0, [100]), (1, [101]), (3, [104])])
    assert lo <= 100 <= hi and hi - lo < 12


def test_text_of_licence_words_only(spark):
    docs = spark.createDataFrame([(1, "license " * 100_000), (2, "the software license mit " * 20_000)], "doc_id long, text string")
    got = {x["doc_id"]: (x["n_words"], x["labels"]) for x in license_scan(docs).collect()}
    assert got == {1: (100_000, ""), 2: (80_000, "")}
