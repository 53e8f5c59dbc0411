"""Source divergence against counts in dictionaries and Python's whole numbers."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from siltline.llm.divergence import SHARES, Trie, shares, source_divergence, terms

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(rows, least=10, ranks=10):
    """Rows (lang, source, part, item, value, rank) of (lang, source, text) rows."""
    places, holding, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        places[lang, source].update(words(text))
        holding[lang].update(set(words(text)))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in holding[lang].items() if n >= least]

        def share(count, kept=kept):
            total = sum(count[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 2) // total for t in kept}

        own = {s: share(places[lang, s]) for s in sources}
        whole = share(sum((places[lang, s] for s in sources), Counter()))
        for s in sources:
            found = {"pair": [], "term": []}
            for other in sources - {s}:
                found["pair"].append((other, sum((own[s][t] - own[other][t]) ** 2 // (own[s][t] + own[other][t]) for t in kept)))
            for t in kept:
                if places[lang, s][t] and own[s][t] > whole[t]:
                    found["term"].append((t, (own[s][t] - whole[t]) ** 2 // (own[s][t] + whole[t])))
            for part, items in found.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(items) if part == "pair" or k < ranks]
    return sorted(out)


def corpus(n, seed, sources=7):
    rng = np.random.default_rng(seed)
    stock = ["the", "The", "THE-end", "é", "Éa", "éa", "日本", "語の", "a1b", "x\x00y", "ab", "abc", "abcd", "b", "ba", "🙂", "_", "naïve", "z" * 300, "Ａ", "\u0085", "don't", "~{|", "tie", "tied", "ties"]
    langs, rows = ["en", "fr", None, ""], []
    for _ in range(n):
        text = " ".join(rng.choice(stock, rng.integers(0, 12)))
        rows.append((langs[rng.integers(0, 4)], rng.choice(["a", "b", None, "", "hot", "hot", "hot", *(f"s{k}" for k in range(sources))]), text if rng.random() > 0.05 else None))
    return [(lang, None if s is None else str(s), t) for lang, s, t in rows] + [("xx", "only", "few words"), ("yy", "one", ""), ("yy", "two", None), ("xx", "1", "")]


def got(df):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect())


@pytest.mark.parametrize("least,block,leaves", [(10, 1024, 1 << 17), (2, 3, 8), (1, 5, 1)])
def test_equals_plain(spark, least, block, leaves):
    """Null columns, empty texts, hot sources, ties; tries handed on often; rounds of few groups; clashing names."""
    rows = corpus(600, least)
    df = spark.createDataFrame([(*r, 1, b"t", 2.0) for r in rows], "lang string, source string, text string, value int, term binary, rank double").repartition(4)
    assert got(source_divergence(df, least=least, block=block, leaves=leaves)) == plain(rows, least)


def test_no_rows_and_long_texts(spark):
    df = spark.createDataFrame([("en", "a", "w" * 300_000 + " x"), ("en", "b", "v " * 200_000)] * 2, "lang string, source string, text string")
    assert got(source_divergence(df.where("lang = 'q'"))) == []
    assert got(source_divergence(df, least=1)) == plain([tuple(r) for r in df.collect()], 1)
    assert got(source_divergence(df)) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_trie_holds_what_it_is_given_in_order():
    rng = np.random.default_rng(5)
    given = [bytes(rng.choice([97, 98, 0xC3, 0xA9], rng.integers(1, 9)).tolist()) for _ in range(3000)]
    trie = Trie()
    number = {t: trie.leaf(t) for t in given}
    assert all(trie.leaf(t) == n for t, n in number.items()) and trie.leaves == len(number)
    assert list(trie.walk()) == [(t, number[t]) for t in sorted(number)]


def test_terms_end_with_their_text():
    texts = ["ab", "cd e", "", "É1f", "g-", "h"]
    found, of = terms(pa.array(["skipped", *texts]).slice(1))
    flat = found.dictionary.take(found.indices).to_pylist()
    assert [(int(k), t.decode()) for k, t in zip(of, flat, strict=True)] == [(k, t) for k, x in enumerate(texts) for t in words(x)]


def test_shares_beyond_64_bits():
    count = np.array([0, 1, 9_223_372_036, 10**13, 10**15])
    total = int(count.sum()) + 2 * len(count)
    assert shares(count, total).tolist() == [1 + SHARES * (c + 2) // total for c in count.tolist()]
    assert shares(count[:3], total).tolist() == [1 + SHARES * (c + 2) // total for c in count[:3].tolist()]
