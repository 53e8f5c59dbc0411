"""Language identification by multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.llm.common import checkpointed, freeing, held_out, in_chunks, tune

#: Hash buckets, n-gram lengths, and additive smoothing.
BUCKETS, LENGTHS, ALPHA = 1 << 16, (1, 2, 3), 0.5
#: About so many labelled rows are learned from, chosen by a hash of id and text; and the languages of one broadcast matrix, beyond which texts are scored in rounds.
SAMPLE_ROWS, LANGUAGES = 20_000, 512
UNDEFINED = "und"


@cache
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams of some texts, the text of each, and which texts have a letter.

    Texts are lower-cased; each run of other characters than letters counts as one space.
    """
    points = [np.frombuffer((" " + t.lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    text = np.repeat(np.arange(len(texts)), [len(p) for p in points])
    x = np.concatenate(points) if points else np.zeros(0, np.uint32)
    letter = _letters()[x]
    x = np.where(letter, x, 32).astype(np.uint64)
    start = np.append(True, text[1:] != text[:-1]) if len(text) else np.zeros(0, bool)
    keep = letter | start | np.append(True, letter[:-1])[: len(letter)]
    x, text, letter = x[keep], text[keep], letter[keep]
    lettered = np.zeros(len(texts), bool)
    lettered[text[letter]] = True
    out, owner = [], []
    for n in LENGTHS:
        if len(x) < n:
            continue
        m = len(x) - n + 1
        h = np.full(m, n, np.uint64)
        some = np.zeros(m, bool)
        for k in range(n):
            h = (h ^ x[k : k + m]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            some |= letter[k : k + m]
        ok = some & (text[:m] == text[n - 1 :])
        out.append((h[ok] >> np.uint64(20)) & np.uint64(BUCKETS - 1))
        owner.append(text[:m][ok])
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), lettered
    return np.concatenate(out).astype(np.int64), np.concatenate(owner), lettered


def _parts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    texts = [t or "" for t in column.to_pylist()]
    for lo, hi in in_chunks([len(t) for t in texts], 1 << 19):
        yield lo, texts[lo:hi]


@freeing
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        for lo, texts in _parts(batch.column(1)):
            bucket, owner, _ = grams(texts)
            here = langs[lo : lo + len(texts)]
            for lang in set(here.tolist()):
                own = here == lang
                n = np.bincount(bucket[own[owner]], minlength=BUCKETS)
                counts[lang] = counts[lang] + n if lang in counts else n
                rows[lang] = rows.get(lang, 0) + int(own.sum())
    for lang, n in counts.items():
        at = np.flatnonzero(n)
        names = pa.array([lang] * (len(at) + 1), pa.string())
        yield pa.RecordBatch.from_arrays([names, pa.array(np.append(at, -1)), pa.array(np.append(n[at], rows[lang]))], ["lang", "bucket", "n"])


#: Parts of a whole in which a share is counted, so that a small one of many rows is not nothing.
_UNITS = 1 << 62


def share(total: int, rows: int) -> int:
    """Of _UNITS, the share that rows are of total."""
    return min(_UNITS, _UNITS * rows // max(total, 1))


def chosen_rows(labelled: DataFrame, sample_rows: int) -> DataFrame:
    """The rows of (id, lang, text) that are learned from."""
    total = labelled.count()
    if total <= sample_rows:
        return labelled
    return labelled.where(F.pmod(F.xxhash64("id", "text"), F.lit(_UNITS)) < share(total, sample_rows))


def learn(chosen: DataFrame, langs: list[str], priors: dict[str, float]) -> np.ndarray:
    """The log-probabilities of some languages, buckets x languages, with the prior in the last row."""
    own = chosen.join(F.broadcast(chosen.sparkSession.createDataFrame([(x,) for x in langs], "lang string")), "lang", "left_semi")
    summed = own.select("lang", "text").mapInArrow(_count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    summed = summed.where("bucket >= 0").toArrow()  # at most a row for each language and bucket
    place = {x: k for k, x in enumerate(langs)}
    column = np.array([place[x] for x in summed["lang"].to_pylist()], np.int64)
    table = np.full((BUCKETS, len(langs)), ALPHA)
    np.add.at(table, (summed["bucket"].to_numpy(), column), summed["n"].to_numpy())
    return np.vstack([np.log(table / table.sum(0)), np.log([priors[x] for x in langs])]).astype(np.float32)


def _totals(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The log-score of each text in each language, and which texts have a letter."""
    bucket, owner, lettered = grams(texts)
    total = np.empty((len(texts), table.shape[1]))
    for k in range(table.shape[1]):
        total[:, k] = np.bincount(owner, table[bucket, k], minlength=len(texts)) + table[-1, k]
    return total, lettered


def _score(model):
    @freeing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, table = model.value
        for batch in batches:
            name: list[str] = []
            score: list[float] = []
            for _, texts in _parts(batch.column(2)):
                if not langs:
                    name += [UNDEFINED] * len(texts)
                    score += [0.0] * len(texts)
                    continue
                total, lettered = _totals(texts, table)
                best = total.argmax(1)
                p = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
                name += [langs[b] if ok else UNDEFINED for b, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
                score += np.where(lettered, p, 0.0).tolist()
            columns = [batch.column(0), batch.column(1), pa.array(name, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "held_out", "lang_pred", "score"])

    return rows


def _round(model):
    """Over rows (r, text): of those with a letter the best of some languages, its log-score, and the sum of all, as a part of the best."""

    @freeing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, table = model.value
        for batch in batches:
            for lo, texts in _parts(batch.column(1)):
                total, lettered = _totals(texts, table)
                best, top = total.argmax(1), total.max(1)
                mass = np.exp(total - top[:, None]).sum(1)
                own = np.flatnonzero(lettered)
                columns = [batch.column(0).slice(lo, len(texts)).take(pa.array(own)), pa.array([langs[k] for k in best[own]], pa.string()), pa.array(top[own]), pa.array(mass[own])]
                yield pa.RecordBatch.from_arrays(columns, ["r", "lang", "top", "mass"])

    return rows


def _in_rounds(rows: DataFrame, chosen: DataFrame, blocks: list[list[str]], priors: dict[str, float]) -> DataFrame:
    """What _score gives, from one matrix after another: each row keeps the best language and its share of all."""
    rows = checkpointed(rows.select(F.monotonically_increasing_id().alias("r"), "id", "held_out", "text"))
    merged = None
    for langs in blocks:
        model = rows.sparkSession.sparkContext.broadcast((langs, learn(chosen, langs, priors)))
        found = checkpointed(rows.select("r", "text").mapInArrow(_round(model), "r long, lang string, top double, mass double"))
        model.destroy()
        merged = found if merged is None else merged.unionAll(found)
    best = merged.groupBy("r").agg(F.min_by("lang", F.struct(-F.col("top"), "lang")).alias("lang"), F.max("top").alias("_top"), F.collect_list(F.struct("top", "mass")).alias("_all"))
    mass = F.aggregate("_all", F.lit(0.0), lambda t, x: t + x["mass"] * F.exp(x["top"] - F.col("_top")))
    out = rows.join(best.select("r", "lang", (1 / mass).alias("p")), "r", "left")
    return out.select("id", "held_out", F.coalesce("lang", F.lit(UNDEFINED)).alias("lang_pred"), F.coalesce("p", F.lit(0.0)).alias("score"))


def language_ids(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """Every row's language: the id, held_out (crc32 of the id mod 4 is 2), lang_pred and score (its posterior).

    Learned from rows that are not held out and have a language and a text: all, or
    about sample_rows of them chosen by a hash of id and text, whatever their partition. The
    log-probability matrix (buckets x languages) is broadcast; a text's n-grams index it. With
    more than LANGUAGES languages it is broadcast in blocks of so many, and every text is scored in
    rounds, so that all are predicted and no more than a block is in memory.

    A null text, or one without a letter, is 'und' with score 0; without any labelled
    row every text is. Ties go to the first language by name. Null ids are not held
    out. Repeated rows, very long texts and empty tables are handled like any other.
    """
    tune(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang"))
    labelled = rows.where(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("id", "lang", "text")
    chosen = chosen_rows(labelled, sample_rows)
    counts = {r["lang"]: r["n"] for r in chosen.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # no more than rows that are learned from
    priors = {x: n / sum(counts.values()) for x, n in counts.items()}
    langs = sorted(counts)
    rows = rows.select("id", "held_out", "text")
    if len(langs) > LANGUAGES:
        out = _in_rounds(rows, chosen, [langs[k : k + LANGUAGES] for k in range(0, len(langs), LANGUAGES)], priors)
    else:
        model = docs.sparkSession.sparkContext.broadcast((langs, learn(chosen, langs, priors) if langs else None))
        out = rows.mapInArrow(_score(model), f"id {kind}, held_out boolean, lang_pred string, score double")
    return out.select(F.col("id").alias(id_col), "held_out", "lang_pred", "score")
