"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded, a gated attention network
trained from the labels of whole documents weighs the passages, and the document is
scored by its weighted passage representation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltline.llm.common import LOWER, freeing, held_out, in_chunks, tune, utf8, with_fields
from siltline.llm.suffix_dedup import Hashes

#: Words of a passage; hash buckets of its character trigrams; further measures.
PASSAGE, BUCKETS, MEASURES = 128, 256, 9
#: Labelled documents that are learned from, at most: the first by a hash of their id, and of those the first of so many bytes in all, none of them longer than LONGEST.
SAMPLE_ROWS, SAMPLE_BYTES, LONGEST = 3_000, 32 << 20, 2 << 20
#: Text encoded at once.
PART_BYTES = 1 << 19
HIDDEN, ATTENTION, EPOCHS, STEPS, BATCH, RATE, DECAY = 32, 16, 30, 800, 64, 3e-3, 1e-2

_LOWER = np.frombuffer(LOWER, np.uint8)
_KIND = np.full(256, 3, np.uint8)  # 0 lower-case or other letter, 1 upper-case, 2 digit, 3 mark, 4 space
_KIND[97:123] = _KIND[128:] = 0
_KIND[65:91] = 1
_KIND[48:58] = 2
_KIND[[9, 10, 11, 12, 13, 32]] = 4


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A row of measures for each passage of some texts, and each text's number of passages (at least 1)."""
    size = np.array([len(t) + 1 for t in texts], np.int64)
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    text_of = np.repeat(np.arange(len(texts)), size)
    kind = _KIND[raw]
    solid = kind != 4
    start = np.flatnonzero(solid & np.append(True, ~solid[:-1]))
    end = np.flatnonzero(solid & np.append(~solid[1:], True)) + 1
    words = np.bincount(text_of[start], minlength=len(texts))
    n = np.maximum(1, -(-words // PASSAGE))
    first = np.cumsum(n) - n
    word_passage = first[text_of[start]] + (np.arange(len(start)) - np.repeat(np.cumsum(words) - words, words)) // PASSAGE
    total = int(n.sum())
    out = np.zeros((total, BUCKETS + MEASURES), np.float32)
    # every byte belongs to the passage of the last word that began, or its text's first
    mark = np.zeros(len(raw), np.int64)
    mark[start] = np.diff(word_passage, prepend=0)
    passage = np.maximum(np.cumsum(mark), first[text_of])
    low = _LOWER[raw].astype(np.uint32)
    tri = (low[:-2] * 65599 + low[1:-1]) * 65599 + low[2:]
    bucket = (tri * np.uint32(2654435761)) >> np.uint32(24)
    inside = text_of[2:] == text_of[:-2]
    counts = np.bincount((passage[:-2] * BUCKETS + bucket)[inside], minlength=total * BUCKETS).reshape(total, BUCKETS)
    counts = np.sqrt(counts)
    out[:, :BUCKETS] = counts / np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-9)
    kinds = np.bincount(passage * 5 + kind, minlength=total * 5).reshape(total, 5)
    solid_bytes = np.maximum(kinds[:, :4].sum(1), 1)
    key = Hashes(raw).of(start, end - start)
    order = np.lexsort((key, word_passage))
    new = np.append(True, (np.diff(word_passage[order]) != 0) | (key[order][1:] != key[order][:-1]))[: len(order)]
    in_passage = np.maximum(np.bincount(word_passage, minlength=total), 1)
    again = np.flatnonzero((key[1:] == key[:-1]) & (word_passage[1:] == word_passage[:-1]))
    lone = np.flatnonzero((end - start == 1) & (kind[start] == 3))
    out[:, BUCKETS:] = np.stack([
        np.log1p(np.bincount(word_passage, minlength=total)), *(kinds[:, k] / solid_bytes for k in (1, 2, 3)),
        solid_bytes / in_passage, np.bincount(word_passage[order][new], minlength=total) / in_passage,
        np.bincount(word_passage[again], minlength=total) / in_passage, np.bincount(word_passage[lone], minlength=total) / in_passage,
        np.log1p(np.bincount(passage[raw == 10], minlength=total)),
    ], 1)
    return out, n


class Attention:
    """Gated attention over the passages of each document, in numpy."""

    def __init__(self, width: int, seed: int = 0):
        r = np.random.default_rng(seed)
        init = lambda a, b: (r.standard_normal((a, b)) / np.sqrt(a)).astype(np.float64)
        self.mean, self.scale = np.zeros(width), np.ones(width)
        self.p = {
            "w1": init(width, HIDDEN), "b1": np.zeros(HIDDEN), "v": init(HIDDEN, ATTENTION), "u": init(HIDDEN, ATTENTION),
            "a": init(ATTENTION, 1), "c": init(HIDDEN, 1), "b": np.zeros(1),
        }

    def forward(self, x: np.ndarray, n: np.ndarray):
        p, at = self.p, np.cumsum(n) - n
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ p["w1"] + p["b1"])
        t, s = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        e = ((t * s) @ p["a"])[:, 0]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, at), n))
        weight = e / np.repeat(np.add.reduceat(e, at), n)
        z = np.add.reduceat(weight[:, None] * h, at)
        score = 1 / (1 + np.exp(-np.clip((z @ p["c"])[:, 0] + p["b"][0], -500, 500)))
        return score, (x, h, t, s, weight, z, at)

    def gradients(self, x: np.ndarray, n: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        score, (x, h, t, s, weight, z, at) = self.forward(x, n)
        p = self.p
        d = ((score - y) / len(y))[:, None]
        dz = np.repeat(d @ p["c"].T, n, axis=0)
        dw = (dz * h).sum(1)
        de = weight * (dw - np.repeat(np.add.reduceat(weight * dw, at), n))
        dts = de[:, None] * p["a"].T
        dt, ds = dts * s * (1 - t * t), dts * t * s * (1 - s)
        dh = (weight[:, None] * dz + dt @ p["v"].T + ds @ p["u"].T) * (1 - h * h)
        return {
            "w1": x.T @ dh, "b1": dh.sum(0), "v": h.T @ dt, "u": h.T @ ds, "a": (t * s).T @ de[:, None],
            "c": z.T @ d, "b": d.sum(0),
        }

    def train(self, x: np.ndarray, n: np.ndarray, y: np.ndarray, seed: int = 0) -> None:
        """Adam on the log loss of the documents' labels."""
        x = x.astype(np.float64)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-2
        begin = np.cumsum(n) - n
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        r, step = np.random.default_rng(seed), 0
        for _ in range(max(EPOCHS, STEPS * BATCH // len(n))):  # few documents are seen more often
            order = r.permutation(len(n))
            for lo in range(0, len(order), BATCH):
                docs = order[lo : lo + BATCH]
                rows = np.concatenate([np.arange(begin[d], begin[d] + n[d]) for d in docs])
                step += 1
                for k, g in self.gradients(x[rows], n[docs], y[docs]).items():
                    g = g + DECAY * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v2[k] = 0.999 * v2[k] + 0.001 * g * g
                    self.p[k] -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.999**step)) + 1e-8)


@freeing
def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        y = batch.column(0)
        texts = utf8(batch.column(1))
        for lo, hi in in_chunks([len(t) for t in texts], PART_BYTES):
            x, n = encode(texts[lo:hi])
            ends = np.cumsum(n)
            bags = [x[e - k : e].tobytes() for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([y.slice(lo, hi - lo), pa.array(bags, pa.binary())], ["y", "bag"])


def sample(docs: DataFrame, labels: DataFrame, rows: int, size: int, longest: int) -> DataFrame:
    """(y, text) to learn from: rows labelled ids at most, one text for each, size bytes of text in all."""
    labels = labels.where(~held_out(F.col("id")) & F.col("y").isin(0, 1)).groupBy("id").agg(F.max("y").alias("y"))
    order = F.xxhash64("id")
    chosen = labels.orderBy(order, "id").limit(rows)
    texts = docs.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= longest)
    texts = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.max("y").alias("y"), F.min("text").alias("text"))  # rows at most
    before = Window.orderBy(order, "id").rowsBetween(Window.unboundedPreceding, 0)
    sizes = texts.select("id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))  # so no text goes through the window's task
    kept = sizes.withColumn("upto", F.sum("size").over(before)).where(F.col("upto") <= size).select("id")
    return texts.join(F.broadcast(kept), "id").select("y", "text")


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int) -> Attention | None:
    """The model learned from docs (id, text) whose ids labels (id, y) names; None without both classes."""
    chosen = sample(docs, labels, sample_rows, SAMPLE_BYTES, LONGEST)
    bags = chosen.mapInArrow(_bags, "y int, bag binary")  # about as many bytes as the texts
    bags = bags.orderBy(F.xxhash64("bag"), "y").toArrow()
    y = bags["y"].to_numpy().astype(float)
    if len(set(y.tolist())) < 2:
        return None
    width = BUCKETS + MEASURES
    held = [np.frombuffer(b, np.float32).reshape(-1, width) for b in bags["bag"].to_pylist()]
    model = Attention(width)
    model.train(np.concatenate(held), np.array([len(b) for b in held]), y)
    return model


def _score(model):
    @freeing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(batch.num_columns - 1))
            score = np.full(len(texts), 0.5)
            if model.value is not None:
                for lo, hi in in_chunks([len(t) for t in texts], PART_BYTES):
                    score[lo:hi] = model.value.forward(*encode(texts[lo:hi]))[0]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score)], [*batch.schema.names[:-1], "score"])

    return rows


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id",
    label_col: str = "quality", threshold: float = 0.7, sample_rows: int = SAMPLE_ROWS, carry: tuple[str, ...] = (),
) -> DataFrame:
    """Every row's quality: the id, held_out (crc32 of the id mod 4 is 2), score (0 to 1) predicted (1 from threshold on)
    and the columns named in carry.

    The score comes from the text alone. It is learned from labelled rows that are
    not held out: the first sample_rows by a hash of their id, one text for each id, up to
    SAMPLE_BYTES in all and without texts of over LONGEST bytes. Their passage codes, about as
    many bytes, are gathered and the small network is trained once. Every row is scored whole.

    Null and empty texts are one empty passage and are scored like any other. Ids with
    several labels take the largest; labels that are null or of no row count for
    nothing; without labels of both classes every score is 0.5. Repeated rows, null
    ids (never held out), very long texts (many passages) and empty tables are defined.
    """
    tune(docs.sparkSession)
    text = F.col(text_col).cast("string").alias("text")
    named = labels.select(F.col(label_id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    rows = docs.select(F.col(id_col).alias("id"), text)
    model = docs.sparkSession.sparkContext.broadcast(fit(rows, named, sample_rows))
    carried = [F.col(c).alias(f"c{k}") for k, c in enumerate(carry)]
    out = docs.select(F.col(id_col).alias("id"), *carried, held_out(F.col(id_col)).alias("held_out"), text)
    out = out.mapInArrow(_score(model), with_fields(out.schema.fields[:-1], "score double"))
    carried = [F.col(f"c{k}").alias(c) for k, c in enumerate(carry)]
    return out.select(F.col("id").alias(id_col), *carried, "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
