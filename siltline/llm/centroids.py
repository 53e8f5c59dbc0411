"""Exact integer k-means with Drake's adaptive distance bounds."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from siltline.llm.common import freeing, shared_folder, tune, with_fields
from siltline.shared import remove

#: Components are held within this, so that every squared distance of some hundred components fits 64 bits.
LARGEST = 1 << 27
#: Up to this, sums of products are exact in doubles.
_EXACT = 1 << 20
#: What a bound in doubles may be off by, as a part of it.
_SLACK = 2.0**-48


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), within LARGEST."""
    return np.clip(np.floor(scale * x.astype(np.float64)), -LARGEST, LARGEST).astype(np.int64)


def distances(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of v to all rows of c."""
    kind = np.float64 if max(np.abs(v).max(initial=0), np.abs(c).max(initial=0)) <= _EXACT else np.int64
    v, c = v.astype(kind), c.astype(kind)
    return ((v * v).sum(1)[:, None] - 2 * (v @ c.T) + (c * c).sum(1)).astype(np.int64)


def paired(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of v to the same rows of c."""
    return ((v - c) ** 2).sum(1)


def _below(x: np.ndarray) -> np.ndarray:
    """x as shorter floats, never above it."""
    x = x * (1 - _SLACK)
    y = x.astype(np.float32)
    return np.where(y > x, np.nextafter(y, np.float32(-np.inf)), y)


class Bounds:
    """The centroids near some vectors: near[i] holds the nearest ones after the own one, low[i] a lower bound of the distance to each, the last to all others."""

    def __init__(self, cluster: np.ndarray, near: np.ndarray, low: np.ndarray):
        self.cluster, self.near, self.low = cluster, near, low

    @classmethod
    def scanned(cls, v: np.ndarray, c: np.ndarray, held: int) -> tuple[Bounds, np.ndarray]:
        """From all distances; and the squared distance to the nearest centroid, of equal ones the first."""
        d = distances(v, c)
        order = np.argsort(d, axis=1, kind="stable")
        ranked = np.take_along_axis(d, order[:, : held + 2], 1)
        low = np.full((len(v), held + 1), np.inf, np.float32)
        low[:, : ranked.shape[1] - 1] = _below(np.sqrt(ranked[:, 1:]))
        return cls(order[:, 0].astype(np.int32), order[:, 1 : held + 1].astype(np.uint16), low), ranked[:, 0]

    def shorter(self, held: int) -> None:
        """Keeps the bounds of the held nearest centroids and takes the others into the last."""
        if held < self.near.shape[1]:
            self.low = np.concatenate([self.low[:, :held], self.low[:, held:].min(1, keepdims=True)], 1)
            self.near = self.near[:, :held]

    def moved(self, v: np.ndarray, c: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, int]:
        """Follows centroids that have moved to c, each by at most move. Returns the squared distances to the new nearest, and the most bounds that were looked behind.

        A centroid whose bound, and all bounds after it, lie above the distance to the own centroid
        can't be as near. Only the centroids before are measured; where no bound lies above, all are.
        """
        held = self.near.shape[1]
        low = self.low.astype(np.float64)
        low[:, :held] -= move[self.near]
        low[:, held] -= move.max(initial=0)
        self.low = _below(low)
        own = paired(v, c[self.cluster])
        least = np.minimum.accumulate(self.low[:, ::-1], axis=1)[:, ::-1]
        open_ = ((np.sqrt(own) * (1 + _SLACK))[:, None] >= least).sum(1)
        for n in np.unique(open_[open_ > 0]).tolist():
            rows = np.flatnonzero(open_ == n)
            if n > held:
                again, own[rows] = Bounds.scanned(v[rows], c, held)
                self.cluster[rows], self.near[rows], self.low[rows] = again.cluster, again.near, again.low
                continue
            some = np.concatenate([self.cluster[rows, None], self.near[rows, :n]], 1)
            d = np.stack([own[rows], *(paired(v[rows], c[some[:, k]]) for k in range(1, n + 1))], 1)
            order = np.lexsort((some, d), axis=1)
            some, d = np.take_along_axis(some, order, 1), np.take_along_axis(d, order, 1)
            self.cluster[rows], self.near[rows, :n], self.low[rows, :n], own[rows] = some[:, 0], some[:, 1:], _below(np.sqrt(d[:, 1:])), d[:, 0]
        return own, int(open_[open_ <= held].max(initial=0))


def _rows(column: pa.Array, kind: type) -> np.ndarray:
    """Equally long binaries as rows of numbers."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]].view(kind).reshape(len(column), -1) if len(column) else np.zeros((0, 0), kind)


def _binaries(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])


_STATE = ["v", "cluster", "distance", "near", "low", "sums"]
_STATE_DDL = "v binary, cluster int, distance long, near binary, low binary, sums array<long>"


def _round(state_of, first: bool, last: bool):
    """One round over rows (id, vector) or (id, v, cluster, near, low): each with its cluster and bounds, then for each cluster one row with sums.

    sums holds the vectors of a cluster in this task, their distances' sum, the most bounds looked
    behind, and the sum of each component. The last round keeps no state but clusters and distances.
    """

    @freeing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, move, held, scale = state_of.value
        total, used = np.zeros((len(c), 3 + c.shape[1]), np.int64), 0
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            if not len(batch):
                continue
            if first:
                v = integers(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1), scale)
                bounds, own = Bounds.scanned(v, c, held)
            else:
                v = _rows(batch.column(1), np.int32).astype(np.int64)
                near, low = _rows(batch.column(3), np.uint16).reshape(len(batch), -1), _rows(batch.column(4), np.float32)
                bounds = Bounds(batch.column(2).to_numpy().copy(), near.copy(), low.copy())
                bounds.shorter(held)
                own, most = bounds.moved(v, c, move)
                used = max(used, most)
            order = np.argsort(bounds.cluster, kind="stable")
            some, at = np.unique(bounds.cluster[order], return_index=True)
            total[some, 0] += np.diff(np.append(at, len(v)))
            total[some, 1] += np.add.reduceat(own[order], at)
            total[some, 3:] += np.add.reduceat(v[order], at)
            state = [pa.nulls(len(v), pa.binary())] * 3 if last else [_binaries(v.astype(np.int32)), _binaries(bounds.near), _binaries(bounds.low)]
            columns = [batch.column(0), state[0], pa.array(bounds.cluster), pa.array(own), *state[1:]]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(v), pa.list_(pa.int64()))], ["id", *_STATE])
        total[:, 2] = used
        some = np.flatnonzero(total[:, 0])
        if len(some):
            n = len(some)
            columns = [pa.nulls(n, kind), pa.nulls(n, pa.binary()), pa.array(some, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(total[some]), pa.list_(pa.int64()))], ["id", *_STATE])

    return rows


def usable(vector: Column, size: int) -> Column:
    """Whether a vector has exactly size components, none of them null or non-finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce((F.size(vector) == size) & ~bad, F.lit(False))


def _totals(state: DataFrame, k: int) -> list[dict[int, int]]:
    """For each cluster its sums over all tasks by their place, of the second (the most bounds) the largest. As many rows as k times the components."""
    sums = state.where("sums IS NOT NULL").select("cluster", F.posexplode("sums").alias("at", "x"))
    rows = sums.groupBy("cluster", "at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("sum"), F.max("x").alias("most")).collect()
    out: list[dict[int, int]] = [{} for _ in range(k)]
    for r in rows:
        out[r["cluster"]][r["at"]] = int(r["most"] if r["at"] == 2 else r["sum"])
    return out


def _long(x: int) -> int | None:
    return x if x < 1 << 63 else None


def clusters(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 40,
    rounds: int = 5,
    size: int = 64,
    scale: int = 256,
    seed: str = "2:",
    held: int | None = None,
) -> DataFrame:
    """Each vector's cluster after rounds rounds of k-means in whole numbers, exactly as if every distance were measured.

    Vectors of exactly size components, none null or non-finite, are kept; a component x becomes
    floor(scale * x). The first centroids are the k vectors with the smallest hexadecimal sha256 of
    seed and the id as text. A round assigns each vector to the nearest centroid (squared distance, of
    equal ones the smaller number) and puts each centroid that has vectors at the floor of their mean.
    Then vectors are assigned once more. Returns the id, cluster, distance (squared), cluster_inertia
    and inertia (sums of it over the cluster and over all) and centroid_sha256 (of the final
    centroid's components in decimal, comma-joined).

    A vector keeps lower bounds of its distances to the held nearest other centroids (at first a
    quarter of k) and one of all others. They shrink by what centroids move; only centroids that
    they can't rule out are measured, and all only where the last bound rules nothing out. After a round
    held falls to the most bounds that were needed, an eighth of k at least. The state is one table
    in the shared folder for each round, removed when the next is written; only k centroids and their
    sums pass through the driver.

    Other vectors (null ones too) get no row; with fewer than k kept ones each starts a centroid; no
    vectors give no rows. Repeated rows count each; of rows with one id those with the smaller
    vector (as a list) start first; a null id counts as empty text. A component beyond 2^27 counts as
    2^27, and an inertia that no long holds is null. Other columns are not read.
    """
    spark = vectors.sparkSession
    tune(spark)
    k = min(k, 1 << 16)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(usable(F.col("v"), size))
    key = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    starts = [r["v"] for r in rows.orderBy(key, "v").limit(k).select("v").collect()]
    fields = rows.schema.fields[:1]
    c = integers(np.array(starts, np.float64).reshape(len(starts), size), scale)
    k, move = len(c), np.zeros(len(c))
    held = min(k - 1, max(1, k // 4) if held is None else held) if k else 0
    folder, state, totals, old = f"{shared_folder(spark)}/clusters-{uuid.uuid4().hex}", None, [], None
    for n in range(rounds + 1 if k else 0):
        shared = spark.sparkContext.broadcast((c, move, held, scale))
        source = rows if state is None else state.where("sums IS NULL").select("id", "v", "cluster", "near", "low")
        step = source.mapInArrow(_round(shared, state is None, n == rounds), with_fields(fields, _STATE_DDL))
        step.write.parquet(f"{folder}/{n}")
        state = spark.read.schema(step.schema).parquet(f"{folder}/{n}")
        shared.destroy()
        if old:
            remove(spark, old)
        old = f"{folder}/{n}"
        totals = _totals(state, k)
        if n < rounds:
            before, c = c, c.copy()
            for j, own in enumerate(totals):
                if own:
                    c[j] = [own[3 + i] // own[0] for i in range(size)]
            move = np.sqrt(paired(c, before)) * (1 + _SLACK)
            if n:
                held = min(held, max(1, k // 8, max(own.get(2, 0) for own in totals)))
    inertia = sum(own.get(1, 0) for own in totals)
    found = [Row(cluster=j, cluster_inertia=_long(own.get(1, 0)), inertia=_long(inertia), centroid_sha256=hashlib.sha256(",".join(map(str, c[j].tolist())).encode()).hexdigest()) for j, own in enumerate(totals)]
    said = spark.createDataFrame(found, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    if state is None:
        state = rows.where("false").select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"), F.lit(None).cast("array<long>").alias("sums"))
    out = state.where("sums IS NULL").select("id", "cluster", "distance").join(F.broadcast(said), "cluster")  # k rows
    return out.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
