"""Greedy packing of clips into batches of a bounded length, and where each clip lies in its batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltline.shared import checkpointed

# Fixed value: seconds of a clip whose duration is not known.
UNKNOWN = 3.0


def next_starts(d: np.ndarray, target: float) -> np.ndarray:
    """For each clip, where the batch that begins with it ends: the first later clip that would take it over target.

    Found by binary search over prefix sums. Where the sum comes so near target that rounding
    could decide, clips are added up one after another, as the rule does, for all such starts at once.
    """
    n = len(d)
    d = np.where(d > target, 2 * max(target, 0.0) + 1, d)  # a batch of its own, however long
    ends = np.cumsum(d)
    before = ends - d
    out = np.maximum(np.searchsorted(ends, before + target, "right"), np.arange(n) + 1)
    slack = 4 * np.finfo(float).eps * (n + 4) * (ends[-1] + abs(target) if n else 0)
    near = np.abs(ends[np.minimum(out, n - 1)] - before - target) <= slack
    near |= np.abs(ends[out - 1] - before - target) <= slack
    starts = np.flatnonzero(near)
    total, j = d[starts], starts + 1
    while len(starts):
        out[starts] = j
        total = total + d[np.minimum(j, n - 1)]
        on = (j < n) & (total <= target)
        starts, total, j = starts[on], total[on], j[on] + 1
    return out


def last_starts(following: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where batches begin one after another: for each clip as a start, the last start that it leads to, and how many there are with itself.

    By pointer doubling: each round goes twice as far.
    """
    n = len(following)
    last = np.where(following < n, following, np.arange(n))
    more = (following < n).astype(np.int64)
    while (last[last] != last).any():
        more, last = more + more[last], last[last]
    return last, more + 1


def _segments(batches: Iterator[pa.RecordBatch], n_unit: int) -> Iterator[tuple[tuple, int, list[np.ndarray]]]:
    """Of a task's rows (unit, key, duration, at): each unit's durations in order and the task's part."""
    now, part, held = None, 0, []
    for rows in batches:
        if not len(rows):
            continue
        units = list(zip(*(c.to_pylist() for c in rows.columns[:n_unit]), strict=True))
        d, at = rows.column(n_unit + 1).to_numpy(), rows.column(n_unit + 2)
        cuts = [0, *(k for k in range(1, len(units)) if units[k] != units[k - 1]), len(units)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if held and units[lo] != now:
                yield now, part, held
                held = []
            now, part = units[lo], at[lo].as_py() >> 33
            held.append(d[lo:hi])
    if held:
        yield now, part, held


def _summary(target: float, n_unit: int):
    """Of a task's first and last unit, which may go on in others: what becomes of a batch that is open when they begin.

    head holds the durations that such a batch may take, and the one after them; if it begins a batch at
    one of them, runs and left say how many batches begin from there on and how long the last one is.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, number = [], 0

        def said(unit: tuple, part: int, held: list[np.ndarray], number: int) -> tuple:
            d = np.concatenate(held)
            following = next_starts(d, target)
            last, runs = last_starts(following)
            head = int(min(following[0], len(d) - 1)) + 1
            ends = {k: float(np.cumsum(d[k:])[-1]) for k in np.unique(last[:head]).tolist()}
            return (*unit, part, number, len(d), d[:head].tolist(), runs[:head].tolist(), [ends[k] for k in last[:head].tolist()])

        first = final = None
        kinds = []

        def noted() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kinds[:] = [f.type for f in batch.schema][:n_unit]
                yield batch

        for unit, part, held in _segments(noted(), n_unit):
            if first is None:
                first = said(unit, part, held, 0)
            else:
                final = unit, part, held, number
            number += 1
        found = [x for x in (first, final and said(*final)) if x]
        names = [*(f"u{k}" for k in range(n_unit)), "part", "number", "n", "head", "runs", "left"]
        if found:
            kinds += [pa.int64()] * 3 + [pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*found, strict=True), kinds, strict=True)], names)

    return rows


def _entered(summaries: Iterator[Row], n_unit: int, target: float) -> dict[int, tuple[float, int, int]]:
    """For each part that begins inside a unit: the length of the open batch, its number and the clips before it in the unit."""
    out: dict[int, tuple[float, int, int]] = {}
    now, state = None, (0.0, -1, 0)
    for r in summaries:
        unit, head = tuple(r)[:n_unit], r["head"]
        if unit != now:
            now, state = unit, (0.0, -1, 0)
        elif r["number"] == 0:
            out[r["part"]] = state
        total, batch, position = state
        start = 0
        if batch >= 0:
            while start < len(head) and total + head[start] <= target:
                total, start = total + head[start], start + 1
        if start < len(head):
            batch, total = batch + r["runs"][start], r["left"][start]
        state = total, batch, position + r["n"]
    return out


def greedy_batches(clips: DataFrame, unit: list[str], order: str, target: float, key: str = "uid", duration: str = "duration") -> DataFrame:
    """Adds batch (from 0 in each unit) and position (from 0 in the unit) to key, unit and duration.

    A batch ends before the clip that would take it over target; a longer clip is a batch of
    its own; a duration of 0 or less, NaN or null counts as UNKNOWN. The rule is a running sum with resets.
    Rows are range-partitioned and sorted once and kept, so a large unit lies in many tasks. Each task says
    what becomes of a batch that is open when it begins: its clips point to where the next batch would
    begin, and pointer doubling leads from any of the first clips to its last batch. These summaries,
    two for each task and as long as a batch, are read in order, one at a time, by the driver; then
    each task numbers its own rows. No task or driver holds a unit.
    """
    known = F.when((F.col(duration) > 0) & ~F.isnan(duration), F.col(duration)).otherwise(UNKNOWN).cast("double").alias(duration)
    rows = clips.select(*unit, F.col(key).alias(key), known, F.col(order).alias("_order"))
    held = rows.orderBy(*unit, "_order", key).drop("_order").withColumn("_at", F.monotonically_increasing_id())
    held, n_unit = checkpointed(held), len(unit)
    fields = [T.StructField(f"u{k}", held.schema[u].dataType) for k, u in enumerate(unit)]
    more = T.StructType.fromDDL("part long, number long, n long, head array<double>, runs array<long>, left array<double>").fields
    told = checkpointed(held.mapInArrow(_summary(target, n_unit), T.StructType([*fields, *more])))
    entered = clips.sparkSession.sparkContext.broadcast(_entered(told.orderBy("part", "number").toLocalIterator(), n_unit, target))  # a state for each task at most

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, batch, total, position = None, 0, 0.0, 0
        for rows_ in batches:
            units = list(zip(*(c.to_pylist() for c in rows_.columns[:n_unit]), strict=True))
            places, numbers = [], []
            if units and now is None and (state := entered.value.get(rows_.column(n_unit + 2)[0].as_py() >> 33)):
                now, (total, batch, position) = units[0], state
            for u, d in zip(units, rows_.column(n_unit + 1).to_pylist(), strict=True):
                if u != now:
                    now, batch, total, position = u, 0, 0.0, 0
                elif total + d > target:
                    batch, total = batch + 1, 0.0
                total += d
                places.append(position)
                numbers.append(batch)
                position += 1
            more = [pa.array(places, pa.int32()), pa.array(numbers, pa.int32())]
            yield pa.RecordBatch.from_arrays([*rows_.columns[:-1], *more], [*rows_.schema.names[:-1], "position", "batch"])

    out = T.StructType([*held.schema.fields[:-1], T.StructField("position", T.IntegerType()), T.StructField("batch", T.IntegerType())])
    return held.mapInArrow(fold, out)


def offsets(batched: DataFrame, unit: list[str], guard: float, duration: str = "duration") -> DataFrame:
    """Adds offset: seconds of the clips before it in its batch, with guard after each."""
    w = Window.partitionBy(*unit, "batch").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    return batched.withColumn("offset", F.coalesce(F.sum(F.col(duration) + guard).over(w), F.lit(0.0)))
