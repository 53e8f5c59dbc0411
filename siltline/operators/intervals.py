"""Joins of points with intervals by a sweep: interval ends are events, and a running sum says how many intervals hold a point."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltline.shared import running_sum


def _or(values: list[str]) -> list[Column]:
    return [F.col(v) for v in values]


def covered(points: DataFrame, intervals: DataFrame, key: list[str], at: str = "at", start: str = "start", end: str = "end", out: str = "covers") -> DataFrame:
    """points with the number of intervals [start, end) of their key that hold at.

    An interval adds 1 at its start and takes 1 away at its end; points and ends are sorted together, ends before
    points of the same place, and summed over the whole order. As every key's ends add up to 0, the sum needs no
    reset at a key, and so no task has to see all points of one: work grows with points and intervals, never with
    their product. Empty and reversed intervals, and those with a null or NaN end, hold nothing; a point whose
    place is null or NaN is in none. Null keys are a key. Repeated points and intervals count each.
    """
    shown = [c for c in points.columns if c not in {*key, at}]
    place = lambda c: F.col(c).cast("double")
    whole = intervals.where((place(start) < place(end)) & ~F.isnan(place(end)))  # a comparison with null is no row
    ends = whole.select(*_or(key), F.explode(F.array(F.struct(place(start).alias("_x"), F.lit(1).alias("_d")), F.struct(place(end).alias("_x"), F.lit(-1).alias("_d")))).alias("_e"))
    ends = ends.select(*_or(key), F.col("_e._x").alias("_x"), F.col("_e._d").cast("long").alias("_d"), F.lit(0).alias("_kind"))
    own = points.select(*_or(key), place(at).alias("_x"), F.lit(0).cast("long").alias("_d"), F.lit(1).alias("_kind"), F.struct(F.col(at).alias("_at"), *shown).alias("_row"))
    swept = running_sum(ends.unionByName(own, allowMissingColumns=True), *key, "_x", "_kind", value="_d", out="_open")
    known = F.when(F.col("_x").isNull() | F.isnan("_x"), 0).otherwise(F.col("_open")).cast("long")
    kept = swept.where("_kind = 1").select(*_or(key), F.col("_row._at").alias(at), *(F.col("_row")[c].alias(c) for c in shown), known.alias(out))
    return kept.select(*points.columns, out)


def merged(intervals: DataFrame, key: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """(key, start, end) of the stretches that any of a key's intervals hold; those that meet or overlap are one.

    Where the running sum of ends rises from 0 a stretch begins, where it falls to 0 it ends. The ends of one place
    are added up first, so intervals that meet are joined. Stretches are paired by their number in the whole order.
    """
    place = lambda c: F.col(c).cast("double")
    whole = intervals.where((place(start) < place(end)) & ~F.isnan(place(end)))
    ends = whole.select(*_or(key), F.explode(F.array(F.struct(place(start).alias("_x"), F.lit(1).alias("_d")), F.struct(place(end).alias("_x"), F.lit(-1).alias("_d")))).alias("_e"))
    ends = ends.groupBy(*key, F.col("_e._x").alias("_x")).agg(F.sum("_e._d").cast("long").alias("_d"))
    swept = running_sum(ends, *key, "_x", value="_d", out="_open")
    opens, shuts = (F.col("_open") > 0) & (F.col("_open") == F.col("_d")), (F.col("_open") == 0) & (F.col("_d") < 0)
    edge = swept.where(opens | shuts).withColumn("_one", F.when(opens, 1).otherwise(0).cast("long"))
    numbered = running_sum(edge, *key, "_x", value="_one", out="_n")
    pairs = numbered.groupBy(*key, "_n").agg(F.min("_x").alias(start), F.max("_x").alias(end))
    return pairs.drop("_n")


def power_inside(samples: DataFrame, spans: DataFrame, key: list[str], value: str = "value", at: str = "at", least: int = 100, floor: float = 1e-10) -> DataFrame:
    """For each key: n_inside, n_outside (samples) and snr_db, mean power inside spans over that outside.

    Null with fewer than least samples on either side; 60 where the outside is not above floor. Samples are
    summed for each key before they are shuffled.
    """
    inside = F.col("covers") > 0
    square = F.col(value).cast("double") * F.col(value).cast("double")
    found = covered(samples.select(*key, at, value), spans, key, at).groupBy(*key).agg(
        F.count(F.when(inside, 1)).alias("n_inside"), F.count(F.when(~inside, 1)).alias("n_outside"), F.avg(F.when(inside, square)).alias("_s"), F.avg(F.when(~inside, square)).alias("_n")
    )
    ratio = F.when(F.col("_n") <= floor, F.lit(60.0)).otherwise(10 * F.log10((F.col("_s") + floor) / (F.col("_n") + floor)))
    return found.withColumn("snr_db", F.when((F.col("n_inside") >= least) & (F.col("n_outside") >= least), ratio)).drop("_s", "_n")
