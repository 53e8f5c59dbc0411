"""The manifest as a table: last write wins, upserts, ingest-once, budgets, pending scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltline.schema import ALIVE, STAGES, stage_ordinal


def last_write_wins(df: DataFrame, key: str, *seq: str) -> DataFrame:
    """The row with the largest seq for each key. The rows of a key are combined before they are shuffled."""
    rest = [c for c in df.columns if c != key]
    newest = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*seq)).alias("_row"))
    return newest.select(key, *(F.col("_row")[c].alias(c) for c in rest)).select(df.columns)


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """new, and those rows of old whose key new doesn't hold."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def ingest_once(incoming: DataFrame, known: DataFrame, key: str, *order: str) -> DataFrame:
    """The first of the incoming rows of each key that is not known yet."""
    fresh = incoming.join(known.select(key).distinct(), key, "left_anti")
    rest = [c for c in fresh.columns if c != key]
    first = fresh.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return first.select(key, *(F.col("_row")[c].alias(c) for c in rest)).select(incoming.columns)


def within_budget(df: DataFrame, unit: list[str], order: list[str], budget: int, used: DataFrame | None = None) -> DataFrame:
    """The first rows of each unit, as many as budget leaves after used (unit columns and n); 0 is no limit.

    The rank filter is pushed into the sort of each task, so at most budget rows of a unit leave one.
    """
    if budget <= 0:
        return df
    place = F.row_number().over(Window.partitionBy(*unit).orderBy(*order))
    ranked = df.withColumn("_place", place).where(F.col("_place") <= budget)
    if used is not None:
        ranked = ranked.join(used.withColumnRenamed("n", "_used"), unit, "left")
        ranked = ranked.where(F.col("_place") <= budget - F.coalesce("_used", F.lit(0))).drop("_used")
    return ranked.drop("_place")


def alive(df: DataFrame) -> DataFrame:
    return df.where(F.col("status").isin(*ALIVE))


def pending_for(df: DataFrame, stage: str, source: str | None = None, shard: int | None = None) -> DataFrame:
    """Live rows that have not been through stage; source and shard prune partitions. An unknown stage is pending for all."""
    out = alive(df)
    if source is not None:
        out = out.where(F.col("source") == source)
    if shard is not None:
        out = out.where(F.col("shard") == shard)
    return out.where(stage_ordinal(F.col("stage")) < STAGES.index(stage)) if stage in STAGES else out


def with_sidecar(clips: DataFrame, sidecar: DataFrame, key: str = "stem") -> DataFrame:
    """clips with text: its own, else that of the sidecar (the last of a key by line), else ''."""
    named = last_write_wins(sidecar, key, "line").select(key, F.trim("sentence").alias("_sentence"))
    own = F.nullif(F.col("text"), F.lit(""))
    return clips.join(named, key, "left").withColumn("text", F.coalesce(own, "_sentence", F.lit(""))).drop("_sentence")


def update_scores(records: DataFrame, scores: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """records with the scores that were found; the others stay as they are."""
    new = scores.select(key, *(F.col(c).alias(f"_{c}") for c in columns))
    out = records.join(new, key, "left")
    return out.withColumns({c: F.coalesce(f"_{c}", c) for c in columns}).drop(*(f"_{c}" for c in columns))


def missing(requested: DataFrame, present: DataFrame, key: str) -> DataFrame:
    return requested.join(present.select(key), key, "left_anti")
