"""Training sets: a repeatable shuffle, a cap, a split, and rows for export."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.functions.expr import bucket, fixed4, hours
from siltline.schema import KEEP, LOW_QUALITY, PENDING
from siltline.shared import ranked

# Scores in metadata files; folders by status; the least number of files for a validation part.
EXPORTED = ("dnsmos_ovrl", "dnsmos_sig", "dnsmos_bak", "nisqa_mos", "nisqa_dis", "squim_pesq", "vad_snr_db", "bandwidth_hz", "speech_ratio")
BUCKETS = {KEEP: "clean", PENDING: "clean", LOW_QUALITY: "low_quality"}
LEAST_FOR_VALIDATION = 50


def split(df: DataFrame, seed: int, fraction: float, cap: int = 0, key: str = "uid") -> DataFrame:
    """df in an order that seed and key decide: place (from 1), at most cap rows (0: all), and part 'val' or 'train'.

    The first int(n * fraction) rows are 'val', none if there are under 50.
    """
    shuffled = ranked(df.withColumn("_order", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key)))), "_order", key, out="place").drop("_order")
    if cap > 0:
        shuffled = shuffled.where(F.col("place") <= cap)
    n = shuffled.count()  # of what ranked has kept
    n_val = int(n * fraction) if n >= LEAST_FOR_VALIDATION else 0
    return shuffled.withColumn("part", F.when(F.col("place") <= n_val, "val").otherwise("train"))


def prepare_summary(parts: DataFrame) -> DataFrame:
    """Files and hours of each part and source."""
    return parts.groupBy("part", "source").agg(F.count("*").alias("files"), hours(F.col("duration")).alias("hours"))


def drop_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("drop_reason")).agg(F.count("*").alias("n"))


def metadata_rows(df: DataFrame, extension: str = "flac", extra: tuple[str, ...] = ()) -> DataFrame:
    """Rows of the metadata files: strings as they are written, ordered by uid within each bucket when written."""
    has = set(df.columns)
    scores = [(fixed4(F.col(c)) if c in has else F.lit("")).alias(c) for c in EXPORTED]
    file = F.concat(F.col("uid"), F.lit(f".{extension}"))
    return df.select("uid", "source", file.alias("file"), F.format_string("%.3f", F.col("duration")).alias("duration"), "text", *scores, *extra)


def bucketed(df: DataFrame, buckets: Mapping[str, str] = BUCKETS) -> DataFrame:
    """Materialized records with their bucket; those of a status without one are left out."""
    return df.where(F.col("stage") == "materialize").withColumn("bucket", bucket(F.col("status"), buckets)).where("bucket is not null")


def write_metadata(df: DataFrame, folder: str, extension: str = "wav", buckets: Mapping[str, str] = BUCKETS, source: str | None = None) -> None:
    """CSV files by uid of materialized records: <folder>/by_source for each bucket and source, <folder>/combined for each bucket.

    The file column is relative to the bucket's and source's folder, or to the bucket's. Rows are
    dealt out by ranges, so that no bucket or source meets in one task. Reruns replace what they write; with a
    source named, only its files and the combined ones.
    """
    kept = bucketed(df, buckets).withColumn("source_key", F.coalesce(F.nullif("source", F.lit("")), F.lit("unknown")))
    rows = metadata_rows(kept, extension, extra=("bucket", "source_key"))
    whole = rows.withColumn("file", F.concat_ws("/", "source_key", "file")).drop("source_key")
    for name, out, keys in (("by_source", rows, ["bucket", "source_key"]), ("combined", whole, ["bucket"])):
        if source is not None and name == "by_source":
            out = out.where(F.col("source_key") == (source or "unknown"))
        out = out.repartitionByRange(*keys, "uid").sortWithinPartitions(*keys, "uid")
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).option("header", True).option("escape", '"').csv(f"{folder}/{name}")


def index_rows(parts: DataFrame) -> DataFrame:
    """Rows of the index files of a split, in its order: part, place, uid, source, duration, text and dnsmos_ovrl, empty where it wasn't measured."""
    score = F.coalesce(F.col("dnsmos_ovrl").cast("string"), F.lit("")) if "dnsmos_ovrl" in parts.columns else F.lit("")
    return parts.select("part", "place", "uid", "source", F.format_string("%.3f", F.col("duration")).alias("duration"), "text", score.alias("dnsmos_ovrl"))


def write_index(parts: DataFrame, folder: str) -> None:
    """CSV files of each part of a split, in its order; no folder for a part without rows."""
    rows = index_rows(parts).repartitionByRange("part", "place").sortWithinPartitions("part", "place").drop("place")
    rows.write.mode("overwrite").partitionBy("part").option("header", True).option("escape", '"').csv(folder)


def dataset_summary(parts: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row: train_files, val_files, train_hours, by_source (files of the training part) and dropped (candidates by drop_reason)."""
    train = F.col("part") == "train"
    counts = parts.agg(
        F.count(F.when(train, 1)).alias("train_files"), F.count(F.when(~train, 1)).alias("val_files"), F.coalesce(hours(F.when(train, F.col("duration"))), F.lit(0.0)).alias("train_hours")
    )

    def mapped(df: DataFrame, key: str, out: str) -> DataFrame:
        one = df.groupBy(key).agg(F.count("*").alias("n"))  # a row for each source or reason
        return one.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "n")))).alias(out))

    by_source = mapped(parts.where(train), "source", "by_source")
    dropped = mapped(candidates.where("drop_reason is not null"), "drop_reason", "dropped")
    return counts.join(F.broadcast(by_source), how="left").join(F.broadcast(dropped), how="left")
