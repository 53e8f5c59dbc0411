"""From the sources in the settings to records and clips: layouts, work units, and a fetch that takes each clip once."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltline.config import Settings, Source, active_sources
from siltline.operators.manifest import upsert
from siltline.plans.curation import nested
from siltline.shared import checkpointed
from siltline.sources import readers
from siltline.sources.manifest_files import folder_number, read_table, write_table
from siltline.sources.tars import AUDIO, tar_index, tar_payloads

_TAR, _PARQUET = r"(?i)\.tar(\.(gz|bz2|xz))?$", r"(?i)\.parquet$"
_AUDIO = r"(?i)\.(" + "|".join(AUDIO) + ")$"


def layout_of(files: DataFrame, explicit: str = "") -> str:
    """The layout of a listing (path): the explicit one, else tar, parquet or files, the first that is there. One row of counts is looked at."""
    if explicit:
        return explicit
    kinds = {"tar": _TAR, "parquet": _PARQUET, "files": _AUDIO}
    found = files.agg(*(F.count(F.when(F.col("path").rlike(p), 1)).alias(k) for k, p in kinds.items())).first()
    kind = next((k for k in kinds if found[k]), None)
    if kind is None:
        raise RuntimeError("no tar, Parquet or audio files in the listing")
    return kind


def _shards_of(files: DataFrame, source: Source) -> DataFrame:
    """path and shard of the tar shards that a source asks for; those without a number are left out."""
    shards = files.where(F.col("path").rlike(_TAR)).select("path", readers.shard_number(F.col("path")).alias("shard")).where("shard is not null")
    return shards.where(F.col("shard").isin(*source.shards)) if source.shards else shards


def fetch_plan(spark: SparkSession, settings: Settings, root: str = "", only: Iterable[str] = ()) -> DataFrame:
    """source, layout, shard, files, bytes and present of the units of the active sources, from names alone.

    Tar shards are a unit each, any other layout is one unit with shard -1. A shard that the settings ask for and
    that is not there has present false and nothing in it.
    """
    out = None
    for source in active_sources(settings.sources, only):
        files = readers.listing(spark, source.folder(root))
        layout = layout_of(files, source.layout)
        if layout == "tar":
            units = _shards_of(files, source).join(files.select("path", "size"), "path")
        else:
            units = files.where(F.col("path").rlike(_PARQUET if layout == "parquet" else _AUDIO)).select(F.lit(-1).alias("shard"), "size")
        units = units.groupBy("shard").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))
        if layout == "tar" and source.shards:
            asked = spark.createDataFrame([(int(s),) for s in sorted(set(source.shards))], "shard int")
            units = asked.join(units, "shard", "left")
        units = units.select(
            F.lit(source.slug).alias("source"), F.lit(layout).alias("layout"), F.col("shard").cast("int").alias("shard"), F.coalesce("files", F.lit(0)).cast("long").alias("files"),
            F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"), F.col("files").isNotNull().alias("present"),
        )
        out = units if out is None else out.unionAll(units)
    return spark.createDataFrame([], "source string, layout string, shard int, files long, bytes long, present boolean") if out is None else out


def _named(spark: SparkSession, source: Source, root: str) -> tuple[str, DataFrame, DataFrame | None]:
    """The layout, the source's members by name and place without their bytes, and for layouts that Spark reads the same with them."""
    folder = source.folder(root)
    files = readers.listing(spark, folder)
    layout = layout_of(files, source.layout)
    if layout == "tar":
        return layout, tar_index(_shards_of(files, source)).withColumn("place", F.coalesce("offset", F.lit(0))), None
    if layout == "parquet":
        members = readers.audio_parquet(spark, folder)
    else:
        members = readers.loose_files(spark, folder).withColumn("place", F.lit(0).cast("long"))
    return layout, members.drop("content"), members


def fetch(spark: SparkSession, settings: Settings, folder: str, root: str = "", only: Iterable[str] = ()) -> DataFrame:
    """Takes what the active sources hold and the manifest table at folder does not; returns source, shard, seen and added.

    Names come first: headers of tars, names and texts of Parquet rows, a listing of loose files. Extensions, uids that are
    known, a uid's first member, limit_per_shard and limit (both count what the manifest has) decide on them; only
    then are the bytes of the chosen members read, of tars by their place. Clips go to <folder>-clips (uid,
    content, by source and shard), then records to the manifest; a fetch that broke off between the two writes
    the same clips again in place of the first. A fetch that is run again adds nothing. A source's sidecar
    (metadata_file, in its folder) gives the texts that members lack.
    """
    folder, counts, per = folder.rstrip("/"), None, settings.shards_per_folder
    for source in active_sources(settings.sources, only):
        layout, index, members = _named(spark, source, root)
        index = checkpointed(index.where(F.col("name").rlike(_AUDIO)))
        try:
            known = read_table(spark, folder).where(F.col("source") == source.slug).select("uid", "source", "shard")
            step = known.count()
        except AnalysisException:  # no table yet
            known, step = spark.createDataFrame([], "uid string, source string, shard int"), 0
        sidecar = None
        if source.metadata_file:
            sidecar = readers.transcripts(spark, f"{source.folder(root)}/{source.metadata_file}", source.metadata_key, source.metadata_text, source.metadata_delimiter)
        fresh = checkpointed(readers.ingested(index, source.slug, known, sidecar, source.limit_per_shard, source.limit))
        shard = (F.coalesce("shard", F.lit(-1)) if "shard" in index.columns else F.lit(-1)).cast("int").alias("shard")
        seen = index.groupBy(shard).agg(F.count("*").alias("seen")).join(fresh.groupBy("shard").agg(F.count("*").alias("added")), "shard", "left")
        seen = seen.select(F.lit(source.slug).alias("source"), "shard", "seen", F.coalesce("added", F.lit(0)).cast("long").alias("added"))
        if not fresh.isEmpty():
            keys = fresh.select("uid", "source", "shard", "path", "place", *(c for c in ("member", "offset", "size") if c in fresh.columns))
            clips = tar_payloads(keys) if layout == "tar" else members.select("path", "place", "content").join(keys, ["path", "place"])
            unit = F.col("shard") if per <= 1 else folder_number(F.col("shard"), per).alias("shards")
            clips = clips.select("uid", "content", "source", unit, F.lit(step).alias("fetched"))  # dealt out by tars and places already
            clips.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*clips.columns[2:]).parquet(f"{folder}-clips")
            records = nested(fresh)
            try:
                units = records.select("source", "shard").distinct()
                old = read_table(spark, folder).join(F.broadcast(units), ["source", "shard"], "left_semi")  # a row for each unit
                write_table(upsert(old.select(records.columns), records, "uid"), folder, per)
            except AnalysisException:
                write_table(records, folder, per)
        counts = seen if counts is None else counts.unionAll(seen)
    return spark.createDataFrame([], "source string, shard int, seen long, added long") if counts is None else checkpointed(counts)


def fetched_clips(spark: SparkSession, folder: str) -> DataFrame:
    """uid and content of all that fetch has taken."""
    return spark.read.parquet(f"{folder.rstrip('/')}-clips").select("uid", "content")
