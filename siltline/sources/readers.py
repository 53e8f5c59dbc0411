"""Readers of the other layouts: Parquet audio, loose files, transcripts, score and metadata files; and ingestion."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltline.functions.expr import number, shard_number, stem, text_or, uid
from siltline.operators.manifest import ingest_once, last_write_wins, within_budget
from siltline.schema import PENDING, SCORES
from siltline.sources.tars import AUDIO

# Names of text columns, the first that is there counts; columns of score files.
TEXT_COLUMNS = ("sentence", "text", "transcription", "transcript", "normalized_text")
OPINIONS = {"mos_pred": "nisqa_mos", "noi_pred": "nisqa_noi", "dis_pred": "nisqa_dis", "col_pred": "nisqa_col", "loud_pred": "nisqa_loud"}


#: Bytes in which a header is looked for.
HEADER_BYTES = 1 << 16


def audio_parquet(spark: SparkSession, path: str, column: str = "audio") -> DataFrame:
    """path, place (in the file), name, content, text of rows whose audio has bytes; a name that is missing is the file's with the row's place."""
    raw = spark.read.parquet(path)
    text = next((c for c in TEXT_COLUMNS if c in raw.columns), None)
    audio = F.col(column)
    fallback = F.concat(stem(F.col("_metadata.file_path")), F.lit("_"), F.col("_metadata.row_index").cast("string"), F.lit(".wav"))
    rows = raw.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("place"), F.coalesce(F.nullif(audio["path"], F.lit("")), fallback).alias("name"),
        audio["bytes"].alias("content"), (F.coalesce(F.col(text).cast("string"), F.lit("")) if text else F.lit("")).alias("text"),
    )
    return rows.where(F.octet_length("content") > 0)


def loose_files(spark: SparkSession, path: str, extensions: tuple[str, ...] = AUDIO) -> DataFrame:
    """path, name, content of audio files in a folder and below."""
    glob = "*.{" + ",".join(x for e in extensions for x in (e, e.upper())) + "}"
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return raw.select("path", F.regexp_extract("path", "[^/]*$", 0).alias("name"), "content")


def transcripts(spark: SparkSession, path: str, key: str = "file_name", text: str = "sentence", delimiter: str = "\t") -> DataFrame:
    """(stem, sentence): a delimited file with a header and without quoting; the last line of a key counts, blank keys are left out."""
    raw = spark.read.option("sep", delimiter).option("header", True).option("quote", "").option("encoding", "UTF-8").csv(path)
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    rows = raw.select(stem(F.trim(F.col(key))).alias("stem"), F.trim(F.coalesce(F.col(text), F.lit(""))).alias("sentence"), place.alias("line"))
    return last_write_wins(rows.where("stem <> ''"), "stem", "line").select("stem", "sentence")


def opinion_file(spark: SparkSession, path: str) -> DataFrame:
    """(stem, nisqa_*) of a score file; values that are no numbers are null."""
    raw = spark.read.option("header", True).csv(path)
    name = "deg" if "deg" in raw.columns else "filename"
    return raw.select(stem(F.col(name)).alias("stem"), *(number(F.col(c)).alias(n) for c, n in OPINIONS.items() if c in raw.columns))


def metadata_files(spark: SparkSession, path: str, listing: DataFrame | None = None) -> DataFrame:
    """Training candidates of metadata CSVs: rows without a file, or whose file listing (path) lacks, are left out; bad durations are 0."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    has = set(raw.columns)
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    rows = raw.where(F.coalesce(F.col("file"), F.lit("")) != "").select(
        F.concat_ws("/", folder, "file").alias("path"), F.coalesce(F.nullif("uid", F.lit("")), stem(F.col("file"))).alias("uid"),
        F.coalesce(F.nullif("source", F.lit("")), F.element_at(F.split(folder, "/"), -1)).alias("source"),
        F.coalesce(number(F.col("duration")), F.lit(0.0)).alias("duration"), F.coalesce("text", F.lit("")).alias("text"),
        *(number(F.col(c)).alias(c) for c in SCORES if c in has),
    )
    return rows if listing is None else rows.join(listing.select("path"), "path", "left_semi")


def scanned_files(spark: SparkSession, path: str) -> DataFrame:
    """Training candidates of a folder without metadata: headers give durations, a file's folder is its source ('unknown' right under path).

    A file whose header can't be read is no candidate; WAV and FLAC headers can. Only the first bytes of a file go through Python.
    """
    from siltline.functions.audio import header

    @F.pandas_udf("double")
    def seconds(content: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in content:
            out = []
            for data in part:
                try:
                    out.append(header(data)[0])
                except Exception:  # noqa: BLE001  any unreadable header
                    out.append(None)
            yield pd.Series(out, dtype="float64")

    files = loose_files(spark, path)
    root = path.rstrip("/").partition("://")[2] or path.rstrip("/")
    below = F.substring_index(F.col("path"), f"{root}/", -1)
    source = F.when(F.instr(below, "/") > 0, F.element_at(F.split("path", "/"), -2)).otherwise("unknown")
    rows = files.select("path", stem(F.col("path")).alias("uid"), source.alias("source"), seconds(F.substring("content", 1, HEADER_BYTES)).alias("duration"), F.lit("").alias("text"))
    return rows.where("duration is not null and not isnan(duration)")


def candidates(spark: SparkSession, clean: str, low_quality: str | None = None) -> DataFrame:
    """Training candidates of the clean folder and, if named, the low-quality one; a folder that is missing has none.

    A folder's metadata files (<source>/metadata.csv) name its candidates, those whose files are
    there; without such files its audio files do.
    """
    out = None
    for root in filter(None, (clean, low_quality)):
        try:
            if listing(spark, root, "metadata.csv").where(F.col("path").rlike(r"/[^/]+/metadata\.csv$")).isEmpty():  # the clips' names meet no task
                found = scanned_files(spark, root)
            else:
                found = metadata_files(spark, f"{root.rstrip('/')}/*/metadata.csv", listing(spark, root))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        out = found if out is None else out.unionByName(found, allowMissingColumns=True)
    return spark.createDataFrame([], "path string, uid string, source string, duration double, text string") if out is None else out


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, size and time of the files in a folder and below; nothing is read but names."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return raw.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("time"))


def layout(names: list[str], explicit: str = "") -> str:
    """The layout of a listing: the explicit one, else tar, parquet or files, whichever is there first."""
    if explicit:
        return explicit
    for kind, ends in (("tar", (".tar", ".tar.gz")), ("parquet", (".parquet",)), ("files", tuple(f".{e}" for e in AUDIO))):
        if any(n.lower().endswith(ends) for n in names):
            return kind
    raise RuntimeError("no tar, Parquet or audio files in the listing")


def work_units(listing: DataFrame, source: str, kind: str, shards: list[int] | None = None) -> DataFrame:
    """(source, shard) units of a listing (path): one for each tar shard that is asked for, else a single one with shard null."""
    if kind != "tar":
        return listing.sparkSession.createDataFrame([(source, None)], "source string, shard int")
    units = listing.where(F.col("path").rlike(r"\.tar(\.gz)?$")).select(F.lit(source).alias("source"), shard_number(F.col("path")).alias("shard"))
    units = units.where("shard is not null").distinct()
    return units.where(F.col("shard").isin(shards)) if shards else units


def ingested(members: DataFrame, source: str, known: DataFrame, sidecar: DataFrame | None = None, budget: int = 0, limit: int = 0) -> DataFrame:
    """New records of members (path, name, perhaps shard, text and others, which stay), each uid once and none that is known.

    The text is the member's own, else the sidecar's, else ''. budget bounds the records of
    each shard, limit those of the source, those that known already holds included; 0 is no bound.
    """
    has = set(members.columns)
    own = F.col("text") if "text" in has else F.lit("")
    shard = F.coalesce(F.col("shard"), F.lit(-1)) if "shard" in has else F.lit(-1)
    more = [c for c in members.columns if c not in {"uid", "source", "shard", "path", "name", "source_name", "stem", "text"}]
    rows = members.select(uid(F.lit(source), F.col("name")).alias("uid"), F.lit(source).alias("source"), shard.cast("int").alias("shard"), "path", F.col("name").alias("source_name"), stem(F.col("name")).alias("stem"), own.alias("text"), *more)
    if sidecar is not None:
        rows = rows.join(sidecar, "stem", "left").withColumn("text", text_or(F.col("text"), F.col("sentence"))).drop("sentence")
    fresh = ingest_once(rows.drop("stem"), known, "uid", "path", "source_name")
    used = known.groupBy("source", "shard").agg(F.count("*").alias("n")) if {"source", "shard"} <= set(known.columns) else None
    fresh = within_budget(fresh, ["source", "shard"], ["uid"], budget, used)
    if limit > 0:
        have = known.where(F.col("source") == source).count() if "source" in known.columns else 0
        fresh = fresh.orderBy("shard", "uid").limit(max(0, limit - have))
    return fresh.withColumns({"status": F.lit(PENDING), "stage": F.lit("fetch"), "reasons": F.array().cast("array<string>")})
