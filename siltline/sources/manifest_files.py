"""The manifest on disk: a Parquet table by source and shard, and JSON lines for exchange."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltline.operators.manifest import last_write_wins
from siltline.schema import MANIFEST, PENDING
from siltline.shared import checkpointed, remove, shared_folder

_DEFAULTS = {"source": "", "shard": -1, "source_name": "", "text": "", "path": "", "duration": 0.0, "sample_rate": 0, "status": PENDING, "stage": "fetch"}


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """Records of JSON lines, the last one of a uid in the order of files and lines.

    Blank, torn and other lines that are no objects are left out, as are records without a
    uid; unknown keys are dropped, missing ones take their defaults; NaN and infinities are numbers.
    """
    with_bad = T.StructType([*MANIFEST.fields, T.StructField("_bad", T.StringType())])
    raw = spark.read.schema(with_bad).option("columnNameOfCorruptRecord", "_bad").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json*").json(path)
    rows = raw.withColumn("_seq", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()))
    rows = checkpointed(rows).where("_bad is null and uid is not null").drop("_bad")  # kept first: the reader can't filter by _bad alone
    rows = last_write_wins(rows, "uid", "_seq").drop("_seq")
    filled = {c: F.coalesce(c, F.lit(v).cast(rows.schema[c].dataType)) for c, v in _DEFAULTS.items()}
    return rows.withColumns(filled | {"reasons": F.coalesce("reasons", F.array().cast("array<string>"))})


def write_json(records: DataFrame, path: str) -> None:
    """JSON lines, a folder for each source, by shard and uid in files of even size; NaN is written as a string that number() reads back."""
    keyed = records.withColumn("source_key", F.col("source"))
    keyed = keyed.repartitionByRange("source_key", "shard", "uid").sortWithinPartitions("source_key", "shard", "uid")
    keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_key").json(path)


def folder_number(shard: Column, shards_per_folder: int) -> Column:
    """The number of the folder that a shard is in, where folders hold several."""
    return F.floor(shard / shards_per_folder).cast("int")


def _others(there: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of a table in the folders (source, shards) that rows touch, but of other units."""
    same = {c: F.col(c).cast(rows.schema[c].dataType).alias(c) for c in rows.columns}
    there = there.select(*same.values(), F.coalesce(same["source"], F.lit("")).alias("_source"))
    units = rows.select(F.coalesce("source", F.lit("")).alias("_of"), F.col("shard").alias("_shard"), F.col("shards").alias("_shards")).distinct()
    own = F.col("_source") == F.col("_of")
    near = there.join(F.broadcast(units.select("_of", "_shards").distinct()), own & F.col("shards").eqNullSafe(F.col("_shards")), "left_semi")  # a row for each folder
    return near.join(F.broadcast(units), own & F.col("shard").eqNullSafe(F.col("_shard")), "left_anti").select(rows.columns)  # a row for each unit


def write_units(rows: DataFrame, path: str, shards_per_folder: int = 1) -> None:
    """Writes rows (uid, source, shard and others) in place of the units (source, shard) that they touch; rows must not come from the table itself.

    A unit has a folder of its own, which reads prune by, or shares it with shards_per_folder - 1 others of its source: a
    folder costs some 20 ms whatever is in it, so units of few records belong together. Then a folder's other
    units are written again with it, so no two writers may touch one folder at a time. A table keeps the number it
    was begun with. Rows are dealt out by ranges of units, so a folder is in as few files as it can be, and a large one in several.
    """
    folders = ["source", "shard"]
    if shards_per_folder > 1:
        folders = ["source", "shards"]
        rows = rows.withColumn("shards", folder_number(F.col("shard"), shards_per_folder))
        try:
            there = rows.sparkSession.read.parquet(path)
        except AnalysisException:  # no table yet
            there = None
        if there is not None:
            if "shards" not in there.columns:
                raise ValueError(f"the folders of {path} hold one shard each")
            rows = rows.unionByName(_others(there, rows))
    dealt = rows.repartitionByRange("source", "shard", "uid").sortWithinPartitions("source", "shard")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)


def write_table(records: DataFrame, path: str, shards_per_folder: int = 1) -> None:
    """Replaces the units (source, shard) that records touch; the rest of the table stays as it is (see write_units).

    records may come from the table itself: they are kept apart before anything is overwritten.
    """
    spark = records.sparkSession
    staged = f"{shared_folder(spark)}/staged-{uuid.uuid4().hex}"
    records.write.parquet(staged)
    write_units(spark.read.parquet(staged), path, shards_per_folder)
    remove(spark, staged)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table; filters on source, and on shard where each has a folder of its own, prune its folders."""
    schema = T.StructType([f for f in MANIFEST.fields if f.name not in ("source", "shard")] + [T.StructField("source", T.StringType()), T.StructField("shard", T.IntegerType())])
    return spark.read.schema(schema).parquet(path).select(schema.names)


def compact(spark: SparkSession, path: str, shards_per_folder: int = 1) -> None:
    """Rewrites the table with one row for each uid, the furthest stage's."""
    from siltline.schema import stage_ordinal

    rows = read_table(spark, path).withColumn("_seq", stage_ordinal(F.col("stage")))
    write_table(last_write_wins(rows, "uid", "_seq").drop("_seq"), path, shards_per_folder)
