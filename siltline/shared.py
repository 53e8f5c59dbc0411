"""The folder that driver and executors share, and tables kept in it."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it in spark.checkpoint.dir.

    Where none is set, a local session gets a temporary one; on a cluster that is an error.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="siltline-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder, in whatever store it is; none there is no error."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its lineage cut, in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def _cumulated(value: int, at: int):
    """Over sorted rows with the place at: each with the sum of a column from the begin of its partition to itself."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = -1, 0
        for batch in batches:
            part = batch.column(at).to_numpy() >> 33
            own = pc.fill_null(batch.column(value).cast(pa.int64()), 0).to_numpy()
            sums = np.cumsum(own)
            first = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
            gone = sums[first] - own[first]  # before each partition's first row
            if len(part) and part[0] == now:
                gone[0] -= total
            sums -= np.repeat(gone, np.diff(np.append(first, len(part))))
            if len(part):
                now, total = part[-1], sums[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums)], [*batch.schema.names, "_own"])

    return rows


def running_sum(df: DataFrame, *order: str, value: str, out: str = "total") -> DataFrame:
    """df with the sum of value (whole numbers) over the rows before each and itself in the order, without one task seeing all rows.

    As in ranked the rows are range-partitioned and sorted once and kept. Each task adds up its own, and
    a sum of each partition meets those before it in one task. Rows that are equal in the order come in any
    order; a null counts as 0.
    """
    held = checkpointed(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).alias("_part")
    sums = held.groupBy(part).agg(F.sum(value).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    base = sums.select("_part", F.coalesce(before, F.lit(0)).cast("long").alias("_before"))  # one row for each partition
    own = held.mapInArrow(_cumulated(held.columns.index(value), len(held.columns) - 1), T.StructType([*held.schema.fields, T.StructField("_own", T.LongType())]))
    own = own.withColumn("_part", F.shiftright("_at", 33)).join(F.broadcast(base), "_part")
    return own.withColumn(out, F.col("_before") + F.col("_own")).drop("_part", "_at", "_before", "_own")


def ranked(df: DataFrame, *order: str, out: str = "rank") -> DataFrame:
    """df with each row's place in the order, from 1, without gaps and without one task seeing all rows.

    The rows are range-partitioned and sorted once and kept; a row's place is its place in
    its partition after the rows of the partitions before it. Only counts meet in one task.
    """
    held = checkpointed(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    held = held.withColumn("_part", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND((1 << 33) - 1))
    counts = held.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    base = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))  # one row for each partition
    return held.join(F.broadcast(base), "_part").withColumn(out, F.col("_before") + F.col("_at") + 1).drop("_part", "_at", "_before")
