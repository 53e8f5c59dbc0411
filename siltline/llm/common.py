"""Shared helpers: session settings, checkpoints, byte-level word splitting."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A-Z to a-z, every other byte as it is.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: As LOWER, and every byte that is no ASCII letter or digit and not part of a
#: non-ASCII character becomes a space: splitting then gives the words
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of the lower-cased text.
ALNUM = bytes(
    LOWER[c] if c >= 0x80 or 48 <= c <= 57 or 97 <= LOWER[c] <= 122 else 32 for c in range(256)
)

#: Text handled at once inside a task, in bytes; bounds a task's working memory.
CHUNK_BYTES = 1 << 20


#: Of an Arrow batch, in bytes; a single longer text stands alone.
BATCH_BYTES = 8 << 20


def tune(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches in bytes, unless they are set to less already.

    Spark reads the setting when a plan runs, long after a function has returned its DataFrame,
    so it stays set. It changes how rows travel to Python, never a result.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(spark.conf.get(name).rstrip("b"))
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def freeing(rows: Callable) -> Callable:
    """A task's function that gives freed memory back to the system when it ends, as Python workers live on for other tasks."""

    @wraps(rows)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from rows(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return run


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


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its lineage cut, in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table of its own in the shared folder: as checkpointed, for rows with texts, which it compresses."""
    folder = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


#: A key is heavy with more than this part of all rows and more rows than this: then there can't be more such keys than the first says.
HEAVY_PART, HEAVY_ROWS = 1000, 10_000


def joined_evenly(rows: DataFrame, side: DataFrame, key: str, total: int) -> DataFrame:
    """rows joined with side (kept, one row for each key, with _n, the rows of that key among total), whatever share of rows a key has.

    Heavy keys, a thousand at most, are broadcast; the others are shuffled.
    """
    least = max(total // HEAVY_PART, HEAVY_ROWS)
    if (side.agg(F.max("_n")).first()[0] or 0) <= least:
        return rows.join(side.drop("_n"), key)
    heavy, light = side.where(F.col("_n") > least).drop("_n"), side.where(F.col("_n") <= least).drop("_n")
    some = rows.join(F.broadcast(heavy), key)
    return some.unionByName(rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key))


def with_fields(kept: list[T.StructField], more: str) -> T.StructType:
    """A task's output: fields as they are, whatever their names, and more in DDL."""
    return T.StructType([*kept, *T.StructType.fromDDL(more).fields])


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def utf8(texts: pa.Array) -> list[bytes]:
    """The texts of an Arrow string column as UTF-8; null counts as empty."""
    return [t or b"" for t in texts.cast(pa.binary()).to_pylist()]


def in_chunks(sizes: list[int], most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes add up to about most; a larger one stands alone."""
    lo, total = 0, 0
    for k, n in enumerate(sizes):
        if k > lo and total + n > most:
            yield lo, k
            lo, total = k, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbered(rows: DataFrame, group: str, out: str, across: bool) -> DataFrame:
    """rows with a gapless number from 0: for each group, or across all in order of the group.

    rows holds part (the task that made a row) and k (the row's place among those of
    its part and group). Only counts are gathered: first those of 1,024 neighbouring
    parts, then one total for each such block, so no task gets more than some thousand.
    """
    counts = rows.groupBy(group, "part").agg(F.count("*").alias("_n")).withColumn("_block", F.expr("part div 1024"))
    totals = counts.groupBy(group, "_block").agg(F.sum("_n").alias("_n"))
    order = Window.orderBy(group, "_block") if across else Window.partitionBy(group).orderBy("_block")
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = totals.select(group, "_block", before(order).alias("_far"))
    near = before(Window.partitionBy(group, "_block").orderBy("part"))
    base = counts.withColumn("_near", near).join(totals, [group, "_block"])
    base = base.select(group, "part", (F.col("_near") + F.col("_far")).alias("_base"))
    return rows.join(base, [group, "part"]).withColumn(out, F.col("_base") + F.col("k")).drop("_base")
