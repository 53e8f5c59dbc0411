"""Incremental ingestion: new files become new rows of a table exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from siltline.operators.manifest import ingest_once
from siltline.shared import checkpointed


def ingest_stream(incoming: DataFrame, target: str, checkpoint: str, key: str, *order: str) -> StreamingQuery:
    """Takes what is there and not yet taken of a file stream, then stops; a rerun goes on where it stopped.

    Each micro-batch is anti-joined with the table, so no state grows with the keys seen so
    far. A batch that is replayed after a failure finds its own rows and adds none twice.
    """

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        try:
            known = spark.read.parquet(target).where(F.col("_batch") != number).select(key)
        except AnalysisException:  # no table yet
            known = rows.select(key).limit(0)
        fresh = checkpointed(ingest_once(rows, known, key, *order)).withColumn("_batch", F.lit(number))
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(target)

    return incoming.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
