"""Token counts by the whole-token shortcut."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.llm import bpe
from siltline.llm.common import freeing, tune


def token_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = bpe.VOCABULARY,
    limit: int = 2048,
) -> DataFrame:
    """One row per row of docs: its id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    The vocabulary strings that encode alone as one token are proved on the
    driver and broadcast (bounded by the vocabulary). Matching pre-tokens count
    as one; only the rest is merged.

    Null and empty texts have no bytes and no tokens. Repeated rows, null ids and
    very long texts are counted like any other; an empty table gives no rows; other
    columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    tune(spark)
    whole = spark.sparkContext.broadcast(bpe.whole_tokens(bpe.vocabulary_path(vocabulary)))

    @freeing
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder(bpe.vocabulary_path(vocabulary), whole.value)
        for batch in (part for whole_batch in batches for part in bpe.parts(whole_batch)):
            texts = pc.fill_null(batch.column(1), "")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.binary_length(texts).cast(pa.int64()), pa.array(encoder.count(texts))],
                ["id", "n_bytes", "n_tokens"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    out = rows.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
    return out.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
