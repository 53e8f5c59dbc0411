"""Packing by power-of-two decomposition."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.llm import bpe
from siltline.llm.common import checkpointed, freeing, numbered, tune


def binary_lengths(n: int, most: int) -> list[int]:
    """n as pieces of most, then the powers of two of the rest, the largest first."""
    return [most] * (n // most) + [1 << b for b in reversed(range(most.bit_length() - 1)) if (n % most) >> b & 1]


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = bpe.VOCABULARY,
    most: int = 2048,
    end_id: int = 1,
) -> DataFrame:
    """Pieces of power-of-two length, each a sequence of its own, so none crosses documents or is padded.

    A document is its ids and then end_id. It is cut into pieces of most ids (a power
    of two) and the binary lengths of the rest. Equal lengths form a bucket: sequence
    numbers run from 0 without gaps, bucket after bucket. Returns a row per piece:
    the id, start (ids of the document before it), length, ids_crc32 (of the ids as
    little-endian unsigned 32-bit numbers), doc_tokens, sequence_id, offset (always 0).

    A null or empty text is end_id alone. Repeated rows and null ids are packed like
    any others; very long texts give more pieces; an empty table gives no rows; pieces of
    equal length are numbered in the order of the tasks that read them; other columns are not read.
    """
    if most & (most - 1):
        raise ValueError("most must be a power of two")
    spark = docs.sparkSession
    tune(spark)
    whole = spark.sparkContext.broadcast(bpe.whole_tokens(bpe.vocabulary_path(vocabulary)))

    @freeing
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder(bpe.vocabulary_path(vocabulary), whole.value)
        part, last = TaskContext.get().partitionId(), np.array([end_id], "<u4").tobytes()
        seen: Counter[int] = Counter()
        for batch in (part for whole_batch in batches for part in bpe.parts(whole_batch)):
            ids, begin = encoder.encode(pc.fill_null(batch.column(1), ""))
            rows, starts, lengths, crcs, totals, place = [], [], [], [], [], []
            for row in range(len(batch)):
                doc = ids[begin[row] : begin[row + 1]].tobytes() + last
                at, total = 0, len(doc) // 4
                for n in binary_lengths(total, most):
                    rows.append(row)
                    starts.append(at)
                    lengths.append(n)
                    crcs.append(zlib.crc32(memoryview(doc)[4 * at : 4 * (at + n)]))
                    totals.append(total)
                    place.append(seen[n])
                    seen[n] += 1
                    at += n
            numbers = (starts, lengths, crcs, totals, [part] * len(rows), place)
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in numbers)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "start", "length", "ids_crc32", "doc_tokens", "part", "k"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, part long, k long"
    pieces = numbered(checkpointed(rows.mapInArrow(cut, schema)), "length", "sequence_id", across=True)
    return pieces.select(
        F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.lit(0).cast("long").alias("offset"),
    )
