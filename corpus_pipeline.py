"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and
read again as the next stage's docs; all but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltline.llm.common import shared_folder, written
from siltline.llm.decontamination import contamination
from siltline.llm.packing import pack
from siltline.llm.quality import quality_scores
from siltline.llm.simhash import near_duplicates
from siltline.llm.suffix_dedup import remove_repeats


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _slim(docs: DataFrame) -> DataFrame:
    """doc_id and text, and every other column inside _row, so that no name can clash with what a stage adds."""
    return docs.select(F.struct(*(F.col(_name(c)) for c in docs.columns if c != "text")).alias("_row"), "doc_id", "text")


def _whole(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs again."""
    return df.select(*(F.col("text") if c == "text" else F.col(f"_row.{_name(c)}") for c in docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject, as they are.

    Null and empty texts are scored like any other. A null id has no label but a score; rows that repeat are each judged.
    """
    scored = quality_scores(_slim(docs), spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=("_row", "text"))
    return _whole(scored.where("predicted = 1"), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: that with the least id, of several the first; null ids come last.

    Rows are told apart by a number, not by their ids: rows that repeat under one id or a null id
    are a group like any other and one of them stays. Null, empty and blank texts are one group.
    """
    rows = written(docs.select(F.monotonically_increasing_id().alias("_key"), F.struct(*(F.col(_name(c)) for c in docs.columns if c != "text")).alias("_row"), "text"))
    order = F.struct(F.col("_row.doc_id").isNull().alias("none"), F.col("_row.doc_id").alias("id"), "_key").alias("_order")
    found = near_duplicates(rows.select(order, "text"), "_order")
    kept = found.where("_order._key = component_id._key").select("_order._key")
    return _whole(rows.join(kept, "_key", "left_semi"), docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str, words: int | None = None) -> DataFrame:
    """Every document without the bytes of repeated strings of 400 bytes; n_chars counts what is left.

    Where words is given, passages of so many words that repeat go as well, whatever bytes they take.

    A null text becomes an empty one; ids count for nothing. Two rows of equal text that come this
    far would both lose it: near_dedup leaves no such rows.
    """
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    cut = remove_repeats(docs, carry=others, words=words).select(F.col("key").alias("_row"), F.col("kept_text").alias("text"))
    cut = _whole(cut, docs)
    if "n_chars" in others:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark, as they are; those without words stay."""
    found = contamination(_slim(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=("_row", "text"))
    return _whole(found.where("not contaminated"), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, packed into sequences; a null or empty text is its end id alone."""
    return pack(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("repeats", repeats),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

#: SQL can't express the stages; the tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage over documents; the stages' outputs are kept in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
