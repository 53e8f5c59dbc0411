"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltline.llm import embedding_dedup
from siltline.llm.best_fit import pack_whole
from siltline.llm.centroids import clusters
from siltline.llm.decontamination import contamination
from siltline.llm.divergence import source_divergence
from siltline.llm.language_id import language_ids
from siltline.llm.license_scan import license_scan
from siltline.llm.packing import pack
from siltline.llm.quality import quality_scores
from siltline.llm.sharding import shards
from siltline.llm.simhash import near_duplicates
from siltline.llm.sql import CLUSTERS_SQL, DIVERGENCE_SQL, LINKS_SQL, REPEATS_SQL, SIMHASH_SQL
from siltline.llm.suffix_dedup import remove_repeats
from siltline.llm.token_counts import token_counts


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
DECONTAMINATION_SQL = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
 b AS (SELECT row_number() OVER () AS u, CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
 win AS (SELECT item, u, n, i AS j, array_to_string(w[i : i + n - 1], ' ') AS key FROM (SELECT item, u, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
 dw AS (SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS key FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
 m AS (SELECT r, i, n, item, u, j FROM dw JOIN win USING (n, key)),
 h AS (SELECT DISTINCT r, unnest(range(i, i + n)) AS pos FROM m),
 hits AS (SELECT r, count(*) AS n_hit FROM h GROUP BY r),
 runs AS (SELECT r, item, min(i) - 1 AS p, min(j) - 1 AS q, n + count(*) - 1 AS c FROM (SELECT *, i - row_number() OVER (PARTITION BY r, u, i - j ORDER BY i) AS g FROM m) GROUP BY r, u, item, n, i - j, g),
 best AS (SELECT r, c AS longest, item AS match_item, p AS match_start, q AS match_item_start FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY c DESC, p, item, q) AS k FROM runs) WHERE k = 1),
 items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
 SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
 coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated, CAST(coalesce(longest, 0) AS BIGINT) AS longest_match, match_item, match_start, match_item_start
 FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r) LEFT JOIN best USING (r)"""


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_documents(spark, sf_dir))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(_documents(spark, sf_dir))
    return found.select("key.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.col("kept_text").alias("text"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_documents(spark, sf_dir))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(_documents(spark, sf_dir))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_documents(spark, sf_dir))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_documents(spark, sf_dir))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest_match", "match_item", "match_start", "match_item_start")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_ids(_documents(spark, sf_dir))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_whole(_documents(spark, sf_dir))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(_documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_token_counts, op2_suffix_dedup, op3_quality, op4_embedding_dedup, op5_license_scan, op6_sharding, op7_simhash, op8_packing, op9_decontamination,
            op10_language_id, op11_best_fit_packing, op12_centroid_clustering, op13_source_divergence,
        )
    }


def oracle_sql() -> dict[str, str]:
    """SQL of the operators that it can express; the tests hold the others against brute force, libraries and held-out rows.

    That of op4 gives all links: the operator, which searches an index, may miss some.
    """
    return {
        "op2_suffix_dedup": REPEATS_SQL,
        "op4_embedding_dedup": LINKS_SQL,
        "op7_simhash": SIMHASH_SQL,
        "op9_decontamination": DECONTAMINATION_SQL,
        "op12_centroid_clustering": CLUSTERS_SQL,
        "op13_source_divergence": DIVERGENCE_SQL,
    }
