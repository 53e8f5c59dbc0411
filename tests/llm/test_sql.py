"""The subpackage's SQL against its queries."""

import duckdb
import pytest

from siltline.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.queries()[name](spark, SF)
    want = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(map(str, want.fetchall()))


def test_sql_of_odd_texts(spark, tmp_path):
    """Null, empty, blank, repeated, periodic and non-ASCII texts, cut inside characters, and words of every hashed length."""
    base = "".join(chr(97 + k * k % 23) + ("é" if k % 7 == 0 else "") for k in range(700))
    texts = [None, "", "  \t", "A b", "a B", "x" * 900, base, "€" + base[3:500] + "ü", base, "𝄞" * 150, "a" + "𝄞" * 150, *(" ".join("w" * k + str(j) for j in range(5)) for k in range(1, 40))]
    ids = [None, *range(1, len(texts) - 1), 5]
    spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    vectors = [(1, [1.0, 0.0]), (2, [2.0, 0.1]), (2, None), (4, []), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [1.0, None]), (8, [0.0, -3.0]), (9, [0.0, -3.0]), (10, [1.0])]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    for name in ("op2_suffix_dedup", "op4_embedding_dedup", "op7_simhash"):
        want = con.execute(queries.oracle_sql()[name])
        columns = [c[0] for c in want.description]
        got = queries.queries()[name](spark, str(tmp_path)).select(columns)
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall())), name
