"""Tar shards beyond the 999th: queries equal their SQL over documents with such numbers."""

import duckdb
import pytest

import __spark_entry__ as entry


@pytest.mark.parametrize("name", ["fetch_units", "source_listing"])
def test_many_shards(spark, tmp_path, name):
    rows = [(256 * shard + k, "text " * k) for shard in (0, 1, 2, 100, 999, 1000, 1001) for k in (1, 5)] + [(7, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    with duckdb.connect() as duck:
        duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        want = duck.execute(entry.oracle_sql()[name])
        columns = [c[0] for c in want.description]
        got = entry.queries()[name](spark, str(tmp_path)).select(columns)
        assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
