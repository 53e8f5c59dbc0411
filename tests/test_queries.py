"""Every query with SQL equals it over DuckDB."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def rows(data, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(plain(r[k]) for k in order) for r in data)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    want = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows(got.collect(), got.columns) == rows(want.fetchall(), columns)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
