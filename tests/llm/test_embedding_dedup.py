import numpy as np
import pytest

from siltline.llm import embedding_dedup
from siltline.llm.embedding_dedup import Grid, distances, halves, near_duplicates


def brute(rows, least=0.9):
    ok = [v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = np.array([np.array(v) / np.linalg.norm(v) if o else np.zeros(8) for (_, v), o in zip(rows, ok, strict=True)])
    link = (unit @ unit.T >= least) & ~np.eye(len(rows), dtype=bool)
    root = np.arange(len(rows))
    while True:
        new = np.array([min([root[i], *root[link[i]]]) for i in range(len(rows))])
        if (new == root).all():
            break
        root = new
    return link.sum(1), root


@pytest.mark.parametrize("members,visitors", [(1024, 65_536), (3, 4)])
def test_equals_brute_force(spark, monkeypatch, members, visitors):
    monkeypatch.setattr(embedding_dedup, "MEMBERS", members)
    monkeypatch.setattr(embedding_dedup, "VISITORS", visitors)
    r = np.random.default_rng(1)
    rows = []
    for _ in range(60):
        base = r.standard_normal(8)
        rows += [(base + 0.12 * r.standard_normal(8)).astype(np.float32).tolist() for _ in range(r.integers(1, 12))]
    rows += [rows[0]] * 5 + [None, [], [0.0] * 8, [1.0] * 7, [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7, [None] + [1.0] * 7]
    rows = list(enumerate(rows))
    docs = spark.createDataFrame([(k, v, 0) for k, v in rows], "vec_id long, embedding array<float>, n_links int").repartition(3)
    got = {x["vec_id"]: x for x in near_duplicates(docs, target=1.0).collect()}
    n, root = brute(rows)
    assert len(got) == len(rows)
    assert [got[k]["n_links"] for k, _ in rows] == n.tolist()
    ids = {}
    for k, c in enumerate(root.tolist()):
        ids.setdefault(c, min(j for j, d in enumerate(root.tolist()) if d == c))
    assert [got[k]["component_id"] for k, _ in rows] == [ids[c] for c in root.tolist()]
    assert all(got[k]["kept"] == (got[k]["component_id"] == k) for k, _ in rows)


def test_recall_on_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = {x["vec_id"]: x["n_links"] for x in near_duplicates(table).collect()}
    data = table.toPandas().sort_values("vec_id")
    v = np.stack(data["embedding"].to_numpy()).astype(float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    want = (v @ v.T >= 0.9).sum(1) - 1
    have = np.array([got[k] for k in data["vec_id"]])
    assert (have <= want).all() and have.sum() >= 0.99 * want.sum()


def test_nearest_cells_come_first():
    r = np.random.default_rng(2)
    x = r.standard_normal((40, 6))
    grid = Grid(r.standard_normal((7, 3)) / 2, r.standard_normal((7, 3)) / 2)
    for most in (1, 5, 20, 49):
        got = grid.visits(x, most)
        a, b = halves(x)
        d = (distances(a, grid.books[0])[:, :, None] + distances(b, grid.books[1])[:, None, :]).reshape(40, -1)
        assert np.allclose(np.take_along_axis(d, got, 1), np.sort(d, 1)[:, :most])


def test_empty_and_useless_tables(spark):
    docs = spark.createDataFrame([(1, None), (2, [0.0, 0.0])], "vec_id long, embedding array<float>")
    assert [tuple(x) for x in near_duplicates(docs).orderBy("vec_id").collect()] == [(1, 0, 1, True), (2, 0, 2, True)]
    assert near_duplicates(docs.limit(0)).count() == 0


def test_sparse_links_and_other_lengths(spark):
    r = np.random.default_rng(5)
    base = r.standard_normal((2400, 16))
    # no class of the first few probes has a link; the few links cross borders of cells
    near = base[::300] + 0.28 * r.standard_normal((8, 16))
    rows = [x.tolist() for x in np.concatenate([base, near])]
    other = [[3.0], [0.5], [-1.0], [1.0, 0.0, 0.0], [1.0, 0.1, 0.0], [0.0, 1.0, 0.0], [2.0, 1.0, 5.0], [2.0, 1.0, 5.0]]
    docs = spark.createDataFrame(list(enumerate(rows + other)), "vec_id long, embedding array<double>").repartition(3)
    got = {x["vec_id"]: x["n_links"] for x in near_duplicates(docs, least=0.9, probe_rows=16).collect()}
    unit = np.array(rows) / np.linalg.norm(rows, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.9).sum(1) - 1
    assert 0 < want.sum() < 40
    assert [got[k] for k in range(len(rows))] == want.tolist()
    assert [got[len(rows) + k] for k in range(len(other))] == [1, 1, 0, 1, 1, 0, 1, 1]


def test_sql_of_a_table_with_links(spark, tmp_path, monkeypatch):
    """At the size of the small tables, but with copies and near copies: the query equals its SQL, which gives all links."""
    import duckdb

    from siltline.llm import embedding_dedup, queries

    monkeypatch.setattr(embedding_dedup, "CELLS", 1 << 12)
    r = np.random.default_rng(21)
    base = r.normal(size=(200, 64))
    rows = [*base, *(base[k % 60] + r.normal(scale=0.1 * (1 + k % 4), size=64) for k in range(240)), *base[:60]]
    df = spark.createDataFrame([(k, [float(y) for y in x], 0) for k, x in enumerate(rows)], "vec_id long, embedding array<float>, label int")
    df.coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = con.execute(queries.oracle_sql()["op4_embedding_dedup"])
    columns = [c[0] for c in want.description]
    want = sorted(want.fetchall())
    got = sorted(tuple(x[c] for c in columns) for x in queries.op4_embedding_dedup(spark, str(tmp_path)).collect())
    links = [sum(x[columns.index("n_links")] for x in t) for t in (got, want)]
    assert links[1] > 500 and links[0] >= 0.99 * links[1]
    if links[0] == links[1]:
        assert got == want
