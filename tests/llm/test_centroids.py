"""Clustering by Drake's bounds against k-means that measures every distance."""

import hashlib

import numpy as np
import pytest

from siltline.llm.centroids import Bounds, clusters, paired


def plain(rows, k, rounds, size, scale=256, seed="2:"):
    """(id, cluster, distance, cluster inertia, inertia, hash) of each kept row, with Python's whole numbers."""
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    c = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, y, strict=True)), j) for j, y in enumerate(c))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for j in range(len(c)):
            some = [v for (_, v), o in zip(kept, own, strict=True) if o == j]
            if some:
                c[j] = [sum(x) // len(some) for x in zip(*some, strict=True)]
    found = [nearest(v) for _, v in kept]
    total = [sum(d for d, j in found if j == n) for n in range(len(c))]
    sha = [hashlib.sha256(",".join(map(str, y)).encode()).hexdigest() for y in c]
    return sorted((str(i), j, d, total[j], sum(total), sha[j]) for (i, _), (d, j) in zip(kept, found, strict=True))


def got(df):
    return sorted((str(r["vec_id"]), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in df.collect())


@pytest.mark.parametrize("k,size,n,held", [(9, 4, 700, None), (16, 3, 500, 3), (2, 2, 60, None), (1, 5, 20, None), (30, 2, 20, None), (12, 2, 300, 11)])
def test_equals_plain(spark, k, size, n, held):
    """Clustered and tied vectors in several tasks, more centroids than vectors included."""
    rng = np.random.default_rng(k)
    v = np.round(rng.normal(0, 0.03, (n, size)) + rng.integers(-2, 3, (n, size)), 2).astype(np.float32)
    rows = [(i, [float(x) for x in y]) for i, y in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    assert got(clusters(df, k=k, rounds=4, size=size, held=held)) == plain(rows, k, 4, size)


def test_odd_vectors(spark):
    """Null, short, long and non-finite vectors get no row; repeated rows and ids, null ids, large components and other columns do no harm."""
    inf, nan = float("inf"), float("nan")
    rows = [(1, None), (2, []), (3, [1.0]), (4, [1.0, 2.0, 3.0]), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [-inf, 0.0])]
    rows += [(9, [0.5, 0.5]), (9, [0.5, 0.5]), (9, [-0.5, 0.25]), (None, [0.0, 1e-9]), (None, [0.0, -1e-9]), (10, [30000.0, -30000.0]), (11, [5000.0, 1.0]), (12, [0.5, 0.5])]
    df = spark.createDataFrame([(*r, 0, b"x") for r in rows], "vec_id long, embedding array<double>, cluster int, v binary")
    assert got(clusters(df, k=3, rounds=3, size=2)) == plain(rows, 3, 3, 2)
    huge = spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 0.0]), (3, [1e30, 0.0])], "vec_id int, embedding array<double>")
    assert {(r["vec_id"], r["distance"]) for r in clusters(huge, k=1, rounds=1, size=2).collect()} == {(n, (s * (1 << 27) - (1 << 27) // 3) ** 2) for n, s in ((1, 1), (2, -1), (3, 1))}
    none = clusters(df.where("vec_id < 9"), k=3, rounds=2, size=2)
    assert none.collect() == [] and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_bounds_hold_and_spare_distances():
    """Over rounds of moving centroids every bound stays below the true distance, and few rows are scanned again."""
    rng = np.random.default_rng(1)
    c = rng.integers(-4000, 4000, (40, 64))
    v = c[rng.integers(0, 40, 3000)] + rng.integers(-600, 600, (3000, 64))
    bounds, own = Bounds.scanned(v, c, 10)
    for spread in (300, 100, 30):
        before, c = c, c + rng.integers(-spread, spread, c.shape)
        own, most = bounds.moved(v, c, np.sqrt(paired(c, before)) * (1 + 2.0**-40))
        true = np.stack([paired(v, np.broadcast_to(y, v.shape)) for y in c], 1)
        assert (own == true.min(1)).all() and (bounds.cluster == true.argmin(1)).all()
        near = np.take_along_axis(true, bounds.near.astype(np.int64), 1)
        assert (bounds.low[:, :10].astype(float) ** 2 <= near).all()
        rest = true.copy()
        np.put_along_axis(rest, bounds.near.astype(np.int64), 1 << 60, 1)
        rest[np.arange(len(v)), bounds.cluster] = 1 << 60
        assert (bounds.low[:, 10].astype(float) ** 2 <= rest.min(1)).all() and most <= 10
    bounds.shorter(4)
    assert bounds.near.shape == (3000, 4) and bounds.low.shape == (3000, 5)
