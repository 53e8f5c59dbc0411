"""Packing, quantiles and interval joins over skewed keys, held against the plain rule."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltline.operators import analytics, batches, intervals
from siltline.shared import running_sum


def packed(rows, target):
    """(unit, key) to (position, batch), one clip after another."""
    out, now, total, batch, position = {}, object(), 0.0, 0, 0
    for unit, key, d in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        d = d if d is not None and d > 0 else batches.UNKNOWN
        if unit != now:
            now, total, batch, position = unit, 0.0, 0, 0
        elif total + d > target:
            batch, total = batch + 1, 0.0
        total += d
        out[unit, key] = position, batch
        position += 1
    return out


@pytest.mark.parametrize("target,unit_of", [(10.0, lambda k: "hot"), (3.0, lambda k: "hot" if k % 3 else f"u{k % 50:02d}"), (1e9, lambda k: "all"), (0.0, lambda k: None if k % 2 else "x"), (25.0, lambda k: f"u{k // 9:04d}")])
def test_packing_equals_the_rule_across_tasks(spark, target, unit_of):
    r = random.Random(int(target))
    sizes = [0.1, 0.2, 0.7, 1.0, 2.5, 0.002, None, -1.0, float("nan"), float("inf"), 40.0, 3.0]
    rows = [(unit_of(k), f"{k:06d}", r.choice(sizes)) for k in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "unit string, uid string, duration double").repartition(5)
        got = batches.greedy_batches(df, ["unit"], "uid", target)
        assert got.rdd.getNumPartitions() > 2
        assert {(x["unit"], x["uid"]): (x["position"], x["batch"]) for x in got.collect()} == packed(rows, target)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_batches_of_many_tasks_hold_what_goes_on(spark):
    """A batch that spans whole tasks, then units that begin and end inside them."""
    rows = [("a", f"{k:05d}", 0.5) for k in range(4000)] + [("b", f"{k:05d}", 1.0) for k in range(3)]
    df = spark.createDataFrame(rows, "unit string, uid string, duration double")
    for target in (1900.0, 0.5, 1.0):
        assert {(x["unit"], x["uid"]): (x["position"], x["batch"]) for x in batches.greedy_batches(df, ["unit"], "uid", target).collect()} == packed(rows, target)
    assert batches.greedy_batches(df.limit(0), ["unit"], "uid", 5.0).collect() == []


def test_next_starts_where_sums_meet_the_target():
    r = np.random.default_rng(2)
    for d in (np.full(400, 0.1), r.choice([0.1, 0.2, 0.3], 400), r.choice([1.0, 1e-12, 1e12], 200), np.array([5.0]), np.zeros(0)):
        for target in (1.0, 0.3, 0.6000000000000001, 1e12):
            want = []
            for i in range(len(d)):
                total, j = float(d[i]), i + 1
                while j < len(d) and total + d[j] <= target and d[i] <= target:
                    total, j = total + d[j], j + 1
                want.append(j)
            assert batches.next_starts(d, target).tolist() == want
    last, runs = batches.last_starts(np.array([2, 3, 5, 4, 6, 7, 7]))
    assert last.tolist() == [5, 6, 5, 6, 6, 5, 6] and runs.tolist() == [3, 4, 2, 3, 2, 1, 1]


def test_quantiles_under_ties(spark):
    """Most rows hold one value: it is counted before the sort, and no task gets more than its part."""
    r = np.random.default_rng(4)
    clip = np.where(r.random(5000) < 0.9, 0.0, r.random(5000))
    ovrl = r.normal(3, 1, 5000)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(clip, ovrl, strict=True)], "clipping_ratio double, dnsmos_ovrl double").repartition(7)
    got = {x["metric"]: x for x in analytics.percentiles(df, ["clipping_ratio", "dnsmos_ovrl"]).collect()}
    for name, values in (("clipping_ratio", clip), ("dnsmos_ovrl", ovrl)):
        assert got[name]["n"] == 5000
        for p in analytics.PERCENTILES:
            assert abs(got[name][f"p{p:g}"] - np.percentile(values, p)) < 1e-9
    assert analytics.percentiles(df.limit(0), ["dnsmos_ovrl"]).collect() == []


def test_running_sum_of_equal_and_empty_parts(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("k"), F.when(F.col("id") % 5 > 0, F.col("id") % 7).alias("v"))
    total = 0
    for x in running_sum(df.repartition(9), "g", "k", value="v").orderBy("g", "k").collect():
        total += x["v"] or 0
        assert x["total"] == total
    assert running_sum(df.limit(0), "g", value="v").collect() == []


def test_points_in_intervals(spark):
    r = random.Random(6)
    nan = float("nan")
    points = [(r.choice(["a", "b", None, "hot", "hot"]), r.choice([r.randint(0, 40) / 2, None, nan]), k) for k in range(800)]
    spans = [(r.choice(["a", "b", None, "hot", "c"]), *r.choice([(2.0, 5.0), (5.0, 5.0), (9.0, 3.0), (0.5, 19.0), (5.0, 7.5), (None, 3.0), (1.0, nan), (-9.0, 99.0), (12.5, 13.0)])) for _ in range(60)]
    p = spark.createDataFrame(points, "key string, at double, k int").repartition(3)
    s = spark.createDataFrame(spans, "key string, start double, end double")
    got = {x["k"]: x["covers"] for x in intervals.covered(p, s, ["key"]).collect()}
    fine = [(k, a, b) for k, a, b in spans if a is not None and b is not None and a < b]
    assert got == {k: sum(key == x and at is not None and a <= at < b for x, a, b in fine) for key, at, k in points}
    assert intervals.covered(p, s.limit(0), ["key"]).agg(F.sum("covers")).first()[0] == 0
    # stretches that any interval holds
    want = set()
    for key in {k for k, _, _ in fine}:
        now = None
        for a, b in sorted((a, b) for k, a, b in fine if k == key):
            if now and a <= now[1]:
                now = (now[0], max(now[1], b))
            else:
                want |= {(key, *now)} if now else set()
                now = (a, b)
        want.add((key, *now))
    assert {tuple(x) for x in intervals.merged(s, ["key"]).collect()} == want


def test_power_inside_spans(spark):
    r = np.random.default_rng(7)
    x = {k: r.normal(0, s, 600) for k, s in (("a", 0.5), ("b", 1e-7), ("c", 1.0))}
    samples = spark.createDataFrame([(k, float(n), float(v)) for k, own in x.items() for n, v in enumerate(own)], "uid string, at double, value double")
    spans = spark.createDataFrame([("a", 10.0, 150.0), ("a", 100.0, 300.0), ("b", 0.0, 200.0), ("c", 0.0, 50.0)], "uid string, start double, end double")
    got = {y["uid"]: y for y in intervals.power_inside(samples, spans, ["uid"]).collect()}
    inside = x["a"][10:300]
    outside = np.concatenate([x["a"][:10], x["a"][300:]])
    assert abs(got["a"]["snr_db"] - 10 * np.log10(((inside**2).mean() + 1e-10) / ((outside**2).mean() + 1e-10))) < 1e-9
    assert (got["a"]["n_inside"], got["a"]["n_outside"], got["b"]["snr_db"], got["c"]["snr_db"]) == (290, 310, 60.0, None)
