"""Corpus statistics, calibration of thresholds and what-if rescoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltline.functions.expr import hours, number
from siltline.operators.gates import Quality, decide_quality
from siltline.schema import ALIVE, KEEP, LOW_QUALITY, REJECTED
from siltline.shared import running_sum

# Percentiles of the calibration report; measures and the side that fails.
PERCENTILES = (1, 5, 10, 25, 50, 75, 90, 99)
SIDES = {
    "dnsmos_ovrl": "min", "dnsmos_sig": "min", "dnsmos_bak": "min", "nisqa_mos": "min", "nisqa_dis": "min",
    "squim_pesq": "min", "vad_snr_db": "min", "bandwidth_hz": "min", "speech_ratio": "min", "clipping_ratio": "max",
}


def _kept(value: Column) -> Column:
    return F.when(F.col("status") == KEEP, value)


def by_column(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def by_source(df: DataFrame) -> DataFrame:
    """Records, kept records and kept hours by source; '?' where it is empty."""
    source = F.coalesce(F.nullif(F.col("source"), F.lit("")), F.lit("?"))
    return df.groupBy(source.alias("source")).agg(
        F.count("*").alias("total"), F.count(_kept(F.lit(1))).alias("keep"), F.coalesce(hours(_kept(F.col("duration"))), F.lit(0.0)).alias("keep_hours")
    )


def reject_reasons(df: DataFrame) -> DataFrame:
    return df.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason")


def summary(df: DataFrame) -> DataFrame:
    """Counts and kept hours over all rows and by status, stage and source, in one pass: axis names what a row counts."""
    source = F.coalesce(F.nullif(F.col("source"), F.lit("")), F.lit("?"))
    axes = F.array(
        F.struct(F.lit("all").alias("axis"), F.lit("").alias("value")), F.struct(F.lit("source").alias("axis"), source.alias("value")),
        F.struct(F.lit("stage").alias("axis"), F.col("stage").alias("value")), F.struct(F.lit("status").alias("axis"), F.col("status").alias("value")),
    )
    rows = df.select(F.explode(axes).alias("a"), _kept(F.col("duration")).alias("d"))
    return rows.groupBy("a.axis", "a.value").agg(F.count("*").alias("n"), F.coalesce(hours(F.col("d")), F.lit(0.0)).alias("keep_hours"))


def long_scores(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(metric, value) of every finite score."""
    pairs = F.array(*(F.struct(F.lit(c).alias("metric"), number(F.col(c)).alias("value")) for c in columns))
    return df.select(F.explode(pairs).alias("p")).select("p.metric", "p.value").where("value is not null")


def _quantiles(scores: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(metric, n, qs): the exact interpolated quantiles of (metric, value) rows.

    Equal values are counted before anything is sorted, so a value that most rows have is one row, and
    ranks are running sums of the counts: no task gets all values of a measure, nor all rows of a value.
    """
    counts = scores.groupBy("metric", "value").agg(F.count("*").alias("_n"))
    held = running_sum(counts, "metric", "value", value="_n", out="_to").withColumn("_from", F.col("_to") - F.col("_n") + 1)
    sizes = held.groupBy("metric").agg(F.sum("_n").alias("n"), F.min("_from").alias("_first"))
    place = F.posexplode(F.array(*(F.lit(float(s)) for s in shares)))
    asked = sizes.select("metric", "n", "_first", place.alias("k", "share")).withColumn("_x", (F.col("n") - 1) * F.col("share"))
    asked = asked.select("metric", "n", "k", (F.col("_x") - F.floor("_x")).alias("_w"), F.explode(F.array(F.floor("_x"), F.ceil("_x"))).alias("_y"), (F.col("_first") + F.col("_y")).alias("_rank"))
    within = F.expr("h.metric = a.metric AND a._rank BETWEEN h._from AND h._to")
    found = held.alias("h").join(F.broadcast(asked.distinct()).alias("a"), within).select("a.*", "h.value")  # two rows for each measure and share
    either = found.groupBy("metric", "n", "k").agg((F.min("value") + (F.max("value") - F.min("value")) * F.max("_w")).alias("q"))
    return either.groupBy("metric", "n").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "q"))), lambda x: x["q"]).alias("qs"))


def percentiles(df: DataFrame, columns: Sequence[str], points: Sequence[float] = PERCENTILES) -> DataFrame:
    """Exact interpolated percentiles of each measure: metric, n, p1, p5, ..."""
    out = _quantiles(long_scores(df, columns), [p / 100 for p in points])
    return out.select("metric", "n", *(F.col("qs")[k].alias(f"p{p:g}") for k, p in enumerate(points)))


def suggested_thresholds(df: DataFrame, sides: Mapping[str, str], keep: float) -> DataFrame:
    """For each measure the threshold that the share keep of its values passes."""
    side = F.create_map(*[F.lit(x) for kv in sides.items() for x in kv])
    out = _quantiles(long_scores(df, list(sides)), [1 - keep, keep]).withColumn("side", F.element_at(side, F.col("metric")))
    return out.select("metric", "side", F.when(F.col("side") == "min", F.col("qs")[0]).otherwise(F.col("qs")[1]).alias("threshold"))


def joint_keep_rate(df: DataFrame, thresholds: Mapping[str, tuple[str, float]]) -> DataFrame:
    """The share of records with any of the measures that pass all thresholds; a missing or bad value passes."""
    measured, passes = F.lit(False), F.lit(True)
    for c, (side, cut) in thresholds.items():
        v = number(F.col(c))
        measured = measured | F.col(c).isNotNull()
        passes = passes & F.coalesce(v >= cut if side == "min" else v <= cut, F.lit(True))
    rate = F.avg(F.when(passes, 1.0).otherwise(0.0))
    return df.where(measured).agg(F.count("*").alias("n"), F.coalesce(rate, F.lit(0.0)).alias("keep_rate"))


def relabelled(df: DataFrame, g: Quality, source: str | None = None) -> DataFrame:
    """Finished and scored records (of one source) decided anew: old labels go, new ones are set, the stage stays; adds before, the status so far."""
    df = df if source is None else df.where(F.col("source") == source)
    scored = F.col("dnsmos_ovrl").isNotNull() | F.col("bandwidth_hz").isNotNull()
    df = df.where(F.col("status").isin(KEEP, LOW_QUALITY) & scored).withColumn("before", F.col("status"))
    cleared = F.array_except("reasons", F.coalesce("quality_failures", F.array().cast("array<string>")))
    return decide_quality(df.withColumn("reasons", cleared), g, stage=None)


def transitions(df: DataFrame, g: Quality, source: str | None = None) -> DataFrame:
    return relabelled(df, g, source).groupBy("before", F.col("status").alias("after")).agg(F.count("*").alias("n"))


def compare_models(df: DataFrame, baseline: str, columns: Sequence[str]) -> DataFrame:
    """Mean finite scores of each model, rows, seconds, speed in times real time, and differences to the baseline."""
    means = [F.avg(number(F.col(c))).alias(c) for c in columns]
    out = df.groupBy("model").agg(*means, F.count("*").alias("n"), F.sum("seconds").alias("seconds"), (F.sum("duration") / F.sum("seconds")).alias("speed"))
    first = out.where(F.col("model") == baseline).select(*(F.col(c).alias(f"_{c}") for c in columns))  # one row
    out = out.join(F.broadcast(first), how="left")
    return out.select("model", "n", "seconds", "speed", *columns, *((F.col(c) - F.col(f"_{c}")).alias(f"d_{c}") for c in columns))


def batching_verdict(pairs: DataFrame, least: float = 0.99) -> DataFrame:
    """Mean, least and largest finite corr, lsd and d_ovrl of packed against single results; passes if every corr is over least."""
    out = []
    for c in ("corr", "lsd", "d_ovrl"):
        v = number(F.col(c))
        out += [F.avg(v).alias(f"mean_{c}"), F.min(v).alias(f"min_{c}"), F.max(v).alias(f"max_{c}")]
    return pairs.agg(F.count("*").alias("n"), *out).withColumn("passed", F.coalesce(F.col("min_corr") > least, F.lit(False)))


# MB/s of a slow link, the share of the baseline under which a host is slow, and the gain from which parallel downloads pay.
SLOW_LINK, SLOW_HOST, GAIN = 5.0, 0.5, 2.0


def throughput_verdict(df: DataFrame, total_gb: float) -> DataFrame:
    """What measured downloads (MB/s: baseline, single, parallel; null or NaN: not measured) say.

    Adds gain (parallel over single), eta_single and eta_parallel (hours and minutes for total_gb
    as text, empty where not measured), link ('slow_link' if baseline and single are slow,
    'slow_host' if single is far under baseline, else null) and advice ('parallel' from GAIN
    on, 'full' below, null where no gain is known).
    """
    base, single, parallel = (F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in ("baseline", "single", "parallel"))
    gain = F.when(single > 0, parallel / single)

    def eta(speed: Column) -> Column:
        h = total_gb * 1024 / speed / 3600
        return F.when(speed <= 0, "inf h").when(h >= 1, F.format_string("%.1f h", h)).when(h < 1, F.format_string("%.0f min", h * 60)).otherwise("")

    link = F.when((base < SLOW_LINK) & (single < SLOW_LINK), "slow_link").when(single < base * SLOW_HOST, "slow_host")
    advice = F.when(gain >= GAIN, "parallel").when(gain < GAIN, "full")
    return df.withColumns({"gain": gain, "eta_single": eta(single), "eta_parallel": eta(parallel), "link": link, "advice": advice})


def stage_counts(df: DataFrame) -> DataFrame:
    """Records of each unit and stage by what came of them: seen, alive (pending or kept so far), keep, low_quality, rejected."""
    by = {s: F.count(F.when(F.col("status") == s, 1)).alias(s) for s in (KEEP, LOW_QUALITY, REJECTED)}
    return df.groupBy("source", "shard", "stage").agg(F.count("*").alias("seen"), F.count(F.when(F.col("status").isin(*ALIVE), 1)).alias("alive"), *by.values())
