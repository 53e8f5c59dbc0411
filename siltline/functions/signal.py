"""Measures of short signals (arrays of samples) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-10


def _mean(x: Column, of=lambda v: v) -> Column:
    total = F.aggregate(x, F.lit(0.0), lambda s, v: s + of(v.cast("double")))
    return total / F.size(x)


def db(amplitude: Column) -> Column:
    return 20 * F.log10(amplitude + EPS)


def rms_dbfs(x: Column) -> Column:
    """Root mean square in dB of full scale; -infinity for an empty signal."""
    return F.when(F.size(x) == 0, F.lit(float("-inf"))).otherwise(db(F.sqrt(_mean(x, lambda v: v * v))))


def peak_dbfs(x: Column) -> Column:
    return F.when(F.size(x) == 0, F.lit(float("-inf"))).otherwise(db(F.array_max(F.transform(x, lambda v: F.abs(v.cast("double"))))))


def clipping_ratio(x: Column, level: float = 0.99) -> Column:
    """The share of samples at or over level; 0 for an empty signal."""
    return F.when(F.size(x) == 0, F.lit(0.0)).otherwise(_mean(x, lambda v: F.when(F.abs(v) >= level, 1.0).otherwise(0.0)))


def dc_offset(x: Column) -> Column:
    return F.when(F.size(x) == 0, F.lit(0.0)).otherwise(_mean(x))


def frames(x: Column, size: int) -> Column:
    """Tumbling frames; an incomplete last one is dropped, a shorter signal is one frame."""
    count = F.greatest(F.floor(F.size(x) / size).cast("int"), F.lit(1))
    return F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.slice(x, k * size + 1, F.lit(size)))


def frame_energy_db(x: Column, size: int) -> Column:
    return F.transform(frames(x, size), rms_dbfs)


def active_ratio(x: Column, size: int, range_db: float = 25.0) -> Column:
    """The share of frames whose energy is above the largest less range_db."""
    energy = frame_energy_db(x, size)
    top = F.array_max(energy)
    return F.size(F.filter(energy, lambda e: e > top - range_db)) / F.size(energy)


def trimmed(x: Column, start: Column, end: Column, rate: float) -> Column:
    """The samples between two seconds (cut to whole samples); empty if they are the wrong way round."""
    a, b = F.greatest((start * rate).cast("int"), F.lit(0)), F.least((end * rate).cast("int"), F.size(x))
    return F.when(b > a, F.slice(x, a + 1, b - a)).otherwise(F.slice(x, 1, 0))


def in_spans(at: Column, spans: Column, rate: float) -> Column:
    """Whether sample number at is in any [start, end) of spans, given in seconds."""
    return F.exists(spans, lambda s: (at >= (s[0] * rate).cast("int")) & (at < (s[1] * rate).cast("int")))


def snr_db(x: Column, spans: Column, rate: float, least: int = 100) -> Column:
    """Power inside spans over power outside, in dB; null if either has under least samples, 60 without noise."""
    numbered = F.transform(x, lambda v, k: F.struct(v.cast("double").alias("v"), in_spans(k, spans, rate).alias("s")))
    power = lambda part: F.aggregate(part, F.lit(0.0), lambda t, e: t + e["v"] * e["v"]) / F.size(part)
    speech, noise = F.filter(numbered, lambda e: e["s"]), F.filter(numbered, lambda e: ~e["s"])
    enough = (F.size(speech) >= least) & (F.size(noise) >= least)
    return F.when(enough, F.when(power(noise) <= EPS, F.lit(60.0)).otherwise(10 * F.log10((power(speech) + EPS) / (power(noise) + EPS))))


def correlation(x: Column, y: Column) -> Column:
    """Cosine of two mean-free signals over their common length; null if either is constant."""
    n = F.least(F.size(x), F.size(y))
    a, b = F.slice(x, 1, n), F.slice(y, 1, n)
    ma, mb = _mean(a), _mean(b)
    pairs = F.zip_with(a, b, lambda u, v: F.struct((u.cast("double") - ma).alias("u"), (v.cast("double") - mb).alias("v")))
    total = lambda of: F.aggregate(pairs, F.lit(0.0), lambda s, p: s + of(p))
    norm = F.sqrt(total(lambda p: p["u"] * p["u"]) * total(lambda p: p["v"] * p["v"]))
    return F.when((n > 0) & (norm > 0), total(lambda p: p["u"] * p["v"]) / norm)


def span_stats(spans: Column, duration: Column) -> Column:
    """Count, seconds, ratio, first start and last end of speech spans."""
    seconds = F.aggregate(spans, F.lit(0.0), lambda s, p: s + (p[1] - p[0]))
    return F.struct(
        F.size(spans).alias("num_speech_segments"),
        seconds.alias("speech_seconds"),
        F.when(duration > 0, seconds / duration).otherwise(0.0).alias("speech_ratio"),
        F.when(F.size(spans) > 0, F.element_at(spans, 1)[0]).alias("first_start"),
        F.when(F.size(spans) > 0, F.element_at(spans, -1)[1]).alias("last_end"),
    )


def trim_bounds(spans: Column, duration: Column, pad: float) -> tuple[Column, Column, Column]:
    """Start, end, and the spans counted from the start (never below 0); null without spans."""
    some = F.size(spans) > 0
    start = F.when(some, F.greatest(F.lit(0.0), F.try_element_at(spans, F.lit(1))[0] - pad))
    end = F.when(some, F.least(duration, F.try_element_at(spans, F.lit(-1))[1] + pad))
    moved = F.transform(spans, lambda s: F.array(F.greatest(s[0] - start, F.lit(0.0)), F.greatest(s[1] - start, F.lit(0.0))))
    return start, end, moved


def unusable(x: Column) -> Column:
    """'empty_audio' or 'corrupt_audio' for signals that can't be measured, else null."""
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(F.coalesce(F.size(x), F.lit(0)) <= 0, "empty_audio").when(bad, "corrupt_audio")
