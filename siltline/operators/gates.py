"""Gates: measured columns in, status and reasons out, as column expressions only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltline.functions.expr import above, all_hits, below, first_hit, number
from siltline.schema import KEEP, LOW_QUALITY, REJECTED


# Default thresholds, and below the names of reasons.
@dataclass(frozen=True)
class Prefilter:
    min_duration: float = 1.0
    max_duration: float = 30.0
    min_rms_dbfs: float = -55.0
    min_speech_seconds: float = 0.4
    use_vad: bool = True


@dataclass(frozen=True)
class Speech:
    min_rms_dbfs: float = -50.0
    min_speech_seconds: float = 1.0
    min_speech_ratio: float = 0.45
    min_duration: float = 1.0
    max_duration: float = 30.0
    trim: bool = True
    trim_pad: float = 0.15


@dataclass(frozen=True)
class Quality:
    min_ovrl: float = 2.6
    min_sig: float = 3.0
    min_bak: float = 3.2
    min_nisqa_dis: float = 3.0
    min_bandwidth_hz: float = 7000.0
    max_clipping: float = 0.001
    use_dnsmos: bool = True
    use_nisqa: bool = True
    use_heuristics: bool = True


@dataclass(frozen=True)
class Candidates:
    sources: tuple[str, ...] = ()
    min_duration: float = 1.0
    max_duration: float = 30.0
    min_ovrl: float = 0.0
    min_bak: float = 0.0


def prefilter_checks(df: DataFrame, g: Prefilter) -> list[tuple[str, Column]]:
    """Checks over the columns that df has, cheap ones first; the first that holds rejects. A duration that is NaN or null is neither too short nor too long."""
    has = set(df.columns)
    out = [("too_short", below(F.col("duration"), g.min_duration)), ("too_long", above(F.col("duration"), g.max_duration))]
    if "unusable" in has:
        out += [(r, F.coalesce(F.col("unusable") == r, F.lit(False))) for r in ("empty_audio", "corrupt_audio", "unreadable")]
    if "raw_rms_dbfs" in has:
        out.append(("silent_raw", F.coalesce(F.col("raw_rms_dbfs") < g.min_rms_dbfs, F.lit(False))))
    if g.use_vad and "raw_speech_seconds" in has:
        out.append(("no_speech_raw", below(F.col("raw_speech_seconds"), g.min_speech_seconds)))
    return out


def speech_checks(df: DataFrame, g: Speech) -> list[tuple[str, Column]]:
    """Checks over the columns that df has, in order; the first that holds rejects."""
    has = set(df.columns)
    out = []
    if "unusable" in has:
        out += [(r, F.coalesce(F.col("unusable") == r, F.lit(False))) for r in ("empty_audio", "corrupt_audio", "unreadable", "vad_failed")]
    out += [
        ("silent_after_separation", F.coalesce(F.col("vocal_rms_dbfs") < g.min_rms_dbfs, F.lit(False))),
        ("no_speech", below(F.col("speech_seconds"), g.min_speech_seconds)),
        ("low_speech_ratio", below(F.col("speech_ratio"), g.min_speech_ratio)),
    ]
    if g.trim and "trimmed" in has:  # seconds that are left
        out += [("too_short_after_trim", below(F.col("trimmed"), g.min_duration)), ("too_long_after_trim", above(F.col("trimmed"), g.max_duration))]
    return out


def quality_checks(df: DataFrame, g: Quality) -> list[tuple[str, Column]]:
    """All that hold are kept; a measure that is missing, NaN or no number passes."""
    has = set(df.columns)
    out = []
    if g.use_dnsmos:
        out += [("low_ovrl", "dnsmos_ovrl", g.min_ovrl), ("low_sig", "dnsmos_sig", g.min_sig), ("residual_background", "dnsmos_bak", g.min_bak)]
    if g.use_nisqa:
        out.append(("separation_artifacts", "nisqa_dis", g.min_nisqa_dis))
    if g.use_heuristics:
        out.append(("band_limited", "bandwidth_hz", g.min_bandwidth_hz))
    checks = [(name, below(F.col(c), least)) for name, c, least in out if c in has]
    if g.use_heuristics and "clipping_ratio" in has:
        checks.append(("clipped", above(F.col("clipping_ratio"), g.max_clipping)))
    return checks


def gate(df: DataFrame, checks: Sequence[tuple[str, Column]], stage: str) -> DataFrame:
    """Rejects by the first check that holds; df's status, stage and reasons follow. Other rows keep their status."""
    reason = first_hit(checks)
    return df.withColumns({
        "status": F.when(reason.isNotNull(), REJECTED).otherwise(F.col("status")),
        "stage": F.lit(stage),
        "reasons": F.when(reason.isNotNull(), F.array_union("reasons", F.array(reason))).otherwise(F.col("reasons")),
    })


def decide_quality(df: DataFrame, g: Quality, stage: str | None = "quality") -> DataFrame:
    """Sets status to keep or low_quality, adds all failing checks to reasons once, and quality_failures; stage None leaves the stage."""
    failures = all_hits(quality_checks(df, g))
    return df.withColumns({
        "quality_failures": failures,
        "status": F.when(F.size(failures) > 0, LOW_QUALITY).otherwise(KEEP),
        "stage": F.col("stage") if stage is None else F.lit(stage),
        "reasons": F.array_union("reasons", failures),
    })


def drop_reason(df: DataFrame, g: Candidates) -> DataFrame:
    """Adds drop_reason of training candidates: null for those that stay.

    A duration of 0 is unknown and passes; bounds are inclusive; a floor of 0 is off; missing scores pass.
    """
    checks = []
    if g.sources:
        checks.append(("other_source", ~F.col("source").isin(*g.sources)))
    duration = F.col("duration")
    checks.append(("duration", (duration > 0) & ((duration < g.min_duration) | (duration > g.max_duration))))
    if g.min_ovrl > 0:
        checks.append(("below_ovrl_floor", F.coalesce(number(F.col("dnsmos_ovrl")) < g.min_ovrl, F.lit(False))))
    if g.min_bak > 0:
        checks.append(("below_bak_floor", F.coalesce(number(F.col("dnsmos_bak")) < g.min_bak, F.lit(False))))
    return df.withColumn("drop_reason", first_hit(checks))
