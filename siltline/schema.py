"""The manifest: one row for each record, its stages and its reason codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Stages in order, statuses.
STAGES = ("fetch", "prefilter", "separate", "vad", "quality", "materialize")
KEEP, LOW_QUALITY, REJECTED, PENDING = "keep", "low_quality", "rejected", "pending"
ALIVE = (PENDING, KEEP)

# Names of the measures that a record may carry.
SCORES = (
    "raw_rms_dbfs", "raw_active_ratio", "raw_speech_seconds", "raw_speech_ratio", "vocal_rms_dbfs", "speech_seconds",
    "speech_ratio", "vad_snr_db", "trim_start", "trim_end", "rms_dbfs", "peak_dbfs", "clipping_ratio", "dc_offset",
    "bandwidth_hz", "lufs", "dnsmos_sig", "dnsmos_bak", "dnsmos_ovrl", "squim_stoi", "squim_pesq", "squim_si_sdr",
    "nisqa_mos", "nisqa_noi", "nisqa_dis", "nisqa_col", "nisqa_loud",
)

METRICS = T.StructType(
    [T.StructField(name, T.DoubleType()) for name in SCORES]
    + [
        T.StructField("separated_from", T.StringType()),
        T.StructField("num_speech_segments", T.IntegerType()),
        T.StructField("speech_segments", T.ArrayType(T.ArrayType(T.DoubleType()))),
        T.StructField("quality_failures", T.ArrayType(T.StringType())),
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("uid", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("sample_rate", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("reasons", T.ArrayType(T.StringType())),
        T.StructField("metrics", METRICS),
    ]
)


def stage_ordinal(stage: Column) -> Column:
    """The place of a stage name; -1 for a name that is no stage."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for k, s in enumerate(STAGES) for x in (s, k)]), stage), F.lit(-1))
