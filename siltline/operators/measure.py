"""Measures of clips from their bytes: one pass over Arrow batches, decoded a clip at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siltline.functions import audio

Spans = Callable[[np.ndarray, int], list[list[float]]]
#: Measures of measure_clips and their types.
MEASURES = {
    "duration": "double", "sample_rate": "int", "unusable": "string", "rms_dbfs": "double", "peak_dbfs": "double", "clipping_ratio": "double",
    "dc_offset": "double", "bandwidth_hz": "double", "lufs": "double", "active_ratio": "double", "snr_db": "double", "spans": "array<array<double>>",
}
_FRAME_RANGE_DB = 25.0


#: Bytes in, samples from -1 to 1 and their rate out; whatever it raises makes a clip unreadable.
Decoder = Callable[[bytes], tuple[np.ndarray, int]]


def measures(x: np.ndarray, rate: int, spans_of: Spans = audio.energy_spans) -> dict:
    """All measures of one clip; what can't be measured is None."""
    out = dict.fromkeys(MEASURES) | {"duration": len(x) / rate, "sample_rate": rate}
    if not len(x):
        return out | {"unusable": "empty_audio"}
    if not np.isfinite(x).all():
        return out | {"unusable": "corrupt_audio"}
    spans = spans_of(x, rate)
    inside = np.zeros(len(x), bool)
    for a, b in spans:
        inside[max(int(a * rate), 0) : max(int(b * rate), 0)] = True
    frame = max(1, int(rate * 0.02))
    framed = x[: len(x) // frame * frame].reshape(-1, frame) if len(x) >= frame else x[None]
    energy = 20 * np.log10(np.sqrt((framed**2).mean(1)) + audio.EPS)
    size = np.abs(x)
    out |= {
        "rms_dbfs": 20 * np.log10(np.sqrt((x * x).mean()) + audio.EPS), "peak_dbfs": 20 * np.log10(size.max() + audio.EPS),
        "clipping_ratio": (size >= 0.99).mean(), "dc_offset": x.mean(), "bandwidth_hz": audio.bandwidth_hz(x, rate),
        "lufs": audio.loudness_lufs(x, rate), "active_ratio": (energy > energy.max() - _FRAME_RANGE_DB).mean(), "spans": spans,
    }
    if min(inside.sum(), (~inside).sum()) >= 100:
        noise = (x[~inside] ** 2).mean()
        out["snr_db"] = 60.0 if noise <= audio.EPS else 10 * np.log10(((x[inside] ** 2).mean() + audio.EPS) / (noise + audio.EPS))
    return {k: (float(v) if isinstance(v, np.floating) else v) for k, v in out.items()}


def measure_clips(clips: DataFrame, key: str = "uid", content: str = "content", spans_of: Spans = audio.energy_spans, decode: Decoder = audio.decode_wav) -> DataFrame:
    """key and the MEASURES of each clip's bytes: WAV, or what decode reads. Bytes that can't be decoded are
    'unreadable'; a clip on which spans_of or a measure fails is 'failed', and the others go on.

    spans_of(samples, rate) finds speech; a model's loads once for each worker if it keeps it in its module.
    """
    kind = clips.schema[key].dataType.simpleString()
    types = pa.schema([("duration", pa.float64()), ("sample_rate", pa.int32()), ("unusable", pa.string()), *((m, pa.float64()) for m in list(MEASURES)[3:-1]), ("spans", pa.list_(pa.list_(pa.float64())))])

    def one(data: bytes | None) -> dict:
        try:
            x, rate = decode(data)
        except Exception:  # noqa: BLE001  whatever is wrong with the bytes is a result, not a failure of the job
            return dict.fromkeys(MEASURES) | {"unusable": "unreadable"}
        try:
            return measures(x, rate, spans_of)
        except Exception:  # noqa: BLE001  so is a model that fails on one clip
            return dict.fromkeys(MEASURES) | {"duration": len(x) / rate, "sample_rate": rate, "unusable": "failed"}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 64):
                part = batch.slice(k, 64)
                found = pa.Table.from_pylist([one(x.as_py()) for x in part.column(1)], schema=types).combine_chunks()
                yield pa.RecordBatch.from_arrays([part.column(0), *(c.combine_chunks() for c in found.columns)], ["key", *types.names])

    fields = ", ".join(f"{k} {v}" for k, v in MEASURES.items())
    return clips.select(key, content).mapInArrow(rows, f"key {kind}, {fields}").withColumnRenamed("key", key)


def trim_clips(clips: DataFrame, decode: Decoder = audio.decode_wav) -> DataFrame:
    """uid, content, source and shard of clips (also trim_start and trim_end) as WAV of the mean channel from one to the other."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 64):
                part = batch.slice(k, 64)
                out = []
                for data, start, end in zip(*(part.column(c).to_pylist() for c in (1, 4, 5)), strict=True):
                    x, rate = decode(data)
                    out.append(audio.encode_wav(x[int(start * rate) : max(int(end * rate), int(start * rate))], rate))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.binary()), part.column(2), part.column(3)], ["uid", "content", "source", "shard"])

    return clips.select("uid", "content", "source", "shard", "trim_start", "trim_end").mapInArrow(rows, "uid string, content binary, source string, shard int")


def encode_clips(clips: DataFrame, rate: int, decode: Decoder = audio.decode_wav, kind: str = "wav", mono: bool = True) -> DataFrame:
    """uid, content, duration and sample_rate of clips as 16-bit WAV (or FLAC, as kind says) at a rate, of the mean channel or of all; clips that can't be read are left out."""
    encode = audio.ENCODERS[kind]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 64):
                part = batch.slice(k, 64)
                keep, out, seconds = [], [], []
                for row, data in enumerate(part.column(1).to_pylist()):
                    try:
                        x, own = decode(data) if mono else decode(data, mono=False)
                    except Exception:  # noqa: BLE001  the record is left as it is
                        continue
                    x = audio.resampled(x, own, rate) if x.ndim == 1 else np.stack([audio.resampled(c, own, rate) for c in x.T], 1)
                    keep.append(row)
                    out.append(encode(x, rate))
                    seconds.append(len(x) / rate)
                columns = [part.column(0).take(pa.array(keep, pa.int64())), pa.array(out, pa.binary()), pa.array(seconds, pa.float64()), pa.array([rate] * len(out), pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["uid", "content", "duration", "sample_rate"])

    return clips.select("uid", "content").mapInArrow(rows, "uid string, content binary, duration double, sample_rate int")
