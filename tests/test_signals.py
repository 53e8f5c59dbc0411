"""Kernels against closed forms."""

import math

import numpy as np
import pytest

from siltline.functions import audio, scores
from siltline.operators.measure import measure_clips, measures
from siltline.operators.separation import joined, separated, spectral_gate, unchanged

RATE = 16_000


def sine(hz, seconds=2.0, level=0.3, rate=RATE):
    return level * np.sin(2 * np.pi * hz * np.arange(int(seconds * rate)) / rate)


def test_levels_of_a_sine():
    m = measures(sine(440), RATE)
    assert m["rms_dbfs"] == pytest.approx(-13.4688, abs=1e-3)
    assert m["peak_dbfs"] == pytest.approx(20 * math.log10(0.3), abs=1e-3)
    assert m["clipping_ratio"] == 0 and abs(m["dc_offset"]) < 1e-9 and m["unusable"] is None
    assert m["bandwidth_hz"] == pytest.approx(440, abs=RATE / 2048)


def test_unusable_and_short():
    assert measures(np.zeros(0), RATE)["unusable"] == "empty_audio"
    assert measures(np.array([0.1, math.nan]), RATE)["unusable"] == "corrupt_audio"
    one = measures(np.array([0.5]), RATE)
    assert one["unusable"] is None and one["bandwidth_hz"] == 0 and one["lufs"] == -math.inf and one["snr_db"] is None
    square = np.sign(sine(100))
    assert measures(square, RATE)["clipping_ratio"] > 0.98
    assert audio.bandwidth_hz(np.zeros(5000), RATE) == 0


def test_bandwidth_of_low_passed_noise():
    spectrum = np.fft.rfft(np.random.default_rng(0).standard_normal(5 * RATE))
    spectrum[int(3000 * 5) :] = 0
    assert 2800 < audio.bandwidth_hz(np.fft.irfft(spectrum) * 0.1, RATE) < 3100


def test_loudness():
    # a full-scale sine at 997 Hz in one channel is -3.01 by the standard
    assert audio.loudness_lufs(sine(997, 5, 1.0, 48_000), 48_000) == pytest.approx(-3.01, abs=0.05)
    assert audio.loudness_lufs(sine(997, 5, 0.1, 48_000), 48_000) == pytest.approx(-23.01, abs=0.05)
    assert audio.loudness_lufs(sine(997, 0.3), RATE) == -math.inf


def test_spectral_distance():
    x = sine(440) + 0.01 * np.random.default_rng(1).standard_normal(2 * RATE)
    assert audio.spectral_distance(x, x) == 0
    assert audio.spectral_distance(x, x * 10) == pytest.approx(20, abs=0.1)
    assert math.isnan(audio.spectral_distance(x[:100], x))


@pytest.mark.parametrize("channels", [1, 2])
def test_wav_round_trip(channels):
    x = sine(300) if channels == 1 else np.stack([sine(300), sine(500)], 1)
    y, rate = audio.decode_wav(audio.encode_wav(x, RATE), mono=False)
    assert rate == RATE and y.shape == (len(x), channels)
    assert np.abs(y - x.reshape(len(x), -1)).max() < 1e-4
    assert audio.header(audio.encode_wav(x, RATE)) == (2.0, RATE, channels)


def test_resampling_keeps_a_sine():
    y = audio.resampled(sine(440), RATE, 22_050)
    assert len(y) == 44_100 and np.abs(y[1000:-1000] - sine(440, rate=22_050)[1000:-1000]).max() < 0.01
    assert audio.stereo(np.zeros((5, 3))).shape == (5, 2) and audio.stereo(np.zeros(5)).shape == (5, 2)


def test_energy_spans():
    quiet = 1e-4 * np.ones(RATE)
    x = np.concatenate([quiet, sine(200, 1), quiet, sine(200, 0.1), quiet])
    (span,) = audio.energy_spans(x, RATE)  # the short one is dropped
    assert span == pytest.approx([0.9, 2.1], abs=0.03)
    assert audio.energy_spans(x[:100], RATE) == [] and audio.energy_spans(np.zeros(RATE), RATE) == []


def test_measured_from_bytes(spark):
    rows = [("a", bytearray(audio.encode_wav(sine(440), RATE))), ("b", bytearray(b"no wav")), ("c", None), ("d", bytearray(audio.encode_wav(np.zeros(0), RATE)))]
    got = {r["uid"]: r for r in measure_clips(spark.createDataFrame(rows, "uid string, content binary")).collect()}
    assert got["a"]["rms_dbfs"] == pytest.approx(-13.4688, abs=1e-2) and got["a"]["duration"] == 2
    assert [got[k]["unusable"] for k in "bcd"] == ["unreadable", "unreadable", "empty_audio"]


def test_packed_separation_is_the_identity(spark):
    clips = [np.stack([sine(hz, s, level)] * 2, 1) for hz, s, level in ((200, 0.5, 0.1), (300, 0.7, 0.9), (400, 0.2, 0.0))]
    whole, places = joined(clips, RATE, 0.5, 0.7)
    for x, (a, b, gain) in zip(clips, places, strict=True):
        assert np.allclose(whole[a:b] / gain, x)
    rows = [("u", 0, f"c{k}", k, bytearray(audio.encode_wav(x, RATE))) for k, x in enumerate(clips)] + [("u", 1, "bad", 0, bytearray(b"x"))]
    df = spark.createDataFrame(rows, "source string, batch int, uid string, position int, content binary")
    got = {r["uid"]: r for r in separated(df, unchanged, ["source", "batch"], RATE).collect()}
    for k, x in enumerate(clips):
        assert np.abs(audio.decode_wav(got[f"c{k}"]["content"], mono=False)[0] - x).max() < 1e-3
    assert got["bad"]["reason"] == "unreadable"

    def picky(x, rate):
        if len(x) > 1.3 * rate:
            raise RuntimeError("too long")
        return x

    alone = {r["uid"]: r["reason"] for r in separated(df, picky, ["source", "batch"], RATE).collect()}
    assert alone == {"c0": None, "c1": None, "c2": None, "bad": "unreadable"}


def test_spectral_gate_keeps_what_is_loud():
    x = np.stack([sine(440), sine(440)], 1)
    assert np.abs(spectral_gate(x, RATE) - x)[600:-600].max() < 0.05
    assert spectral_gate(np.zeros((10, 2)), RATE).shape == (10, 2)


def test_opinion_scores(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(3.0, 3.0, 3.0), (3.0, 1e30, 3.0), (float("nan"), 3.0, 3.0), (None, 3.0, 3.0)], "sig double, bak double, ovrl double")
    out = df.select(*(v.alias(k) for k, v in scores.opinion_scores({c: F.col(c) for c in df.columns}).items())).collect()
    assert out[0]["dnsmos_ovrl"] == pytest.approx(-0.06766283 * 9 + 1.11546468 * 3 + 0.04602535)
    assert all(v is None for r in out[1:] for v in r)
    n = spark.createDataFrame([(0,), (8 * 16_000,), (152_000,), (160_160,), (176_000,)], "n long").select(scores.window_count(F.col("n")).alias("w")).collect()
    assert [r["w"] for r in n] == [0, 7, 1, 1, 2]
