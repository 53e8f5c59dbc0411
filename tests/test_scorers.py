"""Overlapping windows given to a model, and what becomes of odd clips."""

import numpy as np
import pytest

from siltline.functions import audio, scores
from siltline.operators.scorers import window_scorer


@pytest.mark.parametrize("seconds", [0.001, 0.7, 5.0, 9.0, 9.01, 10.0, 10.02, 18.03, 31.7])
def test_windows_of_a_clip(seconds):
    """One by one, by the rule: tiled up to a window, then a window each second as long as whole seconds last."""
    rate = 1000
    x = np.random.default_rng(1).normal(size=int(seconds * rate)).astype(np.float32)
    y = np.tile(x, int(np.ceil(9010 / len(x)))) if len(x) < 9010 else x
    want = [y[k * rate : k * rate + 9010] for k in range(max(int(np.floor(len(y) / rate) - 9.01) + 1, 1))]
    got = scores.windows(x, rate)
    assert len(got) == sum(len(w) == 9010 for w in want) and all((a == b).all() for a, b in zip(got, want, strict=False))


def test_odd_signals_have_no_windows():
    assert len(scores.windows(np.zeros(0))) == len(scores.windows(np.array([0.0, np.nan]))) == len(scores.windows(np.array([np.inf]))) == 0


@pytest.mark.parametrize("at_once", [1, 5, 64])
def test_scores_by_windows(spark, at_once):
    r = np.random.default_rng(2)
    clips = {f"c{k}": 0.3 * r.normal(size=n) for k, n in enumerate((700, 12_000, 9_010, 25_500, 100, 40_000))}
    rows = [(k, bytearray(audio.encode_wav(x, 1000))) for k, x in clips.items()] + [("bad", bytearray(b"no")), ("none", None), ("odd", bytearray(audio.encode_wav(np.full(20_000, 0.5), 1000)))]

    def load():
        def model(x):
            if (x == x[:, :1]).all(1).any():
                raise RuntimeError("a clip that the model fails on")
            return np.stack([2.5 + x.mean(1), 3 + x.std(1), 2.5 + x.max(1) / 4], 1)

        return model

    df = spark.createDataFrame(rows, "uid string, content binary").coalesce(1)
    got = {x["uid"]: x for x in window_scorer(load, rate=1000, at_once=at_once)(df).collect()}
    assert len(got) == len(rows)
    for k in ("bad", "none", "odd", "c4"):  # unreadable, missing, failing, too short
        assert got[k]["n_windows"] == 0 and got[k]["dnsmos_sig"] is got[k]["dnsmos_ovrl"] is None
    for k, x in clips.items():
        if k == "c4":
            continue
        w = scores.windows(audio.decode_wav(audio.encode_wav(x, 1000))[0], 1000)
        raw = {"sig": (2.5 + w.mean(1)).mean(), "bak": (3 + w.std(1)).mean(), "ovrl": (2.5 + w.max(1) / 4).mean()}
        assert got[k]["n_windows"] == len(w)
        for c, v in raw.items():
            assert abs(got[k][f"dnsmos_{c}"] - np.polyval(scores.STANDARD[c], v)) < 1e-4
