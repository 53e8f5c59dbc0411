"""Separation of clips in packed batches: joined, processed in one call, cut again, each at its own level."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from siltline.functions import audio

#: samples x 2 and the rate in, as many samples x 2 out.
Separator = Callable[[np.ndarray, int], np.ndarray]


def joined(signals: list[np.ndarray], rate: int, guard: float, peak: float) -> tuple[np.ndarray, list[tuple[int, int, float]]]:
    """The signals brought to one peak, each followed by guard seconds of silence; where each lies, and its gain."""
    gap = np.zeros((int(guard * rate), 2))
    pieces, places, at = [], [], 0
    for x in signals:
        loudest = np.abs(x).max() if len(x) else 0.0
        gain = peak / loudest if loudest > 0 else 1.0
        pieces += [x * gain, gap]
        places.append((at, at + len(x), gain))
        at += len(x) + len(gap)
    return (np.concatenate(pieces) if pieces else np.zeros((0, 2))), places


def separated(
    clips: DataFrame, separate: Separator, unit: list[str], rate: int = 44_100, guard: float = 0.5, peak: float = 0.7,
    decode: Callable[..., tuple[np.ndarray, int]] = audio.decode_wav, singly: bool = False,
) -> DataFrame:
    """(uid, content, reason) of clips (uid, content, position and the unit columns, batch among them).

    A batch is one group, of a length that its packing bounds. A clip that can't be read is
    'unreadable'; if the separator fails on a batch its clips are tried one by one, and what
    fails then, or comes back empty, is 'separation_failed'. singly separates each clip by itself from the start.
    """

    def batch(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("position")
        names, signals, out = [], [], []
        for name, data in zip(rows["uid"], rows["content"], strict=True):
            try:
                x, own = decode(data, mono=False)
                x = audio.stereo(x)
                signals.append(np.stack([audio.resampled(c, own, rate) for c in x.T], 1))
                names.append(name)
            except Exception:  # noqa: BLE001
                out.append((name, None, "unreadable"))
        try:
            results = [y for x in signals for y in _cut([x])] if singly else _cut(signals)
        except Exception:  # noqa: BLE001
            results = []
            for x in signals:
                try:
                    results += _cut([x])
                except Exception:  # noqa: BLE001
                    results.append(None)
        for name, y in zip(names, results, strict=True):
            good = y is not None and len(y) > 0
            out.append((name, audio.encode_wav(y, rate) if good else None, None if good else "separation_failed"))
        return pd.DataFrame(out, columns=["uid", "content", "reason"])

    def _cut(signals: list[np.ndarray]) -> list[np.ndarray]:
        whole, places = joined(signals, rate, guard, peak)
        vocals = separate(whole, rate) if len(whole) else whole
        return [vocals[a : min(b, len(vocals))] / gain for a, b, gain in places]

    return clips.select(*unit, "uid", "content", "position").groupBy(*unit).applyInPandas(batch, "uid string, content binary, reason string")


def unchanged(x: np.ndarray, rate: int) -> np.ndarray:
    """A separator that changes nothing; stands in for a model."""
    return x


def spectral_gate(x: np.ndarray, rate: int, size: int = 1024, floor: float = 0.02) -> np.ndarray:
    """A simple separator: overlapping frames without the bins that are under floor of the loudest one."""
    hop = size // 2
    window = np.sqrt(np.hanning(size + 1)[:-1])
    padded = np.pad(x, ((hop, size + hop), (0, 0)))
    out = np.zeros_like(padded)
    frames = [(k, np.fft.rfft(padded[k : k + size] * window[:, None], axis=0)) for k in range(0, len(padded) - size + 1, hop)]
    top = max((np.abs(f).max() for _, f in frames), default=0.0)
    for k, f in frames:
        out[k : k + size] += np.fft.irfft(np.where(np.abs(f) < floor * top, 0, f), size, axis=0) * window[:, None]
    return out[hop : hop + len(x)]
