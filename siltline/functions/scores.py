"""Opinion scores from the raw outputs of a speech-quality network, as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of the polynomials from raw outputs to scores, highest power first.
STANDARD = {
    "ovrl": (-0.06766283, 1.11546468, 0.04602535),
    "sig": (-0.08397278, 1.22083953, 0.0052439),
    "bak": (-0.13166888, 1.60915514, -0.39604546),
}
PERSONALISED = {
    "ovrl": (-0.00533021, 0.005101, 1.18058466, -0.11236046),
    "sig": (-0.01019296, 0.02751166, 1.19576786, -0.24348726),
    "bak": (-0.04976499, 0.44276479, -0.1644611, 0.96883132),
}
# Bounds of a plausible score; seconds and rate of a window, and seconds between windows.
LEAST, MOST = 0.5, 5.5
WINDOW, RATE, HOP = 9.01, 16_000, 1


def polynomial(x: Column, coefficients: tuple[float, ...]) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + F.lit(c)
    return out


def opinion_scores(raw: Mapping[str, Column], personalised: bool = False) -> dict[str, Column]:
    """dnsmos_sig, dnsmos_bak and dnsmos_ovrl from mean raw outputs; all null if any is not plausible or not a number."""
    poly = PERSONALISED if personalised else STANDARD
    value = {k: polynomial(raw[k], poly[k]) for k in ("sig", "bak", "ovrl")}
    fine = F.lit(True)
    for v in value.values():
        fine = fine & F.coalesce(v.between(LEAST, MOST), F.lit(False))
    return {f"dnsmos_{k}": F.when(fine, v) for k, v in value.items()}


def window_count(samples: Column) -> Column:
    """Scoring windows of a clip at RATE: shorter ones are repeated until they fill a window; an empty one has none."""
    full = F.lit(int(WINDOW * RATE))
    tiled = F.when(samples < full, samples * F.ceil(full / samples)).otherwise(samples)
    count = F.greatest((F.floor(tiled / RATE) - WINDOW).cast("int") + 1, F.lit(1))
    # the sum before it is cut to a whole number is floored: below zero only where one window is left anyway
    return F.when(samples > 0, count).otherwise(0)


def windows(x: np.ndarray, rate: int = RATE, window: float = WINDOW, hop: int = HOP) -> np.ndarray:
    """The overlapping windows of a signal, as rows of a view: window seconds each, hop seconds apart, counted as window_count does.

    A shorter signal is repeated until it fills a window; an empty one, or one with samples that are no finite
    numbers, has none. Windows that would reach beyond the end are left out.
    """
    size = int(window * rate)
    if not len(x) or not np.isfinite(x).all():
        return np.zeros((0, size), np.float32)
    x = np.asarray(x, np.float32)
    if len(x) < size:
        x = np.tile(x, -(-size // len(x)))
    count = max(int((len(x) // rate - window) / hop) + 1, 1)
    return np.lib.stride_tricks.sliding_window_view(x, size)[:: hop * rate][:count]
