"""Measures of long signals in numpy, for use inside Arrow batches of a task."""

from __future__ import annotations

import io
import struct
import wave
from collections.abc import Callable

import numpy as np

from siltline.functions.flac import decode_flac, encode_flac, flac_header

EPS = 1e-10


def _wave_format(data: bytes) -> tuple[int, int, int, int, bytes, int]:
    """Format (1: whole numbers, 3: floats), channels, rate, bits, samples and their size in bytes of a WAV file, whose samples may be cut off."""
    if data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        raise ValueError("no WAV")
    at, found = 12, None
    while at + 8 <= len(data):
        name, size = data[at : at + 4], int.from_bytes(data[at + 4 : at + 8], "little")
        if name == b"fmt ":
            if len(data) < at + 24 or (data[at + 8 : at + 10] == b"\xfe\xff" and len(data) < at + 34):
                raise ValueError("a format that is cut off")
            kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", data, at + 8)
            if kind == 0xFFFE:  # the format proper stands further on
                kind = struct.unpack_from("<H", data, at + 32)[0]
            found = kind, channels, rate, bits
        elif name == b"data":
            if found is None or not found[1] or not found[2] or not found[3]:
                raise ValueError("samples without a format")
            return *found, data[at + 8 : at + 8 + size], size
        at += 8 + size + size % 2
    raise ValueError("no samples")


def decode_wav(data: bytes, mono: bool = True) -> tuple[np.ndarray, int]:
    """Samples (frames x channels, or the mean of the channels) and the rate of WAV bytes: PCM, from -1 to 1, or floats as they are."""
    kind, channels, rate, bits, raw, _ = _wave_format(bytes(data))
    width = bits // 8
    raw = raw[: len(raw) // (width * channels or 1) * width * channels]
    if kind == 3 and width in (4, 8):
        x = np.frombuffer(raw, f"<f{width}").astype(np.float64)
    elif kind != 1:
        raise ValueError(f"WAV of format {kind}")
    elif width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(np.float64) - 128) / 128
    elif width in (2, 4):
        x = np.frombuffer(raw, f"<i{width}") / float(1 << (8 * width - 1))
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = (((b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16) << 8) >> 8) / float(1 << 23)
    else:
        raise ValueError(f"{bits}-bit samples")
    x = x.reshape(-1, channels)
    return (x.mean(1) if mono else x), rate


def decoder(other: Callable[..., tuple[np.ndarray, int]]) -> Callable[..., tuple[np.ndarray, int]]:
    """Decodes WAV and FLAC bytes itself, as stages leave clips as WAV, and all else by other(data, mono)."""
    own = {b"RIFF": decode_wav, b"fLaC": decode_flac}
    return lambda data, mono=True: own.get(bytes(data[:4]), other)(data, mono)


def encode_wav(x: np.ndarray, rate: int, floats: bool = False) -> bytes:
    """WAV of samples or of frames x channels: 16-bit PCM, where what is beyond full scale is cut, or 32-bit floats as they are."""
    if floats:
        x = np.asarray(x, "<f4")
        channels = 1 if x.ndim == 1 else x.shape[1]
        form = struct.pack("<HHIIHHH", 3, channels, rate, 4 * channels * rate, 4 * channels, 32, 0)
        raw = x.tobytes()
        body = b"WAVEfmt " + struct.pack("<I", len(form)) + form + b"fact" + struct.pack("<II", 4, len(x)) + b"data" + struct.pack("<I", len(raw)) + raw
        return b"RIFF" + struct.pack("<I", len(body)) + body
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1 if x.ndim == 1 else x.shape[1])
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes((np.clip(x, -1, 1) * 32767).round().astype("<i2").tobytes())
    return out.getvalue()


#: How clips are written, by extension.
ENCODERS = {"wav": encode_wav, "flac": encode_flac}


def header(data: bytes) -> tuple[float, int, int]:
    """Seconds, rate and channels from the header of WAV or FLAC bytes, of which the first are enough."""
    if data[:4] == b"fLaC":
        n, rate, channels, _ = flac_header(data)
        return n / rate, rate, channels
    _, channels, rate, bits, _, size = _wave_format(bytes(data))
    return size // (channels * bits // 8) / rate, rate, channels


def resampled(x: np.ndarray, rate: int, to: int) -> np.ndarray:
    """The signal at another rate, band-limited; unchanged if the rates agree."""
    if rate == to or not len(x):
        return x
    n = max(1, round(len(x) * to / rate))
    spectrum = np.fft.rfft(x)
    keep = np.zeros(n // 2 + 1, complex)
    m = min(len(spectrum), len(keep))
    keep[:m] = spectrum[:m]
    return np.fft.irfft(keep, n) * (n / len(x))


def stereo(x: np.ndarray) -> np.ndarray:
    """Two channels: one is doubled, of more the first two stay."""
    x = x[:, None] if x.ndim == 1 else x
    return np.repeat(x, 2, axis=1) if x.shape[1] == 1 else x[:, :2]


def _spectra(x: np.ndarray, size: int, hop: int) -> np.ndarray:
    """Magnitudes of the Hann-windowed frames of a signal."""
    framed = np.lib.stride_tricks.sliding_window_view(x, size)[::hop]
    return np.abs(np.fft.rfft(framed * np.hanning(size), axis=1))


def bandwidth_hz(x: np.ndarray, rate: int, share: float = 0.99, size: int = 2048, seconds: float = 10.0) -> float:
    """The first frequency up to which share of the average power lies; 0 for short or silent signals."""
    x = x[: int(rate * seconds)]
    if len(x) < size:
        return 0.0
    power = (_spectra(x, size, size // 2) ** 2).mean(0)
    if power.sum() <= EPS:
        return 0.0
    k = np.searchsorted(np.cumsum(power) / power.sum(), share)
    return float(min(k, len(power) - 1) * rate / size)


def spectral_distance(x: np.ndarray, y: np.ndarray, size: int = 1024, floor_db: float = -60.0) -> float:
    """Mean log-spectral distance in dB over the frames of x that are above floor_db of its peak; NaN without any."""
    n = min(len(x), len(y))
    if n < size:
        return float("nan")
    x, y = x[:n], y[:n]
    framed = np.lib.stride_tricks.sliding_window_view(x, size)[:: size // 2]
    level = 20 * np.log10(np.sqrt((framed**2).mean(1)) / (np.abs(x).max() + EPS) + 1e-12)
    loud = level >= floor_db
    if not loud.any():
        return float("nan")
    ratio = (_spectra(x, size, size // 2)[loud] + 1e-7) / (_spectra(y, size, size // 2)[loud] + 1e-7)
    return float(np.sqrt(((20 * np.log10(ratio)) ** 2).mean(1)).mean())


def _k_weight(n: int, rate: int) -> np.ndarray:
    """The response of the loudness standard's two filters at the frequencies of an n-point transform."""
    z = np.exp(-2j * np.pi * np.arange(n // 2 + 1) / n)
    # Centre, gain and quality of the shelf, then centre and quality of the high-pass.
    k, gain, q = np.tan(np.pi * 1681.974450955533 / rate), 10 ** (3.999843853973347 / 20), 0.7071752369554196
    mid, a0 = gain**0.4996667741545416, 1 + k / q + k * k
    shelf = (gain + mid * k / q + k * k + 2 * (k * k - gain) * z + (gain - mid * k / q + k * k) * z**2) / (a0 + 2 * (k * k - 1) * z + (1 - k / q + k * k) * z**2)
    k, q = np.tan(np.pi * 38.13547087602444 / rate), 0.5003270373238773
    a0 = 1 + k / q + k * k
    high = (1 - 2 * z + z**2) / (1 + 2 * (k * k - 1) / a0 * z + (1 - k / q + k * k) / a0 * z**2)
    return shelf * high


def loudness_lufs(x: np.ndarray, rate: int) -> float:
    """Gated integrated loudness of one channel; -infinity under 0.4 s or when every block is below the gate."""
    block = int(0.4 * rate)
    if block == 0 or len(x) < block:
        return float("-inf")
    n = len(x) + rate  # room for the filters to die away
    y = np.fft.irfft(np.fft.rfft(x, n) * _k_weight(n, rate), n)[: len(x)]
    total = np.append(0.0, np.cumsum(y * y))
    at = np.arange(0, len(x) - block + 1, max(block // 4, 1))
    power = (total[at + block] - total[at]) / block
    level = lambda p: -0.691 + 10 * np.log10(np.maximum(p, 1e-30))
    power = power[level(power) > -70]
    if not len(power):
        return float("-inf")
    return float(level(power[level(power) > level(power.mean()) - 10].mean()))


def energy_spans(x: np.ndarray, rate: int, frame: float = 0.02, range_db: float = 25.0, silence: float = 0.3, speech: float = 0.25, pad: float = 0.1) -> list[list[float]]:
    """Speech spans in seconds by frame energy: a stand-in where no voice model is plugged in.

    Frames within range_db of the loudest are speech; gaps under silence are closed, spans
    under speech are dropped, the others are padded without overlap. Under 50 ms there are none.
    """
    size = max(1, int(rate * frame))
    if len(x) < rate / 20 or len(x) < size:
        return []
    level = 20 * np.log10(np.sqrt((x[: len(x) // size * size].reshape(-1, size) ** 2).mean(1)) + EPS)
    on = (level > level.max() - range_db) & (level > -90)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], on.view(np.int8), [0]])))
    spans: list[list[float]] = []
    for a, b in zip((edge[::2] * size / rate).tolist(), (edge[1::2] * size / rate).tolist(), strict=True):
        if spans and a - spans[-1][1] < silence:
            spans[-1][1] = b
        else:
            spans.append([a, b])
    spans = [s for s in spans if s[1] - s[0] >= speech]
    end = len(x) / rate
    for k, s in enumerate(spans):
        before = spans[k - 1][1] if k else 0.0
        s[0] = max(s[0] - pad, before)
        s[1] = min(s[1] + pad, end if k + 1 == len(spans) else (s[1] + spans[k + 1][0]) / 2)
    return spans
