"""Lossless FLAC of PCM samples in numpy: fixed predictors and Rice codes out; these, linear prediction and stereo in."""

from __future__ import annotations

import hashlib

import numpy as np

#: Samples in a frame, and partitions of a frame that are tried (as a power of two).
BLOCK, SPLITS = 4096, 5


# ---- bits ---------------------------------------------------------------------------------


def _bits(value: int, n: int) -> np.ndarray:
    """The n lowest bits of a whole number, the highest first."""
    return (value >> np.arange(n - 1, -1, -1)) & 1 if n < 63 else np.array([value >> k & 1 for k in reversed(range(n))])


def _words(values: np.ndarray, n: int) -> np.ndarray:
    """Each value's n lowest bits, one value after another."""
    return ((values[:, None] >> np.arange(n - 1, -1, -1)) & 1).ravel()


def _crc_table(poly: int, width: int) -> list[int]:
    out, top = [], 1 << (width - 1)
    for c in range(256):
        c <<= width - 8
        for _ in range(8):
            c = (c << 1) ^ poly if c & top else c << 1
        out.append(c & ((1 << width) - 1))
    return out


# Polynomials of the checks over a frame's header and over a whole frame.
_CRC8, _CRC16 = _crc_table(0x07, 8), _crc_table(0x8005, 16)


def _crc8(data: bytes) -> int:
    c = 0
    for b in data:
        c = _CRC8[c ^ b]
    return c


def _crc16(data: bytes) -> int:
    c = 0
    for b in data:
        c = ((c << 8) & 0xFFFF) ^ _CRC16[(c >> 8) ^ b]
    return c


def _coded_number(n: int) -> bytes:
    """A frame's number, coded as characters are in UTF-8, up to 36 bits."""
    if n < 0x80:
        return bytes([n])
    more = next(k for k in range(1, 7) if n < 1 << (6 * k + 6 - k))
    head = (0xFF << (7 - more)) & 0xFF
    return bytes([head | n >> (6 * more), *(0x80 | n >> (6 * k) & 0x3F for k in reversed(range(more)))])


# ---- encoding -----------------------------------------------------------------------------


def _rice(u: np.ndarray, k: int) -> np.ndarray:
    """Rice codes: the quotient as zeros and a one, then k low bits."""
    q = u >> k
    begin = np.cumsum(q + 1 + k) - (q + 1 + k)
    out = np.zeros(int((q + 1 + k).sum()), np.int64)
    one = begin + q
    out[one] = 1
    for j in range(k):
        out[one + 1 + j] = u >> (k - 1 - j) & 1
    return out


def _residual(r: np.ndarray, order: int) -> np.ndarray:
    """The coded residual of a block of len(r) + order samples, in the partitions that cost least."""
    u, n = np.where(r >= 0, 2 * r, -2 * r - 1), len(r) + order
    params = np.arange(31)
    best = None
    for split in range(SPLITS):
        size = n >> split
        if n % (1 << split) or size <= order:
            break
        cuts = np.append(0, size * np.arange(1, 1 << split) - order).astype(np.int64) if split else np.zeros(1, np.int64)
        counts = np.diff(np.append(cuts, len(u)))
        costs = np.stack([np.add.reduceat(u >> k, cuts) + counts * (1 + k) for k in params]) if len(u) else np.zeros((31, len(cuts)), np.int64)
        ks = costs.argmin(0)
        total = int(costs.min(0).sum()) + 5 * len(cuts)
        if best is None or total < best[0]:
            best = total, split, cuts, ks
    _, split, cuts, ks = best
    wide = int(ks.max()) > 14  # parameters of five bits
    out = [_bits(int(wide), 2), _bits(split, 4)]
    for lo, hi, k in zip(cuts.tolist(), [*cuts[1:].tolist(), len(u)], ks.tolist(), strict=True):
        out += [_bits(k, 5 if wide else 4), _rice(u[lo:hi], k)]
    return np.concatenate(out)


def _subframe(x: np.ndarray, bits: int) -> np.ndarray:
    """A channel of one block: constant, by the fixed predictor whose residual is least, or as it is."""
    if (x == x[0]).all():
        return np.concatenate([_bits(0, 8), _bits(int(x[0]), bits)])
    plain = np.concatenate([_bits(0b00000010, 8), _words(x, bits)])
    diffs = [x]
    for _ in range(min(4, len(x) - 1)):
        diffs.append(np.diff(diffs[-1]))
    order = int(np.argmin([np.abs(d[4 - k :] if len(x) > 8 else d).sum() for k, d in enumerate(diffs)])) if len(x) > 8 else 0
    coded = np.concatenate([_bits((0b001000 | order) << 1, 8), _words(x[:order], bits), _residual(diffs[order], order)])
    return coded if len(coded) < len(plain) else plain


def encode_flac(x: np.ndarray, rate: int, bits: int = 16) -> bytes:
    """FLAC of samples from -1 to 1 (or frames x channels, eight at most) at 16 or 24 bits; what is beyond full scale is cut."""
    top = (1 << (bits - 1)) - 1
    pcm = (np.clip(x, -1, 1) * top).round().astype(np.int64)
    pcm = pcm[:, None] if pcm.ndim == 1 else pcm
    n, channels = pcm.shape
    raw = pcm.astype("<i4").view(np.uint8).reshape(-1, 4)[:, : bits // 8].tobytes()
    frames, sizes = [], []
    for number, lo in enumerate(range(0, n, BLOCK)):
        block = pcm[lo : lo + BLOCK]
        head = np.concatenate([_bits(0b111111111111100, 15), _bits(0, 1), _bits(0b0111, 4), _bits(0, 4), _bits(channels - 1, 4), _bits(0, 3), _bits(0, 1)])
        head = np.packbits(head.astype(np.uint8)).tobytes() + _coded_number(number) + (len(block) - 1).to_bytes(2, "big")
        head += bytes([_crc8(head)])
        body = np.packbits(np.concatenate([_subframe(block[:, c], bits) for c in range(channels)]).astype(np.uint8)).tobytes()
        frame = head + body
        frames.append(frame + _crc16(frame).to_bytes(2, "big"))
        sizes.append(len(frames[-1]))
    size = min(BLOCK, max(n, 16))
    info = np.concatenate([
        _bits(size, 16), _bits(size, 16), _bits(min(sizes, default=0), 24), _bits(max(sizes, default=0), 24), _bits(rate, 20), _bits(channels - 1, 3), _bits(bits - 1, 5), _bits(n, 36),
    ])
    head = b"fLaC" + bytes([0x80, 0, 0, 34]) + np.packbits(info.astype(np.uint8)).tobytes() + hashlib.md5(raw).digest()
    return head + b"".join(frames)


# ---- decoding -----------------------------------------------------------------------------


def flac_header(data: bytes) -> tuple[int, int, int, int]:
    """Samples, rate, channels and bits from the first block of a FLAC file; only its first bytes are needed."""
    if data[:4] != b"fLaC" or data[4] & 0x7F or len(data) < 42:
        raise ValueError("no FLAC header")
    packed = int.from_bytes(data[18:26], "big")
    return packed & ((1 << 36) - 1), packed >> 44, (packed >> 41 & 7) + 1, (packed >> 36 & 31) + 1


class _Reader:
    """The bits of some bytes."""

    def __init__(self, data: bytes):
        self.bit = np.unpackbits(np.frombuffer(data, np.uint8)).astype(np.int64)
        self.at, n = 0, len(self.bit)
        ones = np.where(self.bit > 0, np.arange(n), n)
        self.next_one = np.minimum.accumulate(ones[::-1])[::-1].tolist() if n else []

    def take(self, n: int) -> int:
        self.at += n
        return int("".join(map(str, self.bit[self.at - n : self.at].tolist())) or "0", 2)

    def signed(self, n: int) -> int:
        x = self.take(n)
        return x - (1 << n) if n and x >> (n - 1) else x

    def many(self, count: int, n: int) -> np.ndarray:
        """count signed numbers of n bits."""
        rows = self.bit[self.at : self.at + count * n].reshape(count, n) if n else np.zeros((count, 1), np.int64)
        self.at += count * n
        x = rows @ (1 << np.arange(rows.shape[1] - 1, -1, -1))
        return np.where(rows[:, 0] > 0, x - (1 << n), x) if n else x

    def rice(self, count: int, k: int) -> np.ndarray:
        ones, next_one, at = [], self.next_one, self.at
        begins = []
        for _ in range(count):
            begins.append(at)
            one = next_one[at]
            ones.append(one)
            at = one + 1 + k
        self.at = at
        one = np.array(ones, np.int64)
        u = one - np.array(begins, np.int64)
        for j in range(k):
            u = u << 1 | self.bit[one + 1 + j]
        return np.where(u & 1, -(u >> 1) - 1, u >> 1)

    def residual(self, n: int, order: int) -> np.ndarray:
        width, split = 4 + self.take(2), self.take(4)
        if width > 5:
            raise ValueError("an unknown residual code")
        out = []
        for part in range(1 << split):
            count = (n >> split) - (0 if part else order)
            k = self.take(width)
            out.append(self.many(count, self.take(5)) if k == (1 << width) - 1 else self.rice(count, k))
        return np.concatenate(out)

    def subframe(self, n: int, bits: int) -> np.ndarray:
        self.take(1)
        kind, wasted = self.take(6), 0
        if self.take(1):
            one = self.next_one[self.at]
            wasted, self.at = one - self.at + 1, one + 1
        bits -= wasted
        if kind == 0:
            x = np.full(n, self.signed(bits))
        elif kind == 1:
            x = self.many(n, bits)
        elif 8 <= kind <= 12:
            order = kind - 8
            first = self.many(order, bits)
            x = self.residual(n, order)
            for k in reversed(range(order)):  # each sum takes back one difference
                x = np.diff(first, k)[-1] + np.cumsum(x)
            x = np.append(first, x)
        elif kind >= 32:
            order = kind - 31
            out = self.many(order, bits).tolist()
            precision, shift = self.take(4) + 1, self.signed(5)
            c = self.many(order, precision)[::-1].tolist()
            for r in self.residual(n, order).tolist():
                out.append(r + (sum(a * b for a, b in zip(c, out[-order:], strict=True)) >> shift))
            x = np.array(out)
        else:
            raise ValueError("an unknown predictor")
        return x << wasted


# Block sizes and sample sizes by their codes in a frame's header.
_SIZES = {1: 192, **{k: 576 << (k - 2) for k in range(2, 6)}, **{k: 256 << (k - 8) for k in range(8, 16)}}
_SAMPLE_BITS = {1: 8, 2: 12, 4: 16, 5: 20, 6: 24, 7: 32}


def decode_flac(data: bytes, mono: bool = True) -> tuple[np.ndarray, int]:
    """Samples from -1 to 1 (frames x channels, or the mean of the channels) and the rate. Broken frames are an error."""
    n, rate, channels, bits = flac_header(data)
    at, last = 4, False
    while not last:
        last, at = bool(data[at] & 0x80), at + 4 + int.from_bytes(data[at + 1 : at + 4], "big")
    blocks = []
    while at < len(data):
        begin = at
        if data[at] != 0xFF or data[at + 1] & 0xFE != 0xF8:
            raise ValueError("no frame where one should begin")
        size, assignment, depth = data[at + 2] >> 4, data[at + 3] >> 4, data[at + 3] >> 1 & 7
        rated, at = data[at + 2] & 15, at + 4
        at += max(1, 8 - (data[at] ^ 0xFF).bit_length())  # as many bytes as the first begins with ones
        if size in (6, 7):
            size, at = int.from_bytes(data[at : at + size - 5], "big") + 1, at + size - 5
        else:
            size = _SIZES[size]
        at += {12: 1, 13: 2, 14: 2}.get(rated, 0)
        if _crc8(data[begin:at]) != data[at]:
            raise ValueError("a broken frame header")
        own = _SAMPLE_BITS.get(depth, bits)
        reader = _Reader(data[at + 1 : at + 1 + size * channels * (own + 1) // 8 + 1024])
        side = {8: 1, 9: 0, 10: 1}.get(assignment)
        x = np.stack([reader.subframe(size, own + (c == side)) for c in range(channels)], 1)
        if assignment == 8:
            x[:, 1] = x[:, 0] - x[:, 1]
        elif assignment == 9:
            x[:, 0] += x[:, 1]
        elif assignment == 10:
            mid = x[:, 0] << 1 | x[:, 1] & 1
            x = np.stack([(mid + x[:, 1]) >> 1, (mid - x[:, 1]) >> 1], 1)
        at += 1 + -(-reader.at // 8)
        if _crc16(data[begin:at]) != int.from_bytes(data[at : at + 2], "big"):
            raise ValueError("a broken frame")
        at += 2
        blocks.append(x)
    x = np.concatenate(blocks) if blocks else np.zeros((0, channels), np.int64)
    if n and len(x) != n:
        raise ValueError("samples are missing")
    x = x / float(1 << (bits - 1))
    return (x.mean(1) if mono else x), rate
