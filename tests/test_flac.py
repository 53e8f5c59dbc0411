"""FLAC and float WAV: round trips, headers, and frames of other encoders' kinds."""

import numpy as np
import pytest

from siltline.functions import audio, flac


def pcm(x, bits=16):
    return np.round(np.clip(x, -1, 1) * ((1 << (bits - 1)) - 1)) / (1 << (bits - 1))


SIGNALS = {
    "empty": np.zeros(0), "one": np.array([0.5]), "few": np.array([0.1, -0.2, 0.3]), "silence": np.zeros(10_000), "level": np.full(5000, -0.25),
    "noise": np.random.default_rng(1).uniform(-1, 1, 9000), "tone": 0.5 * np.sin(np.arange(20_000) / 9), "ramp": np.linspace(-1, 1, 4097), "loud": 3 * np.sin(np.arange(5000)),
    "steps": np.repeat([1.0, -1.0, 0.0, 1.0], 1024), "speech": np.random.default_rng(2).normal(0, 0.01, 30_000) * np.sin(np.arange(30_000) / 3000),
}


@pytest.mark.parametrize("bits", [16, 24])
@pytest.mark.parametrize("name", sorted(SIGNALS))
def test_round_trip(name, bits):
    x = SIGNALS[name]
    data = flac.encode_flac(x, 22_050, bits)
    back, rate = flac.decode_flac(data)
    assert rate == 22_050 and (back == pcm(x, bits)).all() and len(back) == len(x)
    assert flac.flac_header(data) == (len(x), 22_050, 1, bits) and audio.header(data[:64]) == (len(x) / 22_050, 22_050, 1)


def test_channels_and_sizes():
    x = np.stack([SIGNALS["tone"], -SIGNALS["tone"], 0 * SIGNALS["tone"]], 1)
    back, _ = flac.decode_flac(flac.encode_flac(x, 48_000), mono=False)
    assert (back == pcm(x)).all()
    for name, least in (("tone", 0.7), ("silence", 0.02), ("speech", 0.7), ("noise", 1.05)):
        assert len(flac.encode_flac(SIGNALS[name], 16_000)) < least * len(audio.encode_wav(SIGNALS[name], 16_000)) + 100


def test_broken_bytes_are_errors():
    data = flac.encode_flac(SIGNALS["tone"], 16_000)
    for bad in (data[:5000], data[:60] + b"\0" + data[61:], b"fLaC", data[:3000] + bytes([data[3000] ^ 1]) + data[3001:], b""):
        with pytest.raises((ValueError, IndexError)):
            flac.decode_flac(bad)


def frame(body, size, assignment, number=0):
    """A frame around coded subframes."""
    head = bytes([0xFF, 0xF8, 0x70, assignment << 4 | 0b1000]) + flac._coded_number(number) + (size - 1).to_bytes(2, "big")
    head += bytes([flac._crc8(head)])
    body = head + np.packbits(np.concatenate(body).astype(np.uint8)).tobytes()
    return body + flac._crc16(body).to_bytes(2, "big")


def stream(frames, n, channels):
    empty = flac.encode_flac(np.zeros((0, channels)), 8000)
    packed = int.from_bytes(empty[18:26], "big") | n
    return empty[:18] + packed.to_bytes(8, "big") + empty[26:] + b"".join(frames)


def test_other_encoders_frames():
    """Linear prediction, wasted bits, escaped partitions and joint stereo, coded by hand."""
    r = np.random.default_rng(3)
    left, right = r.integers(-900, 900, 64), r.integers(-900, 900, 64)
    for assignment, one, two in ((8, left, left - right), (9, left - right, right), (10, (left + right) >> 1, left - right)):
        bits = (16 + (assignment == 9), 16 + (assignment != 9))
        body = [np.concatenate([flac._bits(2, 8), flac._words(x, b)]) for x, b in zip((one, two), bits, strict=True)]
        x, _ = flac.decode_flac(stream([frame(body, 64, assignment)], 64, 2), mono=False)
        assert (x * 32768 == np.stack([left, right], 1)).all(), assignment
    x = np.cumsum(r.integers(-5, 5, 40))
    residual = [int(x[k]) - ((3 * int(x[k - 1]) - int(x[k - 2])) >> 1) for k in range(2, 40)]
    coded = [flac._bits(0b0100001, 7), flac._bits(0, 1), flac._words(x[:2], 16), flac._bits(3, 4), flac._bits(1, 5), flac._words(np.array([3, -1]), 4), flac._residual(np.array(residual), 2)]
    assert (flac.decode_flac(stream([frame(coded, 40, 0)], 40, 1))[0] * 32768 == x).all()
    escaped = [flac._bits(0b0001000, 7), flac._bits(1, 1), flac._bits(1, 2), flac._bits(0, 2), flac._bits(0, 4), flac._bits(15, 4), flac._bits(9, 5), flac._words(x, 9)]
    assert (flac.decode_flac(stream([frame(escaped, 40, 0)], 40, 1))[0] * 32768 == 4 * x).all()


def test_numbers_of_frames():
    for n in (0, 0x7F, 0x80, 0x7FF, 0x800, 0xFFFF, 0x10000, 0x1FFFFF, 0x200000):
        coded = flac._coded_number(n)
        assert coded == chr(n).encode("utf-8", "surrogatepass") if n < 0x110000 else len(coded) == 4 + (n >= 0x200000)


def test_float_wav():
    x = np.array([0.5, -1.5, 2.25, 1e-9])
    back, rate = audio.decode_wav(audio.encode_wav(x, 44_100, floats=True))
    assert rate == 44_100 and (back == x.astype(np.float32)).all()
    two = np.stack([x, -x], 1)
    data = audio.encode_wav(two, 8000, floats=True)
    assert (audio.decode_wav(data, mono=False)[0] == two.astype(np.float32)).all() and audio.header(data[:80]) == (4 / 8000, 8000, 2)
    for bad in (b"RIFF", b"no", data[:30], data.replace(b"\x03\x00\x02\x00", b"\x07\x00\x02\x00", 1)):
        with pytest.raises((ValueError, IndexError)):
            audio.decode_wav(bad)


def test_clips_as_flac(spark):
    from siltline.operators.measure import encode_clips, measure_clips

    tone = 0.3 * np.sin(np.arange(16_000) / 5)
    df = spark.createDataFrame([("a", bytearray(audio.encode_wav(tone, 16_000))), ("b", bytearray(b"no"))], "uid string, content binary")
    (made,) = encode_clips(df, 16_000, kind="flac").collect()
    assert made["uid"] == "a" and (audio.decoder(audio.decode_wav)(made["content"])[0] == pcm(audio.decode_wav(audio.encode_wav(tone, 16_000))[0])).all()
    again = spark.createDataFrame([("a", made["content"])], "uid string, content binary")
    assert abs(measure_clips(again, decode=audio.decoder(audio.decode_wav)).first()["duration"] - 1.0) < 1e-9


def test_all_channels_stay(spark):
    from siltline.operators.measure import encode_clips

    two = np.stack([0.4 * np.sin(np.arange(8000) / 7), 0.2 * np.cos(np.arange(8000) / 5)], 1)
    df = spark.createDataFrame([("a", bytearray(audio.encode_wav(two, 8000)))], "uid string, content binary")
    for kind in ("wav", "flac"):
        (made,) = encode_clips(df, 8000, kind=kind, mono=False).collect()
        x, rate = audio.decoder(audio.decode_wav)(made["content"], False)
        assert rate == 8000 and x.shape == (8000, 2) and np.abs(x - two).max() < 1e-4 and made["duration"] == 1.0
        (half,) = encode_clips(df, 4000, kind=kind, mono=False).collect()
        assert audio.header(half["content"]) == (1.0, 4000, 2)
