"""Sequential JPEG: every coefficient and pixel against plain sums of cosines."""

import math
import random

import numpy as np
import pytest

from scanloom.sources import decode, encode, jpeg, readers


def plain_block(samples, quant):
    """A block through the transform, rounding by ``quant``, and back, by its definition."""
    scale = lambda k: math.sqrt(1 / 8) if k == 0 else 0.5
    wave = lambda k, x: scale(k) * math.cos((2 * x + 1) * k * math.pi / 16)
    order, r, c, up = {}, 0, 0, True
    for k in range(64):  # walk the zigzag step by step
        order[r, c] = k
        if up:
            r, c, up = (r + 1, c, False) if c == 7 else (r, c + 1, False) if r == 0 else (r - 1, c + 1, True)
        else:
            r, c, up = (r, c + 1, True) if r == 7 else (r + 1, c, True) if c == 0 else (r + 1, c - 1, False)
    f = {(u, v): sum((samples[y][x] - 128) * wave(u, y) * wave(v, x) for y in range(8) for x in range(8)) for u in range(8) for v in range(8)}
    f = {k: round(v / quant[order[k]]) * quant[order[k]] for k, v in f.items()}
    return [[min(255, max(0, round(128 + sum(v * wave(a, y) * wave(b, x) for (a, b), v in f.items())))) for x in range(8)] for y in range(8)]


def test_blocks():
    rng = np.random.default_rng(1)
    plane = np.clip(np.cumsum(rng.normal(size=(16, 24)) * 9, axis=1) + 120, 0, 255).astype(np.uint8)
    quant = np.array([3 + k % 7 for k in range(64)])
    got = jpeg.pixels(jpeg.file([plane], (16, 24), [(1, 1)], quant))[:, :, 0]
    for r in range(2):
        for c in range(3):
            own = np.s_[8 * r : 8 * r + 8, 8 * c : 8 * c + 8]
            assert np.abs(got[own].astype(int) - np.array(plain_block(plane[own].tolist(), quant.tolist()))).max() <= 1  # halves may round either way


@pytest.mark.parametrize("sampling", [[(1, 1)] * 3, [(2, 2), (1, 1), (1, 1)], [(1, 2), (1, 1), (1, 1)], [(2, 1), (1, 1), (1, 1)]])
@pytest.mark.parametrize("apart", [False, True])
@pytest.mark.parametrize("restart", [0, 3])
def test_sampling(sampling, apart, restart):
    """Pictures that are even inside a component's blocks come back to the byte."""
    random.seed(7)
    size, tall, wide = (37, 51), sampling[0][0], sampling[0][1]
    planes = []
    for v, h in sampling:
        rows, columns = -(-size[0] * v // tall), -(-size[1] * h // wide)
        tiles = np.array([[random.randint(0, 255) for _ in range(-(-columns // 8))] for _ in range(-(-rows // 8))], np.uint8)
        planes.append(np.repeat(np.repeat(tiles, 8, 0), 8, 1)[:rows, :columns])
    got = jpeg.pixels(jpeg.file(planes, size, sampling, restart=restart, apart=apart))
    at = lambda k, y, x: int(planes[k][y * sampling[k][0] // tall, x * sampling[k][1] // wide])
    for y in range(size[0]):
        for x in range(size[1]):
            a, b, r = at(0, y, x), at(1, y, x) - 128, at(2, y, x) - 128
            want = [min(255, max(0, round(v))) for v in (a + 1.402 * r, a - 0.344136 * b - 0.714136 * r, a + 1.772 * b)]
            assert got[y, x].tolist() == want


def test_codes_of_all_lengths():
    """Tables whose codes have 2 to 16 bits, as optimised files do."""
    rng = np.random.default_rng(3)
    plane = rng.integers(0, 256, (24, 24)).astype(np.uint8)
    def table(symbols):
        counts, left = [0] * 16, len(symbols)
        room = 1
        for k in range(16):
            room *= 2
            counts[k] = min(left, 1 if k < 7 and k > 0 else max(0, min(left, room - 1)) if k >= 8 else 0)
            room -= counts[k]
            left -= counts[k]
        assert left == 0
        return bytes(counts), symbols
    tables = {"dc": table(jpeg.DC_SYMBOLS), "ac": table(jpeg.AC_SYMBOLS)}
    assert len({n for n, _ in [(k, c) for k, c in enumerate(tables["ac"][0]) if c]}) > 6
    assert np.array_equal(jpeg.pixels(jpeg.file([plane], (24, 24), [(1, 1)], tables=tables)), jpeg.pixels(jpeg.file([plane], (24, 24), [(1, 1)])))
    assert np.abs(jpeg.pixels(jpeg.file([plane], (24, 24), [(1, 1)]))[:, :, 0].astype(int) - plane).max() <= 2


def test_damaged():
    data = jpeg.file([np.full((16, 16), 90, np.uint8)], (16, 16), [(1, 1)])
    assert (jpeg.pixels(data) == 90).all()
    for bad in (b"", b"\xff\xd8", data[:200], data[:-6], data.replace(b"\xff\xc0", b"\xff\xc2"), b"\x89PNG" + data):
        with pytest.raises(ValueError):
            jpeg.pixels(bad)
    noisy = np.random.default_rng(2).integers(0, 256, (64, 64)).astype(np.uint8)
    whole = jpeg.file([noisy], (64, 64), [(1, 1)])
    with pytest.raises(ValueError):
        jpeg.pixels(whole[: len(whole) // 2])


def test_pictures_and_messages(spark):
    grey = jpeg.file([np.full((10, 12), 77, np.uint8)], (10, 12), [(1, 1)])
    png = decode.png(np.full((2, 2), 9, np.uint8))
    rows = [("a.jpg", bytearray(grey)), ("b.png", bytearray(png)), ("c.jpg", bytearray(grey[:100]))]
    got = {r.path: r for r in readers.pictures(spark.createDataFrame(rows, "path string, file binary")).collect()}
    assert (got["a.jpg"].height, got["a.jpg"].width, got["a.jpg"].grey) == (10, 12, [77 / 255] * 120)
    assert got["b.png"].grey == [9 / 255] * 4 and got["c.jpg"].error and got["c.jpg"].grey is None
    message = spark.createDataFrame([("r", "/jpg", 5, bytearray(encode.compressed_message(5, grey, "jpeg")))], "path string, topic string, ts_ns long, data binary")
    assert readers.pictures(readers.message_files(message)).first().grey[0] == 77 / 255
