import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tilewright.sources import png
from tests.test_golden import write_png


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 9), st.integers(1, 9), st.integers(0, 2**32 - 1))
def test_round_trip(width, height, seed):
    image = np.random.default_rng(seed).integers(0, 256, (height, width, 4), np.uint8)
    assert (png.decode(png.encode(image))[0] == image).all()


def filtered(raw: np.ndarray, kinds, step):
    """Lines filtered by the definitions of the format."""
    rows, line = raw.shape
    out = []
    for y in range(rows):
        kind = kinds[y % len(kinds)]
        row = [kind]
        for i in range(line):
            a = int(raw[y, i - step]) if i >= step else 0
            b = int(raw[y - 1, i]) if y else 0
            c = int(raw[y - 1, i - step]) if y and i >= step else 0
            p = a + b - c
            paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            row.append((int(raw[y, i]) - [0, a, b, (a + b) // 2, paeth][kind]) % 256)
        out.append(bytes(row))
    return b"".join(out)


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 2**32 - 1), st.lists(st.integers(0, 4), min_size=1, max_size=5))
def test_filters(seed, kinds):
    raw = np.random.default_rng(seed).integers(0, 256, (6, 15), np.uint8)
    image, _ = png.decode(write_png(5, 6, 8, 2, filtered(raw, kinds, 3)))
    assert (image == raw.reshape(6, 5, 3)).all()


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_small_depths(depth):
    values = np.arange(10) % (1 << depth)
    bits = ((values[:, None] >> np.arange(depth - 1, -1, -1)) & 1).astype(np.uint8).ravel()
    image, head = png.decode(write_png(10, 1, depth, 0, b"\0" + np.packbits(bits).tobytes()))
    assert image[0, :, 0].tolist() == (values * (255 // ((1 << depth) - 1))).tolist()
    assert head.mode == "L"


def test_sixteen_bits_grey_alpha_and_trns():
    image, _ = png.decode(write_png(1, 1, 16, 4, b"\0" + struct.pack(">HH", 0x1234, 0x8000)))
    assert image[0, 0].tolist() == [0x12, 0x12, 0x12, 0x80]
    image, _ = png.decode(write_png(2, 1, 8, 2, b"\0" + bytes([1, 2, 3, 4, 5, 6]), trns=struct.pack(">HHH", 1, 2, 3)))
    assert image[0].tolist() == [[1, 2, 3, 0], [4, 5, 6, 255]]


def test_interlaced():
    rng = np.random.default_rng(5)
    image = rng.integers(0, 256, (7, 9, 4), np.uint8)
    lines = b""
    for x, y, dx, dy in png.ADAM7:
        part = image[y::dy, x::dx]
        if part.size:
            lines += b"".join(b"\0" + row.tobytes() for row in part)
    assert (png.decode(write_png(9, 7, 8, 6, lines, lace=1))[0] == image).all()


def test_damage():
    good = png.encode(np.zeros((2, 2, 4), np.uint8))
    for bad in (b"", good[1:], good[:-5], good[:40] + b"x" + good[41:], write_png(2, 2, 8, 6, b"\0"), write_png(1, 1, 8, 3, b"\0\5", bytes(3))):
        with pytest.raises(png.PngError):
            png.decode(bad)
    assert zlib.crc32(b"") == 0


def test_mode_report(spark):
    palette = write_png(1, 1, 8, 3, b"\0\0", bytes([0, 0, 0, 1, 1, 1, 0, 0, 0]), bytes([0]))
    rows = [(0, 0, bytearray(palette)), (0, 1, bytearray(png.encode(np.zeros((1, 1, 4), np.uint8))))]
    found = png.mode_report(spark.createDataFrame(rows, "x int, y int, content binary")).orderBy("y").collect()
    assert [(r.mode, r.trns, r.black_entries) for r in found] == [("P", True, [0, 2]), ("RGBA", False, [])]
