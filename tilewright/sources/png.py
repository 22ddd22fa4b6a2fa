"""Reading and writing PNG images with zlib and numpy.

decode() reads all colour types and bit depths, interlaced images included; encode() writes
8-bit RGBA. The column forms work on Arrow batches.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Fixed values of the PNG format: signature, channels by colour type, passes of the interlacing (x, y, dx, dy).
SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
DEPTHS = {0: (1, 2, 4, 8, 16), 2: (8, 16), 3: (1, 2, 4, 8), 4: (8, 16), 6: (8, 16)}
ADAM7 = ((0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2))
MODES = {0: "L", 2: "RGB", 3: "P", 4: "LA", 6: "RGBA"}


class PngError(ValueError):
    """Not a PNG image, or a damaged one."""


@dataclass
class Header:
    width: int
    height: int
    depth: int
    colour: int
    interlaced: bool
    palette: np.ndarray | None
    trns: bytes | None

    @property
    def mode(self) -> str:
        return MODES[self.colour]

    def black_entries(self) -> list[int]:
        """Indexes of the palette's black entries."""
        return [] if self.palette is None else np.flatnonzero((self.palette == 0).all(axis=1)).tolist()


def chunks(content: bytes):
    if content[:8] != SIGNATURE:
        raise PngError("signature")
    at = 8
    while at + 12 <= len(content):
        (size,) = struct.unpack_from(">I", content, at)
        kind, body = content[at + 4 : at + 8], content[at + 8 : at + 8 + size]
        if len(body) != size or at + 12 + size > len(content):
            raise PngError("a chunk ends early")
        if zlib.crc32(kind + body) != struct.unpack_from(">I", content, at + 8 + size)[0]:
            raise PngError("checksum")
        yield kind, body
        if kind == b"IEND":
            return
        at += 12 + size
    raise PngError("no end")


def header(content: bytes) -> tuple[Header, bytes]:
    """The header with palette and transparency, and the compressed image data."""
    head, data = None, []
    for kind, body in chunks(content):
        if kind == b"IHDR":
            width, height, depth, colour, method, filters, lace = struct.unpack(">IIBBBBB", body)
            if colour not in CHANNELS or depth not in DEPTHS[colour] or method or filters or lace > 1 or not width or not height:
                raise PngError("header")
            head = Header(width, height, depth, colour, bool(lace), None, None)
        elif head is None:
            raise PngError("header")
        elif kind == b"PLTE":
            if len(body) % 3:
                raise PngError("palette")
            head.palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"tRNS":
            head.trns = body
        elif kind == b"IDAT":
            data.append(body)
    if head is None or (head.colour == 3 and head.palette is None):
        raise PngError("header or palette missing")
    return head, b"".join(data)


def _unfilter(raw: np.ndarray, rows: int, line: int, step: int) -> np.ndarray:
    """Lines of bytes from filtered ones; step is the distance of a pixel's left neighbour."""
    if len(raw) < rows * (line + 1):
        raise PngError("image data ends early")
    lines = raw[: rows * (line + 1)].reshape(rows, line + 1)
    out = np.zeros((rows, line), np.uint8)
    above = np.zeros(line, np.uint8)
    for y in range(rows):
        kind, now = lines[y, 0], lines[y, 1:]
        if kind == 0:
            out[y] = now
        elif kind == 1:
            for c in range(min(step, line)):
                out[y, c::step] = np.cumsum(now[c::step], dtype=np.uint8)
        elif kind == 2:
            out[y] = now + above
        elif kind in (3, 4):
            left, corner = [0] * step, [0] * step
            row, up, done = now.tolist(), above.tolist(), [0] * line
            for i in range(line):
                a, b, c = left[i % step], up[i], corner[i % step]
                if kind == 3:
                    guess = (a + b) >> 1
                else:
                    p = a + b - c
                    pa_, pb, pc = abs(p - a), abs(p - b), abs(p - c)
                    guess = a if pa_ <= pb and pa_ <= pc else b if pb <= pc else c
                done[i] = left[i % step] = (row[i] + guess) & 255
                corner[i % step] = b
            out[y] = done
        else:
            raise PngError("filter")
        above = out[y]
    return out


def _samples(head: Header, raw: np.ndarray, at: int, width: int, height: int) -> tuple[np.ndarray, int]:
    """Samples [height, width, channels] as stored, and where the next pass begins."""
    n = CHANNELS[head.colour]
    line = (width * n * head.depth + 7) // 8
    step = max(1, n * head.depth // 8)
    lines = _unfilter(raw[at:], height, line, step)
    if head.depth == 16:
        flat = lines.reshape(height, -1, 2).astype(np.uint16)
        flat = flat[..., 0] << 8 | flat[..., 1]
    elif head.depth == 8:
        flat = lines.astype(np.uint16)
    else:
        bits = np.unpackbits(lines, axis=1).reshape(height, -1, head.depth)
        flat = (bits * (1 << np.arange(head.depth - 1, -1, -1))).sum(axis=2).astype(np.uint16)
    return flat[:, : width * n].reshape(height, width, n), at + height * (line + 1)


def decode(content: bytes) -> tuple[np.ndarray, Header]:
    """RGB without, RGBA with transparency (palette images always RGBA), 8 bits a channel."""
    head, data = header(content)
    try:
        raw = np.frombuffer(zlib.decompress(data), np.uint8)
    except zlib.error as e:
        raise PngError(str(e)) from e
    n = CHANNELS[head.colour]
    if not head.interlaced:
        s, _ = _samples(head, raw, 0, head.width, head.height)
    else:
        s, at = np.zeros((head.height, head.width, n), np.uint16), 0
        for x, y, dx, dy in ADAM7:
            w, h = -(-(head.width - x) // dx), -(-(head.height - y) // dy)
            if w > 0 and h > 0:
                s[y::dy, x::dx], at = _samples(head, raw, at, w, h)
    if head.colour == 3:
        if s.max(initial=0) >= len(head.palette):
            raise PngError("index beyond the palette")
        alpha = np.full(len(head.palette), 255, np.uint8)
        trns = np.frombuffer((head.trns or b"")[: len(alpha)], np.uint8)
        alpha[: len(trns)] = trns
        return np.concatenate([head.palette[s[..., 0]], alpha[s]], axis=2), head
    clear = None
    if head.trns and head.colour in (0, 2):
        clear = (s == np.array(struct.unpack(f">{n}H", head.trns[: 2 * n]))).all(axis=2)
    eight = (s >> 8 if head.depth == 16 else s * (255 // ((1 << head.depth) - 1))).astype(np.uint8)
    colour = np.repeat(eight[..., :1], 3, axis=2) if head.colour in (0, 4) else eight[..., :3]
    if head.colour in (4, 6):
        return np.concatenate([colour, eight[..., -1:]], axis=2), head
    if clear is not None:
        return np.concatenate([colour, np.where(clear, 0, 255).astype(np.uint8)[..., None]], axis=2), head
    if head.colour == 0:
        return np.concatenate([colour, np.full((*colour.shape[:2], 1), 255, np.uint8)], axis=2), head
    return colour, head


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode(rgba: np.ndarray, level: int = 6) -> bytes:
    """An 8-bit RGBA image."""
    height, width, n = rgba.shape
    if n != 4 or rgba.dtype != np.uint8:
        raise PngError("8-bit RGBA is needed")
    lines = np.zeros((height, 1 + 4 * width), np.uint8)
    lines[:, 1:] = rgba.reshape(height, -1)
    head = struct.pack(">IIBBBBB", width, height, 8, 6, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), level)) + _chunk(b"IEND", b"")


def decode_pixels(tiles: DataFrame, tile_size: int, strict: bool = False) -> DataFrame:
    """tag, tag_ts, x, y, ordinal, mode, trns, pos, rgb24, alpha of tiles(tag, tag_ts, x, y, ordinal, content).

    An image without alpha has alpha 255. strict: other modes than RGBA, and alpha other than
    0 and 255, are errors. So is another size than tile_size squared.
    """
    names = ["tag", "tag_ts", "x", "y", "ordinal"]

    def run(batches):
        for batch in batches:
            content = batch.column(batch.schema.get_field_index("content"))
            for i in range(batch.num_rows):
                image, head = decode(content[i].as_py())
                if image.shape[:2] != (tile_size, tile_size):
                    raise PngError(f"a tile of {image.shape[1]} x {image.shape[0]} pixels")
                alpha = image[..., 3].ravel() if image.shape[2] == 4 else np.full(tile_size * tile_size, 255, np.uint8)
                if strict and (head.mode != "RGBA" or ((alpha != 0) & (alpha != 255)).any()):
                    raise PngError("not RGBA with binary alpha")
                flat = image.reshape(-1, image.shape[2]).astype(np.int32)
                n = len(flat)
                keys = [pa.array([batch.column(batch.schema.get_field_index(c))[i].as_py()] * n, batch.schema.field(c).type) for c in names]
                yield pa.RecordBatch.from_arrays(
                    [
                        *keys,
                        pa.array([head.mode] * n),
                        pa.array([head.trns is not None] * n),
                        pa.array(np.arange(n, dtype=np.int32)),
                        pa.array(flat[:, 0] << 16 | flat[:, 1] << 8 | flat[:, 2], pa.int32()),
                        pa.array(alpha.astype(np.int32)),
                    ],
                    names=[*names, "mode", "trns", "pos", "rgb24", "alpha"],
                )

    schema = "tag string, tag_ts timestamp_ntz, x int, y int, ordinal long, mode string, trns boolean, pos int, rgb24 int, alpha int"
    return tiles.select(*names, "content").mapInArrow(run, schema)


def visible_mask(image: np.ndarray, head: Header, mode: str = "corners", least_share: float = 0.9, explicit: tuple[int, ...] = ()) -> np.ndarray:
    """Which pixels of a decoded image are visible: by alpha, or in an image without it by colour.

    There black and the explicit colours are transparent, and in mode corners the colour that all
    four corners share if it fills least_share of the image or more.
    """
    if head.mode != "RGB" or head.trns is not None:
        return image[..., 3].ravel() != 0 if image.shape[2] == 4 else np.ones(image.shape[0] * image.shape[1], bool)
    flat = image[..., :3].reshape(-1, 3).astype(np.int32)
    colour = flat[:, 0] << 16 | flat[:, 1] << 8 | flat[:, 2]
    clear = (colour == 0) | np.isin(colour, np.array(explicit, np.int32))
    width = image.shape[1]
    corners = {int(colour[i]) for i in (0, width - 1, len(colour) - width, len(colour) - 1)}
    if mode == "corners" and len(corners) == 1:
        same = colour == corners.pop()
        if same.mean() >= least_share:
            clear |= same
    return ~clear


def decode_visible(tiles: DataFrame, tile_size: int, strict: bool = False, mode: str = "corners", least_share: float = 0.9, explicit: tuple[int, ...] = (), warn_share: float = 0.7) -> DataFrame:
    """The visible pixels of tiles, and a row with pos -1 for each tile: its mode and counts. One decoding serves both.

    tag_ts, x, y, event_id (place in the archive), pos, rgb24, alpha; mode, trns, visible, black, opaque, warning only in the rows of tiles.
    """
    names = ["tag_ts", "x", "y", "event_id", "pos", "rgb24", "alpha", "mode", "trns", "visible", "black", "opaque", "warning"]
    types = [pa.timestamp("us"), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]

    def run(batches):
        for batch in batches:
            given = [batch.column(batch.schema.get_field_index(c)) for c in ("tag_ts", "x", "y", "ordinal", "content")]
            for row in zip(*(c.to_pylist() for c in given), strict=True):
                image, head = decode(row[4])
                if image.shape[:2] != (tile_size, tile_size):
                    raise PngError(f"a tile of {image.shape[1]} x {image.shape[0]} pixels")
                alpha = image[..., 3].ravel() if image.shape[2] == 4 else np.full(tile_size * tile_size, 255, np.uint8)
                if strict and (head.mode != "RGBA" or ((alpha != 0) & (alpha != 255)).any()):
                    raise PngError("not RGBA with binary alpha")
                flat = image.reshape(-1, image.shape[2]).astype(np.int32)
                colour = flat[:, 0] << 16 | flat[:, 1] << 8 | flat[:, 2]
                pos = np.flatnonzero(visible_mask(image, head, mode, least_share, explicit)).astype(np.int32)
                black, opaque = int((colour == 0).sum()), bool((alpha == 255).all())
                n = len(pos)
                told = [head.mode, head.trns is not None, n, black, opaque, opaque and black >= warn_share * len(colour)]
                keys = [[v] * (n + 1) for v in row[:4]]
                values = [np.append(pos, -1), np.append(colour[pos], 0), np.append(alpha[pos].astype(np.int32), 0)]
                columns = [*keys, *values, *([None] * n + [t] for t in told)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    schema = "tag_ts timestamp_ntz, x int, y int, event_id long, pos int, rgb24 int, alpha int, mode string, trns boolean, visible long, black long, opaque boolean, warning boolean"
    return tiles.select("tag_ts", "x", "y", "ordinal", "content").mapInArrow(run, schema)


def mode_report(tiles: DataFrame) -> DataFrame:
    """x, y, mode, trns, black_entries of tiles(x, y, content), from the headers alone."""

    def run(batches):
        for batch in batches:
            x, y, content = (batch.column(batch.schema.get_field_index(c)) for c in ("x", "y", "content"))
            heads = [header(c.as_py())[0] for c in content]
            yield pa.RecordBatch.from_arrays(
                [x, y, pa.array([h.mode for h in heads], pa.string()), pa.array([h.trns is not None for h in heads], pa.bool_()), pa.array([h.black_entries() for h in heads], pa.list_(pa.int32()))],
                names=["x", "y", "mode", "trns", "black_entries"],
            )

    return tiles.select("x", "y", "content").mapInArrow(run, "x int, y int, mode string, trns boolean, black_entries array<int>")


def encode_tiles(pixels: DataFrame, tile_size: int) -> DataFrame:
    """x, y, content: an image of each tile's visible pixels(x, y, pos, rgb24), transparent elsewhere.

    A tile's pixels (tile_size squared at most) meet in one group.
    """

    def run(key, table):
        image = np.zeros((tile_size * tile_size, 4), np.uint8)
        pos, c = table.column("pos").to_numpy(), table.column("rgb24").to_numpy()
        image[pos] = np.stack([c >> 16 & 255, c >> 8 & 255, c & 255, np.full(len(c), 255)], axis=1)
        return pa.table({"x": pa.array([key[0].as_py()], pa.int32()), "y": pa.array([key[1].as_py()], pa.int32()), "content": pa.array([encode(image.reshape(tile_size, tile_size, 4))], pa.binary())})

    return pixels.select("x", "y", "pos", "rgb24").groupBy("x", "y").applyInArrow(run, "x int, y int, content binary")
