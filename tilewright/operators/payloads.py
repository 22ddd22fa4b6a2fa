"""Stored records of tiles: sparse or dense bytes of palette indexes, compressed where that is smaller."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tilewright.operators import encoding

FIELDS = "x int, y int, count int, encoding string, compression string, size int, uncompressed_size int, payload binary"


def payloads(values: DataFrame, tile_pixels: int, level: int = 3) -> DataFrame:
    """x, y, count, encoding, compression, size, uncompressed_size, payload of each tile of values(x, y, pos, value).

    A tile's pixels (tile_pixels at most) meet in one group. value is 1..255.
    """

    def run(key, table):
        order = np.argsort(table.column("pos").to_numpy(), kind="stable")
        pos, value = table.column("pos").to_numpy()[order], table.column("value").to_numpy()[order]
        if encoding.SPARSE_BYTES * len(pos) < tile_pixels:
            kind, body = "sparse", pos.astype("<u4").tobytes() + value.astype(np.uint8).tobytes()
        else:
            dense = np.zeros(tile_pixels, np.uint8)
            dense[pos] = value
            kind, body = "dense", dense.tobytes()
        packed = encoding.compress(body, level)
        how, stored = ("zstd", packed) if len(packed) < len(body) else ("none", body)
        cells = [key[0].as_py(), key[1].as_py(), len(pos), kind, how, len(stored), len(body), stored]
        types = [pa.int32()] * 3 + [pa.string()] * 2 + [pa.int32()] * 2 + [pa.binary()]
        return pa.table([pa.array([c], t) for c, t in zip(cells, types, strict=True)], names=[f.split()[0] for f in FIELDS.split(", ")])

    return values.select("x", "y", "pos", "value").groupBy("x", "y").applyInArrow(run, FIELDS)


def from_payloads(stored: DataFrame, tile_pixels: int) -> DataFrame:
    """x, y, pos, value of stored records; a record of a wrong size is an error."""
    names = ["x", "y", "count", "encoding", "compression", "uncompressed_size", "payload"]

    def run(batches):
        for batch in batches:
            for x, y, count, kind, how, size, body in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names), strict=True):
                raw = np.frombuffer(encoding.decompress(body, how, size), np.uint8)
                if kind == "sparse":
                    if len(raw) != encoding.SPARSE_BYTES * count:
                        raise ValueError("length of a sparse record")
                    pos, value = raw[: 4 * count].view("<u4").astype(np.int32), raw[4 * count :]
                elif kind == "dense" and len(raw) == tile_pixels:
                    pos = np.flatnonzero(raw).astype(np.int32)
                    value = raw[pos]
                else:
                    raise ValueError("length or encoding of a dense record")
                n = len(pos)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, x, np.int32)), pa.array(np.full(n, y, np.int32)), pa.array(pos), pa.array(value.astype(np.int32))], names=["x", "y", "pos", "value"])

    return stored.select(*names).mapInArrow(run, "x int, y int, pos int, value int")
