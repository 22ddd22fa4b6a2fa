"""Sparse and dense records of tiles.

A sparse record holds position and value of each visible pixel (5 bytes each), a dense one a
value for every pixel of the tile; the smaller one is stored.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value of the format: bytes of a position and a value.
SPARSE_BYTES = 5


def stored_bytes(count: Column, tile_pixels: int) -> Column:
    return F.least(count * SPARSE_BYTES, F.lit(tile_pixels).cast("long"))


def encoding(count: Column, tile_pixels: int) -> Column:
    return F.when(count * SPARSE_BYTES < tile_pixels, "sparse").otherwise("dense")


def tiles(state: DataFrame, tile_pixels: int, *keys: str) -> DataFrame:
    """keys, x, y, count, encoding, stored_bytes; tiles without visible pixels don't occur."""
    out = state.groupBy(*keys, "x", "y").agg(F.count("*").alias("count"))
    return out.withColumn("encoding", encoding(F.col("count"), tile_pixels)).withColumn("stored_bytes", stored_bytes(F.col("count"), tile_pixels))


def sparse_records(state: DataFrame, value: str = "value") -> DataFrame:
    """x, y, record: the tile's (pos, v) by position."""
    return state.groupBy("x", "y").agg(F.array_sort(F.collect_list(F.struct("pos", F.col(value).alias("v")))).alias("record"))


def dense_records(records: DataFrame, tile_pixels: int) -> DataFrame:
    """x, y, dense: a value for each position, 0 where the sparse record has none.

    A record is scattered into a zeroed array, so a tile costs its pixels and no search.
    """

    def run(batches):
        for batch in batches:
            x, y, record = (batch.column(batch.schema.get_field_index(c)) for c in ("x", "y", "record"))
            for i in range(batch.num_rows):  # a tile at a time: its pixels are the unit of memory
                one = record[i].values
                dense = np.zeros(tile_pixels, np.int32)
                if one is not None and len(one):
                    dense[np.asarray(one.field(0))] = np.asarray(one.field(1))
                cell = pa.ListArray.from_arrays(pa.array([0, tile_pixels], pa.int32()), pa.array(dense))
                yield pa.RecordBatch.from_arrays([x.slice(i, 1), y.slice(i, 1), cell], names=["x", "y", "dense"])

    return records.select("x", "y", "record").mapInArrow(run, "x int, y int, dense array<int>")


def from_dense(dense: DataFrame) -> DataFrame:
    """x, y, pos, value of the visible pixels of dense records."""
    return dense.select("x", "y", F.posexplode("dense").alias("pos", "value")).where("value <> 0")


def sparse_payload(positions: list[int], values: list[int]) -> bytes:
    """All positions as little-endian u32, then all values as u8."""
    return struct.pack(f"<{len(positions)}I", *positions) + bytes(values)


def pairs_of_payload(payload: bytes, encoding_: str, count: int, tile_pixels: int) -> tuple[list[int], list[int]]:
    """Positions and values of a stored record; ValueError if its length is wrong."""
    if encoding_ == "sparse":
        if len(payload) != SPARSE_BYTES * count:
            raise ValueError("length of a sparse record")
        return list(struct.unpack(f"<{count}I", payload[: 4 * count])), list(payload[4 * count :])
    if encoding_ != "dense" or len(payload) != tile_pixels:
        raise ValueError("length or encoding of a dense record")
    found = [(i, v) for i, v in enumerate(payload) if v]
    return [i for i, _ in found], [v for _, v in found]


def compress(payload: bytes, level: int = 3) -> bytes:
    """A zstd frame of a record."""
    import zstandard

    return zstandard.ZstdCompressor(level=level).compress(payload)


def decompress(stored: bytes, compression: str, size: int) -> bytes:
    """The record of a stored frame; ValueError if its size isn't the expected one."""
    import zstandard

    if compression not in ("none", "zstd"):
        raise ValueError(f"no such compression: {compression}")
    payload = stored if compression == "none" else zstandard.ZstdDecompressor().decompress(stored)
    if len(payload) != size:
        raise ValueError("size of a record")
    return payload
