"""Shards of tiles: manifests, roll-ups, and the order and portions of work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilewright.functions.names import shard_name, shard_of


def measures() -> list[Column]:
    return [
        F.count("*").alias("tile_count"),
        F.sum("count").cast("long").alias("visible_pixels"),
        F.sum("stored_bytes").cast("long").alias("stored_bytes"),
    ]


def in_shards(tiles: DataFrame, shard_tiles: int) -> DataFrame:
    return tiles.withColumn("sx", shard_of(F.col("x"), shard_tiles)).withColumn("sy", shard_of(F.col("y"), shard_tiles))


def manifest(tiles: DataFrame, shard_tiles: int) -> DataFrame:
    """sx, sy, name, tile_count, visible_pixels, stored_bytes of each shard."""
    out = in_shards(tiles, shard_tiles).groupBy("sx", "sy").agg(*measures())
    return out.withColumn("name", shard_name(F.col("sx"), F.col("sy")))


def rollup(tiles: DataFrame, shard_tiles: int) -> DataFrame:
    """The measures of shards, of columns of shards and of the store; null stands for all."""
    return in_shards(tiles, shard_tiles).rollup("sx", "sy").agg(*measures())


def largest(shards: DataFrame, n: int = 10) -> DataFrame:
    return shards.orderBy(F.desc("stored_bytes"), "name").limit(n)


def schedule(shards: DataFrame) -> DataFrame:
    """Largest first, with the work done up to each (one row for each shard is ordered)."""
    order = Window.orderBy(F.desc("stored_bytes"), "name").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return shards.withColumn("done_bytes", F.sum("stored_bytes").over(order).cast("long")).withColumn("nth", F.row_number().over(Window.orderBy(F.desc("stored_bytes"), "name")))


def byte_chunks(tiles: DataFrame, budget: int, shard_tiles: int) -> DataFrame:
    """sx, sy, x, y, chunk: a shard's tiles in order, a new chunk where the budget would be passed.

    The fold is per shard, which holds shard_tiles ** 2 tiles at most.
    """
    listed = in_shards(tiles, shard_tiles).groupBy("sx", "sy").agg(F.array_sort(F.collect_list(F.struct("x", "y", "stored_bytes"))).alias("tiles"))
    start = F.struct(
        F.array().cast("array<struct<x:int,y:int,chunk:int>>").alias("out"), F.lit(0).alias("chunk"), F.lit(0).cast("long").alias("used")
    )

    def step(acc, tile):
        fresh = (acc["used"] > 0) & (acc["used"] + tile["stored_bytes"] > budget)
        chunk = acc["chunk"] + F.when(fresh, 1).otherwise(0)
        used = F.when(fresh, tile["stored_bytes"]).otherwise(acc["used"] + tile["stored_bytes"])
        item = F.struct(tile["x"].alias("x"), tile["y"].alias("y"), chunk.alias("chunk"))
        return F.struct(F.array_append(acc["out"], item).alias("out"), chunk.alias("chunk"), used.alias("used"))

    chunks = listed.select("sx", "sy", F.explode(F.aggregate("tiles", start, step, lambda acc: acc["out"])).alias("c"))
    return chunks.select("sx", "sy", "c.x", "c.y", "c.chunk")


def buckets(rows: DataFrame, per_bucket: int, *order: str) -> DataFrame:
    """Rows dealt to numbered folders of per_bucket in order."""
    nth = F.row_number().over(Window.orderBy(*order))
    return rows.withColumn("bucket", F.floor((nth - 1) / per_bucket).cast("int"))


def upsert_meta(old: DataFrame, new: DataFrame) -> DataFrame:
    """Shard rows by name, the new ones replacing the old ones."""
    return old.join(new, "name", "left_anti").unionByName(new)


def discover(overlay: DataFrame, state: DataFrame) -> DataFrame:
    """Distinct names of the shards of either manifest."""
    return overlay.select("name").union(state.select("name")).distinct()


def encoding_stats(tiles: DataFrame, shard_tiles: int) -> DataFrame:
    """sx, sy, sparse, dense (tiles of each encoding), largest (pixels of the fullest tile)."""
    kinds = [F.count_if(F.col("encoding") == k).alias(k) for k in ("sparse", "dense")]
    return in_shards(tiles, shard_tiles).groupBy("sx", "sy").agg(*kinds, F.max("count").alias("largest"))


def stored_stats(records: DataFrame, shard_tiles: int) -> DataFrame:
    """sx, sy, tiles, sums and histograms by encoding and compression of stored records(x, y, count, encoding, compression, size, uncompressed_size)."""
    kinds = [F.count_if(F.col(c) == k).alias(k) for c, k in (("encoding", "sparse"), ("encoding", "dense"), ("compression", "zstd"), ("compression", "none"))]
    sums = [F.sum(c).cast("long").alias(n) for c, n in (("count", "visible_pixels"), ("size", "stored_bytes"), ("uncompressed_size", "uncompressed_bytes"))]
    return in_shards(records, shard_tiles).groupBy("sx", "sy").agg(F.count("*").alias("tiles"), *kinds, *sums, F.max("count").alias("largest"))
