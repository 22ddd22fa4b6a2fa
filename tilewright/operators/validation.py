"""Checks of a store: violations as rows, and what applying an overlay would do."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.functions.names import shard_name
from tilewright.operators import encoding, shards


def violations(tiles: DataFrame, shards: DataFrame, grid: int, tile_pixels: int) -> DataFrame:
    """rule, item of tiles(x, y, count, encoding, stored_bytes) and the manifest shards(sx, sy, name, tile_count, ...)."""
    tile = F.format_string("%d/%d", "x", "y")
    found = [
        tiles.where(f"x < 0 or y < 0 or x >= {grid} or y >= {grid}").select(F.lit("out of the grid").alias("rule"), tile.alias("item")),
        tiles.where(f"count <= 0 or count > {tile_pixels}").select(F.lit("count").alias("rule"), tile.alias("item")),
        tiles.where("stored_bytes < 0").select(F.lit("size").alias("rule"), tile.alias("item")),
        tiles.where("encoding not in ('sparse', 'dense')").select(F.lit("encoding").alias("rule"), tile.alias("item")),
        tiles.groupBy("x", "y").count().where("count > 1").select(F.lit("repeated tile").alias("rule"), tile.alias("item")),
        shards.where("tile_count <= 0").select(F.lit("empty shard").alias("rule"), F.col("name").alias("item")),
    ]
    return reduce(DataFrame.unionByName, found)


def index_violations(tiles: DataFrame, manifest: DataFrame, shard_tiles: int, tile_pixels: int) -> DataFrame:
    """rule, item where a stored index contradicts itself or its manifest."""
    tile = F.format_string("%d/%d", "x", "y")
    sums = shards.manifest(tiles, shard_tiles).select("name", *(F.col(c).alias(f"_{c}") for c in ("tile_count", "visible_pixels", "stored_bytes")))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("tile_count", "visible_pixels", "stored_bytes")))
    found = [
        tiles.where(encoding.encoding(F.col("count"), tile_pixels) != F.col("encoding")).select(F.lit("encoding of count").alias("rule"), tile.alias("item")),
        tiles.where(encoding.stored_bytes(F.col("count"), tile_pixels) != F.col("stored_bytes")).select(F.lit("size of count").alias("rule"), tile.alias("item")),
        manifest.join(sums, "name", "full").where(~same).select(F.lit("manifest").alias("rule"), F.col("name").alias("item")),
        manifest.where(shard_name(F.col("sx"), F.col("sy")) != F.col("name")).select(F.lit("shard name").alias("rule"), F.col("name").alias("item")),
    ]
    return reduce(DataFrame.unionByName, found)


def recounted(tiles: DataFrame, state: DataFrame, tile_pixels: int) -> DataFrame:
    """rule, item of tiles whose stored count isn't that of their pixels, or that hold a place twice or out of the tile."""
    counted = state.groupBy("x", "y").agg(F.count("*").alias("n"), F.count_distinct("pos").alias("places"), F.min("pos").alias("low"), F.max("pos").alias("high"))
    both = tiles.select("x", "y", "count").join(counted, ["x", "y"], "full")
    bad = ~F.col("count").eqNullSafe(F.col("n")) | (F.col("places") != F.col("n")) | (F.col("low") < 0) | (F.col("high") >= tile_pixels)
    return both.where(bad).select(F.lit("pixels of index").alias("rule"), F.format_string("%d/%d", "x", "y").alias("item"))


def payload_rules(stored: DataFrame, tile_pixels: int) -> DataFrame:
    """rule, item of stored records whose compression, count or sizes can't be."""
    tile = F.format_string("%d/%d", "x", "y")
    right = F.when(F.col("encoding") == "sparse", encoding.SPARSE_BYTES * F.col("count")).otherwise(F.lit(tile_pixels))
    rules = {
        "compression": ~F.col("compression").isin("none", "zstd"),
        "count": (F.col("count") < 0) | (F.col("count") > tile_pixels),
        "size": (F.col("size") < 0) | (F.col("size") != F.octet_length("payload")),
        "uncompressed size": (F.col("uncompressed_size") < 0) | (F.col("uncompressed_size") != right),
    }
    return reduce(DataFrame.unionByName, [stored.where(c).select(F.lit(n).alias("rule"), tile.alias("item")) for n, c in rules.items()])


def payload_violations(pixels: DataFrame, tile_pixels: int) -> DataFrame:
    """x, y, bad_pos, bad_value, repeated of decoded records (x, y, pos, value)."""
    out = pixels.groupBy("x", "y").agg(
        F.count_if((F.col("pos") < 0) | (F.col("pos") >= tile_pixels)).alias("bad_pos"),
        F.count_if((F.col("value") <= 0) | (F.col("value") > 255)).alias("bad_value"),
        (F.count("*") - F.count_distinct("pos")).alias("repeated"),
    )
    return out.where("bad_pos > 0 or bad_value > 0 or repeated > 0")


def missing_shards(manifest: DataFrame, present: DataFrame) -> DataFrame:
    """Names in the manifest without data."""
    return manifest.select("name").join(present.select("name").distinct(), "name", "left_anti")


def dry_run(state: DataFrame, overlay: DataFrame) -> DataFrame:
    """x, y, before, overlaid, after: pixels of the tiles that an overlay touches."""
    before = state.groupBy("x", "y").agg(F.count("*").alias("before"))
    both = overlay.select("x", "y", "pos").join(state.select("x", "y", "pos", F.lit(1).alias("had")), ["x", "y", "pos"], "left")
    touched = both.groupBy("x", "y").agg(F.count("*").alias("overlaid"), F.count_if(F.expr("had is null")).alias("new"))
    out = touched.join(before, ["x", "y"], "left").withColumn("before", F.coalesce("before", F.lit(0)))
    return out.select("x", "y", "before", "overlaid", (F.col("before") + F.col("new")).alias("after"))
