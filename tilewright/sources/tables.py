"""Parquet tables and the pixel relation that the registered queries make of them.

Pixels have the columns event_id (arrival), tag_ts, x, y (tile), pos (row * size + column in
the tile), rgb24 and alpha. The adapter reads them from the events table: a day is a
snapshot, tiles are 16 x 16 pixels on a grid of 8 x 8 tiles, a shard has 2 x 2 tiles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TILE_SIZE, GRID, SHARD_TILES = 16, 8, 2
TILE_PIXELS = TILE_SIZE * TILE_SIZE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("tag_ts"),
        (F.col("user_id") % GRID).cast("int").alias("x"),
        (F.floor(F.col("user_id") / GRID) % GRID).cast("int").alias("y"),
        (F.col("event_id") % TILE_PIXELS).cast("int").alias("pos"),
        (number % 40 * 419430).cast("int").alias("rgb24"),
        F.when(F.col("event_type") == "error", 0).otherwise(255).alias("alpha"),
    )
