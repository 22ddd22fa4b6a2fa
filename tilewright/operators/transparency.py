"""Which pixels of a tile are transparent, by the mode of its image, and warnings about it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TILE = ["tag_ts", "x", "y"]
#: none: only black and the explicit colours; corners: also the colour of all four corners where it dominates.
MODES = ("none", "corners")


def rgb_transparency(
    pixels: DataFrame, tile_size: int, mode: str = "corners", least_share: float = 0.9, explicit: list[int] | None = None
) -> DataFrame:
    """Pixels of images without alpha, with transparent: black always, explicit colours, and in mode
    corners the colour shared by a tile's four corners if its share of the tile's pixels is least_share or more.
    """
    if mode not in MODES:
        raise ValueError(f"no such mode: {mode}")
    plain = (F.col("rgb24") == 0) | (F.col("rgb24").isin(*explicit) if explicit else F.lit(False))
    if mode == "none":
        return pixels.withColumn("transparent", plain)
    corners = [0, tile_size - 1, tile_size * (tile_size - 1), tile_size * tile_size - 1]
    # one exchange by tile, which has tile_size squared pixels; pixels are decoded once
    tile = Window.partitionBy(*TILE)
    at = {f"_c{i}": F.max(F.when(F.col("pos") == p, F.col("rgb24"))).over(tile) for i, p in enumerate(corners)}
    out = pixels.withColumns(at)
    same = (F.col("_c0") == F.col("_c1")) & (F.col("_c0") == F.col("_c2")) & (F.col("_c0") == F.col("_c3"))
    is_corner = F.coalesce(same & (F.col("rgb24") == F.col("_c0")), F.lit(False))
    share = F.sum(is_corner.cast("long")).over(tile) / F.count("*").over(tile)
    dominant = is_corner & (share >= least_share)
    return out.withColumn("transparent", plain | dominant).select(*pixels.columns, "transparent")


def transparent_share(pixels: DataFrame, transparent: Column) -> DataFrame:
    """tag_ts, x, y, pixels, transparent: sums for each tile."""
    return pixels.groupBy(*TILE).agg(F.count("*").alias("pixels"), F.count_if(transparent).alias("transparent"))


def black_summary(pixels: DataFrame, warn_share: float = 0.7) -> DataFrame:
    """tag_ts, x, y, black, ratio, opaque, warning: an image with alpha, all opaque and mostly black, is suspect."""
    black = F.count_if(F.col("rgb24") == 0)
    ratio = black / F.count("*")
    opaque = F.bool_and(F.col("alpha") == 255)
    return pixels.groupBy(*TILE).agg(
        black.alias("black"), ratio.alias("ratio"), opaque.alias("opaque"), (opaque & (ratio >= warn_share)).alias("warning")
    )


def partial_alpha(pixels: DataFrame) -> DataFrame:
    """tag_ts, x, y, partial: pixels neither transparent nor opaque, which the strict mode rejects."""
    return pixels.groupBy(*TILE).agg(F.count_if(~F.col("alpha").isin(0, 255)).alias("partial")).where("partial > 0")
