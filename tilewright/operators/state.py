"""Overlays, the rolling state and changes between snapshots.

The last visible write of a pixel wins and a transparent one never overwrites, so the state
is one max_by over an order key of snapshot and arrival: any number of snapshots merge in one
shuffle with map-side combining, in any order, and merging twice changes nothing.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIXEL = ["x", "y", "pos"]
#: Bits of the order key for the arrival within a snapshot.
ARRIVAL_BITS = 30


def order_key(tag_ts: Column, arrival: Column) -> Column:
    """One long that orders by snapshot, then arrival (below 2**30): a primitive aggregation buffer."""
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), tag_ts)
    return F.shiftleft(seconds, ARRIVAL_BITS) + arrival


def visible(pixels: DataFrame) -> DataFrame:
    return pixels.where("alpha <> 0")


def tag_overlay(pixels: DataFrame) -> DataFrame:
    """tag_ts, x, y, pos, rgb24: the last visible write of each pixel in each snapshot."""
    return visible(pixels).groupBy("tag_ts", *PIXEL).agg(F.max_by("rgb24", "event_id").alias("rgb24"))


def rolling_state(pixels: DataFrame) -> DataFrame:
    """x, y, pos, rgb24 after all snapshots."""
    return visible(pixels).groupBy(*PIXEL).agg(F.max_by("rgb24", order_key(F.col("tag_ts"), F.col("event_id"))).alias("rgb24"))


def state_as_of(pixels: DataFrame, at: datetime) -> DataFrame:
    """The state after the snapshots up to at."""
    return rolling_state(pixels.where(F.col("tag_ts") <= F.lit(at).cast("timestamp_ntz")))


def merge_overlay(state: DataFrame, overlay: DataFrame) -> DataFrame:
    """x, y, pos, rgb24: the state with an overlay's pixels on top."""
    new = overlay.select(*PIXEL, F.col("rgb24").alias("new_rgb"))
    return state.join(new, PIXEL, "full").select(*PIXEL, F.coalesce("new_rgb", "rgb24").alias("rgb24"))


def merge_dense(state: DataFrame, overlay: DataFrame) -> DataFrame:
    """x, y, dense: dense records(x, y, dense) with those of an overlay on top, where 0 is transparent; the same result as merge_overlay()."""
    new = overlay.select("x", "y", F.col("dense").alias("new"))
    over = F.zip_with("dense", "new", lambda below, above: F.when(above != 0, above).otherwise(below))
    return state.join(new, ["x", "y"], "full").select("x", "y", F.when(F.col("new").isNull(), F.col("dense")).when(F.col("dense").isNull(), F.col("new")).otherwise(over).alias("dense"))


def keep_last_tile(tiles: DataFrame, arrival: str) -> DataFrame:
    """Of tiles sent twice in a snapshot the last to arrive."""
    last = Window.partitionBy("tag_ts", "x", "y").orderBy(F.desc(arrival))
    return tiles.withColumn("_nth", F.row_number().over(last)).where("_nth = 1").drop("_nth")


def pixel_deltas(pixels: DataFrame) -> DataFrame:
    """tag_ts, added, disappeared, net: pixels seen for the first time, and transparent ones that were visible before.

    A pixel once visible stays visible in the state, so a running maximum tells what was there.
    """
    seen = pixels.groupBy("tag_ts", *PIXEL).agg(F.max((F.col("alpha") != 0).cast("int")).alias("now"))
    before = Window.partitionBy(*PIXEL).orderBy("tag_ts").rowsBetween(Window.unboundedPreceding, -1)
    seen = seen.withColumn("had", F.coalesce(F.max("now").over(before), F.lit(0)))
    added, gone = F.count_if(F.expr("now = 1 and had = 0")), F.count_if(F.expr("now = 0 and had = 1"))
    return seen.groupBy("tag_ts").agg(added.alias("added"), gone.alias("disappeared"), (added - gone).alias("net"))


def composite_over(layers: DataFrame, alpha: str = "alpha") -> DataFrame:
    """x, y, pos, rgb24, alpha: the layers of each pixel, in the order of event_id, each over the ones below.

    A fold over each pixel's own layers; alpha is 0..255.
    """
    from tilewright.functions.colours import blue, green, over_alpha, over_channel, red, rgb24

    ordered = F.array_sort(F.collect_list(F.struct("event_id", F.col("rgb24").alias("c"), F.col(alpha).cast("int").alias("a"))))

    def over(below, above):
        mixed = [over_channel(part(above["c"]), above["a"], part(below["c"]), below["a"]) for part in (red, green, blue)]
        return F.struct(rgb24(*mixed).alias("c"), over_alpha(above["a"], below["a"]).alias("a"))

    nothing = F.struct(F.lit(0).alias("c"), F.lit(0).alias("a"))
    out = layers.groupBy(*PIXEL).agg(F.aggregate(ordered, nothing, over).alias("out"))
    return out.select(*PIXEL, F.col("out.c").alias("rgb24"), F.col("out.a").alias("alpha"))
