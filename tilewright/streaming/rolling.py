"""The rolling state as a stream: each micro-batch of pixels is merged into the state's store.

The state keeps each pixel's order key, so late snapshots don't overwrite newer ones, and a
batch that is delivered twice changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.operators.state import PIXEL, order_key, visible
from tilewright.sources.store import Store

STATE = "x int, y int, pos int, rgb24 int, written long"


def latest(pixels: DataFrame) -> DataFrame:
    """x, y, pos, rgb24, written: the last visible write of each pixel and its order key."""
    keyed = visible(pixels).withColumn("written", order_key(F.col("tag_ts"), F.col("event_id")))
    return keyed.groupBy(*PIXEL).agg(F.max_by("rgb24", "written").alias("rgb24"), F.max("written").alias("written"))


def merge(state: DataFrame, batch: DataFrame) -> DataFrame:
    """The state with a batch's pixels, by order key."""
    return fold(state, latest(batch))


def fold(state: DataFrame, new: DataFrame) -> DataFrame:
    """The state with further pixels of its own form."""
    both = state.select(*PIXEL, "rgb24", "written").unionByName(new.select(*PIXEL, "rgb24", "written"))
    return both.groupBy(*PIXEL).agg(F.max_by("rgb24", "written").alias("rgb24"), F.max("written").alias("written"))


def stream_state(pixels: DataFrame, store: Store, checkpoint: str):
    """Starts the query that merges a streaming DataFrame of pixels into the store; it ends with what is available."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        new = latest(batch).persist()  # read for its shards and then for its pixels
        if not new.isEmpty():
            store.upsert(new, fold, STATE)
        new.unpersist()

    return pixels.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
