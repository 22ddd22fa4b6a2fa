"""Palettes: dictionary encoding of colours, index 0 being transparent.

A palette (index, rgb24) has at most max_colours rows, which is checked before it is
broadcast. New colours are appended by ascending value, so indexes don't depend on the order
in which tiles arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilewright.functions.colours import blue, green, red, to_hex

MAX_COLOURS = 64


class PaletteOverflow(ValueError):
    """More colours than the palette may hold."""


def build(pixels: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """index, rgb24, hex: the known entries, then the visible pixels' other colours, ascending."""
    colours = pixels.where("alpha <> 0").select("rgb24").distinct()
    start = F.lit(0)
    if known is not None:
        colours = colours.join(known, "rgb24", "left_anti")
        colours = colours.crossJoin(known.agg(F.coalesce(F.max("index"), F.lit(0)).alias("_last")))  # one row
        start = F.col("_last")
    new = colours.select((F.row_number().over(Window.orderBy("rgb24")) + start).cast("int").alias("index"), "rgb24")
    whole = new if known is None else known.select("index", "rgb24").union(new)
    return whole.select("index", "rgb24", to_hex(F.col("rgb24")).alias("hex"))


def checked(palette: DataFrame, max_colours: int = MAX_COLOURS) -> DataFrame:
    """The palette as a small table that may be broadcast; PaletteOverflow if it is too large."""
    rows = palette.select("index", "rgb24").limit(max_colours + 1).collect()
    if len(rows) > max_colours:
        raise PaletteOverflow(f"more than {max_colours} colours")
    return palette.sparkSession.createDataFrame(rows, "index int, rgb24 int")


def encode(pixels: DataFrame, palette: DataFrame, max_colours: int = MAX_COLOURS) -> DataFrame:
    """Visible pixels with their palette index as value."""
    small = F.broadcast(checked(palette, max_colours))
    return pixels.where("alpha <> 0").join(small, "rgb24").withColumnRenamed("index", "value")


def decode(values: DataFrame, palette: DataFrame, max_colours: int = MAX_COLOURS) -> DataFrame:
    """r, g, b, a for value; 0 is transparent, an unknown index an error."""
    small = F.broadcast(checked(palette, max_colours))
    joined = values.join(small, F.col("value") == F.col("index"), "left")
    known = F.when((F.col("value") != 0) & F.col("index").isNull(), F.raise_error(F.lit("value beyond the palette")).cast("int")).otherwise(F.coalesce("rgb24", F.lit(0)))
    out = joined.withColumn("_c", known)
    return out.select(*values.columns, red(F.col("_c")).alias("r"), green(F.col("_c")).alias("g"), blue(F.col("_c")).alias("b"), F.when(F.col("value") == 0, 0).otherwise(255).alias("a"))


def unknown(pixels: DataFrame, palette: DataFrame, max_colours: int = MAX_COLOURS) -> DataFrame:
    """Distinct visible colours that the palette lacks."""
    small = F.broadcast(checked(palette, max_colours))
    return pixels.where("alpha <> 0").select("rgb24").distinct().join(small, "rgb24", "left_anti")


def overflow(pixels: DataFrame, max_colours: int) -> DataFrame:
    """tag_ts, colours, overflows: whether a snapshot's colours exceed the palette."""
    n = F.count_distinct("rgb24")
    return pixels.where("alpha <> 0").groupBy("tag_ts").agg(n.alias("colours"), (n > max_colours).alias("overflows"))


def contiguity(palette: DataFrame) -> DataFrame:
    """Entries whose index isn't their place."""
    place = F.row_number().over(Window.orderBy("index"))
    return palette.withColumn("place", place).where("index <> place")
