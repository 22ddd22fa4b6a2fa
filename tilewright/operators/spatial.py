"""Drawings as connected components of visible pixels across tile borders.

Growing each pixel by a square of radius d and joining what touches by edges links two
pixels exactly if max(|dx|, |dy|) <= 2d + 1 and not both equal 2d + 1. Pixels are dealt to
grid cells of that width, so the range join is an equi-join on neighbouring cells.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.functions.names import artwork_name


def world(state: DataFrame, tile_size: int) -> DataFrame:
    """id, wx, wy, rgb24: pixels by their place in the world; id orders by row, then column."""
    wx = F.col("x").cast("long") * tile_size + F.col("pos") % tile_size
    wy = F.col("y").cast("long") * tile_size + F.floor(F.col("pos") / tile_size)
    return state.select(F.shiftleft(wy, 31).bitwiseOR(wx).alias("id"), wx.alias("wx"), wy.alias("wy"), "rgb24")


def neighbour_mosaic(tiles: DataFrame) -> DataFrame:
    """x, y, nx, ny, count: each tile with itself and its existing neighbours."""
    offsets = F.array(*(F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dy in (-1, 0, 1) for dx in (-1, 0, 1)))
    spread = tiles.select("x", "y", F.explode(offsets).alias("o")).select("x", "y", (F.col("x") + F.col("o.dx")).alias("nx"), (F.col("y") + F.col("o.dy")).alias("ny"))
    other = tiles.select(F.col("x").alias("nx"), F.col("y").alias("ny"), "count")
    return spread.join(other, ["nx", "ny"]).select("x", "y", "nx", "ny", "count")


def links(points: DataFrame, d: int) -> DataFrame:
    """(a, b), a < b, of points(id, wx, wy) that a dilation by d joins."""
    if d == 0:  # edge neighbours: the point to the right and the one below
        place = points.select(F.col("id").alias("b"), F.col("wx").alias("bx"), F.col("wy").alias("by"))
        steps = F.array(F.struct(F.lit(1).alias("dx"), F.lit(0).alias("dy")), F.struct(F.lit(0).alias("dx"), F.lit(1).alias("dy")))
        spread = points.select(F.col("id").alias("a"), "wx", "wy", F.explode(steps).alias("o")).select("a", (F.col("wx") + F.col("o.dx")).alias("bx"), (F.col("wy") + F.col("o.dy")).alias("by"))
        return spread.join(place, ["bx", "by"]).select("a", "b")
    reach = 2 * d + 1
    width = reach + 1
    cell = points.select("id", "wx", "wy", F.floor(F.col("wx") / width).alias("cx"), F.floor(F.col("wy") / width).alias("cy"))
    offsets = F.array(*(F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dy in (-1, 0, 1) for dx in (-1, 0, 1)))
    spread = cell.select(F.col("id").alias("a"), F.col("wx").alias("ax"), F.col("wy").alias("ay"), "cx", "cy", F.explode(offsets).alias("o"))
    spread = spread.select("a", "ax", "ay", (F.col("cx") + F.col("o.dx")).alias("cx"), (F.col("cy") + F.col("o.dy")).alias("cy"))
    dx, dy = F.abs(F.col("ax") - F.col("wx")), F.abs(F.col("ay") - F.col("wy"))
    near = (F.greatest(dx, dy) <= reach) & ~((dx == reach) & (dy == reach))
    return spread.join(cell, ["cx", "cy"]).where((F.col("a") < F.col("id")) & near).select("a", F.col("id").alias("b"))


def _saved(df: DataFrame) -> DataFrame:
    """Cuts lineage by a checkpoint in the shared folder (an own one only where none is set and all runs on this machine)."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="tilewright-"))
    return df.checkpoint()


def components(points: DataFrame, d: int) -> DataFrame:
    """The points with component: the least id of those that they reach.

    Labels spread to neighbours and then jump to their label's label, so rounds grow with the
    logarithm of a component's extent.
    """
    edges = links(points, d)
    both = _saved(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = _saved(points.select("id", F.col("id").alias("component")))
    while True:
        near = both.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("component").alias("least"))
        spread = labels.join(near, F.col("id") == F.col("a"), "left").select("id", F.col("component").alias("old"), F.least("component", F.coalesce("least", F.col("component"))).alias("component"))
        jump = spread.select(F.col("id").alias("j_id"), F.col("component").alias("j_component"))
        new = spread.join(jump, F.col("component") == F.col("j_id")).select("id", "old", F.col("j_component").alias("component"))
        new = _saved(new)
        if new.where("old <> component").isEmpty():
            return points.join(new.select("id", "component"), "id")
        labels = new.select("id", "component")


def component_stats(labelled: DataFrame) -> DataFrame:
    """component, world_x, world_y, w, h, pixels, n_colors."""
    out = labelled.groupBy("component").agg(
        F.min("wx").alias("world_x"),
        F.min("wy").alias("world_y"),
        (F.max("wx") - F.min("wx") + 1).alias("w"),
        (F.max("wy") - F.min("wy") + 1).alias("h"),
        F.count("*").alias("pixels"),
        F.count_distinct("rgb24").alias("n_colors"),
    )
    return out


def artworks(stats: DataFrame, least_pixels: int = 20) -> DataFrame:
    """component stats with name and skip_reason: too few pixels, then a single colour; null where it is kept."""
    reason = F.when(F.col("pixels") < least_pixels, "small").when(F.col("n_colors") <= 1, "one colour")
    return stats.withColumn("name", artwork_name(F.col("world_x"), F.col("world_y"), F.col("w"), F.col("h"))).withColumn("skip_reason", reason)


def totals(found: DataFrame) -> DataFrame:
    """found, small, one_colour, pixels: one row for all artworks."""
    return found.agg(F.count("*").alias("found"), F.count_if(F.expr("skip_reason = 'small'")).alias("small"), F.count_if(F.expr("skip_reason = 'one colour'")).alias("one_colour"), F.sum("pixels").cast("long").alias("pixels"))


def mosaic_artworks(state: DataFrame, tile_size: int, d: int, least_pixels: int = 20) -> DataFrame:
    """Drawings as seen from the 3 x 3 tiles around each tile: the one that holds a drawing's centre keeps it.

    Every pixel is in up to nine mosaics. A drawing that reaches beyond a mosaic is cut there,
    so it may be found twice or not at all; components() over the world has no such limit.
    """
    offsets = F.array(*(F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dy in (-1, 0, 1) for dx in (-1, 0, 1)))
    centre = state.select(F.col("x").alias("mx"), F.col("y").alias("my")).distinct()
    spread = state.select("*", F.explode(offsets).alias("o")).select("x", "y", "pos", "rgb24", (F.col("x") + F.col("o.dx")).alias("mx"), (F.col("y") + F.col("o.dy")).alias("my"))
    seen = spread.join(centre, ["mx", "my"])
    lx = (F.col("x") - F.col("mx") + 1) * tile_size + F.col("pos") % tile_size
    ly = (F.col("y") - F.col("my") + 1) * tile_size + F.floor(F.col("pos") / tile_size)
    # mosaics lie apart in a world of their own, so that none touches another
    pitch = 3 * tile_size + 4 * d + 4
    points = seen.select("mx", "my", (F.col("mx").cast("long") * pitch + lx).alias("wx"), (F.col("my").cast("long") * pitch + ly).alias("wy"), "rgb24")
    points = points.withColumn("id", F.shiftleft("wy", 31).bitwiseOR(F.col("wx")))
    labelled = components(points, d)
    stats = component_stats(labelled).withColumn("mx", F.floor(F.col("world_x") / pitch)).withColumn("my", F.floor(F.col("world_y") / pitch))
    x0, y0 = F.col("world_x") - F.col("mx") * pitch, F.col("world_y") - F.col("my") * pitch
    cx, cy = F.floor((2 * x0 + F.col("w") - 1) / 2), F.floor((2 * y0 + F.col("h") - 1) / 2)
    own = (cx >= tile_size) & (cx < 2 * tile_size) & (cy >= tile_size) & (cy < 2 * tile_size)
    stats = stats.where(own).withColumn("world_x", F.col("mx") * tile_size + x0 - tile_size).withColumn("world_y", F.col("my") * tile_size + y0 - tile_size)
    return artworks(stats.drop("component", "mx", "my"), least_pixels)


def dilate(points: DataFrame, d: int) -> DataFrame:
    """wx, wy of all places within the square of radius d around a point."""
    steps = F.sequence(F.lit(-d), F.lit(d))
    rows = points.select("wx", "wy", F.explode(steps).alias("dy")).select("wx", (F.col("wy") + F.col("dy")).alias("wy"), F.explode(steps).alias("dx"))
    return rows.select((F.col("wx") + F.col("dx")).alias("wx"), "wy").distinct()


def crops(labelled: DataFrame, kept: DataFrame, largest: int = 4096) -> DataFrame:
    """name, part_row, part_column, content: images of each kept drawing (component, world_x, world_y, w, h, name), transparent around it.

    A drawing wider or higher than largest is cut into a grid of parts of that size, named by
    their place in it, so that what meets in one group is bounded; parts without a pixel of
    the drawing have no image. Other drawings are the part 0, 0 under their own name.
    """
    import numpy as np
    import pyarrow as pa

    from tilewright.sources.png import encode

    boxes = kept.select("component", "world_x", "world_y", "w", "h", "name")
    rows = labelled.join(boxes, "component").withColumns({"cx": F.col("wx") - F.col("world_x"), "cy": F.col("wy") - F.col("world_y")})
    row, column = (F.floor(F.col(c) / largest).cast("int") for c in ("cy", "cx"))
    rows = rows.withColumns({"part_row": row, "part_column": column})
    whole = (F.col("w") <= largest) & (F.col("h") <= largest)
    part_name = F.concat(F.regexp_replace("name", r"\.png$", ""), F.lit("_r"), F.col("part_row").cast("string"), F.lit("_c"), F.col("part_column").cast("string"), F.lit(".png"))
    rows = rows.select(
        "component",
        "part_row",
        "part_column",
        F.when(whole, F.col("name")).otherwise(part_name).alias("name"),
        F.least(F.lit(largest), F.col("w") - F.col("part_column") * largest).alias("w"),
        F.least(F.lit(largest), F.col("h") - F.col("part_row") * largest).alias("h"),
        (F.col("cx") % largest).alias("cx"),
        (F.col("cy") % largest).alias("cy"),
        "rgb24",
    )

    def run(key, table):
        w, h = table.column("w")[0].as_py(), table.column("h")[0].as_py()
        image = np.zeros((h, w, 4), np.uint8)
        c = table.column("rgb24").to_numpy()
        image[table.column("cy").to_numpy(), table.column("cx").to_numpy()] = np.stack([c >> 16 & 255, c >> 8 & 255, c & 255, np.full(len(c), 255)], axis=1)
        part = {n: table.column(n).slice(0, 1) for n in ("name", "part_row", "part_column")}
        return pa.table({**part, "content": pa.array([encode(image)], pa.binary())})

    return rows.groupBy("component", "part_row", "part_column").applyInArrow(run, "name string, part_row int, part_column int, content binary")
