"""Connected components of links between 64-bit ids, by alternating large and small stars.

Every round hangs each node's larger (then smaller) neighbours onto its smallest one, so the
graph turns into stars; rounds grow with the logarithm of the longest path. A node's
neighbours meet only in a minimum, which is combined before the shuffle, and in a join whose
other side has one row for each node; hot nodes are looked up by a bounded broadcast. A graph
of at most SMALL edges, which are counted first, is settled by one task in the same way.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import drop, keep, lookup


#: Edges (16 bytes each) that one task takes.
SMALL = 1 << 20


def _settled(batches):
    """(id, root) of all edges of the partition."""
    found = [np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()]) for b in batches if b.num_rows]
    if not found:
        return
    ids, nth = np.unique(np.concatenate(found, axis=1), return_inverse=True)
    a, b = nth.reshape(2, -1)
    root = np.arange(len(ids))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        if (low == high).all():
            break
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[root])], names=["id", "root"])


def components(links: DataFrame) -> DataFrame:
    """(id, root) for each id in links(a, b): root is the smallest id that it reaches.

    Links may repeat and point either way; those of an id to itself and those with a null are
    ignored; ids without a link don't occur.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    edges = keep(links.where("a is not null and b is not null and a <> b").select(high.alias("u"), low.alias("v")).distinct(), "edges")
    if edges.count() <= SMALL:
        return edges.coalesce(1).mapInArrow(_settled, "id long, root long")
    before = None
    while True:
        seen = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if seen == before or not seen["n"]:
            break
        before = seen
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count("*").alias("held")).withColumnRenamed("u", "w")
        large = lookup(both.where("v > u"), least, [("u", "w")], "held", 2 * seen["n"]).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # a node has one row now for each of its neighbours' least ones
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
        joined = large.join(least, F.col("u") == F.col("w"))
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("w", "m"))
        new = keep(small.distinct(), "edges")
        drop(edges)
        edges = new
    roots = edges.groupBy("u").agg(F.min("v").alias("root"))
    return roots.select(F.col("u").alias("id"), "root").union(edges.select("v", "v").distinct())
