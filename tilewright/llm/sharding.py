"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Documents with equal texts are a group and stay together. Groups enter by decreasing size
the bin with the tightest sufficient room, found in a balanced tree of the bins' rooms. With
a capacity this needs few shards; with a number of shards the smallest capacity is sought at
which they suffice, which makes their sizes near equal. A group above an even share has a
shard to itself, and the others are filled evenly.

The driver sees groups of over 1/1024 of all bytes one by one (there are fewer than 1024) and
the others as counts of size classes: exact sizes up to 64 KiB, 256 classes an octave above.
So its work doesn't grow with the corpus. A group finds its bin by its number in its class.

Edge cases: null text has no bytes (size 1) and equals the empty text; repeated rows are rows;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import keep, lookup, mix64, numbered, text_of

#: A group of more than 1 / LARGE of all bytes is placed on its own.
LARGE = 1024
EXACT = 1 << 16


class RoomTree:
    """A balanced search tree (a treap with hashed priorities) of bins by their room."""

    def __init__(self):
        self.root = None

    def insert(self, room: int, bin_: int) -> None:
        key = (room, bin_)
        self.root = self._insert(self.root, key, int(mix64(np.array([hash(key) & (2**63 - 1)], np.uint64))[0]))

    def _insert(self, node, key, priority):
        if node is None:
            return [key, priority, None, None]
        side = 2 if key < node[0] else 3
        node[side] = child = self._insert(node[side], key, priority)
        if child[1] > node[1]:
            node[side], child[5 - side] = child[5 - side], node
            return child
        return node

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The least (room, bin) with room for size."""
        node, best = self.root, None
        while node is not None:
            if node[0][0] >= size:
                best, node = node[0], node[2]
            else:
                node = node[3]
        return best

    def remove(self, key: tuple[int, int]) -> None:
        self.root = self._remove(self.root, key)

    def _remove(self, node, key):
        if key != node[0]:
            side = 2 if key < node[0] else 3
            node[side] = self._remove(node[side], key)
            return node
        return self._merge(node[2], node[3])

    def _merge(self, left, right):
        if left is None or right is None:
            return right if left is None else left
        if left[1] > right[1]:
            left[3] = self._merge(left[3], right)
            return left
        right[2] = self._merge(left, right[2])
        return right


def best_fit_decreasing(classes: list[tuple[int, int]], capacity: int, most: int | None = None):
    """Bins of the (size, count) classes, largest size first: a list of (class, bin, count).

    Opens a bin when none has room; None if that would be more than most.
    """
    tree, bins, out = RoomTree(), 0, []
    for nth, (size, todo) in enumerate(classes):
        while todo:
            found = tree.tightest(size)
            if found is None:
                if bins == most or size > capacity:
                    return None
                found = (capacity, bins)
                bins += 1
            else:
                tree.remove(found)
            room, bin_ = found
            n = min(todo, room // size)
            out.append((nth, bin_, n))
            todo -= n
            if room > n * size:
                tree.insert(room - n * size, bin_)
    return out


def even_bins(classes: list[tuple[int, int]], bins: int):
    """best_fit_decreasing into bins of the smallest capacity found at which they suffice."""
    alone, rest, first = [], [], 0
    left = sum(s * n for s, n in classes)
    for nth, (size, n) in enumerate(classes):
        while n and first < bins - 1 and size * (bins - first) >= left:  # fills a bin of its own
            alone.append((nth, first, 1))
            first, n, left = first + 1, n - 1, left - size
        rest.append((size, n))
    free = bins - first
    low = max([-(-left // free), *(s for s, n in rest if n)], default=1) if left else 1
    slack, found = 0, None
    while found is None:
        found = best_fit_decreasing(rest, low + slack, free)
        good, slack = low + slack, 2 * slack + 1
    bad = low if good == low else low + (slack - 1) // 2 // 2
    while good - bad > max(1, low // 100_000):
        middle = (good + bad) // 2
        tried = best_fit_decreasing(rest, middle, free)
        if tried is None:
            bad = middle
        else:
            good, found = middle, tried
    return alone + [(nth, bin_ + first, n) for nth, bin_, n in found]


def size_class(size: Column) -> Column:
    """Exact up to EXACT, then by 256 steps an octave."""
    return F.when(size <= EXACT, size).otherwise(F.lit(EXACT) + F.floor((F.log2(size.cast("double")) - 16) * 256) + 1).cast("long")


def shard(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row of docs(doc_id, text)."""
    body = text_of()
    rows = keep(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(body.cast("binary"), 256)).alias("key"),
        ),
        "rows",
    )
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("copies"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    groups = groups.withColumn("class", F.when(F.col("bytes") * LARGE > total, F.lit(-1)).otherwise(size_class(F.col("bytes"))))
    ranked = keep(numbered(groups, "groups", "class"), "ranked")
    large = ranked.where("class = -1").select("bytes", "class_rank").collect()  # fewer than LARGE rows
    small = ranked.where("class >= 0").groupBy("class").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).collect()
    # a class counts with the mean of its sizes, rounded up
    entries = [(r["bytes"], 1, -1, r["class_rank"]) for r in large] + [(-(-r["bytes"] // r["n"]), r["n"], r["class"], 0) for r in small]
    entries.sort(key=lambda e: (-e[0], e[2], e[3]))
    used = [e[3] for e in entries]
    table = []
    for nth, bin_, n in even_bins([e[:2] for e in entries], shards):
        table.append((entries[nth][2], used[nth], bin_))
        used[nth] += n
    found = np.array(sorted(table), np.int64).reshape(-1, 3)

    def binned(batches):
        code = ((found[:, 0] + 1) << 44) | found[:, 1]
        for batch in batches:
            kind, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("class", "class_rank"))
            place = found[np.searchsorted(code, ((kind + 1) << 44) | rank, side="right") - 1, 2]
            key, copies = (batch.column(batch.schema.get_field_index(c)) for c in ("key", "copies"))
            yield pa.RecordBatch.from_arrays([key, copies, pa.array(place.astype(np.int32))], names=["g_key", "copies", "shard"])

    found_bins = ranked.mapInArrow(binned, "g_key binary, copies long, shard int")
    placed = lookup(rows, found_bins, [("key", "g_key")], "copies", rows.count()).drop("key", "g_key", "copies")
    out = numbered(placed, "placed", "shard")
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("class_rank").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
