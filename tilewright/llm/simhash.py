"""SimHash fingerprints of documents and the search for all prints within a Hamming radius.

A term is a run of five words (a shorter text is one term), its weight the number of its
occurrences. Each term's 128-bit hash votes with its weight on each bit; a bit is set where
the votes for it prevail. Likeness is the share of equal bits.

The search is exact. Prints are cut into eight blocks of 16 bits, and each block in turn is the key of
a table of all prints. If two prints differ in at most radius bits, then in some block they differ
in no more than its share of them (the shares and one for each block add up to radius + 1), so a
query print probes each table with all keys that near to its own; what it finds is compared in
full, and the first table that finds a pair tells it. Blocks of query prints meet blocks of the
distinct prints. Equal prints are one entry with a count.

Edge cases: null text counts as empty; a text without words has the print of all zeros; equal
texts have equal prints; rows are ordered by doc_id, downwards, null last, then by text, and
the row after the last is the first, so a single row is its own successor; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import BLOCK_BYTES, keep, mix64, ranges, small_batches, text_of, wide
from tilewright.llm.shingles import shingle_hashes, word_hashes

BITS = 128
#: Bits in which the prints of texts with 0.8 of their shingles in common may differ.
RADIUS = 28
#: Prints of a block of queries and of the index, and probes of a table at once.
QUERY_BLOCK, INDEX_BLOCK, PROBES = 4096, 1 << 16, 1 << 17
#: Code points of a text by which rows of one doc_id are dealt.
BEGINNING = 64
#: Blocks of the bits, each the key of a table.
TABLES = 8


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """A row of 16 bytes for each UTF-8 text."""
    at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
    terms, n = shingle_hashes(*word_hashes(np.frombuffer(b"".join(texts), np.uint8), at))
    out = np.zeros((len(texts), BITS // 8), np.uint8)
    full = np.flatnonzero(n)
    if len(full):
        words = np.stack([terms, mix64(terms ^ np.uint64(0xC2B2AE3D27D4EB4F))], axis=1)
        votes = np.add.reduceat(np.unpackbits(words.view(np.uint8), axis=1), (np.cumsum(n) - n)[full], axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * votes > n[full, None], axis=1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1 - np.bitwise_count(a ^ b).sum(axis=1) / BITS


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_FIELDS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compared(ids: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
    """The result of each text and the one that follows it."""
    edited = [t[: len(t) - len(t) // 3] + f[: len(t) // 3] for t, f in zip(texts, following, strict=True)]
    raw = [e.encode() for e in edited]
    # what follows one row is mostly the next row's text
    place: dict[str, int] = {}
    for t in (*texts, *following):
        place.setdefault(t, len(place))
    prints = fingerprints([t.encode() for t in place])
    own, after, changed = prints[[place[t] for t in texts]], prints[[place[t] for t in following]], fingerprints(raw)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string()),
            pa.array([p.tobytes().hex() for p in own], pa.string()),
            pa.array([p.tobytes().hex() for p in changed], pa.string()),
            pa.array(likeness(own, changed)),
            pa.array(likeness(own, after)),
        ],
        names=_NAMES,
    )


def _neighbours(batches):
    """Results of all rows but a partition's last; its first and last text besides, for the partitions beside it."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    extra = [("part", pa.int32()), ("kind", pa.int32()), ("text", pa.string())]

    def told(result: pa.RecordBatch, kind: int, text: str | None) -> pa.RecordBatch:
        columns = [pa.array([v] * result.num_rows, t) for v, (_, t) in zip((part, kind, text), extra, strict=True)]
        return pa.RecordBatch.from_arrays([*result.columns, *columns], names=[*_NAMES, *(n for n, _ in extra)])

    def border(id_, text: str, kind: int) -> pa.RecordBatch:
        columns = [pa.array([id_], pa.int64()), pa.array([0], pa.int64())] + [pa.array([None], pa.string())] * 3 + [pa.array([None], pa.float64())] * 2
        return told(pa.RecordBatch.from_arrays(columns, names=_NAMES), kind, text)

    ids, texts, size, started = [], [], 0, False
    for batch in batches:
        for id_, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if not started:
                started = True
                yield border(id_, text, 1)
            ids.append(id_)
            texts.append(text)
            size += len(text)
            if size > BLOCK_BYTES and len(ids) > 1:
                yield told(compared(ids[:-1], texts[:-1], texts[1:]), 0, None)
                ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])
    if len(ids) > 1:
        yield told(compared(ids[:-1], texts[:-1], texts[1:]), 0, None)
    if ids:
        yield border(ids[-1], texts[-1], 2)


def _borders(batches):
    """Results of partitions' last rows, from (doc_id, text, the first text of the partition that follows)."""
    for batch in batches:
        for id_, text, after in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield compared([id_], [text], [after])


def shares(radius: int) -> list[int]:
    """The bits in which prints within radius may differ in each block, if they differ in more in all others; -1 where the block needs no table."""
    each, more = divmod(radius + 1, TABLES)
    return [each + (i < more) - 1 for i in range(TABLES)]


def _keys(p1: np.ndarray, p2: np.ndarray) -> np.ndarray:
    """A column of 16-bit keys for each table."""
    return np.stack([(p >> np.uint64(16 * i) & np.uint64(0xFFFF)).astype(np.int64) for p in (p1, p2) for i in range(4)], axis=1)


def near_prints(q1: np.ndarray, q2: np.ndarray, p1: np.ndarray, p2: np.ndarray, radius: int):
    """(query, print) of all pairs within radius, in portions."""
    asked, filed = _keys(q1, q2), _keys(p1, p2)
    most = shares(radius)
    distance = np.bitwise_count(np.arange(1 << 16))
    for nth, share in enumerate(most):
        if share < 0:
            continue
        order = np.argsort(filed[:, nth], kind="stable")
        start = np.searchsorted(filed[order, nth], np.arange((1 << 16) + 1))
        flips = np.flatnonzero(distance <= share)
        step = max(1, PROBES // len(flips))
        for first in range(0, len(q1), step):
            keys = (asked[first : first + step, nth, None] ^ flips).ravel()
            size = start[keys + 1] - start[keys]
            query = first + np.repeat(np.arange(len(keys)) // len(flips), size)
            found = order[np.repeat(start[keys], size) + ranges(size)]
            ok = np.flatnonzero(np.bitwise_count(q1[query] ^ p1[found]).astype(np.int64) + np.bitwise_count(q2[query] ^ p2[found]) <= radius)
            query, found = query[ok], found[ok]
            for before in range(nth):
                new = distance[asked[query, before] ^ filed[found, before]].astype(np.int64) > most[before]
                query, found = query[new], found[new]
            yield query, found


def _distances(radius: int):
    def run(batches):
        for batch in batches:
            for queries, prints in zip(*(batch.column(batch.schema.get_field_index(c)) for c in ("queries", "prints")), strict=True):
                q, i = queries.values, prints.values
                (q1, q2), (p1, p2) = ([np.asarray(x.field(c)).view(np.uint64) for c in range(2)] for x in (q, i))
                for row, col in near_prints(q1, q2, p1, p2, radius):
                    yield pa.RecordBatch.from_arrays([pa.array(q1[row].view(np.int64)), pa.array(q2[row].view(np.int64)), *(i.field(c).take(pa.array(col)) for c in (2, 3))], names=["q1", "q2", "n", "doc_id"])

    return run


def print_pairs(queries: DataFrame, index: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(q1, q2, n, doc_id) for each print of queries(p1, p2) and each row of index(p1, p2, n, doc_id) within radius."""
    spark = queries.sparkSession
    small_batches(spark)

    def blocks_of(df: DataFrame, name: str, most: int, least: int) -> tuple[DataFrame, int]:
        """The rows in blocks of about most, at least so many blocks; the number of blocks."""
        n = max(least, -(-df.count() // most))
        held = df.groupBy(F.pmod(F.xxhash64("p1", "p2"), F.lit(n)).alias("block")).agg(F.collect_list(F.struct(*df.columns)).alias(name))
        return held, n

    filed, n = blocks_of(index.select("p1", "p2", F.col("n").cast("long").alias("n"), F.col("doc_id").cast("long").alias("doc_id")), "prints", INDEX_BLOCK, 1)
    # tables are dear to make, so a small index is shared out by its queries
    asked, _ = blocks_of(queries.select("p1", "p2").distinct(), "queries", QUERY_BLOCK, -(-min(wide(spark), 48) // n))
    each = asked.select("queries", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("block"))
    met = each.join(filed, "block").select("queries", "prints")
    return met.mapInArrow(_distances(radius), "q1 long, q2 long, n long, doc_id long")


def within_radius(queries: DataFrame, index: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(q1, q2, n) for each print of queries(p1, p2): the rows of index(p1, p2, n) within radius."""
    return print_pairs(queries, index.withColumn("doc_id", F.lit(None)), radius).groupBy("q1", "q2").agg(F.sum("n").alias("n"))


def simhash(docs: DataFrame, radius: int = RADIUS, every: int = 50) -> DataFrame:
    """The fingerprint of each row of docs(doc_id, text), of its edited text, and their likeness.

    The edited text has its last third (rounded down, in code points) replaced by as much of
    the beginning of the next row's text. For a doc_id divisible by every, n_near is the number
    of other rows whose print is within radius, and near_ids has the least doc_id of each
    distinct print within radius, its own among them; the rows with the fingerprint of one of
    these are the rows found. Both are null for the other rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    order = [F.col("doc_id").desc_nulls_last()]
    # rows of one doc_id (or of none) part by the beginnings of their texts
    dealt = narrow.repartitionByRange(wide(spark), *order, F.substring("text", 1, BEGINNING)).sortWithinPartitions(*order, "text")
    rows = keep(dealt.mapInArrow(_neighbours, _FIELDS + ", part int, kind int, text string"), "prints")
    # two rows for each partition: its last one meets the first one of the next that has rows, the last partition the first
    held = sorted(r["part"] for r in rows.where("kind = 2").select("part").collect())
    order = spark.createDataFrame(list(zip(held, held[1:] + held[:1], strict=True)), "last_part int, first_part int")
    last = rows.where("kind = 2").select("part", "doc_id", "text").join(F.broadcast(order), F.col("part") == F.col("last_part"))
    first = rows.where("kind = 1").select(F.col("part").alias("of_part"), F.col("text").alias("after"))
    edges = last.hint("merge").join(first, F.col("first_part") == F.col("of_part")).select("doc_id", "text", "after")
    out = keep(rows.where("kind = 0").select(*_NAMES).union(edges.mapInArrow(_borders, _FIELDS)), "compared")

    def word(start: int):
        half = [F.conv(F.substring("fingerprint", start + 8 * i, 8), 16, 10).cast("long") for i in range(2)]
        return F.shiftleft(half[0], 32).bitwiseOR(half[1])

    prints = out.select("doc_id", word(1).alias("p1"), word(17).alias("p2"))
    asked = F.coalesce(F.col("doc_id") % every == 0, F.lit(False))
    index = prints.groupBy("p1", "p2").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id"))
    # in a struct, since lists leave out nulls: a print may have only rows without doc_id
    found = F.array_sort(F.collect_list(F.struct("doc_id")))
    near = print_pairs(prints.where(asked).select("p1", "p2"), index, radius).groupBy("q1", "q2").agg(F.sum("n").alias("n"), F.transform(found, lambda x: x["doc_id"]).alias("near_ids"))
    joined = out.withColumns({"p1": word(1), "p2": word(17)}).withColumn("asked", asked)
    # only rows that ask look up what is near them
    k1 = F.when(F.col("asked"), F.col("p1"))
    joined = joined.where("not asked").select(*_NAMES, F.lit(None).cast("long").alias("n_near"), F.lit(None).cast("array<long>").alias("near_ids")).union(
        joined.where("asked").join(near, (k1 == F.col("q1")) & (F.col("p2") == F.col("q2"))).select(*_NAMES, F.col("n") - 1, "near_ids")
    )
    return joined
