"""Exact deduplication by composable polynomial fingerprints.

A text is cut into chunks. A chunk's hash is its bytes (plus one) as the coefficients of a
polynomial, taken at a fixed base modulo a prime, under four primes at once; all chunks of a
block are hashed side by side as one matrix product whose sums stay below 2**53 and so are
exact. Hashes of neighbouring chunks combine by shifting the left one by the length of the
right one, so the fingerprint doesn't depend on where a text was cut and a huge text needs no
sequential pass. Texts with one fingerprint and length are then compared chunk by chunk with
the row that would stay.

Edge cases: null text counts as empty; empty texts are equal to each other; of rows with the
same doc_id and text one stays; a null doc_id comes after all others; an empty table gives an
empty result; only doc_id and text are read, so further columns can't clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import CELLS, blocks, cut, keep, lookup, small_batches, taken_cells, text_of, utf8

#: The four largest primes below 2**31, and a base for each.
PRIMES = np.array([2147483647, 2147483629, 2147483587, 2147483579], np.int64)
BASES = np.array([1000003, 805306457, 402653189, 1610612741], np.int64)
#: Bytes that are hashed as one row of the matrix: 256 * 2**31 * CHUNK stays below 2**53.
CHUNK = 1024
#: Bytes of a chunk in the comparison of texts.
COMPARE = 1 << 16
#: Members of a group that share one copy of the text they are compared with.
SHARE = 100


def powers(exponents: np.ndarray) -> np.ndarray:
    """BASES ** exponents modulo PRIMES, a row for each exponent."""
    left = exponents.astype(np.int64).copy()
    out = np.ones((len(left), 4), np.int64)
    square = np.tile(BASES, (1, 1))
    while left.any():
        odd = (left & 1).astype(bool)
        out[odd] = out[odd] * square % PRIMES
        square = square * square % PRIMES
        left >>= 1
    return out


def combine(left: np.ndarray, right: np.ndarray, right_shift: np.ndarray) -> np.ndarray:
    """Hash of the concatenation; right_shift is powers() of the right part's length."""
    return (left * right_shift + right) % PRIMES


def chunk_hashes(data: np.ndarray, at: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all chunks, their lengths and the number of chunks of each text."""
    sizes = np.diff(at)
    n_chunks = -(-sizes // CHUNK)
    text = np.repeat(np.arange(len(sizes)), n_chunks)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(n_chunks) - n_chunks, n_chunks)
    start = at[:-1][text] + nth * CHUNK
    length = np.minimum(CHUNK, at[1:][text] - start)
    rows = np.zeros((len(text), CHUNK))
    row = np.repeat(np.arange(len(text)), length)
    # each chunk stands at the right end of its row, so that all rows share the table of powers
    column = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length) + np.repeat(CHUNK - length, length)
    rows[row, column] = data
    rows[row, column] += 1
    return (rows @ table).astype(np.int64) % PRIMES, length, n_chunks


def fingerprint_block(data: np.ndarray, at: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Four residues for each text; the empty text has zeros."""
    n = len(at) - 1
    out = np.zeros((n, 4), np.int64)
    value, length, n_chunks = chunk_hashes(data, at, table)
    shift, count = powers(length), n_chunks.copy()
    while len(value):
        text = np.repeat(np.arange(n), count)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
        if count.max(initial=0) <= 1:
            out[text] = value
            break
        left = nth % 2 == 0
        paired = np.flatnonzero(left & (nth + 1 < count[text]))
        merged, merged_shift = value[left].copy(), shift[left].copy()
        to = (np.cumsum(left) - 1)[paired]
        merged[to] = combine(value[paired], value[paired + 1], shift[paired + 1])
        merged_shift[to] = shift[paired] * shift[paired + 1] % PRIMES
        value, shift, count = merged, merged_shift, -(-count // 2)
    return out


def normalise(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run of white space becomes one space."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    after = np.zeros(len(data), bool)
    after[1:] = space[:-1]
    after[at[:-1][at[:-1] < len(data)]] = False
    kept = ~(space & after)
    out = data[kept].copy()
    out[space[kept]] = 32
    return out, np.concatenate([[0], np.cumsum(kept)])[at]


def power_table() -> np.ndarray:
    return powers(np.arange(CHUNK - 1, -1, -1)).astype(np.float64)


def _fingerprints(bits: int, wanted: np.ndarray | None = None):
    """The fingerprints of all texts; with wanted, those with their bodies of the texts whose first word lies in a wanted cell."""

    def run(batches):
        table, mask = power_table(), (1 << bits) - 1
        for batch in batches:
            for part in blocks(batch, "text"):
                data, at = normalise(*utf8(part.column(1)))
                print_ = fingerprint_block(data, at, table)
                f1, f2 = (((print_[:, i] << 31) | print_[:, i + 1]) & mask for i in (0, 2))
                texts = cut(data, at)
                ids, size = part.column(0), np.diff(at)
                if wanted is not None:
                    some = np.flatnonzero(wanted[f1 % CELLS])
                    ids, f1, f2, size, texts = ids.take(pa.array(some)), f1[some], f2[some], size[some], [texts[i] for i in some.tolist()]
                columns = [ids, pa.array(f1), pa.array(f2), pa.array(size), pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())]
                names = ["doc_id", "f1", "f2", "n_bytes", "text_sha256"]
                if wanted is not None:
                    columns, names = [*columns, pa.array(texts, pa.binary())], [*names, "body"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _chunks(batches):
    """A row for each chunk of a text; the text that would stay gives one for each share of its group."""
    names = ["g1", "g2", "g3", "share", "chunk", "doc_id", "first", "piece"]
    for batch in batches:
        for row in batch.to_pylist():
            body, shares = row["body"], -(-row["group_size"] // SHARE)
            first = row["text_sha256"] == row["first_sha256"] and row["doc_id"] == row["keep_id"]
            mine = range(shares) if first else [int(row["salt"]) % shares]
            pieces = [body[i : i + COMPARE] for i in range(0, len(body), COMPARE)] or [b""]
            for share in mine:
                cols = list(zip(*((row["f1"], row["f2"], row["n_bytes"], share, i, row["doc_id"], first, p) for i, p in enumerate(pieces)), strict=True))
                types = [pa.int64()] * 3 + [pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=names)


def exact_dedup(docs: DataFrame, bits: int = 62) -> DataFrame:
    """One row for each row of docs(doc_id, text); see the module for the edge cases.

    bits narrows the two fingerprint words, for tests that need collisions. Returns doc_id,
    keep_id, group_size, kept, text_sha256, n_bytes, fingerprint.
    """
    small_batches(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    key = ["f1", "f2", "n_bytes"]
    fields = "doc_id long, f1 long, f2 long, n_bytes long, text_sha256 string"
    prints = keep(narrow.mapInArrow(_fingerprints(bits), fields).withColumn("row", F.monotonically_increasing_id()), "prints")
    total = prints.count()
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "text_sha256")

    def groups(rows: DataFrame, by: list[str]) -> DataFrame:
        """Those of several rows, by columns g_..."""
        found = rows.groupBy(*(F.col(c).alias(f"g_{c}") for c in by)).agg(F.min(order).alias("first"), F.count("*").alias("group_size"))
        return found.where("group_size > 1")

    def on(by: list[str]) -> list[tuple[str, str]]:
        return [(c, f"g_{c}") for c in by]

    several = keep(groups(prints, key), "several")
    found = several.select("g_f1", "g_f2", "g_n_bytes", F.col("first.doc_id").alias("keep_id"), F.col("first.text_sha256").alias("first_sha256"), "group_size")
    # only the bodies of groups of several rows leave Python (and a few whose fingerprints fall into their cells)
    bodies = narrow.mapInArrow(_fingerprints(bits, taken_cells(several.select("g_f1"))), fields + ", body binary")
    bodies = lookup(bodies, found, on(key), "group_size", total).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)))
    chunks = bodies.select(*key, "doc_id", "text_sha256", "body", "keep_id", "first_sha256", "group_size", "salt").mapInArrow(
        _chunks, "g1 long, g2 long, g3 long, share int, chunk int, doc_id long, first boolean, piece binary"
    )
    at = ["g1", "g2", "g3", "share", "chunk"]
    first = chunks.where("first").select(*at, F.col("piece").alias("first_piece")).dropDuplicates(at)
    unlike = keep(
        chunks.where("not first").join(first, at, "left").where("piece is distinct from first_piece").select("g1", "g2", "g3", "doc_id").distinct(), "unlike"
    )
    rows, by = prints, key
    if not unlike.isEmpty():  # equal fingerprints of unlike texts: these rows are grouped by their digests too
        marked = unlike.select(F.col("g1").alias("f1"), F.col("g2").alias("f2"), F.col("g3").alias("n_bytes"), "doc_id", F.lit(True).alias("apart"))
        same = [prints[c].eqNullSafe(marked[c]) for c in (*key, "doc_id")]
        rows, by = prints.join(marked, same, "left").select(*(prints[c] for c in prints.columns), F.when(F.col("apart"), F.col("text_sha256")).otherwise("").alias("split")), [*key, "split"]
        several = keep(groups(rows, by), "several")
    out = lookup(rows, several, on(by), "group_size", total, "left")
    return out.select(
        "doc_id",
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("first").isNull() | (F.col("row") == F.col("first.row"))).alias("kept"),
        "text_sha256",
        "n_bytes",
        F.format_string("%016x%016x", "f1", "f2").alias("fingerprint"),
    )
