"""Scratch tables, byte views of Arrow text and other helpers of the llm operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that the Python operators work on at once.
BLOCK_BYTES = 1 << 20
#: Inside a regular-expression class: the white space of the contracts.
SPACE = r"\x20\x09-\x0D"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(col: str = "text") -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; where none is set, an own temporary one if all runs on this machine, else an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tilewright-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    """A setting of the session for a while."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def keep(df: DataFrame, label: str) -> DataFrame:
    """Writes df as a table in the shared scratch folder and reads it back.

    Cuts lineage like checkpoint(), but as compressed columns; the shuffle files of the plan go
    as soon as it has run. The table's files go when the JVM ends; drop() removes them sooner.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/tilewright-{label}-{uuid.uuid4().hex}"
    with _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.option("compression", "zstd").parquet(path)
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tilewright_path = path
    return out


def settle(spark: SparkSession) -> None:
    """Lets Spark's cleaner see that what earlier plans broadcast is no longer in use, so that executors drop it.

    For once between the stages of a long run; a driver that lives long does so by itself from time to time.
    """
    gc.collect()  # the plans that Python holds
    spark.sparkContext._jvm.System.gc()


def drop(df: DataFrame) -> None:
    """Removes a table of keep() that no plan still to run will read."""
    spark = df.sparkSession
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._tilewright_path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jvm_path, True)


def small_batches(spark: SparkSession) -> None:
    """Keeps what goes to Python at once to 4 MB (longer texts alone), whatever the length of the rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def wide(spark: SparkSession) -> int:
    """Partitions for work that Python does in memory."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text or binary column without nulls, and its n + 1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def release() -> None:
    """Gives what a Python worker has freed back to the system, since idle workers stay for a while."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim is not None:
        trim(0)


def blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES):
    """Slices of the batch whose texts hold about limit bytes; a longer text is a slice of its own."""
    _, at = utf8(batch.column(batch.schema.get_field_index(column)))
    start, n = 0, batch.num_rows
    while start < n:
        end = int(np.searchsorted(at, at[start] + limit, side="right")) - 1
        end = min(n, max(end, start + 1))
        yield batch.slice(start, end - start)
        start = end
    release()


def cut(data: np.ndarray, at: np.ndarray) -> list[bytes]:
    whole = data.tobytes()
    return [whole[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=False)
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def ranges(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c, one after another."""
    total = int(counts.sum())
    starts = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) - np.repeat(starts, counts)


def distinct_sample(texts: DataFrame, most: int) -> DataFrame:
    """(part, hash, n, text): of each part of texts(part, text) the most distinct texts of least hash (all if there are fewer).

    n is the number of the text's rows. There are few parts.
    """
    spark = texts.sparkSession
    hashed = texts.select("part", "text", F.xxhash64("text").alias("hash"))
    place = F.pmod("hash", F.lit(1 << 30))
    found = keep(hashed.groupBy("part", "hash").agg(F.count("*").alias("n")), "hashes")
    sizes = found.groupBy("part").agg(F.count("*").alias("texts")).collect()
    # hashes are even, so that the first ones lie below this; all of a small part do
    below = [F.when(F.col("part") == r["part"], F.lit(int(min(1.0, (1.5 * most + 100) / r["texts"]) * (1 << 30)))) for r in sizes]
    first = found.where(place < F.coalesce(*below)).select("part", "hash", "n").collect() if sizes else []
    parts: dict = {}
    for r in sorted(first, key=lambda r: (r["hash"] % (1 << 30), r["hash"])):
        if len(own := parts.setdefault(r["part"], [])) < most:
            own.append((r["part"], r["hash"], r["n"]))
    chosen = spark.createDataFrame([r for own in parts.values() for r in own], "part string, hash long, n long")
    drop(found)
    return hashed.join(F.broadcast(chosen), ["part", "hash"]).groupBy("part", "hash").agg(F.first("n").alias("n"), F.first("text").alias("text"))


def numbered(df: DataFrame, label: str, *classes: str, run=None, fields: str | None = None) -> DataFrame:
    """Adds class_rank (0, 1, ... within each combination of the class columns) without sorting a class.

    With run and fields the rows are those of df.mapInArrow(run, fields), made in the same Python worker.

    Every task numbers its own rows of each class; the tasks' counts, one row per task and
    class, are summed up to offsets. The order is that of the tasks of one written table.
    """
    from pyspark.sql import Window
    from pyspark.sql.types import LongType, StructField, StructType

    names = list(classes)
    made = StructType.fromDDL(fields) if fields else df.schema
    schema = StructType([*made.fields, StructField("_task", LongType()), StructField("_local", LongType())])

    def number(batches):
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), {}
        for batch in run(batches) if run else batches:
            if not batch.num_rows:
                continue
            keys = list(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names), strict=True))
            local = []
            for key in keys:
                rank = seen.get(key, 0)
                local.append(rank)
                seen[key] = rank + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, task, np.int64)), pa.array(local, pa.int64())],
                names=[*batch.schema.names, "_task", "_local"],
            )

    rows = keep(df.mapInArrow(number, schema), label)
    counts = rows.groupBy(*names, "_task").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*names).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*(F.col(c).alias(f"_of_{c}") for c in (*names, "_task")), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    on = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in (*names, "_task")]
    joined = rows.join(offsets, on, "left")
    return joined.select(*made.names, (F.col("_local") + F.col("_before")).alias("class_rank"))


def worker_cache() -> dict:
    """What a Python worker keeps from one task to the next; may be empty at any time."""
    import sys
    import types

    return sys.modules.setdefault("_tilewright_worker", types.ModuleType("_tilewright_worker")).__dict__


#: A key with this share of all rows or more is hot, and at least so many rows.
HOT_SHARE, HOT_ROWS = 1000, 1000
#: Cells of the semi filter.
CELLS = 1 << 20


def lookup(rows: DataFrame, groups: DataFrame, on: list[tuple[str, str]], n: str, total: int, how: str = "inner") -> DataFrame:
    """rows joined with groups(one row for each key, n: the rows of the key), whatever a key's share of the total rows.

    At most HOT_SHARE keys can have a share of 1 / HOT_SHARE of all rows, so the hot ones are
    broadcast; no task of the join of the others has a key beyond that share. on: pairs of a
    column of rows and one of groups, whose names differ from all those of rows.
    """
    least = max(total // HOT_SHARE, HOT_ROWS)
    same = [F.col(a) == F.col(b) for a, b in on]
    found = groups.where(F.col(n) >= least).collect() if total >= HOT_ROWS else []  # HOT_SHARE rows at most
    if not found:
        return rows.join(groups, same, how)
    hot = F.broadcast(rows.sparkSession.createDataFrame(found, groups.schema))
    near = rows.join(hot, same)
    far = rows.join(hot, same, "left_anti").join(groups.where(F.col(n) < least), same, how)
    return near.unionByName(far)


def semi_filter(rows: DataFrame, wanted: DataFrame, key: str, wanted_key: str, how: str = "left_semi") -> DataFrame:
    """The rows whose key may be among those of wanted, before any shuffle: all of these, and others with a like hash.

    What is broadcast are the cells of the wanted keys, CELLS long values at most; where these are
    nearly all taken the filter passes everything. With how left_anti, the rows that it leaves out.
    """
    cells = wanted.select(F.pmod(F.xxhash64(wanted_key), F.lit(CELLS)).alias("_cell")).distinct()
    return rows.join(F.broadcast(cells), F.pmod(F.xxhash64(key), F.lit(CELLS)) == F.col("_cell"), how)


def taken_cells(words: DataFrame) -> np.ndarray:
    """A flag for each of CELLS cells: whether the column of 64-bit words has one that falls into it."""
    out = np.zeros(CELLS, bool)
    column = words.columns[0]
    # CELLS rows at most
    out[words.select(F.pmod(column, F.lit(CELLS)).cast("int").alias("c")).distinct().toArrow().column(0).to_numpy()] = True
    return out
