"""How fast archives of snapshots inflate and are read, by way of reading."""

from __future__ import annotations

import tarfile
import time

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.sources.split_archive import Stream, file_size, group_parts

#: stream: inflation alone; tar: the members' bytes too.
MODES = ("stream", "tar")
RESULT = "tag string, codec string, mode string, repeat_index int, ok boolean, seconds double, compressed_bytes long, decompressed_stream_bytes long, tar_members long, tar_payload_bytes long, error string"


def measure(paths: list[str], codec: str, mode: str) -> tuple:
    """ok, seconds, compressed bytes, inflated bytes, members, their bytes, error of reading one archive."""
    began, inflated, members, payload, error = time.perf_counter(), 0, 0, 0, None
    try:
        stream = Stream(paths, codec)
        if mode == "tar":
            with tarfile.open(fileobj=stream, mode="r|") as tar:
                for member in tar:
                    if member.isfile():
                        members += 1
                        payload += len(tar.extractfile(member).read())
        while stream.read(1 << 20):
            pass
        inflated = stream.total
    except Exception as e:
        error = f"{type(e).__name__}: {e}"
    return error is None, time.perf_counter() - began, sum(file_size(p) for p in paths), inflated, members, payload, error


def benchmark(pipeline, repeats: int = 3) -> DataFrame:
    """A row for each archive, mode and repeat, with throughputs; every reading is a task of its own."""
    spark = pipeline.spark
    known = pipeline.archives().select("tag", "paths").collect()  # a row for each archive
    rows = [(r["tag"], r["paths"], mode, nth) for r in known for mode in MODES for nth in range(repeats)]
    todo = spark.createDataFrame(rows, "tag string, paths string, mode string, repeat_index int").repartition(max(1, len(rows)))
    fields = [f.split()[0] for f in RESULT.split(", ")]

    def run(batches):
        for batch in batches:
            for tag, paths, mode, nth in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                (((_, codec), parts),) = group_parts(paths.split(",")).items()
                row = (tag, codec, mode, nth, *measure(parts, codec, mode))
                types = [pa.string()] * 3 + [pa.int32(), pa.bool_(), pa.float64()] + [pa.int64()] * 4 + [pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=fields)

    found = todo.mapInArrow(run, RESULT).persist()
    mib = lambda c: F.when(F.col("ok"), F.try_divide(F.col(c) / float(1 << 20), F.col("seconds"))).otherwise(0.0)
    return found.withColumns({"compressed_mib_s": mib("compressed_bytes"), "decompressed_mib_s": mib("decompressed_stream_bytes")})


def ranking(results: DataFrame) -> DataFrame:
    """Codec and mode by median throughput, the fastest first; failed readings only count as such."""
    good = F.when(F.col("ok"), F.col("decompressed_mib_s"))
    out = results.groupBy("codec", "mode").agg(F.count("*").alias("runs"), F.count_if(~F.col("ok")).alias("failed"), F.median(good).alias("median_mib_s"), F.max(good).alias("best_mib_s"))
    return out.orderBy(F.desc_nulls_last("median_mib_s"), "codec", "mode")
