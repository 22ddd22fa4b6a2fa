"""Versioned stores of sharded pixels, folders of images, and logs.

A store keeps its last two versions, so it can be read while its successor is written.
"""

from __future__ import annotations

import json
import os
import re
import tomllib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions.names import shard_name, shard_of, tile_x, tile_y
from tilewright.operators import encoding, shards


def file_system(spark: SparkSession, path: str):
    """Spark's file system of a path, and the path for it."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replaces a small file on any file system of Spark's, by renaming a complete one."""
    fs, target = file_system(spark, path)
    _, part = file_system(spark, f"{path}.{uuid.uuid4().hex}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(target, False)
    fs.rename(part, target)


class Store:
    """Pixels in shards on any file system of Spark's, with a stored tile index and manifests.

    A commit writes the shards that it changes and their tile index (data/commit=N, index/commit=N)
    and then a manifest (manifest/v-N) that names the commit of every shard, so the others are
    carried over unread. The current version is the last manifest that its committer marked as
    complete; a crash leaves the former one in place. The one before the current is kept for its
    readers. A manifest has one row for each shard.
    """

    MANIFEST = "sx int, sy int, name string, commit int, tile_count long, visible_pixels long, stored_bytes long, uncompressed_bytes long"
    INDEX = "x int, y int, count long, encoding string, stored_bytes long"

    def __init__(self, spark: SparkSession, root: str, shard_tiles: int = 32, tile_pixels: int = 1_000_000):
        self.spark, self.root, self.shard_tiles, self.tile_pixels = spark, root.rstrip("/"), shard_tiles, tile_pixels

    def _names(self, folder: str) -> list[str]:
        fs, path = file_system(self.spark, f"{self.root}/{folder}")
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _exists(self, name: str) -> bool:
        fs, path = file_system(self.spark, f"{self.root}/{name}")
        return fs.exists(path)

    def versions(self) -> list[int]:
        """Numbers of the complete versions."""
        return sorted(int(n[2:]) for n in self._names("manifest") if re.fullmatch(r"v-\d+", n) and self._exists(f"manifest/{n}/_SUCCESS"))

    def manifest(self, version: int | None = None) -> DataFrame:
        """sx, sy, name, commit, tile_count, visible_pixels, stored_bytes, uncompressed_bytes of each shard, as stored."""
        found = self.versions()
        if not found:
            return self.spark.createDataFrame([], self.MANIFEST)
        return self.spark.read.schema(self.MANIFEST).json(f"{self.root}/manifest/v-{version or found[-1]}")

    def _shards(self, version: int | None = None) -> list:
        return self.manifest(version).select("sx", "sy", "commit").collect()  # one row for each shard

    def _read(self, kind: str, held: list, schema: str) -> DataFrame:
        paths = [f"{self.root}/{kind}/commit={r['commit']}/sx={r['sx']}/sy={r['sy']}" for r in held]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, schema: str = "x int, y int, pos int, rgb24 int") -> DataFrame:
        """The current version; an empty table if there is none yet."""
        return self._read("data", self._shards(), schema)

    def tiles(self) -> DataFrame:
        """x, y, count, encoding, stored_bytes of the current version's tiles, from the stored index."""
        return self._read("index", self._shards(), self.INDEX)

    def shard(self, sx: int, sy: int) -> DataFrame:
        """One shard's rows, by partition pruning; empty if it isn't there."""
        held = [r["commit"] for r in self._shards() if (r["sx"], r["sy"]) == (sx, sy)]
        if not held:
            return self.read().limit(0)
        rows = self.spark.read.parquet(f"{self.root}/data")
        return rows.where((F.col("commit") == held[0]) & (F.col("sx") == sx) & (F.col("sy") == sy)).drop("commit", "sx", "sy")

    def tile(self, x: int, y: int) -> DataFrame:
        """One tile's rows, from its shard alone."""
        return self.shard(x // self.shard_tiles, y // self.shard_tiles).where((F.col("x") == x) & (F.col("y") == y))

    def missing(self) -> DataFrame:
        """sx, sy, name, kind of the shards whose data or index files aren't there."""
        gone = [(r["sx"], r["sy"], kind) for r in self._shards() for kind in ("data", "index") if not self._exists(f"{kind}/commit={r['commit']}/sx={r['sx']}/sy={r['sy']}")]
        found = self.spark.createDataFrame(gone, "sx int, sy int, kind string")
        return found.select("sx", "sy", shard_name(F.col("sx"), F.col("sy")).alias("name"), "kind")

    def _sharded(self, df: DataFrame) -> DataFrame:
        return df.withColumn("sx", shard_of(F.col("x"), self.shard_tiles)).withColumn("sy", shard_of(F.col("y"), self.shard_tiles))

    def touched(self, df: DataFrame) -> list[tuple[int, int]]:
        """The shards of df's rows, at most one for each shard of the grid."""
        return sorted((r["sx"], r["sy"]) for r in self._sharded(df).select("sx", "sy").distinct().collect())

    def write(self, df: DataFrame) -> int:
        """Writes the next version of all shards; returns its number."""
        return self._commit(df, [])

    def replace(self, df: DataFrame, touched: list[tuple[int, int]]) -> int:
        """The next version, in which the touched shards hold df's rows and the others what they held."""
        return self._commit(df, [r for r in self._shards() if (r["sx"], r["sy"]) not in set(touched)])

    def upsert(self, batch: DataFrame, merge, schema: str) -> int:
        """Replaces the shards of batch's rows by merge(their rows, batch)."""
        touched = set(self.touched(batch))
        held = [r for r in self._shards() if (r["sx"], r["sy"]) in touched]
        return self.replace(merge(self._read("data", held, schema), batch), sorted(touched))

    def _commit(self, df: DataFrame, kept: list) -> int:
        found = self.versions()
        number = found[-1] + 1 if found else 1
        order = [c for c in ("x", "y", "pos") if c in df.columns]
        static = ("partitionOverwriteMode", "static")
        data = f"{self.root}/data/commit={number}"
        rows = self._sharded(df).repartition("sx", "sy").sortWithinPartitions("sx", "sy", *order)
        rows.write.mode("overwrite").option(*static).partitionBy("sx", "sy").parquet(data)
        index = f"{self.root}/index/commit={number}"
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
        written = self.spark.read.schema(f"{fields}, sx int, sy int").parquet(data)
        tiles = encoding.tiles(written, self.tile_pixels, "sx", "sy")
        tiles.repartition("sx", "sy").write.mode("overwrite").option(*static).partitionBy("sx", "sy").parquet(index)
        new = self.spark.read.schema(f"{self.INDEX}, sx int, sy int").parquet(index).groupBy("sx", "sy").agg(*shards.measures(), F.sum("stored_bytes").alias("uncompressed_bytes"))
        new = new.withColumn("name", shard_name(F.col("sx"), F.col("sy"))).withColumn("commit", F.lit(number))
        names = [f.split()[0] for f in self.MANIFEST.split(", ")]
        if kept:
            carried = self.spark.createDataFrame([(r["sx"], r["sy"]) for r in kept], "sx int, sy int")
            new = new.select(*names).unionByName(self.manifest().join(F.broadcast(carried), ["sx", "sy"]).select(*names))  # a row for each shard
        new.select(*names).coalesce(1).write.mode("overwrite").json(f"{self.root}/manifest/v-{number}")
        self._drop(found[:-1], [*found[-1:], number])
        return number

    def _drop(self, old: list[int], kept: list[int]) -> None:
        """Removes old versions and what no kept one refers to."""
        used = {(r["commit"], r["sx"], r["sy"]) for v in kept for r in self._shards(v)}
        for v in old:
            for r in self._shards(v):
                if (r["commit"], r["sx"], r["sy"]) not in used:
                    for kind in ("data", "index"):
                        fs, path = file_system(self.spark, f"{self.root}/{kind}/commit={r['commit']}/sx={r['sx']}/sy={r['sy']}")
                        fs.delete(path, True)
            fs, path = file_system(self.spark, f"{self.root}/manifest/v-{v}")
            fs.delete(path, True)


def tile_files(spark: SparkSession, folder: str) -> DataFrame:
    """x, y, path, content of the files x/y.png under a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][nN][gG]").option("recursiveFileLookup", "true").load(folder)
    found = files.select(tile_x(F.col("path")).alias("x"), tile_y(F.col("path")).alias("y"), "path", "content")
    return found.where("x is not null and y is not null")


def write_tiles(tiles: DataFrame, folder: str, zoom: int = 11) -> DataFrame:
    """Writes content of tiles(x, y, content) to folder/zoom/x/y.png, each in one step; returns x, y, png_bytes.

    folder must be one that the executors share.
    """
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            x, y, content = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("x", "y", "content"))
            for a, b, body in zip(x, y, content, strict=True):
                os.makedirs(f"{folder}/{zoom}/{a}", exist_ok=True)
                part = f"{folder}/{zoom}/{a}/.{b}.{uuid.uuid4().hex}"
                with open(part, "wb") as f:
                    f.write(body)
                os.replace(part, f"{folder}/{zoom}/{a}/{b}.png")
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int32()), pa.array(y, pa.int32()), pa.array([len(c) for c in content], pa.int64())], names=["x", "y", "png_bytes"])

    return tiles.select("x", "y", "content").mapInArrow(run, "x int, y int, png_bytes long")


def write_images(images: DataFrame, folder: str) -> DataFrame:
    """Writes content of images(bucket, name, content) to folder/bucket/name, each in one step; returns bucket, name, png_bytes.

    folder must be one that the executors share.
    """
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            bucket, name, content = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("bucket", "name", "content"))
            for b, n, body in zip(bucket, name, content, strict=True):
                os.makedirs(f"{folder}/{b:04d}", exist_ok=True)
                part = f"{folder}/{b:04d}/.{n}.{uuid.uuid4().hex}"
                with open(part, "wb") as f:
                    f.write(body)
                os.replace(part, f"{folder}/{b:04d}/{n}")
            yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(name, pa.string()), pa.array([len(c) for c in content], pa.int64())], names=["bucket", "name", "png_bytes"])

    return images.select(F.col("bucket").cast("int"), "name", "content").mapInArrow(run, "bucket int, name string, png_bytes long")


def image_names(spark: SparkSession, folder: str) -> DataFrame:
    """bucket, name of the images under folder/bucket."""
    fs, path = file_system(spark, folder)
    if not fs.exists(path):
        return spark.createDataFrame([], "bucket int, name string")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][nN][gG]").option("recursiveFileLookup", "true").load(folder).select("path")
    return files.select(F.regexp_extract("path", r"/(\d+)/[^/]+$", 1).try_cast("int").alias("bucket"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name"))


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON-lines log; lines that can't be read are left out."""
    rows = spark.read.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    return rows.where("_corrupt_record is null").drop("_corrupt_record")


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def save_json(path: str, value) -> None:
    """Replaces a JSON file in one step."""
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "w") as f:
        json.dump(value, f, indent=1, sort_keys=True)
    os.replace(part, path)


def load_json(path: str, default):
    try:
        with open(path) as f:
            return json.load(f)
    except FileNotFoundError:
        return default


def load_toml(path: str) -> dict:
    with open(path, "rb") as f:
        return tomllib.load(f)


def clean_temporary(folder: str) -> int:
    """Removes files *.tmp and *.part under a folder; returns their number."""
    n = 0
    for top, _, files in os.walk(folder):
        for name in files:
            if name.endswith((".tmp", ".part")):
                os.remove(f"{top}/{name}")
                n += 1
    return n
