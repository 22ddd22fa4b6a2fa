"""Snapshots and their archive parts before they are at hand: listings of tags and assets, and downloads that go on where they broke off."""

from __future__ import annotations

import hashlib
import os
import time
import urllib.error
import urllib.request

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions.names import sha256_of_digest
from tilewright.operators import tags
from tilewright.sources.split_archive import group_parts

#: The fields of a release's JSON that count.
RELEASE = "tag_name string, assets array<struct<name: string, size: bigint, digest: string, browser_download_url: string>>"
CHUNK = 1 << 20


def listed_tags(spark: SparkSession, path: str) -> DataFrame:
    """tag, tag_ts of the lines (hash, refs/tags/...) of a listing in files, oldest first."""
    return tags.parse_tags(spark.read.text(path).withColumnRenamed("value", "line")).orderBy("tag_ts", "tag")


def assets(releases: DataFrame, column: str = "json") -> DataFrame:
    """tag, name, size, digest, url of the assets of releases, a JSON text each; a text without assets has none."""
    found = releases.select(F.from_json(column, RELEASE).alias("r")).select(F.col("r.tag_name").alias("tag"), F.explode("r.assets").alias("a"))
    return found.select("tag", "a.name", "a.size", "a.digest", F.col("a.browser_download_url").alias("url"))


def local_parts(spark: SparkSession, folder: str, pattern: str = "*") -> list[str]:
    """The parts of the one archive in a folder, in order; an error if there is none or there are several."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path")
    found = group_parts([r["path"].removeprefix("file:") for r in files.collect()])  # a row for each part
    if len(found) != 1:
        raise ValueError(f"{len(found)} archives match")
    return next(iter(found.values()))


def _fetch(url: str, target: str, size: int | None, sha256: str | None, tries: int, wait: float) -> tuple[bool, int, str | None]:
    """Whether the file is complete, the bytes that came now, and the last error."""
    part, came, error = f"{target}.part", 0, None
    for attempt in range(tries):
        if attempt:
            time.sleep(wait * attempt)
        have = os.path.getsize(part) if os.path.exists(part) else 0
        try:
            request = urllib.request.Request(url, headers={"Range": f"bytes={have}-"} if have else {})
            with urllib.request.urlopen(request, timeout=60) as answer:
                go_on = answer.status == 206  # otherwise the whole file comes
                with open(part, "ab" if go_on else "wb") as out:
                    while block := answer.read(CHUNK):
                        out.write(block)
                        came += len(block)
        except urllib.error.HTTPError as e:
            error = f"HTTP {e.code}"
            if e.code == 416 and not (size is not None and have == size):  # nothing beyond what is here: begin anew
                os.remove(part)
                continue
            if e.code != 416 and e.code not in (403, 429) and e.code < 500:
                break
            if e.code != 416:
                continue
        except OSError as e:
            error = f"{type(e).__name__}: {e}"
            continue
        if size is not None and os.path.getsize(part) != size:
            error = f"{os.path.getsize(part)} of {size} bytes"
            if os.path.getsize(part) > size:
                os.remove(part)
            continue
        if sha256:
            digest = hashlib.sha256()
            with open(part, "rb") as f:
                while block := f.read(CHUNK):
                    digest.update(block)
            if digest.hexdigest() != sha256:
                error = "sha256"
                os.remove(part)
                continue
        os.replace(part, target)
        return True, came, None
    return False, came, error


def download(wanted: DataFrame, folder: str, parallel: int = 4, tries: int = 3, wait: float = 1.0) -> DataFrame:
    """tag, name, ok, fetched_bytes, error of each asset of wanted(tag, name, size, digest, url), fetched into folder/tag.

    Complete files aren't fetched again; a broken one goes on from folder/tag/name.part. folder must
    be one that the executors share.
    """
    names = ["tag", "name", "size", "sha256", "url"]

    def run(batches):
        for batch in batches:
            rows = []
            for tag, name, size, sha256, url in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names), strict=True):
                os.makedirs(f"{folder}/{tag}", exist_ok=True)
                target = f"{folder}/{tag}/{os.path.basename(name)}"
                done = os.path.exists(target) and (size is None or os.path.getsize(target) == size)
                rows.append((tag, name, *((True, 0, None) if done else _fetch(url, target, size, sha256, tries, wait))))
            types = [pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["tag", "name", "ok", "fetched_bytes", "error"])

    todo = wanted.select("tag", "name", "size", sha256_of_digest(F.col("digest")).alias("sha256"), "url").repartition(parallel, "tag", "name")
    return todo.mapInArrow(run, "tag string, name string, ok boolean, fetched_bytes long, error string")
