"""Choosing snapshots and archive parts, and the work that is left."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilewright.functions import names


def thin(tags: DataFrame, days: int, time: str = "tag_ts") -> DataFrame:
    """The first time and then each at least so many whole days after the last one kept.

    What is kept depends on what was kept, so the distinct times (one for each snapshot) are
    folded in order.
    """
    times = tags.select(time).where(F.col(time).isNotNull()).distinct()
    ordered = times.agg(F.array_sort(F.collect_list(time)).alias("t"))
    empty = F.array().cast("array<timestamp_ntz>")
    far = lambda kept, t: (F.size(kept) == 0) | (names.whole_days(F.element_at(kept, -1), t) >= days)
    kept = F.aggregate("t", empty, lambda kept, t: F.when(far(kept, t), F.array_append(kept, t)).otherwise(kept))
    return ordered.select(F.explode(kept).alias(time))


def select_tags(tags: DataFrame, days: int, first: datetime | None = None, last: datetime | None = None, limit: int | None = None) -> DataFrame:
    """Thinning within a range (which moves its start), then the first so many."""
    if first is not None:
        tags = tags.where(F.col("tag_ts") >= F.lit(first).cast("timestamp_ntz"))
    if last is not None:
        tags = tags.where(F.col("tag_ts") <= F.lit(last).cast("timestamp_ntz"))
    out = thin(tags, days)
    return out.orderBy("tag_ts").limit(limit) if limit is not None else out


def parse_tags(lines: DataFrame, column: str = "line") -> DataFrame:
    """tag, tag_ts of lines that name a snapshot: one row a tag, unreadable times dropped."""
    tag = F.regexp_extract(F.regexp_replace(column, r"\^\{\}$", ""), r"refs/tags/(world-.*)$", 1)
    found = lines.select(tag.alias("tag")).where("tag <> ''").distinct()
    return found.withColumn("tag_ts", names.tag_time(F.col("tag"))).where("tag_ts is not null")


def select_parts(assets: DataFrame, prefer: str = "auto", column: str = "name") -> DataFrame:
    """name, prefix, codec, part_no of the split archive among the assets.

    prefer: gzip, zstd, or auto (zstd if there is any). Files that aren't parts are left out;
    none or several archives left are an error.
    """
    name = F.col(column)
    parts = assets.where(names.is_part(name)).select(
        name.alias("name"), names.part_prefix(name).alias("prefix"), names.part_codec(name).alias("codec"), names.part_extension(name).alias("extension")
    )
    every = Window.partitionBy()
    if prefer == "auto":
        parts = parts.withColumn("_zstd", F.max((F.col("codec") == "zstd").cast("int")).over(every))
        parts = parts.where((F.col("codec") == "zstd") | (F.col("_zstd") == 0)).drop("_zstd")
    else:
        parts = parts.where(F.col("codec") == prefer)
    groups = F.size(F.collect_set(F.concat_ws(".", F.lower("prefix"), "extension")).over(every))
    parts = parts.withColumn("_groups", groups)
    checked = F.when(F.col("_groups") == 1, F.col("name")).otherwise(F.raise_error(F.lit("several split archives match")))
    order = Window.orderBy(*names.part_order(F.col("name")))
    return parts.select(checked.alias("name"), "prefix", "codec", F.row_number().over(order).alias("part_no"))


def sort_parts(assets: DataFrame, column: str = "name") -> DataFrame:
    """Parts with their place in the archive (part_no from 1)."""
    order = Window.orderBy(*names.part_order(F.col(column)))
    return assets.withColumn("part_no", F.row_number().over(order))


def valid_downloads(files: DataFrame, expected: DataFrame) -> DataFrame:
    """Files(name, length, content) whose size and, where given, sha256 are as expected(name, size, digest)."""
    digest = names.sha256_of_digest(F.col("digest"))
    same = (F.col("length") == F.col("size")) & (digest.isNull() | (F.sha2("content", 256) == digest))
    return files.join(expected, "name").where(same).select(*files.columns)


def pending(selected: DataFrame, applied: DataFrame, key: str = "tag_ts") -> DataFrame:
    return selected.join(applied, key, "left_anti")


def done(selected: DataFrame, applied: DataFrame, key: str = "tag_ts") -> DataFrame:
    return selected.join(applied, key, "left_semi")


def first_samples(rows: DataFrame, cls: str, order: str | Column, n: int = 20) -> DataFrame:
    """The first n rows of each class."""
    nth = Window.partitionBy(cls).orderBy(order)
    return rows.withColumn("nth", F.row_number().over(nth)).where(F.col("nth") <= n)


def class_histogram(rows: DataFrame, cls: str) -> DataFrame:
    return rows.groupBy(cls).agg(F.count("*").alias("n"))


def slowest(rows: DataFrame, took: str, n: int = 10, *ties: str) -> DataFrame:
    """The n rows that took longest."""
    return rows.orderBy(F.desc(took), *ties).limit(n)


def without_existing(rows: DataFrame, existing: DataFrame, key: str = "name") -> DataFrame:
    """Rows whose output isn't there yet."""
    return rows.join(existing.select(key).distinct(), key, "left_anti")
