"""Spark sessions with the settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC makes timestamps without zone comparable; the rest lets adaptive execution size and split the shuffles.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
}


def session(app: str = "tilewright", **settings: str) -> SparkSession:
    """The active session or a new one; settings override SETTINGS."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
