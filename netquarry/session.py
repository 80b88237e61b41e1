"""Session settings of the library."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def session(name: str = "netquarry", **settings: str) -> SparkSession:
    """A session with the library's settings; a cluster's own master, memory and partition settings stay."""
    return SparkSession.builder.appName(name).config(map=SETTINGS | settings).getOrCreate()
