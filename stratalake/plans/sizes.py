"""Stage sizes from what lies in the input paths."""

from __future__ import annotations

from pyspark.sql import SparkSession

from stratalake.session import sizing
from stratalake.sources.storage import total_bytes


def size_for(spark: SparkSession, *paths: str, data_gb: float | None = None) -> float:
    """Set the session's shuffle and split sizes for a job that reads ``paths``; returns the gigabytes assumed.

    The file system sums up the sizes below each path (or glob pattern) before the job is
    planned; compressed input is taken as it lies there. ``data_gb`` overrides the sum.
    """
    size = total_bytes(spark, *paths) / 1024**3 if data_gb is None else data_gb
    for key, value in sizing(size).items():
        spark.conf.set(key, value)
    return size
