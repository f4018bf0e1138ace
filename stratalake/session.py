"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

MB = 1024 * 1024

# A task reads or receives up to this much, and a rebalanced write produces files
# of up to this size. Jobs too small for that get smaller shares, down to the
# minimum, so that all cores have work.
TARGET_PARTITION_BYTES = 128 * MB
MIN_PARTITION_BYTES = 4 * MB
FULL_SIZE_PARTITIONS = 200

# Beyond this many tasks per stage partitions grow instead: a shuffle moves
# (map tasks x reduce tasks) blocks, which must neither become too many nor tiny.
MAX_PARTITIONS = 32_768
MAX_SPLIT_BYTES = 1024 * MB

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
}


def _within(low: int, value: int, high: int) -> int:
    return min(max(low, value), high)


def sizing(data_gb: float) -> dict[str, str]:
    """Settings for a job over ``data_gb`` of input.

    Adaptive execution merges shuffle partitions that turn out small but adds
    none to a plain aggregate or window, so their starting number has to be high
    enough. Input splits grow with the data so that map tasks stay countable.
    """
    size = int(data_gb * 1024 * MB)
    share = _within(MIN_PARTITION_BYTES, size // FULL_SIZE_PARTITIONS, TARGET_PARTITION_BYTES)
    partitions = _within(16, size // share, MAX_PARTITIONS)
    split = _within(TARGET_PARTITION_BYTES, size // MAX_PARTITIONS, MAX_SPLIT_BYTES)
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(share),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(split),
    }
    if share == TARGET_PARTITION_BYTES:
        # Many tiny tasks cost more than they gain once the cluster is full anyway.
        settings["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "false"
    return settings


def get_spark(
    app_name: str,
    *,
    data_gb: float | None = None,
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create or reuse a session; ``data_gb`` sizes its stages, ``conf`` wins over defaults."""
    settings = {**DEFAULTS, **(sizing(data_gb) if data_gb is not None else {}), **(conf or {})}
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: For a chain of jobs: shuffle files go when the job that wrote them ends (by default they stay until
#: the driver collects garbage), and a hot key is split even where that costs one more shuffle.
CHAINED = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


@contextmanager
def chained_jobs(spark: SparkSession) -> Iterator[None]:
    """``CHAINED`` settings for the jobs within it, so that a chain of jobs needs the disk of the largest."""
    before = {key: spark.conf.get(key, None) for key in CHAINED}
    for key, value in CHAINED.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh directory name below the shared folder in ``spark.checkpoint.dir``.

    Only a local master may fall back to the machine's own temporary folder,
    because executors elsewhere could not read what was written there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="stratalake-")
    return f"{base.rstrip('/')}/stratalake/{label}-{uuid.uuid4().hex}"
