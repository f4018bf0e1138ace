"""Readers for the stored layers, partitioned by batch date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.sources import snapshots
from stratalake.sources.snapshots import read_parts
from stratalake.tables import BATCH_DATE, CORRUPT, TableSpec, spec_for


def _batches(df: DataFrame, since: date | None, until: date | None) -> DataFrame:
    """Restrict to a closed range of batch dates; prunes directories, not rows."""
    if since is not None:
        df = df.where(F.col(BATCH_DATE) >= F.lit(since))
    if until is not None:
        df = df.where(F.col(BATCH_DATE) <= F.lit(until))
    return df


def read_bronze(
    spark: SparkSession,
    table: str | TableSpec,
    path: str,
    *,
    since: date | None = None,
    until: date | None = None,
) -> DataFrame:
    """Accepted Bronze rows.

    The declared schema saves reading file footers and lets batches with and
    without the reject marker be read together.
    """
    spec = spec_for(table)
    stored = spark.read.schema(spec.bronze).parquet(path).select(*spec.bronze.names)
    return _batches(stored.where(F.col(CORRUPT).isNull()).drop(CORRUPT), since, until)


def read_silver(
    spark: SparkSession,
    table: str | TableSpec,
    path: str,
    *,
    since: date | None = None,
    until: date | None = None,
) -> DataFrame:
    """Silver rows, optionally of some batches only; follows the pointer of a table that has one."""
    schema = spec_for(table).silver
    if snapshot := snapshots.current(spark, path):
        return read_parts(spark, path, schema, snapshot, _within(snapshot.dates(), since, until))
    return _batches(spark.read.schema(schema).parquet(path), since, until)


def _within(dates: list[date], since: date | None, until: date | None) -> list[date]:
    return [d for d in dates if (since is None or d >= since) and (until is None or d <= until)]


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """A Gold table; follows the pointer of a table that has one."""
    if snapshots.current(spark, path):
        return snapshots.read_whole(spark, path)
    return spark.read.parquet(path)
