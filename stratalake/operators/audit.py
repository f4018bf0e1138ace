"""Audit columns of the Bronze layer."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.tables import BATCH_DATE, INGESTED_AT, SOURCE_FILE


def as_utc(moment: datetime | None) -> datetime:
    """The given moment, or now, in UTC; a naive value is taken to be UTC already."""
    if moment is None:
        return datetime.now(timezone.utc)
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


def file_lineage() -> Column:
    """Path of the file a row came from; only valid directly on a file scan."""
    return F.col("_metadata.file_path")


def with_audit(
    df: DataFrame, source: str | Column, ingested_at: datetime | None = None
) -> DataFrame:
    """Append ingest time, source and batch date.

    The clock is read once on the driver, so every row of a batch, and any task
    that is run again, carries the same values.
    """
    moment = as_utc(ingested_at)
    return df.withColumns(
        {
            INGESTED_AT: F.lit(moment),
            SOURCE_FILE: F.lit(source) if isinstance(source, str) else source,
            BATCH_DATE: F.lit(moment.date()),
        }
    )
