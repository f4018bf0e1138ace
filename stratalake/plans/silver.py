"""Bronze to Silver."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.cleaning import derived, tidied, valid_rows
from stratalake.operators.dedup import latest_per_key
from stratalake.sources import storage
from stratalake.sources.layers import read_bronze, read_silver
from stratalake.sources.sinks import child, require_distinct, write_partitioned
from stratalake.tables import BATCH_DATE, TableSpec, spec_for


def refined(
    bronze: DataFrame, table: str | TableSpec, earlier: DataFrame | None = None
) -> DataFrame:
    """Latest valid version of each record: clean first, then deduplicate.

    Columns computed from the others are added to the surviving rows only, which
    keeps them out of the shuffle. ``earlier`` is a Silver table to bring up to
    date with newer Bronze rows; the latest version of the latest versions is
    the same as that of all rows.
    """
    spec = spec_for(table)
    rows = tidied(valid_rows(bronze, spec), spec)
    if earlier is not None:
        rows = earlier.select(*rows.columns).unionAll(rows)
    return derived(latest_per_key(rows, spec.key), spec)


def _refuse_gap(spark: SparkSession, table: str | TableSpec, bronze: str, previous: DataFrame, since: date) -> None:
    """Refuse Bronze batches between the newest one in ``previous`` and ``since``; reads only their directories."""
    newest = previous.agg(F.max(BATCH_DATE)).first()[0]
    start = newest + timedelta(days=1) if newest else None
    skipped = read_bronze(spark, table, bronze, since=start, until=since - timedelta(days=1))
    if row := skipped.select(BATCH_DATE).first():
        raise ValueError(
            f"Bronze batch {row[0]} lies between the earlier version (up to {newest}) and since={since};"
            " start from that batch or an older one"
        )


def _only_batch(spark: SparkSession, bronze: str) -> date | None:
    """The date of a Bronze table's batch, if it has no more than one."""
    found = storage.matches(spark, child(bronze, f"{BATCH_DATE}=*"))
    try:
        return date.fromisoformat(found[0].rsplit("=", 1)[1]) if len(found) == 1 else None
    except ValueError:  # rows without a batch date
        return None


def refine(
    spark: SparkSession,
    table: str | TableSpec,
    bronze: str,
    silver: str,
    *,
    earlier: str | None = None,
    since: date | None = None,
) -> int:
    """Rebuild one Silver table; returns the rows written.

    By default from all Bronze batches. With ``earlier``, the path of a previous
    Silver version, only Bronze batches from ``since`` on are read and cleaned;
    that version must hold all older batches as they are now, under the same
    rules. A batch between its newest batch date and ``since`` is refused: reading
    it again does no harm, leaving it out would. Batches dated before that newest date
    are taken to be in it. Either way the whole table is written anew, as a re-delivered record
    moves to its newest batch and must leave its old one.
    """
    if (earlier is None) != (since is None):
        raise ValueError("earlier and since go together")
    require_distinct(bronze, silver)
    previous = None
    if earlier is not None:
        require_distinct(earlier, silver)
        previous = read_silver(spark, table, earlier)
        _refuse_gap(spark, table, bronze, previous, since)
    fresh = read_bronze(spark, table, bronze, since=since)
    only = _only_batch(spark, bronze) if previous is None else None
    return write_partitioned(refined(fresh, table, previous), silver, only)
