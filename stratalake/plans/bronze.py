"""Landing files to Bronze."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.audit import as_utc, file_lineage, with_audit
from stratalake.sources.landing import LANDED_FILE, read_csv_by_header, read_landing
from stratalake.sources.sinks import STEP, batch_path, refuse_children, require_distinct, write_batch
from stratalake.tables import CORRUPT, CORRUPT_FIELD, TableSpec, spec_for


@dataclass(frozen=True)
class IngestResult:
    """What one ingest wrote: all rows, and how many of them are rejects."""

    table: str
    batch: date
    rows: int
    rejected: int


def reject_missing_keys(df: DataFrame, table: str | TableSpec) -> DataFrame:
    """Mark rows without a key as rejects, with the parsed fields as their text."""
    spec = spec_for(table)
    text = F.to_csv(F.struct(*spec.landing.names))
    missing = F.col(CORRUPT).isNull() & F.col(spec.key).isNull()
    return df.withColumn(CORRUPT, F.when(missing, text).otherwise(F.col(CORRUPT)))


def landed_rows(
    spark: SparkSession,
    spec: TableSpec,
    landing: str | list[str],
    file_format: str,
    source: str | None,
    moment: datetime,
    *,
    keep_rejects: bool,
    **read_options: bool,
) -> DataFrame:
    """Landing rows with audit columns; ``source`` None records the file of each row."""
    if file_format == "csv" and read_options.pop("by_header", False):
        if read_options.pop("check_header", False):
            raise ValueError("check_header refuses other orders of columns, by_header follows them: choose one")
        raw = read_csv_by_header(spark, spec, landing, keep_rejects=keep_rejects, **read_options)
        return with_audit(raw, F.col(LANDED_FILE) if source is None else source, moment).drop(LANDED_FILE)
    raw = read_landing(spark, spec, landing, file_format, keep_rejects=keep_rejects, **read_options)
    return with_audit(raw, file_lineage() if source is None else source, moment)


def check_options(bronze: str, dead_letter: str | None, strict: bool, lineage: str) -> None:
    """Refuse options that contradict each other."""
    if strict and not dead_letter:
        raise ValueError("strict needs a dead_letter path for the rows it rejects")
    if lineage not in ("landing", "file"):
        raise ValueError(f"lineage must be 'landing' or 'file', not {lineage!r}")
    if dead_letter:
        require_distinct(bronze, dead_letter)


def ingest(
    spark: SparkSession,
    table: str | TableSpec,
    landing: str,
    bronze: str,
    *,
    file_format: str = "csv",
    dead_letter: str | None = None,
    strict: bool = False,
    lineage: str = "landing",
    source_name: str | None = None,
    ingested_at: datetime | None = None,
    **read_options: bool,
) -> IngestResult:
    """Write the landing files of one table as one Bronze batch.

    The files are parsed once, by a map-only job that also counts. Without
    ``dead_letter`` a malformed field is stored as NULL. With it, Bronze keeps
    the malformed rows as well, each with its raw text; ``read_bronze`` leaves
    them out, and a copy goes to the dead-letter path. ``strict`` (with a
    dead-letter path) treats a missing key as malformed. ``lineage="file"``
    records the file of each row in place of the landing path. A batch ingested
    again without ``dead_letter`` keeps the letters of its earlier ingest. A Bronze
    path written by the incremental ingest is refused.
    """
    spec = spec_for(table)
    require_distinct(landing, bronze)
    check_options(bronze, dead_letter, strict, lineage)
    refuse_children(spark, bronze, STEP)

    moment = as_utc(ingested_at)
    source = None if lineage == "file" else (source_name or landing)
    rows = landed_rows(
        spark, spec, landing, file_format, source, moment, keep_rejects=bool(dead_letter), **read_options
    )
    if not dead_letter:
        written = write_batch(rows, bronze, moment.date())
        return IngestResult(spec.name, moment.date(), written["rows"], 0)

    if strict:
        rows = reject_missing_keys(rows, spec)
    written = write_batch(rows, bronze, moment.date(), rejected=F.count(CORRUPT))
    if written["rejected"]:
        stored = spark.read.schema(spec.bronze).parquet(batch_path(bronze, moment.date()))
    else:  # nothing to look for, but an earlier run may have left letters
        stored = spark.createDataFrame([], spec.bronze)
    copy_rejects(stored, dead_letter, moment.date())
    return IngestResult(spec.name, moment.date(), written["rows"], written["rejected"])


def copy_rejects(stored: DataFrame, dead_letter: str, batch: date) -> int:
    """Copy the rejects among a batch's stored Bronze rows; returns how many.

    Works on the stored Parquet rather than the landing files: the marker is
    final there, and row groups without rejects are skipped by their statistics.
    The rebalance turns the few rejects of many tasks into few files.
    """
    rejects = stored.where(F.col(CORRUPT).isNotNull()).hint("rebalance")
    return write_batch(rejects, dead_letter, batch)["rows"]


def read_dead_letters(spark: SparkSession, table: str | TableSpec, path: str) -> DataFrame:
    """Rejected rows: raw text, whatever fields could be parsed, and audit columns."""
    spec = spec_for(table)
    audit = [f.name for f in spec.bronze.fields if f.name.startswith("_") and f.name != CORRUPT]
    stored = spark.read.schema(spec.bronze).parquet(path)
    return stored.select(CORRUPT_FIELD.name, *spec.landing.names, *audit)
