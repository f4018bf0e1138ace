"""Bronze ingest that reads each landing file once."""

from __future__ import annotations

import hashlib
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.audit import as_utc, file_lineage, with_audit
from stratalake.plans.bronze import IngestResult, reject_missing_keys
from stratalake.sources import storage
from stratalake.sources.sinks import STEP, child, of_batch, refuse_children, require_distinct
from stratalake.sources.snapshots import POINTER
from stratalake.tables import BATCH_DATE, CORRUPT, CORRUPT_FIELD, TableSpec, spec_for

# Spark forgets files this much older than the newest it has seen, by default a week;
# a file that arrives late must be read all the same. In exchange the list of files
# read, kept below the progress path, is never shortened.
NEVER = "36500d"


def ingest_new_files(
    spark: SparkSession,
    table: str | TableSpec,
    landing: str,
    bronze: str,
    progress: str,
    *,
    file_format: str = "csv",
    dead_letter: str | None = None,
    strict: bool = False,
    lineage: str = "file",
    source_name: str | None = None,
    ingested_at: datetime | None = None,
    files_per_step: int | None = None,
    check_header: bool = False,
    multi_line: bool = False,
) -> IngestResult:
    """Append the files that arrived since the last call; returns what this call wrote.

    The batch ingest re-reads the whole landing path; this one records what it
    has read below ``progress`` (on shared storage), so its cost follows the new
    data, whatever the files' modification times. ``files_per_step`` splits a large
    backlog into steps. Each step owns a directory above the batch date: rows and,
    with ``dead_letter``, letters are written there before the step is committed, and
    a step that runs again, even on another day, replaces both. Options mean what
    they mean in the batch ingest; without ``dead_letter`` a malformed field is
    stored as NULL. A Bronze path that the batch ingest has written is refused.
    """
    spec = spec_for(table)
    require_distinct(landing, bronze)
    if strict and not dead_letter:
        raise ValueError("strict needs a dead_letter path for the rows it rejects")
    if lineage not in ("landing", "file"):
        raise ValueError(f"lineage must be 'landing' or 'file', not {lineage!r}")
    if dead_letter:
        require_distinct(bronze, dead_letter)
        refuse_children(spark, dead_letter, BATCH_DATE)
    refuse_children(spark, bronze, BATCH_DATE)
    if storage.exists(spark, child(bronze, POINTER)):
        raise ValueError(f"{bronze} belongs to the ingest with a file table")
    writer = hashlib.sha256(progress.rstrip("/").encode()).hexdigest()[:8]
    if not storage.exists(spark, child(progress, "offsets")) and storage.matches(spark, child(bronze, f"{STEP}={writer}-*")):
        raise ValueError(f"{progress} has lost what it knew: {bronze} holds steps written with it, which would be read again")

    moment = as_utc(ingested_at)
    fields = [*spec.landing.fields, *([CORRUPT_FIELD] if dead_letter else [])]
    reader = (
        spark.readStream.format(file_format)
        .schema(T.StructType(fields))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", multi_line)
        .option("maxFileAge", NEVER)
    )
    if file_format == "csv":
        reader = reader.option("header", True).option("enforceSchema", not check_header)
    if files_per_step:
        reader = reader.option("maxFilesPerTrigger", files_per_step)
    source = file_lineage() if lineage == "file" else (source_name or landing)
    rows = with_audit(reader.load(landing), source, moment)
    if strict:
        rows = reject_missing_keys(rows, spec)
    totals = {"rows": 0, "rejected": 0}

    def write_step(step: DataFrame, number: int) -> None:
        name = f"{STEP}={writer}-{number}"
        seen = Observation()
        counted = of_batch(step.observe(seen, F.count(F.lit(1)).alias("rows")), moment.date())
        counted.write.mode("overwrite").partitionBy(BATCH_DATE).parquet(child(bronze, name))
        found = 0
        if dead_letter:
            stored = spark.read.schema(spec.bronze).parquet(child(bronze, name))
            letters, count = stored.where(F.col(CORRUPT).isNotNull()), Observation()
            letters = of_batch(letters.hint("rebalance").observe(count, F.count(F.lit(1)).alias("rows")), moment.date())
            letters.write.mode("overwrite").partitionBy(BATCH_DATE).parquet(child(dead_letter, name))
            found = count.get["rows"]
        totals["rows"] += seen.get["rows"]
        totals["rejected"] += found

    (
        rows.writeStream.foreachBatch(write_step)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return IngestResult(spec.name, moment.date(), totals["rows"], totals["rejected"])
