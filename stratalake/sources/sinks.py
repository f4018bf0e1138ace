"""Writers. Each counts the rows it writes inside the write job itself."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratalake.tables import BATCH_DATE


def child(root: str, *parts: str) -> str:
    """Join path parts below a storage root."""
    return "/".join([root.rstrip("/"), *parts])


def require_distinct(source: str, target: str) -> None:
    """Refuse a job that would overwrite what it reads."""
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError(f"source and target are the same path: {source}")


#: Directory level of the incremental ingest's steps.
STEP = "_step"


def refuse_children(spark: SparkSession, root: str, level: str) -> None:
    """Refuse a path laid out by the other kind of ingest, whose rows a reader would miss."""
    path = spark._jvm.org.apache.hadoop.fs.Path(child(root, f"{level}=*"))
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    if found:
        raise ValueError(f"{root} holds {level} directories: it belongs to another kind of ingest")


def batch_path(root: str, batch: date) -> str:
    """Directory of one batch, in the layout partition discovery expects."""
    return child(root, f"{BATCH_DATE}={batch.isoformat()}")


def _counted(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Attach row metrics; call it right before the write, after any shuffle."""
    seen = Observation()
    columns = [F.count(F.lit(1)).alias("rows")]
    columns += [metric.alias(name) for name, metric in metrics.items()]
    return df.observe(seen, *columns), seen


def write_batch(df: DataFrame, root: str, batch: date, **metrics: Column) -> dict[str, int]:
    """Replace one batch and leave all others alone.

    A batch owns its partition directory, so it is overwritten directly: no
    dynamic-partition staging, no sort by a constant, and a repeated run with
    fewer rows, or none, leaves nothing stale behind. Tasks write what they
    scanned; there is no shuffle.
    """
    counted, seen = _counted(df.drop(BATCH_DATE), **metrics)
    counted.write.mode("overwrite").parquet(batch_path(root, batch))
    return seen.get


def of_batch(df: DataFrame, batch: date) -> DataFrame:
    """Rows of one batch with its date as a constant, by which no task sorts before it writes."""
    return df.drop(BATCH_DATE).withColumn(BATCH_DATE, F.lit(batch))


def write_partitioned(df: DataFrame, root: str, batch: date | None = None) -> int:
    """Replace a whole table partitioned by batch date; returns the rows written.

    The rebalance groups rows by batch date so that a task writes few files, and
    adaptive execution splits a date that is too large for one task and merges
    the small ones. Rows that all belong to ``batch`` need no grouping: tasks write
    what they hold.
    """
    counted, seen = _counted(df if batch else df.hint("rebalance", F.col(BATCH_DATE)))
    if batch:
        counted = of_batch(counted, batch)
    (
        counted.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(BATCH_DATE)
        .parquet(root)
    )
    return seen.get["rows"]


@dataclass(frozen=True)
class Target:
    """A further place a result goes to: a data source name and its options."""

    format: str
    options: dict[str, str] = field(default_factory=dict)

    def write(self, df: DataFrame) -> None:
        df.write.format(self.format).options(**self.options).mode("overwrite").save()


def bigquery_target(table: str, staging_bucket: str | None = None) -> Target:
    """Direct write through the BigQuery connector, which must be on the class path.

    ``table`` is ``project.dataset.table``.
    """
    options = {"table": table, "writeMethod": "direct"}
    if staging_bucket:
        options["temporaryGcsBucket"] = staging_bucket
    return Target("bigquery", options)


def publish(df: DataFrame, path: str, *targets: Target) -> int:
    """Compute a result once, as Parquet, and copy the stored files to further targets."""
    counted, seen = _counted(df)
    counted.write.mode("overwrite").parquet(path)
    if targets:
        stored = df.sparkSession.read.schema(df.schema).parquet(path)
        for target in targets:
            target.write(stored)
    return seen.get["rows"]


def write_lines(lines: DataFrame, path: str) -> None:
    """Write a single string column as text files."""
    lines.write.mode("overwrite").text(path)
