"""Tables that are replaced at once: versions in directories of their own and one pointer that readers follow.

``<root>/_version=<n>/…`` holds what version n wrote. ``<root>/_current`` names the version,
for a table partitioned by batch date also the version whose files each date is read from.
A version that is still being written, or whose writer died, is not in the pointer; the next
attempt writes the same directory anew.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.sources import storage
from stratalake.tables import BATCH_DATE

POINTER = "_current"
VERSION = "_version"
LEDGER, CHANGES = "_ledger", "_changes"


@dataclass(frozen=True)
class Snapshot:
    """What the pointer says.

    ``parts`` maps a batch date to the version that holds it and, if the table has a range
    column, to that column's least and greatest value and whether it has nulls. ``notes``
    are the writer's.
    """

    version: int
    parts: dict[str, dict] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)

    def dates(self) -> list[date]:
        return sorted(date.fromisoformat(day) for day in self.parts)

    def dates_with(self, values: set[date | None]) -> list[date]:
        """Batch dates that may hold one of ``values`` in the range column."""
        known = sorted(v.isoformat() for v in values if v is not None)

        def may_hold(part: dict) -> bool:
            if "range" not in part:
                return True
            low, high, nulls = part["range"]
            return (nulls and None in values) or (low is not None and any(low <= v <= high for v in known))

        return sorted(date.fromisoformat(day) for day, part in self.parts.items() if may_hold(part))


def _below(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def version_path(root: str, version: int, kind: str = "") -> str:
    """Directory of a version's rows, or of its ledger or changes."""
    return _below(root, *([kind] if kind else []), f"{VERSION}={version}")


def current(spark: SparkSession, root: str) -> Snapshot | None:
    """The table's current snapshot; None if it has no pointer."""
    found = storage.read_pointer(spark, _below(root, POINTER))
    return Snapshot(**found) if found else None


def point(spark: SparkSession, root: str, snapshot: Snapshot) -> None:
    """Make ``snapshot`` the current one."""
    content = {"version": snapshot.version, "parts": snapshot.parts, "notes": snapshot.notes}
    storage.write_pointer(spark, _below(root, POINTER), content)


def read_parts(
    spark: SparkSession, root: str, schema: T.StructType, snapshot: Snapshot, dates: list[date] | None = None
) -> DataFrame:
    """Rows of the given batch dates (all by default); directories of other dates are not even listed."""
    days = [day.isoformat() for day in (snapshot.dates() if dates is None else dates)]
    paths = [f"{version_path(root, snapshot.parts[d]['version'])}/{BATCH_DATE}={d}" for d in days if d in snapshot.parts]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths).select(*schema.names)


def read_whole(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """Rows of an unpartitioned table's current version."""
    snapshot = current(spark, root)
    if snapshot is None:
        raise ValueError(f"{root} has no {POINTER}")
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(version_path(root, snapshot.version))


def described(spark: SparkSession, root: str, version: int, schema: T.StructType, range_column: str | None) -> dict[str, dict]:
    """Entries of ``parts`` for the batch dates that a version has written, from its stored files."""
    stored = spark.read.schema(schema).parquet(version_path(root, version)).groupBy(BATCH_DATE)
    parts = {}
    value = F.col(range_column) if range_column else F.lit(None).cast("date")
    found = stored.agg(F.count(F.lit(1)).alias("rows"), F.min(value).alias("low"), F.max(value).alias("high"), F.count(value).alias("known"))
    for row in found.collect():  # one row per batch date
        entry = {"version": version, "rows": row["rows"]}
        if range_column:
            low, high = (x and x.isoformat() for x in (row["low"], row["high"]))
            entry["range"] = [low, high, row["known"] < row["rows"]]
        parts[row[BATCH_DATE].isoformat()] = entry
    return parts


def drop_unreferenced(spark: SparkSession, root: str, keep_changes_from: int | None = None) -> list[str]:
    """Delete version directories that the pointer does not name; returns them.

    Readers that started before the last publication may still use them, so call it when
    none can be left. Change tables from ``keep_changes_from`` on stay (all by default).
    """
    snapshot = current(spark, root)
    if snapshot is None:
        return []
    used = {snapshot.version, *(part["version"] for part in snapshot.parts.values())}
    dropped = []
    for kind in ("", LEDGER, CHANGES):
        for path in storage.matches(spark, _below(root, *([kind] if kind else []), f"{VERSION}=*")):
            number = int(path.rsplit("=", 1)[1])
            unused = {"": number not in used, LEDGER: number != snapshot.version}.get(
                kind, keep_changes_from is not None and number < keep_changes_from
            )
            if unused:
                storage.delete(spark, path)
                dropped.append(path)
    return dropped
