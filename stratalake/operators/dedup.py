"""Latest version per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.tables import INGESTED_AT

_RANK = "_version_rank"


def latest_per_key(df: DataFrame, key: str, recency: str = INGESTED_AT) -> DataFrame:
    """One row per key: the most recent, ties settled by the remaining columns.

    All columns take part in the order, so rows that still tie are identical and
    the result does not depend on partitioning. Because only rank 1 is kept,
    Spark limits each group to one row per map task before the shuffle; a key
    that holds a third of all rows sends at most one row per task.
    """
    rest = [name for name in df.columns if name not in (key, recency)]
    newest_first = Window.partitionBy(key).orderBy(
        *(F.desc_nulls_last(name) for name in [recency, *rest])
    )
    return (
        df.withColumn(_RANK, F.row_number().over(newest_first)).where(f"{_RANK} = 1").drop(_RANK)
    )
