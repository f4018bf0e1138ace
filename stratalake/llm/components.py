"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


#: Edges in a file of the tables between rounds.
FILE_EDGES = 250_000


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every end of ``edges(a, b)``; the component is its smallest id.

    Each round rewires edges to the smallest neighbour (Kiveris et al., 2014) until
    nothing changes, in about log2 of the longest path rounds. Edges stay in tables;
    only a count and a checksum come to the driver. A hub's edges are split by adaptive
    execution, since both sides of each join are stored tables. Self loops keep lone
    vertices; null ends are left out.
    """
    ends = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).dropna()
    ends = written(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    lone = ends.filter("a = b").select(F.col("a").alias("id"), F.col("a").alias("component"))
    now = ends.filter("a != b")
    state = _state(now)
    while state[0]:
        files = math.ceil(state[0] / FILE_EDGES)  # small tables in few files: a round is mostly overhead then
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        least = written(least.coalesce(files), "least")
        large = both.filter("b > a").join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = written(large.distinct().coalesce(files), "large-star")
        least = written(now.groupBy("a").agg(F.min("b").alias("m")).coalesce(files), "least")
        moved = now.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.union(least.select("a", F.col("m").alias("b"))).distinct()
        now = written(moved.coalesce(files), "small-star")
        before, state = state, _state(now)
        if before == state:
            break
    found = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component"))
    return found.union(roots).union(lone).groupBy("id").agg(F.min("component").alias("component"))
