"""Exact top-k by integer inner product, pruned with segment means and deviations, coarse to fine.

For segments of length l, q.x = sum of l * (mean_q * mean_x) + (q - mean_q).(x - mean_x),
and the last term is at most l * dev_q * dev_x. That bound on q.x is the usual lower
bound l * ((mean_q - mean_x)^2 + (dev_q - dev_x)^2) on the squared distance, written for
inner products. More, shorter segments give a tighter bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, whole_groups

#: Rows of a block of candidates and of queries, queries looked at together, segments of each resolution.
CANDIDATES, QUERIES, TOGETHER, LEVELS = 16_384, 1_024, 256, (4, 16)


def _statistics(rows: np.ndarray, segments: int) -> np.ndarray:
    """Per segment sqrt(l) * mean and sqrt(l) * deviation, so that their product is the bound."""
    out = []
    for part in np.array_split(np.arange(rows.shape[1]), min(segments, rows.shape[1])):
        values = rows[:, part]
        root = np.sqrt(len(part))
        out += [values.mean(axis=1) * root, values.std(axis=1) * root]
    return np.stack(out, axis=1)


def _exact(q: np.ndarray, x: np.ndarray, pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return np.concatenate(
        [np.zeros(0, q.dtype)]
        + [np.einsum("ij,ij->i", q[pairs[0][a : a + 200_000]], x[pairs[1][a : a + 200_000]]) for a in range(0, len(pairs[0]), 200_000)]
    )


def search_block(q_ids, q, x_ids, x, k: int, levels=LEVELS, rows: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, vector, score)`` with every query's k best of ``x``, ties to smaller ids; queries by row if ``rows``."""
    largest = max(np.abs(q).max(initial=0), np.abs(x).max(initial=0))
    if largest**2 * q.shape[1] >= 2.0**53:  # doubles would round: integers from here on
        q, x, levels = q.astype(np.int64), x.astype(np.int64), ()
    length_q, length_x = (np.sqrt(np.einsum("ij,ij->i", m, m, dtype=np.float64)) for m in (q, x))
    stats = [(_statistics(q, s), _statistics(x, s)) for s in levels]
    found: list[tuple] = []
    for a in range(0, len(q), TOGETHER):
        now = slice(a, a + TOGETHER)
        own = q_ids[now][:, None] == x_ids[None, :]
        many = len(own)
        if levels:
            slack = 1e-9 * (1 + length_q[now][:, None] * length_x[None, :])
            bound = np.where(own, -np.inf, stats[0][0][now] @ stats[0][1].T + slack)
            seeds = min(4 * k, bound.shape[1])
            best = np.argpartition(-bound, seeds - 1, axis=1)[:, :seeds]
            tried = np.einsum("ij,ikj->ik", q[now], x[best])
            tried[np.take_along_axis(own, best, axis=1)] = -np.inf
            kth = np.partition(tried, seeds - k, axis=1)[:, seeds - k] if seeds >= k else np.full(many, -np.inf)
            alive = (bound >= kth[:, None]) & ~own
            for fine_q, fine_x in stats[1:]:
                if alive.mean() > 0.2:
                    alive &= fine_q[now] @ fine_x.T + slack >= kth[:, None]
                else:
                    i, j = np.nonzero(alive)
                    alive[i, j] = _exact(fine_q[now], fine_x, (i, j)) + slack[i, j] >= kth[i]
        else:
            alive, kth = ~own, None
        i, j = np.nonzero(alive)
        if alive.mean() > 0.1:
            score = (q[now] @ x.T)[i, j]
        else:
            score = _exact(q[now], x, (i, j))
        if kth is not None:
            good = score >= kth[i]
            i, j, score = i[good], j[good], score[good]
        order = np.lexsort((x_ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        i, j, score = i[rank < k], j[rank < k], score[rank < k]
        found.append((i + a if rows else q_ids[now][i], x_ids[j], score.astype(np.int64)))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3


def _searcher(k: int, scale: float):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["dim", "q_block", "x_block"]
        for rows in whole_groups(batches, keys, CANDIDATES):
            key = np.stack([np.asarray(rows[c]) for c in keys])
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            for start, end in zip([0, *cuts], [*cuts, rows.num_rows], strict=True):
                part = rows.slice(start, end - start).combine_chunks()
                flat = part["vec"].combine_chunks().flatten()
                ints = np.floor(scale * np.asarray(flat, dtype=np.float64)).reshape(part.num_rows, -1)
                ids, query = np.asarray(part["id"]), np.asarray(part["query"])
                if query.all() or not query.any():
                    continue
                a, b, s = search_block(ids[query], ints[query], ids[~query], ints[~query], k, rows=True)
                found = {"query_id": ids[query][a], "query_hash": np.asarray(part["h"])[query][a], "vec_id": b, "score": s}
                yield pa.RecordBatch.from_pydict(found)

    return search


def segment_search(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 20, k: int = 20, scale: float = 64
) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of floor(scale * x) per query.

    Queries are the rows whose id is divisible by ``every``; candidates are all other
    rows of the same length. Ties go to the smaller vec_id. Vectors that are null, empty
    or hold null or non-finite components, and rows without an id, take no part. A
    repeated id is a query once for each different vector (told apart by a 64-bit hash),
    with a list of its own for each, and never its own candidate; its rows are separate candidates.
    Scores must stay below 2**63. Queries meet candidates in pairs of blocks of a fixed
    size; each pair gives at most k rows a query.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec")).filter(
        F.expr("id is not null and size(vec) > 0 and forall(vec, x -> x is not null and abs(x) < double('infinity'))")
    )
    rows = rows.select("id", "vec", F.size("vec").alias("dim"), F.xxhash64("id", "vec").alias("h"))
    x_blocks = max(1, -(-rows.count() // CANDIDATES))
    chosen = rows.filter(F.pmod("id", F.lit(every)) == 0).dropDuplicates(["id", "h"])
    q_blocks = max(1, -(-chosen.count() // QUERIES))
    q = chosen.withColumn("q_block", F.pmod("h", F.lit(q_blocks)).cast("int"))
    q = q.withColumn("x_block", F.explode(F.sequence(F.lit(0), F.lit(x_blocks - 1)))).withColumn("query", F.lit(True))
    x = rows.withColumn("x_block", F.pmod("h", F.lit(x_blocks)).cast("int"))
    x = x.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))).withColumn("query", F.lit(False))
    columns, keys = ["dim", "q_block", "x_block", "id", "h", "vec", "query"], ["dim", "q_block", "x_block"]
    dealt = q.select(columns).union(x.select(columns)).repartition(*keys).sortWithinPartitions(*keys)
    found = map_arrow(dealt, _searcher(k, scale), "query_id long, query_hash long, vec_id long, score long")
    order = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
