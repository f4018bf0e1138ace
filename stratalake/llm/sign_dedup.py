"""Near-duplicate vectors: random-hyperplane sign hashing in several tables, exact cosine, components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_blocks, map_arrow, whole_groups, written
from .components import components

#: Mean members a bucket should have, fewest sign bits, most members verified as one block.
BUCKET, FEWEST_BITS, BLOCK = 512, 6, 2048


def plan_tables(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """``(bits, tables)``: bits keep buckets near BUCKET members, tables reach ``recall`` at ``threshold``."""
    bits = max(FEWEST_BITS, math.ceil(math.log2(max(n, 1) / BUCKET)))
    together = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - together)))


def _signs(vectors: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """The bucket of each vector in each table."""
    planes = np.random.default_rng([seed, vectors.shape[1]]).standard_normal((vectors.shape[1], tables * bits))
    above = (vectors @ planes >= 0).reshape(len(vectors), tables, bits)
    return above @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), dtype=np.float64).reshape(-1, dim)


def _hasher(bits: int, tables: int, seed: int):
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                buckets = _signs(_matrix(part.column("vec"), dim), bits, tables, seed)
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((np.int64(t) << bits) | buckets[:, t]), *(part.column(c) for c in ("dim", "rep", "copies", "vec"))],
                        ["bucket", "dim", "rep", "copies", "vec"],
                    )

    return hashed


def _verifier(bits: int, tables: int, seed: int, threshold: float):
    def links(vectors: np.ndarray, block: np.ndarray, table: int, pair: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        unit = scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]
        left = np.flatnonzero(block == pair[0])
        right = left if pair[0] == pair[1] else np.flatnonzero(block == pair[1])
        i, j = np.nonzero(unit[left] @ unit[right].T >= threshold - 1e-9)
        i, j = left[i], right[j]
        if pair[0] == pair[1]:
            i, j = i[i < j], j[i < j]
        norms = np.sqrt(np.einsum("ij,ij->i", scaled, scaled))
        exact = np.einsum("ij,ij->i", scaled[i], scaled[j]) / (norms[i] * norms[j]) >= threshold
        i, j = i[exact], j[exact]
        if table and len(i):  # a pair counts in the first table that brings it together
            ends, at = np.unique(np.concatenate([i, j]), return_inverse=True)
            signs = _signs(vectors[ends], bits, tables, seed)[:, :table]
            first = ~(signs[at[: len(i)]] == signs[at[len(i) :]]).any(axis=1)
            i, j = i[first], j[first]
        return i, j

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["dim", "bucket", "left_block", "right_block"]
        for rows in whole_groups(batches, keys):
            key = np.stack([np.asarray(rows[k]) for k in keys])
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            rep, copies, block = (np.asarray(rows[c]) for c in ("rep", "copies", "block"))
            a, b, n = [], [], []
            for start, end in zip([0, *cuts], [*cuts, rows.num_rows], strict=True):
                if end - start < 2:
                    continue
                dim, bucket, one, two = (int(x) for x in key[:, start])
                vectors = _matrix(rows["vec"].slice(start, end - start), dim)
                i, j = links(vectors, block[start:end], bucket >> bits, (one, two))
                if not len(i):
                    continue
                i, j = i + start, j + start
                weight = np.bincount(np.concatenate([i, j]), np.concatenate([copies[j], copies[i]]), rows.num_rows)
                linked = np.flatnonzero(weight)
                a += [rep[linked]]
                b += [np.full(len(linked), -1)]
                n += [weight[linked].astype(np.int64)]
                roots = spanning(i, j, rows.num_rows)
                a += [rep[roots[0]]]
                b += [rep[roots[1]]]
                n += [np.zeros(len(roots[0]), np.int64)]
            if a:
                b_all, n_all = np.concatenate(b), np.concatenate(n)
                yield pa.RecordBatch.from_pydict({"a": np.concatenate(a), "b": pa.array(b_all, mask=n_all > 0), "n": n_all})

    return verify


def spanning(i: np.ndarray, j: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges ``(root, member)`` that connect what the edges ``(i, j)`` connect, one for each non-root."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        label = label[label]
        if (label == before).all():
            break
    members = np.flatnonzero(label != np.arange(size))
    return label[members], members


def sign_dedup(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9, recall: float = 0.999, seed: int = 9
) -> DataFrame:
    """Per row of ``vectors``: id, n_links, component_id, kept.

    Pairs that share a bucket in some table and have cosine >= ``threshold`` in double
    precision are linked; a pair exactly at the threshold is found with probability
    ``recall``, closer ones more surely. Equal vectors are one class, hashed once and
    linked to each other without comparing. Buckets of more than BLOCK classes are
    dealt to pairs of blocks. Null, empty or zero vectors and ones with null or
    non-finite components link with nothing, as do vectors of other lengths. A row
    without an id has no links and a null component. Repeated ids are separate rows: one
    with another vector has links and a component of its own.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    fit = F.expr(
        "id is not null and size(vec) > 0 and forall(vec, x -> x is not null and abs(x) < double('infinity'))"
        " and exists(vec, x -> x != 0)"
    )
    rows = rows.withColumn("fit", F.coalesce(fit, F.lit(False)))
    classes = rows.filter("fit").groupBy("vec").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    # a class has a number of its own, as several classes may hold one id
    classes = classes.withColumns({"dim": F.size("vec"), "rep": F.monotonically_increasing_id()})
    classes = written(classes, "vectors")
    bits, tables = plan_tables(classes.count(), threshold, recall)
    kind = classes.schema["vec"].dataType.elementType.simpleString()
    hashed = map_arrow(
        classes, _hasher(bits, tables, seed), f"bucket long, dim int, rep long, copies long, vec array<{kind}>"
    )
    dealt = in_blocks(written(hashed, "buckets"), ["dim", "bucket"], "rep", BLOCK)
    keys = ["dim", "bucket", "left_block", "right_block"]
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys)
    found = written(map_arrow(dealt, _verifier(bits, tables, seed, threshold), "a long, b long, n long"), "links")
    degree = found.filter("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    groups = components(found.filter("b is not null").select("a", "b")).withColumnsRenamed({"id": "rep", "component": "root"})
    groups = written(groups.join(classes.select("rep", "least"), "rep"), "groups")
    named = groups.groupBy("root").agg(F.min("least").alias("component"))
    groups = groups.join(named, "root").select("rep", "component")
    reps = classes.join(degree, "rep", "left").join(groups, "rep", "left")
    reps = written(reps.select("vec", "copies", "others", F.coalesce("component", "least").alias("component")), "classes")
    joined = rows.join(reps.withColumn("fit", F.lit(True)), ["vec", "fit"], "left")
    component = F.coalesce("component", "id")
    return joined.select(
        F.col("id").alias("vec_id"),
        (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("others", F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
