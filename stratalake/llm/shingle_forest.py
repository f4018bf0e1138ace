"""Near-duplicate join on word shingles: MinHash in fixed bands (called trees here), then exact Jaccard similarity.

Each document has one key per band, a hash of the band's MinHash values. Two documents
are candidates if they share a key. The length of the bands is the longest at which a pair at
the threshold is found with the target probability, 1 - (1 - s^length)^trees. It is the
same for all documents: bands replace a forest, whose prefixes are shortened by data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_blocks, map_arrow, whole_groups, written
from .components import components
from .shingles import mix, shingle_sets
from .sign_dedup import spanning

TREES, DEPTH, RECALL = 24, 8, 0.9999
#: Members of a bucket, and of a group of candidates, that are compared as one block.
BUCKET_BLOCK, GROUP_BLOCK = 2048, 512
#: Cells of the 0/1 matrices that count common shingles.
CELLS = 8_000_000


def prefix_length(threshold: float, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix that reaches ``recall`` for pairs at ``threshold``."""
    for length in range(depth, 1, -1):
        if 1 - (1 - threshold**length) ** trees >= recall:
            return length
    return 1


def _sketcher(size: int, trees: int, length: int):
    """Per row: a digest of its shingle set, its size, a key per tree and a byte per MinHash value."""
    rng = np.random.default_rng(5)
    flips, factors = rng.integers(0, 1 << 63, (2, trees * length), dtype=np.uint64)
    factors |= np.uint64(1)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, sets in shingle_sets(batch.column("text"), size):
                counts = np.array([len(s) for s in sets])
                some = np.flatnonzero(counts)
                ids, texts = (batch.column(c).slice(row, len(sets)) for c in ("doc_id", "tid"))
                d1, d2 = np.zeros((2, len(sets)), np.uint64)
                keys = np.zeros((len(sets), trees), np.uint64)
                low = np.zeros((len(sets), trees * length), np.uint8)
                if len(some):
                    flat = np.concatenate([sets[i] for i in some])
                    starts = np.cumsum(counts[some]) - counts[some]
                    d1[some] = np.add.reduceat(mix(flat), starts)
                    d2[some] = np.add.reduceat(flat * flat, starts)
                    for j in range(trees * length):
                        least = np.minimum.reduceat((flat ^ flips[j]) * factors[j], starts) >> np.uint64(32)
                        low[some, j] = least.astype(np.uint8)
                        tree = j // length
                        keys[some, tree] = mix(keys[some, tree] * np.uint64(31) + least + np.uint64(tree + 1))
                yield pa.RecordBatch.from_arrays(
                    [ids, texts, pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), pa.array(counts, pa.int32()),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, trees), pa.int32()), pa.array(keys.reshape(-1).view(np.int64))),
                     pa.array([x.tobytes() for x in low], pa.binary())],
                    names=["doc_id", "tid", "d1", "d2", "n", "keys", "low"],
                )

    return sketch


def _cuts(rows: pa.Table, keys: list[str]) -> zip:
    key = np.stack([np.asarray(rows[k]) for k in keys])
    cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
    return zip([0, *cuts], [*cuts, rows.num_rows], strict=True)


def _candidates(threshold: float, values: int):
    """Within each bucket, edges that join the documents whose sketches and sizes allow the threshold."""
    # 5.5 deviations below what a pair at the threshold is expected to share
    least = threshold * values - 5.5 * np.sqrt(threshold * (1 - threshold) * values)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["key", "left_block", "right_block"]
        for rows in whole_groups(batches, keys):
            rep, n, block = (np.asarray(rows[c]) for c in ("rep", "n", "block"))
            one, two = np.asarray(rows["left_block"]), np.asarray(rows["right_block"])
            low = np.frombuffer(b"".join(rows["low"].to_pylist()), np.uint8).reshape(rows.num_rows, values)
            i_all, j_all = [], []
            for a, b in _cuts(rows, keys):
                if one[a] == two[a]:
                    left = right = np.arange(a, b)
                else:
                    left, right = (a + np.flatnonzero(block[a:b] == x) for x in (one[a], two[a]))
                for part in np.array_split(left, max(1, len(left) * len(right) * values // CELLS)):
                    same = (low[part][:, None, :] == low[right][None, :, :]).sum(axis=2, dtype=np.int32)
                    ratio = np.minimum.outer(n[part], n[right]) >= threshold * np.maximum.outer(n[part], n[right]) - 1e-9
                    i, j = np.nonzero((same >= least) & ratio)
                    i, j = part[i], right[j]
                    far = rep[i] != rep[j]
                    i_all.append(i[far])
                    j_all.append(j[far])
            if i_all and len(i := np.concatenate(i_all)):
                j = np.concatenate(j_all)
                names, at = np.unique(rep, return_inverse=True)  # a document is in many buckets
                roots, members = spanning(at[i], at[j], len(names))
                yield pa.RecordBatch.from_pydict({"a": names[roots], "b": names[members]})

    return find


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each left with each right set."""
    if len(left) * len(right) <= 16:
        return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in right] for x in left])
    flat = np.concatenate([*left, *right])
    values, at = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    total = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    width = max(1, CELLS // (len(left) + len(right)))
    for start in range(0, len(values), width):
        a, b = np.searchsorted(at, [start, start + width])
        cells = np.zeros((len(left) + len(right), width), np.float32)
        cells[owner[a:b], at[a:b] - start] = 1
        total += cells[: len(left)] @ cells[len(left) :].T
    return total


def _verifier(threshold: float):
    """Within each pair of blocks of a group of candidates: links by exact similarity."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["component", "left_block", "right_block"]
        for rows in whole_groups(batches, keys, 2_000):
            rep, copies, block = (np.asarray(rows[c]) for c in ("rep", "copies", "block"))
            one, two = np.asarray(rows["left_block"]), np.asarray(rows["right_block"])
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows["shingles"]]
            sizes = np.array([len(s) for s in sets])
            i_all, j_all = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for a, b in _cuts(rows, keys):
                if one[a] == two[a]:
                    left = right = np.arange(a, b)
                else:
                    left, right = (a + np.flatnonzero(block[a:b] == x) for x in (one[a], two[a]))
                if not len(left) or not len(right):
                    continue
                both = _common([sets[x] for x in left], [sets[x] for x in right])
                union = np.add.outer(sizes[left], sizes[right]) - both
                i, j = np.nonzero(both >= threshold * union - 1e-9)
                i, j = left[i], right[j]
                i, j = (i[i < j], j[i < j]) if one[a] == two[a] else (i, j)
                far = rep[i] != rep[j]
                i_all.append(i[far])
                j_all.append(j[far])
            i, j = np.concatenate(i_all), np.concatenate(j_all)
            if len(i):
                weight = np.bincount(np.concatenate([i, j]), np.concatenate([copies[j], copies[i]]), rows.num_rows).astype(np.int64)
                linked = np.flatnonzero(weight)
                roots, members = spanning(i, j, rows.num_rows)
                b_all = np.concatenate([np.full(len(linked), -1), rep[members]])
                n_all = np.concatenate([weight[linked], np.zeros(len(members), np.int64)])
                yield pa.RecordBatch.from_pydict({"a": np.concatenate([rep[linked], rep[roots]]), "b": pa.array(b_all, mask=n_all > 0), "n": n_all})

    return verify


def _setter(size: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, found in shingle_sets(batch.column("text"), size):
                part = batch.slice(row, len(found))
                yield pa.RecordBatch.from_arrays(
                    [part.column("component"), part.column("rep"), part.column("copies"), pa.array([s.tobytes() for s in found], pa.binary())],
                    names=["component", "rep", "copies", "shingles"],
                )

    return sets


def shingle_join(docs: DataFrame, size: int = 5, threshold: float = 0.8, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, class_id, n_links, kept.

    Documents whose sets of ``size``-word shingles have Jaccard similarity of at least
    ``threshold`` are linked; n_links counts a document's links, class_id is the
    smallest doc_id it reaches by links, kept marks that document. Documents with equal
    sets are one class: sketched together, linked without comparing. A text of fewer
    than ``size`` words is one shingle; null texts and texts without words link with
    nothing. Rows that repeat a doc_id count one by one, each with the links of its own
    text. Rows without a doc_id have no links and a null class_id.

    Buckets of one document are dropped before anything wide moves. What is left forms
    groups of candidates, each document's shingles travel to its group once, and large
    groups are dealt to pairs of blocks. No pairs leave a task, only counts of links
    and edges that span them.
    """
    length = prefix_length(threshold, trees, depth, recall)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("tid"), "text")
    sketches = written(
        map_arrow(rows, _sketcher(size, trees, length), "doc_id long, tid long, d1 long, d2 long, n int, keys array<long>, low binary"), "sketches"
    )
    fit = sketches.filter("doc_id is not null and n > 0")
    classes = fit.groupBy("d1", "d2", "n").agg(
        F.min(F.struct("doc_id", "tid")).alias("least"), F.count(F.lit(1)).alias("copies"),
        F.first("keys").alias("keys"), F.first("low").alias("low"),
    )
    # a doc_id can be in several classes, so classes have numbers of their own
    classes = written(classes.select(F.monotonically_increasing_id().alias("rep"), "*"), "shingle-classes")
    entries = classes.select(F.explode("keys").alias("key"), "rep")
    shared = written(entries.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key"), "shared")
    members = entries.join(shared, "key").join(classes.select("rep", "n", "low"), "rep").select("key", "rep", "n", "low")
    keys = ["key", "left_block", "right_block"]
    dealt = in_blocks(written(members, "members"), ["key"], "rep", BUCKET_BLOCK)
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys)
    groups = written(components(map_arrow(dealt, _candidates(threshold, trees * length), "a long, b long")), "groups")

    chosen = classes.select("rep", "copies", "least.doc_id", "least.tid").join(groups.withColumnRenamed("id", "rep"), "rep")
    texts = rows.join(chosen, ["doc_id", "tid"])
    # rows that repeat a doc_id and its text are one text of their class
    texts = texts.groupBy("doc_id", "tid", "component", "rep", "copies").agg(F.first("text").alias("text"))
    sets = map_arrow(texts.select("component", "rep", "copies", "text"), _setter(size), "component long, rep long, copies long, shingles binary")
    keys = ["component", "left_block", "right_block"]
    dealt = in_blocks(written(sets, "sets"), ["component"], "rep", GROUP_BLOCK)
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys)
    links = written(map_arrow(dealt, _verifier(threshold), "a long, b long, n long"), "links")
    others = links.filter("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    joined = components(links.filter("b is not null").select("a", "b")).withColumnRenamed("id", "rep")
    known = classes.select("d1", "d2", "n", "rep", "copies", F.col("least.doc_id").alias("own")).join(others, "rep", "left").join(joined, "rep", "left")
    known = written(known, "classes")
    least = written(known.filter("component is not null").groupBy("component").agg(F.min("own").alias("least")), "least-ids")
    known = known.join(least, "component", "left").select("d1", "d2", "n", "copies", "others", F.coalesce("least", "own").alias("class"))
    out = sketches.select("doc_id", "d1", "d2", F.when(F.col("doc_id").isNotNull(), F.col("n")).alias("n")).join(known, ["d1", "d2", "n"], "left")
    out = out.withColumn("class_id", F.coalesce("class", "doc_id"))
    return out.select(
        "doc_id",
        "class_id",
        (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("others", F.lit(0))).cast("long").alias("n_links"),
        F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"),
    )
