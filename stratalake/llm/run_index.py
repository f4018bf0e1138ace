"""Exact repeats of long byte strings, by grouping anchors that are sampled by content.

No Burrows-Wheeler transform and no suffix array is built. Each window of ``length`` bytes
contributes the position of its least ``GRAM``-byte hash (an anchor). Equal windows choose
the same anchor at the same place, so every repeat of ``length`` bytes shows as two anchors
with the same gram. Anchors are grouped by gram and by a hash of their context, all bytes in
which a window with the anchor can start; a group is kept once, with its size and a sampled
position, and a group of two or more is repeated from end to end. Where a gram has several
groups, the windows that start 0, 1, 2 ... bytes before its anchors are compared by 64-bit
hashes: a window repeats if another has the same hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_blocks, map_arrow, whole_groups, with_keys, written
from .shingles import STRETCH, mix, powers, text_bytes

GRAM = 24
#: Runs of one gram that are compared as one block.
BLOCK = 8192


def _anchors(raw: np.ndarray, offsets: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> tuple:
    """Row, position, gram hash and context hash of the anchors of windows that start in [first, last) of each row."""
    p = powers()
    if len(raw) < length:
        return (np.zeros(0, np.int64),) * 4
    sums = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * p[: len(raw)], dtype=np.uint64)])
    n = len(raw) - GRAM + 1
    gram = mix((sums[GRAM:] - sums[:-GRAM]) * p[2 * STRETCH - np.arange(n)])
    place = np.uint64((1 << 23) - 1)
    least = (gram & ~place) | np.arange(n, dtype=np.uint64)
    width, reach = length - GRAM + 1, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: n - width + 1], least[width - reach : n - reach + 1])
    change = np.zeros(len(least) + 1, np.int32)
    some = last > first
    np.add.at(change, first[some], 1)
    np.add.at(change, last[some], -1)
    starts = np.flatnonzero(np.cumsum(change[:-1]))
    at = (least[starts] & place).astype(np.int64)
    row = np.searchsorted(offsets, starts, side="right") - 1
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    at, row = at[new], row[new]
    left = np.minimum(at - offsets[row], length - GRAM)
    end = np.minimum(at + length, offsets[row + 1])
    context = (sums[end] - sums[at - left]) * p[2 * STRETCH - (at - left)]
    context = mix(context ^ mix((left << 32 | (end - at)).astype(np.uint64)))
    return row, at - offsets[row], gram[at], context


def _finder(length: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            row, rows = 0, len(offsets) - 1
            while row < rows:
                end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + STRETCH, side="right")) - 1)
                a, b = int(offsets[row]), int(offsets[end])
                if b - a <= STRETCH:
                    own = offsets[row : end + 1] - a
                    at, pos, gram, context = _anchors(raw[a:b], own, own[:-1], own[1:] - length + 1, length)
                else:  # one long text, in stretches that see as far as a window and its context reach
                    parts = []
                    for start in range(a, b - length + 1, STRETCH):
                        low, high = max(a, start - length), min(b, start + STRETCH + 2 * length)
                        first, last = start - low, min(start + STRETCH, b - length + 1) - low
                        _, p, g, c = _anchors(raw[low:high], np.array([0, high - low]), np.array([first]), np.array([last]), length)
                        parts.append((p + low - a, g, c))
                    pos, gram, context = (np.concatenate(x) for x in zip(*parts, strict=True))
                    pos, where = np.unique(pos, return_index=True)
                    gram, context, at = gram[where], context[where], np.zeros(len(where), np.int64)
                if len(pos):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(gram.view(np.int64)), pa.array(context.view(np.int64)), batch.column("doc_id").take(pa.array(at + row)),
                         batch.column("tid").take(pa.array(at + row)), pa.array(pos)],
                        names=["gram", "context", "doc_id", "tid", "pos"],
                    )
                row = end

    return find


def _contexts(length: int):
    """The bytes around the positions listed with each text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            lists = batch.column("wanted")
            counts = np.diff(np.asarray(lists.offsets))
            flat = lists.flatten()
            row = np.repeat(np.arange(len(counts)), counts)
            pos = np.asarray(flat.field("pos"))
            at = offsets[row] + pos
            start, end = np.maximum(at - (length - GRAM), offsets[row]), np.minimum(at + length, offsets[row + 1])
            whole = raw.tobytes() if len(raw) < 64 * STRETCH else None
            view = memoryview(whole if whole is not None else raw)
            out = pa.RecordBatch.from_arrays(
                [flat.field("gram"), flat.field("copies"), batch.column("doc_id").take(pa.array(row)), batch.column("tid").take(pa.array(row)), pa.array(pos),
                 pa.array([bytes(view[a:b]) for a, b in zip(start, at, strict=True)], pa.binary()),
                 pa.array([bytes(view[a:b]) for a, b in zip(at, end, strict=True)], pa.binary())],
                names=["gram", "copies", "doc_id", "tid", "pos", "before", "after"],
            )
            yield out

    return cut


def matching_statistics(gram: np.ndarray, before: list[bytes], after: list[bytes], apart: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes to the left and right of each run's anchor that lie in a match of ``length`` with another run of its gram.

    The suffixes that start the same number of bytes before the anchor are sorted by
    (gram, hash of their first ``length`` bytes); one has a match of that length if a
    neighbour in this order is equal and has another number in ``apart``. The farthest
    start with a match gives the bytes to the left, the nearest one those to the right.
    """
    reach, p = length - GRAM, powers()
    left, right = np.array([len(v) for v in before]), np.array([len(v) for v in after])
    joined = b"".join(v.rjust(reach, b"\0") + w.ljust(length, b"\0") for v, w in zip(before, after, strict=True))
    joined = np.frombuffer(joined, np.uint8).reshape(-1, reach + length)
    sums = np.zeros((reach + length + 1, len(gram)), np.uint64)
    for part in range(0, len(gram), 2000):  # unfolded to eight bytes a byte
        cells = joined[part : part + 2000].astype(np.uint64) + np.uint64(1)
        sums[1:, part : part + 2000] = np.cumsum((cells * p[: reach + length]).T, axis=0)
    own = mix(gram.astype(np.uint64))
    most_left, most_right = np.zeros(len(gram), np.int64), np.zeros(len(gram), np.int64)
    for start in range(reach, -1, -1):  # bytes before the anchor: reach - start
        back = reach - start
        rows = np.flatnonzero((left >= back) & (right >= length - back))
        suffix = (sums[start + length, rows] - sums[start, rows]) * p[reach - start] + own[rows]
        order = np.argsort(suffix)
        suffix, label = suffix[order], apart[rows[order]]
        new = np.ones(len(rows), bool)
        new[1:] = suffix[1:] != suffix[:-1]
        first = np.flatnonzero(new)
        if len(first) == len(rows):
            continue
        several = np.minimum.reduceat(label, first) != np.maximum.reduceat(label, first)
        hit = rows[order[several[np.cumsum(new) - 1]]]
        most_left[hit] = back  # grows from round to round
        most_right[hit] = np.maximum(most_right[hit], length - back)
    return most_left, most_right


def _streamer(length: int):
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["gram", "left_block", "right_block"]
        for rows in whole_groups(batches, keys, 5_000):
            key = np.stack([np.asarray(rows[k]) for k in keys])
            _, number = np.unique(key, axis=1, return_inverse=True)
            number = number.reshape(-1)
            # within one block all rows count as different, across two only those of different blocks
            apart = np.where(key[1] != key[2], np.asarray(rows["block"]), -1 - np.arange(rows.num_rows))
            left, right = matching_statistics(number, rows["before"].to_pylist(), rows["after"].to_pylist(), apart, length)
            pos, copies = np.asarray(rows["pos"]), np.asarray(rows["copies"])
            found = np.flatnonzero((right > 0) & (copies == 1))
            taken = rows.take(pa.array(found))
            yield pa.RecordBatch.from_arrays(
                [taken["doc_id"].combine_chunks(), taken["tid"].combine_chunks(), pa.array(pos[found] - left[found]), pa.array(pos[found] + right[found])],
                names=["doc_id", "tid", "first", "last"],
            )

    return stream


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the number that tells rows of one doc_id apart."""
    return docs.withColumn("__tid", F.xxhash64(F.coalesce("text", F.lit(""))))


def repeated_spans(docs: DataFrame, length: int = 200) -> DataFrame:
    """Spans of bytes ``(doc_id, tid, spans)`` of ``docs(doc_id, text)`` that occur elsewhere as part of ``length`` equal bytes.

    ``tid`` is xxhash64 of the text, which tells rows of one doc_id apart; spans may
    overlap. Null texts are empty; texts below ``length`` bytes have no spans. Equal rows
    repeat each other.
    """
    rows = keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")))
    rows = rows.withColumnRenamed("__tid", "tid")
    anchors = written(
        map_arrow(rows, _finder(length), "gram long, context long, doc_id long, tid long, pos long"), "anchors"
    )
    grams = anchors.groupBy("gram").agg(
        F.count(F.lit(1)).alias("n"), F.min("context").alias("c1"), F.max("context").alias("c2")
    )
    grams = written(grams.filter("n > 1").select("gram", (F.col("c1") != F.col("c2")).alias("several")), "grams")
    met = written(anchors.join(grams, "gram"), "repeated-anchors")
    runs = met.filter("several").groupBy("gram", "context").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "tid", "pos")).alias("sample")
    )
    runs = written(runs.select("gram", "context", "copies", "sample.*"), "runs")

    # Runs of one context are repeated throughout: every occurrence is covered from end to end.
    many = runs.filter("copies > 1").select("gram", "context").withColumn("whole", F.lit(True))
    alike = met.join(many, ["gram", "context"], "left").filter("whole or not several")
    covered = alike.select("doc_id", "tid", (F.col("pos") - (length - GRAM)).alias("first"), (F.col("pos") + length).alias("last"))

    wanted = runs.groupBy("doc_id", "tid").agg(F.collect_list(F.struct("gram", "copies", "pos")).alias("wanted"))
    wanted = written(wanted, "wanted")
    texts = with_keys(rows, wanted.select("doc_id", "tid"), ["doc_id", "tid"])
    around = texts.alias("t").join(wanted.alias("w"), F.expr("t.doc_id <=> w.doc_id and t.tid = w.tid")).select("t.doc_id", "t.tid", "t.text", "w.wanted")
    bits = map_arrow(around, _contexts(length), "gram long, copies long, doc_id long, tid long, pos long, before binary, after binary")
    keys = ["gram", "left_block", "right_block"]
    dealt = in_blocks(written(bits, "contexts").withColumn("run", F.xxhash64("before", "after")), ["gram"], "run", BLOCK)
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys)
    partly = map_arrow(dealt.drop("run"), _streamer(length), "doc_id long, tid long, first long, last long")
    spans = covered.union(partly).groupBy("doc_id", "tid").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    return written(spans, "spans")


def _merged(first: np.ndarray, last: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes in the union of spans."""
    first, last = np.maximum(first, 0), np.minimum(last, size)
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(last[order])
    new = np.ones(len(first), bool)
    new[1:] = first[1:] > reach[:-1]
    return first[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(first) - 1)] if len(first) else last


def _cut(text: bytes, spans: pa.Array) -> tuple[bytes, int]:
    """What is left of a text, and how many runs were removed."""
    a, b = _merged(np.asarray(spans.field("first")), np.asarray(spans.field("last")), len(text))
    return b"".join(text[x:y] for x, y in zip([0, *b], [*a, len(text)], strict=True)), len(a)


def _reporter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc_id, text, spans in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("spans"), strict=True):
            text = text.as_buffer().to_pybytes()
            left, n = _cut(text, spans.values)
            out.append((doc_id, len(text), len(text) - len(left), n, hashlib.sha256(left).hexdigest()))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)] if out else [pa.array([], t) for t in kinds],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def _with_spans(rows: DataFrame, spans: DataFrame, id_name: str) -> DataFrame:
    hit = with_keys(rows, spans.select(F.col("doc_id").alias(id_name), F.col("tid").alias("__tid")), [id_name, "__tid"])
    found = spans.select(F.col("doc_id").alias("__id"), F.col("tid").alias("__text"), F.col("spans").alias("__spans"))
    return hit.join(found, F.col(id_name).eqNullSafe(F.col("__id")) & (F.col("__tid") == F.col("__text"))).drop("__id", "__text")


def repeat_report(docs: DataFrame, length: int = 200) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 once all repeated bytes are removed.

    Rows without repeats never leave Spark's own functions.
    """
    spans = repeated_spans(docs, length)
    rows = keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")))
    hit = _with_spans(rows, spans, "doc_id").select("doc_id", "text", F.col("__spans").alias("spans"))
    cut = map_arrow(hit, _reporter, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    keys = spans.select("doc_id", F.col("tid").alias("__tid"))
    rest = with_keys(rows, keys, ["doc_id", "__tid"], "left_anti").select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"),
        F.sha2(F.encode("text", "utf-8"), 256).alias("kept_sha256"),
    )
    return cut.union(rest)


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("text"), batch.column("__spans"), strict=True)
        texts = [_cut(t.as_buffer().to_pybytes(), s.values)[0].decode("utf-8", "ignore") for t, s in pairs]
        names = [n for n in batch.schema.names if n != "__spans"]
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names], names=names)


def cut_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """``docs`` with repeated bytes removed from ``text``; characters cut through go whole. Other columns stay.

    ``__tid`` and ``__spans`` are used inside: columns of these names are refused.
    """
    if clash := {"__tid", "__spans"} & set(docs.columns):
        raise ValueError(f"columns with names used inside: {', '.join(sorted(clash))}")
    spans = repeated_spans(docs, length)
    columns = [f"`{c}`" for c in docs.columns]
    rows = keyed(docs)
    hit = _with_spans(rows.filter("text is not null"), spans, "doc_id")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    cut = map_arrow(hit.select(*columns, "__spans"), _cutter, schema)
    keys = spans.select("doc_id", F.col("tid").alias("__tid"))
    rest = with_keys(rows, keys, ["doc_id", "__tid"], "left_anti").select(*columns)
    return cut.union(rest)
