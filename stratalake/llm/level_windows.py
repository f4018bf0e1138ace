"""Repeated windows of words, found level by level: only what repeats at one length is looked at at twice that length."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, with_keys, written
from .words import Words, byte_class, mixed, shards

#: Every byte but space, tab, line feed, vertical tab, form feed and carriage return.
WORD_BYTES = byte_class((0, 8), (14, 31), (33, 255))
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LAST = (1 << 63) - 1

_PROFILE = "doc_id long, place long, tid long, n_words long, sha string, keys array<long>"
_KEYS = "place long, tid long, keys array<long>"
_WINDOWS = "a long, b long, least long, most long, members array<struct<place: long, tid: long, start: int>>"
_CUT = "place long, tid long, n_removed long, kept_sha256 string"


def levels(length: int) -> list[int]:
    """The lengths of the levels: a quarter, a half, the whole."""
    return sorted({max(1, length // 4), max(1, length // 2), length})


def _joined_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(a * _ODD + b)


def _sliding(values: np.ndarray, length: int, join: Callable) -> np.ndarray:
    """``join`` over every stretch of ``length`` values, from stretches of 1, 2, 4, ... values."""
    if len(values) < length:
        return values[:0]
    found, done, size = None, 0, 1
    n = len(values) - length + 1
    while True:
        if length & size:
            found = values[:n] if found is None else join(found, values[done : done + n])
            done += size
        if done == length:
            return found
        values = join(values[:-size], values[size:])
        size *= 2


def _windows(words: Words, length: int) -> np.ndarray:
    """Numbers of the words that start a window of ``length`` words of one text."""
    if len(words.doc) < length:
        return np.empty(0, dtype=np.int64)
    return np.flatnonzero(words.doc[: len(words.doc) - length + 1] == words.doc[length - 1 :])


def _level_keys(hashes: np.ndarray, level: int, length: int) -> np.ndarray:
    """For each window of ``length`` words the least hash of the windows of ``level`` words in it.

    It depends on the window's words alone, so two equal windows agree at every level.
    """
    return _sliding(_sliding(hashes, level, _joined_hash), length - level + 1, np.minimum)


def _per_text(words: Words, where: np.ndarray, keys: np.ndarray) -> pa.Array:
    """The distinct keys of each text as a list."""
    doc, keys = words.doc[where], keys[where]
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])  # neighbours mostly share their key
    doc, keys = doc[fresh], keys[fresh]
    order = np.lexsort((keys, doc))
    doc, keys = doc[order], keys[order]
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    offsets = np.zeros(words.documents + 1, dtype=np.int32)
    np.cumsum(np.bincount(doc[fresh], minlength=words.documents), out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[fresh].view(np.int64)))


def _profile(length: int) -> Callable:
    """Words and SHA-256 of every text and its keys of the first level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, "text"):
            words = Words(shard["text"], WORD_BYTES)
            body, offsets = words.joined()
            body, cuts = memoryview(body), offsets.tolist()
            keys = _level_keys(words.hashes(), levels(length)[0], length)
            yield pa.RecordBatch.from_arrays(
                [
                    *(shard[c].combine_chunks() for c in ("doc_id", "place", "tid")),
                    pa.array(np.bincount(words.doc, minlength=words.documents)),
                    pa.array([hashlib.sha256(body[a:b]).hexdigest() for a, b in zip(cuts, cuts[1:], strict=False)]),
                    _per_text(words, _windows(words, length), keys),
                ],
                names=["doc_id", "place", "tid", "n_words", "sha", "keys"],
            )

    return run


def _candidates(words: Words, shard: pa.Table, level: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes, and the windows whose key at ``level`` is among the shard's repeated ``keys``."""
    hashes = words.hashes()
    known = np.unique(shard["keys"].combine_chunks().flatten().to_numpy().view(np.uint64))
    where = _windows(words, length)
    keys = _level_keys(hashes, level, length)[where]
    place = np.minimum(np.searchsorted(known, keys), max(0, len(known) - 1))
    return hashes, where[known[place] == keys] if len(known) else where[:0]


def _next_keys(before: int, level: int, length: int) -> Callable:
    """Keys at ``level`` of the windows whose key at the level before repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, "text"):
            words = Words(shard["text"], WORD_BYTES)
            hashes, where = _candidates(words, shard, before, length)
            found = _per_text(words, where, _level_keys(hashes, level, length))
            yield pa.RecordBatch.from_arrays(
                [shard["place"].combine_chunks(), shard["tid"].combine_chunks(), found], names=["place", "tid", "keys"]
            )

    return run


def _whole_windows(before: int, length: int) -> Callable:
    """Windows of the whole length by two hashes, those of a shard that are equal in one row with all their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, "text"):
            words = Words(shard["text"], WORD_BYTES)
            hashes, where = _candidates(words, shard, before, length)
            if not len(where):
                continue
            a = _sliding(hashes, length, _joined_hash)[where]
            b = _sliding(words.hashes(seed=1), length, _joined_hash)[where]
            place, tid = (shard[c].to_numpy()[words.doc[where]] for c in ("place", "tid"))
            start = (where - np.searchsorted(words.doc, words.doc[where])).astype(np.int32)
            order = np.lexsort((place, b, a))
            a, b, place, tid, start = (x[order] for x in (a, b, place, tid, start))
            fresh = np.ones(len(a), dtype=bool)
            fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            at = np.flatnonzero(fresh)
            ends = np.append(at[1:], len(a))
            members = pa.StructArray.from_arrays([pa.array(place), pa.array(tid), pa.array(start)], ["place", "tid", "start"])
            out = pa.table(
                {
                    "a": a[at].view(np.int64),
                    "b": b[at].view(np.int64),
                    "least": place[at],
                    "most": place[ends - 1],
                    "members": pa.ListArray.from_arrays(pa.array(np.append(at, len(a)).astype(np.int32)), members),
                }
            )
            yield from out.to_batches(max_chunksize=50_000)

    return run


def _cut(length: int) -> Callable:
    """What is left of texts when the words of the windows at ``starts`` go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, "text"):
            words = Words(shard["text"], WORD_BYTES)
            lists = shard["starts"].combine_chunks()
            doc = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            at = np.searchsorted(words.doc, doc) + lists.flatten().to_numpy()
            change = np.zeros(len(words.doc) + 1, dtype=np.int32)
            np.add.at(change, at, 1)
            np.add.at(change, at + length, -1)
            gone = np.cumsum(change[:-1]) > 0
            body, offsets = words.joined(~gone)
            body, cuts = memoryview(body), offsets.tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    shard["place"].combine_chunks(),
                    shard["tid"].combine_chunks(),
                    pa.array(np.bincount(words.doc[gone], minlength=words.documents)),
                    pa.array([hashlib.sha256(body[a:b]).hexdigest() for a, b in zip(cuts, cuts[1:], strict=False)]),
                ],
                names=["place", "tid", "n_removed", "kept_sha256"],
            )

    return run


def _repeating(found: DataFrame, label: str) -> DataFrame:
    """``(place, tid, keys)``: of the keys of each text those that texts with another doc_id have too.

    Each text brings a key once, and the least and largest place of a key are combined
    before the shuffle. The join back has one row per key on its other side; adaptive
    execution splits a key that very many texts share.
    """
    pairs = found.select("place", "tid", F.explode("keys").alias("key"))
    again = pairs.groupBy("key").agg(F.min("place").alias("least"), F.max("place").alias("most"))
    again = written(again.filter("least < most").select("key"), label)
    return written(pairs.join(again, "key").groupBy("place", "tid").agg(F.collect_list("key").alias("keys")), label + "-texts")


def repeated_windows(docs: DataFrame, length: int = 50) -> DataFrame:
    """Removes the words of windows that a document with a smaller doc_id holds too.

    Words of ``docs(doc_id, text)`` are runs of anything but ASCII white space, unchanged; a
    window is ``length`` consecutive words of one document. A word goes if a window that
    covers it has its sequence of words also in a document with a smaller doc_id; windows
    are judged on the input. Returns one row per row of ``docs``: ``doc_id, n_words,
    n_removed, kept_sha256`` (of the kept words, one space between two).

    Of texts with the same words only the least doc_id goes on. Level by level (a quarter of
    the length, a half, the whole) each window is told by the least hash among its windows of
    that level's length; only windows whose key is shared with another doc_id are extended to
    the next level, and the search ends when none is left. Whole windows are compared by 128
    bits of hashes, all of them, wherever they start.

    Null texts have no words. A null doc_id counts like the largest possible one: its words go
    if a smaller doc_id has them. Rows with equal doc_id do not remove each other's words;
    repeated rows get the same result each. Other columns are not read; an empty table gives
    no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumns({"place": F.coalesce("doc_id", F.lit(_LAST)), "tid": F.xxhash64("text")})
    profile = written(map_arrow(rows, _profile(length), _PROFILE), "profile")
    copied = profile.filter(F.col("n_words") >= length).groupBy("sha").agg(F.min("place").alias("least"), F.max("place").alias("most"))
    copied = written(copied.filter("least < most").select("sha", "least"), "copied")
    flagged = profile.join(copied, "sha", "left").withColumn("copy", F.coalesce(F.col("place") > F.col("least"), F.lit(False)))

    steps = levels(length)
    firsts = flagged.filter(~F.col("copy") & (F.size("keys") > 0)).select("place", "tid", "keys").dropDuplicates(["place", "tid"])
    keys = _repeating(firsts, f"level-{steps[0]}")
    texts = with_keys(rows.select("place", "tid", "text"), written(keys.select("place", "tid"), "texts-left"), ["place", "tid"])
    texts = written(texts.dropDuplicates(["place", "tid"]).join(keys, ["place", "tid"]), "candidates")
    for before, level in zip(steps, steps[1:-1], strict=False):
        keys = _repeating(map_arrow(texts, _next_keys(before, level, length), _KEYS), f"level-{level}")
        texts = texts.drop("keys").join(keys, ["place", "tid"])
    before = steps[-2] if len(steps) > 1 else steps[-1]
    windows = written(map_arrow(texts, _whole_windows(before, length), _WINDOWS), "windows")
    owners = windows.groupBy("a", "b").agg(F.min("least").alias("owner"), F.max("most").alias("last"))
    owners = written(owners.filter("owner < last").select("a", "b", "owner"), "owners")
    hits = windows.join(owners, ["a", "b"]).filter("most > owner")
    hits = hits.select("owner", F.explode("members").alias("m")).filter("m.place > owner")
    starts = hits.groupBy("m.place", "m.tid").agg(F.collect_list("m.start").alias("starts"))
    cut = texts.drop("keys").join(written(starts, "starts"), ["place", "tid"])
    cut = written(map_arrow(cut, _cut(length), _CUT), "cut")
    return (
        flagged.drop("keys")
        .join(cut, ["place", "tid"], "left")
        .select(
            "doc_id",
            "n_words",
            F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(F.col("copy"), F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        )
    )
