"""Words of many texts at once: pointers into the text buffer of an Arrow column, compared by slices of eight bytes."""

from __future__ import annotations

import copy
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Text bytes looked at in one go, and rows at most. A longer text is a shard of its own.
SHARD_BYTES, SHARD_ROWS = 16 << 20, 1 << 20

#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Masks that keep the first 0 to 8 bytes of a slice.
_KEEP = np.array([((1 << 8 * k) - 1) << (64 - 8 * k) for k in range(9)], dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Which bytes belong to a word, from closed ranges; in UTF-8 all bytes of a character beyond ASCII are >= 0x80."""
    member = np.zeros(256, dtype=bool)
    for first, last in ranges:
        member[first : last + 1] = True
    return member


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column without nulls; offsets start at 0."""
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    places = np.frombuffer(offsets, dtype=kind, count=column.offset + len(column) + 1)[column.offset :]
    if data is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    places = places.astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8)[places[0] : places[-1]], places - places[0]


def shards(batches: Iterable[pa.RecordBatch], column: str, limit: int = SHARD_BYTES) -> Iterator[pa.Table]:
    """Whole rows in tables of up to ``limit`` bytes of text (or one longer text) and ``SHARD_ROWS`` rows, whatever the batches hold."""
    held: list[pa.RecordBatch] = []
    size = rows = 0
    for batch in batches:
        ends = text_buffer(batch.column(column))[1][1:]
        at = done = 0
        while at < batch.num_rows:
            stop = min(int(np.searchsorted(ends, done + limit - size, side="right")), at + SHARD_ROWS - rows)
            if stop <= at and not held:
                stop = at + 1
            if stop > at:
                held.append(batch.slice(at, stop - at))
                size += int(ends[stop - 1]) - done
                rows += stop - at
                at, done = stop, int(ends[stop - 1])
            if at < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size, rows = [], 0, 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


class Words:
    """Pointers to the starts of all words of a shard's texts, in the order of the texts.

    ``starts`` and ``lengths`` are in bytes of ``data``, ``doc`` is the row a word
    belongs to. ``lower`` turns A-Z to a-z first. No word crosses from one text to the next.
    """

    def __init__(self, column: pa.Array | pa.ChunkedArray, member: np.ndarray, lower: bool = False) -> None:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        data, offsets = text_buffer(column)
        inside = member[data]
        follows = np.empty(len(data), dtype=bool)
        if len(data):
            follows[0] = False
            follows[1:] = inside[:-1]
            follows[offsets[:-1][offsets[:-1] < len(data)]] = False
            self.starts = np.flatnonzero(inside & ~follows)
            follows[-1] = False
            follows[:-1] = inside[1:]
            follows[offsets[1:][offsets[1:] > 0] - 1] = False
            self.lengths = (np.flatnonzero(inside & ~follows) + 1 - self.starts).astype(np.int32)
        else:
            self.starts, self.lengths = np.empty(0, np.int64), np.empty(0, np.int32)
        self.doc = (np.searchsorted(offsets, self.starts, side="right") - 1).astype(np.int32)
        self.documents = len(column)
        #: where each text starts
        self.first = offsets[:-1]
        self.data = np.zeros(len(data) + 8, dtype=np.uint8)
        self.data[: len(data)] = LOWER[data] if lower else data
        self._firsts: np.ndarray | None = None
        self._eights = np.ndarray(len(data) + 1, dtype=">u8", buffer=self.data, strides=(1,))

    def slices(self, depth: int, which: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Bytes ``8 * depth`` to ``8 * depth + 8`` of words as numbers that order like them; zero beyond a word's end.

        No word holds a zero byte where the order matters, so a shorter word comes before the longer ones it begins.
        """
        left = np.clip(self.lengths[which] - 8 * depth, 0, 8)
        places = np.minimum(self.starts[which] + 8 * depth, len(self._eights) - 1)
        return self._eights[places].astype(np.uint64) & _KEEP[left]

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes and length."""
        h = (self.lengths.astype(np.uint64) + np.uint64(seed)) * _ODD
        h = mixed(h ^ self.firsts())
        depth, which = 1, np.flatnonzero(self.lengths > 8)
        while len(which):
            h[which] = mixed(h[which] ^ self.slices(depth, which))
            depth += 1
            which = which[self.lengths[which] > 8 * depth]
        return h

    def firsts(self) -> np.ndarray:
        """The first slice of every word, computed once."""
        if self._firsts is None:
            self._firsts = self.slices(0)
        return self._firsts

    def narrowed(self, starts: np.ndarray, lengths: np.ndarray) -> Words:
        """Pointers of one's own choice into the same texts; they belong to no text."""
        view = copy.copy(self)
        view.starts, view.lengths, view.doc = starts, lengths.astype(np.int32), np.zeros(len(starts), np.int32)
        view._firsts = None
        return view

    def equal(self, chosen: np.ndarray, number: np.ndarray) -> bool:
        """Whether every word has the same bytes as the word ``chosen[number]`` of its number."""
        if not np.array_equal(self.lengths, self.lengths[chosen][number]):
            return False
        if not np.array_equal(self.firsts(), self.firsts()[chosen][number]):
            return False
        depth, which = 1, np.flatnonzero(self.lengths > 8)
        while len(which):
            if not np.array_equal(self.slices(depth, which), self.slices(depth, chosen)[number[which]]):
                return False
            depth += 1
            which = which[self.lengths[which] > 8 * depth]
        return True

    def different(self, kind: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """``(chosen, number)``: one word of each (bytes, kind), and for every word the number of the chosen one it equals."""
        keys = self.hashes()
        if kind is not None:
            keys = keys + kind.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        if len(keys) < 1 << 24:
            # 40 bits of the hash and the word's place in one number: sorted as plain integers
            order = np.sort(keys & ~np.uint64((1 << 24) - 1) | np.arange(len(keys), dtype=np.uint64))
            fresh = np.diff(order >> np.uint64(24), prepend=np.uint64(1 << 63)) != 0
            order = (order & np.uint64((1 << 24) - 1)).astype(np.int64)
            chosen, number = order[fresh], np.empty(len(keys), np.int64)
            number[order] = np.cumsum(fresh) - 1
            if self._same(chosen, number, kind):
                return chosen, number
        _, chosen, number = np.unique(keys, return_index=True, return_inverse=True)
        if self._same(chosen, number, kind):
            return chosen, number
        every = np.arange(len(keys))  # two words share a whole hash: each for itself
        return every, every

    def _same(self, chosen: np.ndarray, number: np.ndarray, kind: np.ndarray | None) -> bool:
        return self.equal(chosen, number) and (kind is None or np.array_equal(kind[chosen][number], kind))

    def sorted_runs(self) -> tuple[np.ndarray, np.ndarray]:
        """Pointers in the order of their words' bytes, and for each the number of its run of equal words.

        Multikey quicksort with slices of eight bytes for keys: pointers are sorted by one
        slice; only runs that are equal so far and have more bytes go on to the next.
        """
        first = self.slices(0)
        order = np.argsort(first)
        first = first[order]
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = first[1:] != first[:-1]
        run = np.cumsum(fresh)
        going = np.arange(len(order))
        depth = 0
        while True:
            # runs of several pointers, at least one of them with bytes beyond this slice
            longer = np.zeros(len(order) + 1, dtype=bool)
            longer[run[going][self.lengths[order[going]] > 8 * (depth + 1)]] = True
            size = np.bincount(run[going], minlength=len(longer))
            going = going[longer[run[going]] & (size[run[going]] > 1)]
            if not len(going):
                break
            depth += 1
            keys, runs = self.slices(depth, order[going]), run[going]
            by = np.lexsort((keys, runs))
            order[going] = order[going][by]
            keys = keys[by]
            split = np.zeros(len(going), dtype=bool)
            split[1:] = (keys[1:] != keys[:-1]) & (runs[1:] == runs[:-1])
            fresh[going[split]] = True
            run = np.cumsum(fresh)
        return order, run - 1

    def texts(self, which: np.ndarray) -> pa.Array:
        """The words themselves, as a string column."""
        lengths = self.lengths[which].astype(np.int64)
        offsets = np.zeros(len(which) + 1, dtype=np.int64)
        np.cumsum(lengths, out=offsets[1:])
        places = gathered(self.starts[which], lengths)
        kind, width = (pa.string(), np.int32) if offsets[-1] < 1 << 31 else (pa.large_string(), np.int64)
        return pa.Array.from_buffers(
            kind, len(which), [None, pa.py_buffer(offsets.astype(width)), pa.py_buffer(self.data[places])]
        )

    def joined(self, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """``(bytes, offsets)`` of each text's words (of those marked in ``keep``), one space between two."""
        which = slice(None) if keep is None else keep
        starts, doc = self.starts[which], self.doc[which]
        ends = starts + self.lengths[which]
        body = self.data[:-8].copy()
        edges = np.zeros(len(body) + 1, dtype=np.int8)
        edges[starts] += 1
        edges[ends] -= 1  # may be the start of the next text's first word
        inside = np.cumsum(edges[:-1], dtype=np.int8) > 0
        between = ends[:-1][doc[1:] == doc[:-1]]
        body[between] = 32
        inside[between] = True
        count = np.bincount(doc, minlength=self.documents)
        sizes = np.bincount(doc, weights=ends - starts, minlength=self.documents).astype(np.int64)
        offsets = np.zeros(self.documents + 1, dtype=np.int64)
        np.cumsum(sizes + np.maximum(count - 1, 0), out=offsets[1:])
        return body[inside], offsets


def gathered(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices ``start, start + 1, ...`` of every stretch, one stretch after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def binaries(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary value per count, cut out of ``values``."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts * values.itemsize, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def mixed(h: np.ndarray) -> np.ndarray:
    """A reversible mix of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))
