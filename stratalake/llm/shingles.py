"""Word shingles of Arrow text batches as 64-bit hashes, a stretch of text at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed together; longer texts are cut between words.
STRETCH = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (Steele, Lea and Flood, 2014)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers() -> np.ndarray:
    if not _POWERS:
        _POWERS.append(np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(2 * STRETCH, _BASE)])))
    return _POWERS[0]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column without nulls; row i is bytes[offsets[i]:offsets[i + 1]]."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


def _hash_words(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of ``raw`` and the number of words before each of ``bounds``."""
    solid = ~_SPACE[raw]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    inner = bounds[(bounds > 0) & (bounds < len(raw))]
    first[inner] = solid[inner]
    last[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    p = powers()
    sums = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * p[: len(raw)], dtype=np.uint64)])
    found = (sums[ends] - sums[starts]) * p[2 * STRETCH - starts]
    return mix(found ^ (ends - starts).astype(np.uint64)), np.searchsorted(starts, bounds)


def word_groups(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, word hashes, bounds)`` for groups of rows; row first + i has words[bounds[i]:bounds[i + 1]].

    Words are runs of bytes other than ASCII white space.
    """
    raw, offsets = text_bytes(column)
    row, rows = 0, len(column)
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + STRETCH, side="right")) - 1)
        a, b = int(offsets[row]), int(offsets[end])
        if b - a <= 2 * STRETCH:
            words, bounds = _hash_words(raw[a:b], offsets[row : end + 1] - a)
        else:  # one long text
            parts = []
            while a < b:
                cut = min(b, a + STRETCH)
                if cut < b:
                    space = np.flatnonzero(_SPACE[raw[a:cut]])
                    cut = a + int(space[-1]) + 1 if len(space) else cut
                parts.append(_hash_words(raw[a:cut], np.zeros(0, np.int64))[0])
                a = cut
            words = np.concatenate(parts)
            bounds = np.array([0, len(words)])
        yield row, words, bounds
        row = end


def shingle_sets(column: pa.Array, size: int = 5) -> Iterator[tuple[int, list[np.ndarray]]]:
    """``(first row, sorted distinct shingle hashes of each row)``; a text of fewer words is one shingle, an empty one none."""
    factors = mix(np.arange(1, size + 1, dtype=np.uint64) * _BASE) | np.uint64(1)
    for row, words, bounds in word_groups(column):
        n = len(words) - size + 1
        joined = np.zeros(max(n, 0), np.uint64)
        for j in range(size):
            joined += words[j : j + n] * factors[j] if n > 0 else np.uint64(0)
        joined = mix(joined)
        sets = []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a >= size:
                sets.append(np.unique(joined[a : b - size + 1]))
            elif b > a:
                sets.append(mix(np.atleast_1d((words[a:b] * factors[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a))))
            else:
                sets.append(np.zeros(0, np.uint64))
        yield row, sets
