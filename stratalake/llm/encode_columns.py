"""Token ids of a whole column of texts: each distinct piece is encoded once, ids are gathered by index."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .encode import _ENCODERS, PieceEncoder, encoder
from .words import Words, byte_class, gathered

#: White space as the encoders' own per-text code sees it.
_BLANK = r"[\t-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Bytes of ASCII letters and of the letters that UTF-8 writes as 0xC3 and one more byte.
_LETTERS = byte_class((65, 90), (97, 122), (0xC3, 0xC3), (0x80, 0x96), (0x98, 0xB6), (0xB8, 0xBF))
#: ASCII marks; behind a word a run of them is a piece of its own. An apostrophe may belong to what follows.
_MARKS = byte_class((33, 38), (40, 47), (58, 64), (91, 96), (123, 126))
_KINDS = _LETTERS + 2 * _MARKS.astype(np.uint8)
_NOT_BLANK = byte_class((0, 8), (14, 31), (33, 255))
_NOT_SPACE = byte_class((0, 9), (11, 31), (33, 255))
#: Words encoded by one call, and words whose ids a worker remembers from one shard to the next (about 60 bytes each).
_CALL, REMEMBERED = 2000, 400_000
#: Bytes of the longest word that is remembered.
_LONGEST = 64
#: Text bytes encoded in one go.
SHARD_BYTES = 8 << 20
#: What stands before a word: nothing, a space or a line feed.
_FIRST, _SPACE, _LINE = 0, 1, 2


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _appended(held: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``held`` with ``more`` behind its first ``used`` values, in twice the room if there is none left."""
    if used + len(more) > len(held):
        held = np.concatenate([held[:used], np.empty(used + 2 * len(more), held.dtype)])
    held[used : used + len(more)] = more
    return held


class RememberedWords:
    """Ids by word: numbers of words by hash, their bytes to compare, their ids; arrays, no object per word."""

    def __init__(self, dtype: np.dtype) -> None:
        self.n, self.table = 0, np.full(1 << 12, -1, np.int32)
        self.hashes, self.data, self.ids = np.empty(0, np.uint64), np.empty(0, np.uint8), np.empty(0, dtype)
        #: where the bytes and the ids of each word start, and behind them those of the next
        self.starts, self.firsts = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64(len(self.table) - 1)).astype(np.int64)

    def find(self, words: Words, hashes: np.ndarray) -> np.ndarray:
        """The number of each word; -1 if it is not remembered, -2 if it never can be, as another has its hash."""
        found, slots, left = np.full(len(hashes), -1, np.int64), self._slots(hashes), np.arange(len(hashes))
        while len(left):  # each looks at the next slot until it meets its hash or a free one
            number = self.table[slots[left]]
            left, number = left[number >= 0], number[number >= 0]
            same = self.hashes[number] == hashes[left]
            found[left[same]] = number[same]
            left = left[~same]
            slots[left] = (slots[left] + 1) & (len(self.table) - 1)
        some = np.flatnonzero(found >= 0)
        starts, lengths = self.starts[found[some]], words.lengths[some].astype(np.int64)
        differs = self.starts[found[some] + 1] - starts != lengths
        found[some[differs]] = -2
        some, starts, lengths = some[~differs], starts[~differs], lengths[~differs]
        unlike = np.flatnonzero(self.data[gathered(starts, lengths)] != words.data[gathered(words.starts[some], lengths)])
        found[some[np.searchsorted(np.cumsum(lengths), unlike, side="right")]] = -2
        return found

    def get(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that are remembered, one after the other, and how many each has."""
        many = self.firsts[numbers + 1] - self.firsts[numbers]
        return self.ids[gathered(self.firsts[numbers], many)], many

    def add(self, words: Words, hashes: np.ndarray, ids: np.ndarray, many: np.ndarray, free: np.ndarray) -> None:
        """Remember the words marked ``free``; of those that share a hash the first."""
        first = np.zeros(len(hashes), dtype=bool)
        first[np.unique(hashes, return_index=True)[1]] = True
        some = np.flatnonzero(first & free & (words.lengths <= _LONGEST))
        n, lengths = self.n + len(some), words.lengths[some].astype(np.int64)
        body, own = words.data[gathered(words.starts[some], lengths)], ids[gathered((np.cumsum(many) - many)[some], many[some])]
        self.data, self.ids = _appended(self.data, self.starts[self.n], body), _appended(self.ids, self.firsts[self.n], own)
        self.starts = _appended(self.starts, self.n + 1, self.starts[self.n] + np.cumsum(lengths))
        self.firsts = _appended(self.firsts, self.n + 1, self.firsts[self.n] + np.cumsum(many[some]))
        self.hashes = _appended(self.hashes, self.n, hashes[some])
        left, self.n = np.arange(self.n, n), n
        if 2 * n > len(self.table):  # half of the slots stay free
            self.table, left = np.full(1 << (2 * n).bit_length(), -1, np.int32), np.arange(n)
        slots = self._slots(self.hashes[left])
        while len(left):  # a word that finds its slot taken goes on to the next
            empty = self.table[slots] < 0
            self.table[slots[empty]] = left[empty]
            taken = self.table[slots] != left
            left, slots = left[taken], (slots[taken] + 1) & (len(self.table) - 1)


class ColumnEncoder:
    """Gives the same ids as ``PieceEncoder.encode`` text by text.

    Words are told apart by hash and compared byte for byte. Plain words of Latin letters
    go to the tokenizer's model many at a time; other pieces, and texts in which tokens may
    span white space, take the per-text encoder.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.texts: PieceEncoder = encoder(path)
        self.dtype, self.remembered = self.texts.dtype, remembered
        self.known: dict[bool, RememberedWords] = {}
        if self.texts.keeps_blanks or self.texts.drops_blanks:
            self.lines = Tokenizer(self.texts.model)
            self.lines.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
            # code points of the bytes' stand-ins; a line feed parts words
            self.points = np.array([10 if b == 10 else ord(x) for b, x in enumerate(self.texts.letters)], "<u4")
            # tokens that only the start (after a space) or only the end of a word has
            space, suffix = self.texts.letters[32], self.texts.model.end_of_word_suffix
            vocabulary = self.texts.tokenizer.get_vocab()
            self.edge = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self.edge[[i for t, i in vocabulary.items() if (t.startswith(space) if self.texts.keeps_blanks else t.endswith(suffix))]] = True

    def _plain(self, column: pa.Array) -> np.ndarray:
        """Which texts are the sum of their pieces."""
        parts = [re.escape(x) for x in self.texts.special]
        if self.texts.keeps_blanks:
            parts += [_BLANK + _BLANK, _BLANK + r"\z", r"\A\n"]
        if not parts:
            return np.ones(len(column), dtype=bool)
        return ~pc.match_substring_regex(column, "|".join(parts)).to_numpy(zero_copy_only=False)

    def _letters(self, words: Words, lead: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct plain words in an order of its own, their ids and how many each has; words of the shards before may still be known."""
        known = self.known.get(lead)
        if known is None or known.n > self.remembered:
            known = self.known[lead] = RememberedWords(self.dtype)
        hashes = words.hashes()
        found = known.find(words, hashes)
        old, new = np.flatnonzero(found >= 0), np.flatnonzero(found < 0)
        flat, sizes = known.get(found[old])
        if len(new):
            texts = _strings(words.texts(new))
            if self.texts.drops_blanks:
                texts = [w if w.isascii() else w.lower() for w in texts]
            ids, many = self._encoded(texts, lead)
            if len(many) != len(new):
                raise RuntimeError("the vocabulary does not mark the edges of words")
            free = found[new] == -1
            known.add(words.narrowed(words.starts[new], words.lengths[new]), hashes[new], ids, many, free)
            flat, sizes = np.concatenate([flat, ids]), np.concatenate([sizes, many])
        return np.concatenate([old, new]), flat, sizes

    def _encoded(self, words: list[str], lead: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words, many by one call, and how many each has."""
        space = " " if lead and self.texts.keeps_blanks else ""
        parts, sizes = [np.empty(0, self.dtype)], [np.empty(0, np.int64)]
        for a in range(0, len(words), _CALL):
            part = words[a : a + _CALL]
            text = (space + ("\n" + space).join(part)).encode()
            text = self.points[np.frombuffer(text, np.uint8)].tobytes().decode("utf-32-le")
            if self.texts.keeps_blanks and not lead:  # no token tells where such a word starts
                found = self.lines.encode(text, add_special_tokens=False)
                ids, many = np.array(found.ids, dtype=self.dtype), np.bincount(found.word_ids, minlength=len(part))
            else:
                (found,) = self.lines.encode_batch_fast([text], add_special_tokens=False)
                ids = np.array(found.ids, dtype=self.dtype)
                edges = np.flatnonzero(self.edge[ids])
                many = np.diff(edges, append=len(ids)) if lead and self.texts.keeps_blanks else np.diff(edges, prepend=-1)
            parts.append(ids)
            sizes.append(many)
        return np.concatenate(parts), np.concatenate(sizes)

    def _distinct(self, words: Words, which: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the distinct words ``which``, with what stands ``before`` them, and how many each has."""
        start, length = words.starts[which], words.lengths[which]
        # letters and marks of each word, and whether no letter follows a mark
        kind = _KINDS[words.data[gathered(start, length)]]
        first = np.cumsum(length) - length
        held, marks = (np.add.reduceat(kind == k, first, dtype=np.int32) if len(first) else first for k in (1, 2))
        mixed = np.flatnonzero((kind[:-1] == 2) & (kind[1:] == 1)) + 1
        of = np.searchsorted(first, mixed, side="right") - 1
        plain = (held > 0) & (held + marks == length)
        plain[of[mixed != first[of]]] = False
        simple, marked = np.flatnonzero(plain), np.flatnonzero(plain & (marks > 0))
        lead = (before[simple] == _SPACE) & self.texts.keeps_blanks
        bare = words.narrowed(start[simple], held[simple])
        chosen, number = bare.different(lead)
        flat, sizes, at = [], [], np.zeros(len(chosen), np.int64)
        for side in (False, True):
            own = chosen[lead[chosen] == side]
            order, ids, many = self._letters(bare.narrowed(bare.starts[own], bare.lengths[own]), side)
            at[np.flatnonzero(lead[chosen] == side)[order]] = np.arange(len(own)) + sum(map(len, sizes))
            flat.append(ids)
            sizes.append(many)
        known = sum(map(len, sizes))
        single: list[bytes] = [b""]  # the part that is not there

        def add(found: list[bytes]) -> np.ndarray:
            single.extend(found)
            return np.arange(known + len(single) - len(found), known + len(single))

        body = np.full(len(which), known)
        body[simple] = at[number]
        same = self.texts.rest if self.texts.keeps_blanks else self.texts.words
        head = self.texts.heads if self.texts.keeps_blanks else self.texts.words
        rest = np.flatnonzero(~plain)
        pieces = _strings(words.texts(which[rest]))
        body[rest] = add([(same if b == _SPACE else head)[x] for b, x in zip(before[rest].tolist(), pieces, strict=True)])
        behind = np.full(len(which), known)
        runs = words.narrowed(start[marked] + held[marked], marks[marked])
        chosen, number = runs.different()
        behind[marked] = add([head[x] for x in runs.texts(chosen).to_pylist()])[number]
        ahead = np.full(len(which), known)
        if self.texts.keeps_blanks:
            ahead[before == _LINE] = add([head["\n"]])[0]
        flat = np.concatenate([*flat, np.frombuffer(b"".join(single), self.dtype)])
        sizes = np.concatenate([*sizes, [len(x) // self.dtype.itemsize for x in single]]).astype(np.int64)
        starts, parts = np.cumsum(sizes) - sizes, np.stack([ahead, body, behind], axis=1)
        return flat[gathered(starts[parts].ravel(), sizes[parts].ravel())], sizes[parts].sum(axis=1)

    def encode(self, column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)``: the ids of all texts of a column without nulls, one after the other."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if not (self.texts.keeps_blanks or self.texts.drops_blanks):
            return self._one_by_one(column)
        plain = self._plain(column)
        words = Words(column.filter(pa.array(plain)), _NOT_SPACE if self.texts.keeps_blanks else _NOT_BLANK, lower=self.texts.drops_blanks)
        before = np.zeros(len(words.starts), dtype=np.uint8)
        if self.texts.keeps_blanks and len(before):
            last = words.data[words.starts - 1]  # the first word of all looks at padding
            new = np.diff(words.doc, prepend=-1) != 0
            before = np.where(last == 32, _SPACE, _LINE).astype(np.uint8)
            # a text's first word follows nothing, or the text's own first space
            before[new & (words.starts == words.first[words.doc])] = _FIRST
        chosen, number = words.different(before)
        flat, sizes = self._distinct(words, chosen, before[chosen])
        many = sizes[number]
        ids = flat[gathered((np.cumsum(sizes) - sizes)[number], many)]
        per_text = np.zeros(len(column), dtype=np.int64)
        per_text[plain] = np.bincount(words.doc, weights=many, minlength=words.documents)
        if plain.all():
            return ids, np.concatenate([[0], np.cumsum(per_text)])
        others = {i: np.frombuffer(self.texts.encode(column[i].as_py()), self.dtype) for i in np.flatnonzero(~plain).tolist()}
        own = np.cumsum(per_text)
        parts, at = [], 0
        for i, x in others.items():
            parts += [ids[at : own[i]], x]
            at = own[i]
            per_text[i] = len(x)
        return np.concatenate([*parts, ids[at:]]), np.concatenate([[0], np.cumsum(per_text)])

    def _one_by_one(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [np.frombuffer(self.texts.encode(text.as_py()), self.dtype) for text in column]
        return np.concatenate([np.empty(0, self.dtype), *found]), np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)


def column_encoder(path: str, remembered: int = REMEMBERED) -> ColumnEncoder:
    """This Python worker's column encoder for a vocabulary file, until ``encode.forget``."""
    name = f"columns of {path}"
    if name not in _ENCODERS:
        _ENCODERS[name] = ColumnEncoder(path, remembered)
    return _ENCODERS[name]
