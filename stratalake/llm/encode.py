"""Token ids of whole texts, with the ids of blank-separated pieces remembered."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np

#: Pieces remembered by a Python worker (about 220 bytes each), and characters looked at in one go.
REMEMBERED, STRETCH = 300_000, 1_000_000
#: A word of Latin letters with at most one mark behind it, in which no letter is rewritten by NFC.
_WORD = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([,.]?)")
#: A blank beside other white space: tokens may span them.
_RUN = re.compile(r" \s|\s ")
_OTHER_BLANKS = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
#: This worker's encoders, by text and by column.
_ENCODERS: dict = {}


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class _Pieces(dict):
    """Ids by piece, found when first asked for; of ``most`` pieces the half used longest ago goes."""

    def __init__(self, find, most: int) -> None:
        super().__init__()
        self.find, self.most, self.older = find, most, {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.most // 2:
            self.older = dict(self)
            self.clear()
        found = self.older.get(piece)
        if found is None:
            found = self.find(piece)
        self[piece] = found
        return found


class PieceEncoder:
    """Gives the same ids as ``Tokenizer.encode(text, add_special_tokens=False)``.

    Both kinds of vocabulary it speeds up never merge across a blank: one keeps a
    blank with the word behind it, the other drops white space. So a text's ids are
    those of its pieces, and a piece seen before is not encoded again. Texts for which
    this does not hold (special tokens in the text, runs of blanks where blanks count,
    other kinds of tokenizer) go to the tokenizer whole. Plain words go straight to the
    tokenizer's model, which skips the steps that cannot change them.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [spec.get("pre_tokenizer") or {}]
        self.keeps_blanks = spec.get("normalizer") is None and steps[0].get("type") == "ByteLevel" and len(steps) == 1
        self.drops_blanks = steps[0].get("behavior") == "Removed" and "\\s" in str(steps[0].get("pattern"))
        self.special = tuple(t["content"] for t in spec.get("added_tokens", []))
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.letters = _byte_letters()
        if self.keeps_blanks or self.drops_blanks:
            rules = spec["model"]
            self.model = models.BPE(
                vocab=rules["vocab"],
                merges=[tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in rules["merges"]],
                cache_capacity=0,  # what is remembered is remembered here
                **{k: rules[k] for k in ("end_of_word_suffix", "continuing_subword_prefix") if rules.get(k)},
            )
        self.heads = _Pieces(lambda piece: self._find("", piece), remembered)
        self.rest = _Pieces(lambda piece: self._find(" ", piece), remembered)
        self.words = _Pieces(lambda piece: self._find("", piece), remembered)
        self.marks = self.words if self.drops_blanks else self.heads

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()

    def _find(self, lead: str, piece: str) -> bytes:
        same = self.rest if lead else self.marks
        if m := _WORD.fullmatch(piece):
            word, mark = m.groups()
            if mark:  # a mark is a piece of its own; the word may be known
                return same[word] + self.marks[mark]
            if self.drops_blanks and not word.islower():
                return self.words[word.lower()]
            letters = word if word.isascii() else "".join(self.letters[b] for b in word.encode())
            found = self.model.tokenize(self.letters[32] + letters if lead else letters)
            return array(self.dtype.char, [t.id for t in found]).tobytes()
        if self.keeps_blanks and "\n" in piece:
            above, _, below = piece.partition("\n")
            if piece.split() == [above, below]:  # a single line break between two words
                return same[above] + self.heads["\n"] + self.heads[below]
        return self._whole(lead + piece)

    def _stretches(self, text: str) -> Iterator[list[str]]:
        """The text's pieces, from a stretch that ends before a blank at a time."""
        at = 0
        while at < len(text):
            end = text.find(" ", at + STRETCH)
            end = len(text) if end < 0 else end
            yield text[at:end].split(" ")
            at = end

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian integers of ``self.dtype``."""
        if not (self.keeps_blanks or self.drops_blanks) or any(x in text for x in self.special):
            return self._whole(text)
        if self.drops_blanks:
            if _latin(text):  # there letters are lowered one by one
                text = text.lower()
            parts = self._stretches(text.replace("\n", " "))
            return b"".join(b"".join(map(self.words.__getitem__, p)) for p in parts)
        if "  " in text or " \n" in text or "\n " in text or text.endswith(" "):
            return self._whole(text)
        if any(c in text for c in _OTHER_BLANKS) and _RUN.search(text):
            return self._whole(text)
        return b"".join(
            self.heads[p[0]] + b"".join(map(self.rest.__getitem__, p[1:])) for p in self._stretches(text)
        )


def encoder(path: str, remembered: int = REMEMBERED) -> PieceEncoder:
    """This Python worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path, remembered)
    return _ENCODERS[path]


def forget() -> None:
    """Drop this Python worker's encoders and the pieces they remember."""
    _ENCODERS.clear()
