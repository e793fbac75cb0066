"""Exact, fast use of the installed tokenizer library inside tasks.

A text is split where the tokenizer's own pre-tokenizer is sure to split it, and each distinct piece
is encoded by the library once per worker. Texts with characters outside the plain alphabet, for
which the split is not proven here, or with a special string go to the library whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# The letters, numbers and white space of the plain alphabet (tab, line feed, carriage
# return, printable ASCII and Latin-1), as Unicode classes them.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_NUMBERS = "0-9²³¹¼½¾"
_BLANKS = "\t\n\r "
_ODD = re.compile("[^\t\n\r -~¡-ÿ]|<\\|")
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
BYTE_PIECES = re.compile(
    f"{_CONTRACTIONS}| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_BLANKS}{_LETTERS}{_NUMBERS}]+"
    f"|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+"
)
# Pre-tokens of the word-end vocabulary in lower-case ASCII without white space.
_PRE_TOKENS = re.compile(f"{_CONTRACTIONS}|[a-z]+|[0-9]|[^a-z0-9]+")
# Python splits at these, the tokenizer does not.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
CACHE_PIECES = 250_000  # of each generation


@lru_cache(maxsize=4)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def is_plain(text: str) -> bool:
    return _ODD.search(text) is None


class _Pieces:
    """What the library makes of each piece, remembered for the two last generations of pieces."""

    def __init__(self, path: str):
        self.library = tokenizer(path)
        self.known: dict = {}
        self.older: dict = {}

    def look_up(self, pieces: list[str]) -> Iterator:
        new = set(pieces).difference(self.known)
        if new:
            if len(self.known) + len(new) > CACHE_PIECES:
                self.older, self.known = self.known, {}
                new = set(pieces)
            kept = {p: self.older[p] for p in new if p in self.older}
            self.known.update(kept)
            if len(kept) < len(new):
                self._learn([p for p in new if p not in kept])
        return map(self.known.__getitem__, pieces)

    def _learn(self, new: list[str]) -> None:
        for piece, got in zip(new, self.library.encode_batch_fast(new, add_special_tokens=False)):
            self.known[piece] = self._keep(got)

    def _keep(self, got):
        raise NotImplementedError


class BytePieces(_Pieces):
    """Token counts of pre-tokens of a byte-level vocabulary."""

    def _keep(self, got):
        return len(got)

    def count(self, text: str) -> int:
        if not is_plain(text):
            return len(self.library.encode(text, add_special_tokens=False))
        return sum(self.look_up(BYTE_PIECES.findall(text)))

    def boundaries(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(offsets of the pre-tokens' starts and of the end, tokens before each)."""
        if is_plain(text):
            pieces = BYTE_PIECES.findall(text)
            return np.cumsum([0, *map(len, pieces)]), np.cumsum([0, *self.look_up(pieces)])
        got = self.library.encode(text, add_special_tokens=False)
        word = np.array(got.word_ids)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        at = np.array([o[0] for o in got.offsets], np.int64)
        return np.append(at[first], len(text)), np.append(first, len(word))


class WordIds(_Pieces):
    """Ids of a word-end vocabulary that lower-cases and drops white space.

    No pre-token holds white space, so what stands between white space is encoded once and remembered. Plain
    ASCII is cut in pre-tokens here, and only new ones go to the library's model; the rest goes to the library.
    """

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenize = self.library.model.tokenize
        self.words: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """The ids as little-endian 32-bit numbers."""
        if "<|" in text or any(c in text for c in _SEPARATORS):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        # Only letters whose lower case is one letter whatever stands around them are lowered here.
        return b"".join(self.look_up((text.lower() if text.isascii() else text).split()))

    def _learn(self, new: list[str]) -> None:
        other = []
        for piece in new:
            if piece.isascii() and piece.isprintable():
                self.known[piece] = b"".join(map(self._word, _PRE_TOKENS.findall(piece.lower())))
            else:
                other.append(piece)
        if other:
            super()._learn(other)

    def _word(self, word: str) -> bytes:
        got = self.words.get(word)
        if got is None:
            if len(self.words) >= CACHE_PIECES:
                self.words.clear()
            got = self.words[word] = array("I", [t.id for t in self.tokenize(word)]).tobytes()
        return got

    def _keep(self, got):
        return np.array(got.ids, "<u4").tobytes()


# One per process: workers are reused, and what a task has learned serves the next.
@lru_cache(maxsize=1)
def byte_pieces(path: str) -> BytePieces:
    return BytePieces(path)


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    return WordIds(path)
