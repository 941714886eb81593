"""Texts to token ids with a byte-level vocabulary file of the tokenizers library.

Such a tokenizer cuts a text into pieces and merges every piece by itself, so the ids of a text are
those of its pieces in order. Pieces repeat, so their ids are kept in a cache of two generations of
bounded size, and only pieces that are not in it go to the library. Where a text has characters on
whose class Unicode versions may differ, its words (cut before a space that a letter or digit
follows, always the start of a piece) go to the library whole if they hold such characters.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable

import numpy as np
from tokenizers import Tokenizer

GENERATION = 300_000  # entries of one cache generation; a longer key than LONGEST is not kept
LONGEST = 64

_BEFORE_WORD = re.compile(r" (?=[^\W_])")
# The piece pattern of byte-level tokenizers, here for plain characters, and their
# letters for the 256 bytes.
_PLAIN = re.compile("[\n\t !-~À-ÖØ-öø-ɏ]*")
_PIECE = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ɏ]+| ?[0-9]+| ?[!-/:-@\[-`{-~]+|[\n\t ]+(?![^\n\t ])|[\n\t ]+"
)
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTERS = {b: b for b in _PRINTABLE} | {
    b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(_PRINTABLE))
}


def byte_letters(piece: str) -> str:
    return piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(_BYTE_LETTERS)


class Generations(dict):
    """word -> value, computed on a miss. When ``size`` words are held they become the old
    generation, and the previous old one is forgotten."""

    def __init__(self, compute: Callable[[str], bytes], size: int = GENERATION):
        super().__init__()
        self.compute, self.size, self.old = compute, size, {}

    def __missing__(self, word):
        value = self.old.get(word)
        if value is None:
            value = self.compute(word)
        if len(word) <= LONGEST:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[word] = value
        return value


class Encoder:
    """``encode(text)`` gives the ids as little-endian bytes of ``dtype``."""

    def __init__(self, path: str, extra_ids: Iterable[int] = ()):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        self.added = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        top = max([self.tokenizer.get_vocab_size(with_added_tokens=True) - 1, *extra_ids])
        self.code, self.dtype = ("H", np.dtype("<u2")) if top < 1 << 16 else ("I", np.dtype("<u4"))
        self.pieces = Generations(self._piece)
        self.words = Generations(self._word)

    def _piece(self, piece: str) -> bytes:
        return array(self.code, [t.id for t in self.model.tokenize(byte_letters(piece))]).tobytes()

    def _word(self, word: str) -> bytes:
        return array(self.code, self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _plain(self, text: str) -> bool:
        return bool(_PLAIN.fullmatch(text)) and not any(token in text for token in self.added)

    def encode(self, text: str) -> bytes:
        if self._plain(text):
            return b"".join(map(self.pieces.__getitem__, _PIECE.findall(text)))
        first, *rest = _BEFORE_WORD.split(text)
        words = [first, *(" " + word for word in rest)]
        return b"".join(
            b"".join(map(self.pieces.__getitem__, _PIECE.findall(word))) if self._plain(word) else self.words[word]
            for word in words
        )

    def one(self, token: int) -> bytes:
        return np.array([token], self.dtype).tobytes()


_ENCODERS: dict = {}


def encoder(path: str, extra_ids: tuple[int, ...] = ()) -> Encoder:
    """One encoder per worker process, so its cache outlives a task."""
    key = (path, extra_ids)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, extra_ids)
    return _ENCODERS[key]
