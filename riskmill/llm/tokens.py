"""Byte-pair tokens of white-space-delimited words, looked up instead of computed where possible.

The tokenizer drops white space and never joins across it: its normal form changes no character by its
neighbours beyond a space, and its patterns and special strings hold none. So the ids of a text are the ids
of its words in order, and a table from word to ids gives the same result as encoding whole texts. For the same
reason punctuation behind an ASCII letter or digit is a part of its own, and ASCII words are the same in lower case.
"""

from __future__ import annotations

import os
import sys
from array import array
from functools import lru_cache

import numpy as np

MAX_CACHED_WORDS = 1_000_000  # of a worker; bounds its memory, not its results
_TAIL = b".,!?;:"


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def default_tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_words(path: str, words: list[bytes]) -> list[list[int]]:
    texts = [w.decode("utf-8", "replace") for w in words]
    return [e.ids for e in tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)]


def parted(word: bytes) -> tuple[bytes, bytes]:
    """A word in its simplest equivalent form, and the punctuation behind it, which is encoded apart."""
    if b"<|" in word:  # may hold a special string, which is matched as it is written
        return word, b""
    core = word.rstrip(_TAIL)
    if not core or not core[-1:].isalnum():
        core = word
    return core.lower() if core.isascii() else core, word[len(core) :]


class WordTable(dict):
    """word -> what ``of`` makes of its ids (values that add up); new words are encoded many at a time."""

    def __init__(self, path: str, of):
        super().__init__()
        self.path, self.of = path, of

    def rows(self, texts: list[list[bytes]]) -> list[list]:
        """The values of all words of these texts."""
        if len(self) > MAX_CACHED_WORDS:
            self.clear()
        new = {w for words in texts for w in words if w not in self}
        if new:
            self._learn(new)
        return [list(map(self.__getitem__, words)) for words in texts]

    def _learn(self, words: set[bytes]) -> None:
        parts = {w: parted(w) for w in words}
        wanted = {p for pair in parts.values() for p in pair if p and p not in self}
        for part in _slices(list(wanted), 20_000):
            self.update(zip(part, map(self.of, encode_words(self.path, part)), strict=True))
        for word, (core, tail) in parts.items():
            self[word] = self[core] + self[tail] if tail else self[core]


def _slices(items: list, size: int):
    return (items[k : k + size] for k in range(0, len(items), size))


_tables: dict = {}


def word_table(path: str, of, known: dict | None = None) -> WordTable:
    """This worker's table, kept from task to task."""
    table = _tables.setdefault((path, of), WordTable(path, of))
    table.update(known or {})
    return table


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian 16-bit integers."""
    return array("H", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<u2").tobytes()
