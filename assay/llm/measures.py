"""Counts of a batch of texts, each from a few numpy passes over its bytes and words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import Words, block_hashes, mix, raw, runs, span_hashes

_IS = {
    "continuation": [*range(0x80, 0xC0)], "symbol": [*b"#*$%&|<>"], "upper": [*range(65, 91)], "lower": [*range(97, 123)],
    "digit": [*range(48, 58)], "stop": [*b".!?"], "comma": [*b",;:"], "shout": [*b"!"], "bar": [*b"|"], "lead": [*range(0xC0, 256)],
}
_CLASS = {name: np.isin(np.arange(256), codes) for name, codes in _IS.items()}


def repeats(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value: does its owner have it more than once, and is it not the first of them (by position)?"""
    key = values ^ mix(owner.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    new = runs(key[order]) | runs(owner[order])
    many, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order] = ~new
    many[order] = ~new | np.append(~new[1:], [False] * min(1, len(new)))
    return many, later


class Measures:
    """Lazy counts of a batch of texts; every method returns one number per text."""

    def __init__(self, texts: pa.Array):
        self.data, self.offsets = raw(texts)
        self._words: Words | None = None
        self._cache: dict[str, np.ndarray] = {}

    def _once(self, name: str, make) -> np.ndarray:
        if name not in self._cache:
            self._cache[name] = make()
        return self._cache[name]

    @property
    def words(self) -> Words:
        if self._words is None:
            self._words = Words(self.data, self.offsets)
        return self._words

    def per_text(self, flags: np.ndarray, bounds: np.ndarray | None = None) -> np.ndarray:
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return np.diff(sums[self.offsets if bounds is None else bounds])

    def count(self, kind: str) -> np.ndarray:
        """Bytes of a class of `_IS`."""
        return self._once(kind, lambda: self.per_text(_CLASS[kind][self.data]))

    def n_words(self) -> np.ndarray:
        return self.words.counts

    def chars(self) -> np.ndarray:
        return np.diff(self.offsets) - self.count("continuation")

    def word_chars(self) -> np.ndarray:
        """Code points in words."""
        w = self.words
        return self._once("word_chars", lambda: self.per_text(w.ends - w.starts, w.first) - self.count("continuation"))

    def word_hashes(self) -> np.ndarray:
        return self._once("word_hashes", self.words.hashes)

    def _lines(self) -> tuple[np.ndarray, ...]:
        """Starts, ends and owners of the lines that hold a word."""
        def make():
            breaks = np.flatnonzero(self.data == 10)
            starts = np.sort(np.concatenate([self.offsets[:-1], breaks + 1]))
            ends = np.sort(np.concatenate([breaks, self.offsets[1:]]))
            with_word = np.searchsorted(self.words.starts, ends) > np.searchsorted(self.words.starts, starts)
            starts, ends = starts[with_word], ends[with_word]
            return starts, ends, np.searchsorted(self.offsets, starts, side="right") - 1
        return self._once("lines", make)

    def n_lines(self) -> np.ndarray:
        return np.bincount(self._lines()[2], minlength=len(self.offsets) - 1)

    def n_dup_lines(self) -> np.ndarray:
        """Lines with a word that equal an earlier line of the text."""
        starts, ends, owner = self._lines()
        later = repeats(block_hashes(self.data, starts, ends), owner)[1]
        return np.bincount(owner[later], minlength=len(self.offsets) - 1)

    def n_repeat_words(self, width: int = 3) -> np.ndarray:
        """Words in windows of `width` words that the text has twice or more, the first one included."""
        starts, owner = self.words.windows(width)
        many = repeats(span_hashes(self.word_hashes(), starts, starts + width, 0xD1342543DE82EF95), owner)[0]
        edge = np.zeros(len(self.words.starts) + 1, np.int64)
        np.add.at(edge, starts[many], 1)
        np.add.at(edge, starts[many] + width, -1)
        return self.per_text(np.cumsum(edge)[:-1] > 0, self.words.first)

    def n_distinct_words(self) -> np.ndarray:
        return self.per_text(~repeats(self.word_hashes(), self.words.owners())[1], self.words.first)
