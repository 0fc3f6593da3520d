"""Vectorised word hashing: the words of many texts as flat arrays, without a Python loop per word."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from marquee.llm.common import mix64

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(None)
def char_table(kind: str) -> np.ndarray:
    """For every code point, whether ``str.<kind>`` holds (``isalnum``, ``isalpha``, ``isupper``)."""
    test = getattr(str, kind)
    return np.fromiter((test(chr(i)) for i in range(0x110000)), bool, 0x110000)


@lru_cache(4)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(base: int, n: int) -> np.ndarray:
    return _powers(base, 1 << max(20, int(n).bit_length()))[:n]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each followed by a line break, and where each text starts."""
    joined = "\n".join(texts) + "\n"
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return np.frombuffer(joined.encode("utf-32-le"), "<u4"), starts


class Words:
    """The words (runs of letters and digits, lower-cased) of a list of texts.

    ``text`` holds each word's text number, ``begin`` and ``end`` its place in
    the joined lower-cased texts; ``hash`` is a 64-bit hash of the whole word.
    """

    def __init__(self, texts: list[str]):
        self.lowered = [t.lower() for t in texts]
        codes, self.starts = code_points(self.lowered)
        inside = char_table("isalnum")[codes]
        change = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
        self.begin, self.end = change[::2], change[1::2]
        self.text = np.searchsorted(self.starts, self.begin, side="right") - 1
        n = len(codes)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(codes.astype(np.uint64) * powers(_BASE, n), out=self._sums[1:])
        self._shift = powers(_INVERSE, n)[self.begin] if len(self.begin) else np.zeros(0, np.uint64)
        self.hash = self._span_hash(self.end)

    def _span_hash(self, end: np.ndarray) -> np.ndarray:
        raw = (self._sums[end] - self._sums[self.begin]) * self._shift
        return mix64(raw + (end - self.begin).astype(np.uint64))

    def prefix_hash(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the first ``length`` characters, and which words are that long."""
        end = np.minimum(self.begin + length, self.end)
        return self._span_hash(end), (self.end - self.begin) >= length

    def word(self, i: int) -> str:
        t = int(self.text[i])
        at = int(self.starts[t])
        return self.lowered[t][int(self.begin[i]) - at:int(self.end[i]) - at]

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(first word, words, hash)`` of every ``k``-word shingle, in text order.

        A text with some but fewer than ``k`` words has one shingle, its whole sequence.
        """
        n = len(self.text)
        counts = np.bincount(self.text, minlength=len(self.lowered)) if n else np.zeros(len(self.lowered), np.int64)
        firsts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
        span = np.minimum(counts, k)
        number = np.where(counts > 0, np.maximum(counts - k + 1, 1), 0)
        begin = np.repeat(firsts - np.concatenate([[0], np.cumsum(number)[:-1]]).astype(np.int64), number)
        begin = begin + np.arange(len(begin))
        length = np.repeat(span, number)
        out = np.zeros(len(begin), np.uint64)
        for j in range(k):
            there = j < length
            word = self.hash[np.where(there, begin + j, 0)] if n else out
            out = np.where(there, mix64(out * np.uint64(_BASE) + word), out)
        return begin, length, out


class HashTable:
    """Which of many 64-bit hashes are among a few given ones, and at which place."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.order = np.sort(keys), np.argsort(keys, kind="stable")
        self._bits = max(16, min(24, int(max(len(keys), 1)).bit_length() + 4))
        self._maybe = np.zeros(1 << self._bits, bool)
        self._maybe[self.keys >> np.uint64(64 - self._bits)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``hashes`` that are known, and the place of each among the given keys."""
        at = np.flatnonzero(self._maybe[hashes >> np.uint64(64 - self._bits)])
        if not len(self.keys) or not len(at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        place = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        hit = self.keys[place] == hashes[at]
        return at[hit], self.order[place[hit]]
