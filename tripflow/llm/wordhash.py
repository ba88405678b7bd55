"""Word sequences as numbers: hashes of words and of word shingles, for whole texts at once."""

from __future__ import annotations

import hashlib

import numpy as np

from tripflow.llm.wumanber import _FOLD, words_of

_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = 0x100000001B3
_INVERSE = pow(_STEP, -1, 1 << 64)
_SHINGLE = np.uint64(0xD6E8FEB86659FD93)


class _Powers:
    """Powers of an odd number modulo 2**64, as many as the longest text has needed."""

    def __init__(self, base: int):
        self.base, self.values = np.uint64(base), np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.values) < n:
            last = self.values[-1:] * self.base
            self.values = np.concatenate([self.values, self.values * last])
        return self.values[:n]


_UP, _DOWN = _Powers(_STEP), _Powers(_INVERSE)


def mixed(h: np.ndarray) -> np.ndarray:
    """Bits spread over the whole word."""
    h = h ^ (h >> np.uint64(32))
    h = h * _ODD
    return h ^ (h >> np.uint64(29))


def word_hashes(data: bytes | None) -> np.ndarray:
    """A 64-bit hash of each word of UTF-8 bytes, in order."""
    if not data:
        return np.zeros(0, np.uint64)
    folded = np.frombuffer(data.translate(_FOLD), np.uint8)
    inside = np.concatenate([[False], folded != 32, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    if not len(edges):
        return np.zeros(0, np.uint64)
    start, end = edges[0::2], edges[1::2]
    # sums of byte * power up to each place; a word is a difference, shifted back to place 0
    total = np.zeros(len(folded) + 1, np.uint64)
    np.cumsum(folded.astype(np.uint64) * _UP.upto(len(folded)), out=total[1:])
    return mixed((total[end] - total[start]) * _DOWN.upto(len(folded))[start] + (end - start).astype(np.uint64))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` words; of the whole text, if it has fewer but some."""
    size = min(size, len(words))
    if not size:
        return np.zeros(0, np.uint64)
    n = len(words) - size + 1
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h = (h + words[k:n + k]) * _SHINGLE
        h ^= h >> np.uint64(31)
    return h


def digest(data: bytes | None) -> bytes:
    """16 bytes that tell word sequences apart; equal for all texts without words."""
    return hashlib.md5(b" ".join(words_of(data))).digest()
