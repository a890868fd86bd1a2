"""Vectorised word splitting and hashing over Arrow text buffers.

A word is a maximal run of characters other than space and U+0009..U+000D;
those six are single bytes in UTF-8, so the bytes can be split directly.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np

WORD_GAPS = np.zeros(256, bool)
WORD_GAPS[[9, 10, 11, 12, 13, 32]] = True
PUNCTUATION = WORD_GAPS.copy()  # those, control characters, and ASCII punctuation
PUNCTUATION[[b for b in range(128) if not chr(b).isalnum()]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (avalanches all bits)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 2**64)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64."""
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@dataclass
class Words:
    """Words of several texts: byte range and hash of each, and the first word of each text."""

    data: np.ndarray  # bytes, lower-cased if asked for
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # word index where each text begins, and the count

    @cached_property
    def kinds(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes (ascending), a word of each, the kind of every word, and how many words each kind has."""
        return np.unique(self.hash, return_index=True, return_inverse=True, return_counts=True)


def words_of(data: np.ndarray, off: np.ndarray, lower: bool = False, hashes: bool = True, gaps: np.ndarray = WORD_GAPS) -> Words:
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(data, none, none, none.astype(np.uint64), np.zeros(len(off), np.int64))
    if lower:
        data = LOWER[data]
    inside = ~gaps[data]
    heads = off[:-1][off[:-1] < n]
    joined = np.zeros(n, bool)  # byte continues the word of the byte before it
    joined[1:] = inside[1:] & inside[:-1]
    joined[heads] = False
    start = np.flatnonzero(inside & ~joined)
    last = inside.copy()
    last[:-1] &= ~joined[1:]
    end = np.flatnonzero(last) + 1
    first = np.searchsorted(start, off)
    if not hashes or not len(start):
        return Words(data, start, end, np.zeros(len(start), np.uint64), first)
    size = end - start
    at = np.cumsum(size) - size
    values = _BYTE[data[inside]]
    values *= powers(_BASE, int(size.max()))[np.arange(len(values)) - np.repeat(at, size)]
    return Words(data, start, end, mix64(np.add.reduceat(values, at) + size.astype(np.uint64)), first)


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte range, the ranges being neighbours that cover ``data``."""
    if not len(start):
        return np.zeros(0, np.uint64)
    size = end - start
    values = _BYTE[data]
    values *= powers(_BASE, int(size.max()))[np.arange(len(data)) - np.repeat(start, size)]
    return mix64(np.add.reduceat(values, start) + size.astype(np.uint64))


class RangeHash:
    """Hash of any range of a sequence of 64-bit values, from prefix sums modulo 2**64."""

    def __init__(self, values: np.ndarray) -> None:
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers(_BASE, n), out=self.sums[1:])
        self.back = powers(_INVERSE, n + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def window_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` keys, by doubling."""
    out, have = keys, 1
    while have * 2 <= width:
        out, have = np.minimum(out[:-have], out[have:]), have * 2
    rest = width - have
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out
