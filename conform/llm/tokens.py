"""Words of Arrow text columns as numpy arrays: whole batches at once, no Python loop over words.

A word is a maximal run of word bytes inside one text. Its hash is a polynomial over the bytes modulo 2^64 (one
prefix sum serves all words), finished by a mixer; runs of words are hashed the same way over the words' hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 19

# Odd multipliers of the polynomials over bytes and over words.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xC2B2AE3D27D4EB4F


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective mixer of 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(BYTE_BASE))

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
NOT_BLANK = ~BLANK
#: ASCII letters and digits, and every byte of a character beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


class _Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, kept and grown as needed."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, b in (("up", self.base), ("down", self.inverse)):
                p = np.full(size, b, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self.up[:n], self.down[:n]


BYTE_POWERS, WORD_POWERS = _Powers(BYTE_BASE), _Powers(WORD_BASE)


class Runs:
    """Hash of any run ``[start, end)`` of a sequence of 64-bit values, from one prefix sum."""

    def __init__(self, values: np.ndarray, powers: _Powers) -> None:
        up, self.down = powers.upto(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:-1], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.down[start])


@dataclass
class Words:
    """Words of ``n`` texts: byte spans in ``data``; the words of text i are ``first[i]:first[i + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self) -> np.ndarray:
        return Runs(BYTE_VALUE[self.data], BYTE_POWERS).hash(self.start, self.end)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type)
    _, off, data = column.buffers()
    n = len(column)
    if n == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def find_words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Words:
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(len(offsets), np.int64))
    w = is_word[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], after[-1] = False, False
    before[1:], after[:-1] = w[:-1], w[1:]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    start, end = np.flatnonzero(w & ~before), np.flatnonzero(w & ~after) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def blocks(column: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, slice) with about ``most`` bytes of text each, so that work arrays stay small."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    lo = 0
    while lo < len(sizes):
        upto = np.cumsum(sizes[lo:])
        hi = lo + max(1, int(np.searchsorted(upto, most, "right")))
        yield lo, column.slice(lo, hi - lo)
        lo = hi


def runs_of(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count: [2, 3] -> [0, 1, 0, 1, 2]."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
