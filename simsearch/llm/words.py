"""Words of many texts at once, as 64-bit hashes in NumPy arrays.

A word is a longest run of bytes other than white space (or other separators). Its hash is a
polynomial over a random number per byte, then mixed; word sequences are hashed
the same way over their words' hashes. Two seeds give two independent hashes,
used together where equality must be certain.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

from simsearch.llm.texts import IS_SPACE, lower_ascii, utf8

# Odd multipliers and the finishing constants of a public 64-bit mixer.
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_SHIFT = np.uint64(33)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every bit of the values over all 64."""
    values = (values ^ (values >> _SHIFT)) * _MIX[0]
    values = (values ^ (values >> _SHIFT)) * _MIX[1]
    return values ^ (values >> _SHIFT)


# Powers of a base that stay in a worker's memory (8 bytes each): enough for a piece of usual size.
MOST_POWERS = 1 << 21
_powers: dict[int, np.ndarray] = {}


def powers(base: int, size: int) -> np.ndarray:
    """base**0 .. base**(size-1) modulo 2**64; up to MOST_POWERS are kept for the task's later pieces."""
    held = _powers.get(base)
    if held is None or len(held) < size:
        table = np.full(max(size, 1 << 16), base & (2**64 - 1), np.uint64)
        table[0] = 1
        held = np.multiply.accumulate(table, out=table)
        if len(held) <= MOST_POWERS:
            _powers[base] = held
    return held[:size]


@functools.cache
def _byte_values(seed: int) -> np.ndarray:
    return np.random.default_rng([7, seed]).integers(1, 2**64 - 1, 256, np.uint64)


class Words:
    """Places of the words of a column of texts: word i is raw[starts[i]:ends[i]].

    Row r has the words first[r] .. first[r + 1] - 1.
    """

    def __init__(self, column: pa.Array, lower: bool = False, separators: np.ndarray = IS_SPACE):
        raw, at = utf8(column)
        self.raw = lower_ascii(raw) if lower else raw
        self.separators = separators
        inside = ~separators[raw]
        begins, finishes = inside.copy(), inside.copy()
        if len(raw):
            begins[1:] &= ~inside[:-1]
            finishes[:-1] &= ~inside[1:]
            edges = at[:-1][np.diff(at) > 0]
            begins[edges] = inside[edges]
            edges = edges[edges > 0] - 1
            finishes[edges] = inside[edges]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(finishes) + 1
        self.first = np.searchsorted(self.starts, at)
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        if not len(self):
            return np.zeros(0, np.uint64)
        base = _BASES[seed]
        values = np.where(self.separators, np.uint64(0), _byte_values(seed))
        weighed = values[self.raw] * powers(base, len(self.raw))
        sums = np.add.reduceat(weighed, self.starts)
        return mix(sums * powers(pow(base, -1, 2**64), len(self.raw))[self.starts])

    def whole(self, hashes: np.ndarray) -> np.ndarray:
        """One hash of each row's whole word sequence."""
        return self._spans(hashes, self.first[:-1], self.first[1:])

    def runs(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """Hash of the ``length`` words from each word on; those that leave their row mean nothing."""
        begin = np.arange(max(0, len(hashes) - length + 1))
        found = np.zeros(len(hashes), np.uint64)
        found[:len(begin)] = self._spans(hashes, begin, begin + length)
        return found

    def fits(self, length: int) -> np.ndarray:
        """Whether ``length`` words from each word on lie in its row."""
        return np.arange(len(self)) + length <= np.repeat(self.first[1:], self.counts)

    def _spans(self, hashes, begin, end):
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * powers(_BASES[0], len(hashes)), out=sums[1:])
        back = powers(pow(_BASES[0], -1, 2**64), len(hashes) + 1)
        return mix((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64))


def sliding(reduce: np.ufunc, values: np.ndarray, length: int) -> np.ndarray:
    """``reduce`` over values[i : i + length], a power of two, cut short at the end."""
    found, width = values.copy(), 1
    while width < min(length, len(found)):
        found[:-width] = reduce(found[:-width], found[width:])
        width *= 2
    return found
