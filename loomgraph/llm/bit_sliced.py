"""Exact top-k by a bit-sliced index.

A block of rows keeps, for each attribute, the bitmaps of the upper bits of its quantised value.  A query
adds them, each as often as its own upper bits say, with bitmap arithmetic (ripple-carry adders over words of
64 rows).  The sum's slices, read from the most significant down, give the k-th largest coarse score.  As the
coarse score is off by a known bound at most, every row that can be among the first k lies above that score
less twice the bound; those boundary rows alone are scored exactly.

Defined cases: vectors that are null or hold null or non-finite components take no part, nor do rows with a
null id; shorter vectors count as ending in zeros; ties go to the smaller id; repeated rows are candidates
each; an empty table gives an empty result; with fewer candidates than k all are returned.  Any finite component takes part:
quantised values and scores beyond 64 bits are Python's integers, and a score beyond the range of a long counts, and is returned,
as the nearest long.  Other columns of the input, whatever their names, are ignored."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame

from loomgraph.llm.vectors import Best, search

#: Bits of an attribute, and of a query's component, that enter the coarse sum.
ROW_BITS, QUERY_BITS = 7, 6
SCALE = 1024


#: A score is a long.
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def quantised(x: np.ndarray) -> np.ndarray:
    """As 64-bit integers, if all fit, else as Python's."""
    if np.abs(x).max(initial=0.0) < 2.0**52:
        return np.floor(SCALE * x).astype(np.int64)
    floor = lambda v: math.floor(SCALE * v) if abs(v) < 2.0**52 else SCALE * int(v)  # noqa: E731  larger doubles are whole
    return np.array([[floor(v) for v in row] for row in x.tolist()], object).reshape(x.shape)


def _narrow(x: np.ndarray, bits: int) -> np.ndarray:
    """As 64-bit integers if ``bits`` are enough for whatever is made of them."""
    return x.astype(np.int64) if bits < 63 else x.astype(object)


def _bits(x: np.ndarray) -> int:
    """Of the largest absolute value."""
    return max(int(x.max(initial=0)).bit_length(), int(-x.min(initial=0)).bit_length())


def _pack(bits: np.ndarray) -> np.ndarray:
    """Bitmaps of a (rows, n) array of truth values, as (n, words)."""
    rows = -(-len(bits) // 64) * 64
    wide = np.zeros((rows, bits.shape[1]), bool)
    wide[: len(bits)] = bits
    return np.packbits(wide, axis=0, bitorder="little").T.copy().view(np.uint64)


def _shift(top: int, bits: int) -> int:
    return max(0, int(top).bit_length() - bits)


class Slices:
    """A sum held as bitmaps, least significant first."""

    def __init__(self, n: int, words: int):
        self.s = np.zeros((n, words), np.uint64)

    def add(self, slices: np.ndarray, at: int) -> None:
        """Adds slices * 2 ** at to every row."""
        s, carry = self.s, None
        for i, x in enumerate(slices, at):
            a = s[i]
            half = a ^ x
            if carry is None:
                carry = a & x
                s[i] = half
            else:
                over = (a & x) | (half & carry)
                s[i] = half ^ carry
                carry = over
        i = at + len(slices)
        while i < len(s) and carry.any():
            over = s[i] & carry
            s[i] ^= carry
            carry = over
            i += 1

    def kth(self, k: int, there: np.ndarray) -> int:
        """The k-th largest sum among the rows in ``there``, from the most significant slice downward."""
        above, equal, value = 0, there.copy(), 0
        for i in range(len(self.s) - 1, -1, -1):
            ones = equal & self.s[i]
            n = int(np.bitwise_count(ones).sum())
            if above + n >= k:
                equal, value = ones, value | 1 << i
            else:
                above, equal = above + n, equal & ~self.s[i]
        return value

    def at_least(self, value: int, there: np.ndarray) -> np.ndarray:
        """The bitmap of rows whose sum is ``value`` or more."""
        if value <= 0:
            return there
        if value >> len(self.s):
            return np.zeros_like(there)
        more, equal = np.zeros_like(there), there.copy()
        for i in range(len(self.s) - 1, -1, -1):
            if value >> i & 1:
                equal &= self.s[i]
            else:
                more |= equal & self.s[i]
                equal &= ~self.s[i]
        return more | equal


class Index:
    """The index of a block."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, quantised(x)
        n, dim = x.shape
        self.low = self.x.min(axis=0)
        raised = _narrow(self.x, _bits(self.x) + 1) - self.low  # from 0 on
        self.shift = _shift(raised.max(initial=0), ROW_BITS)
        coarse = (raised >> self.shift).astype(np.int64)
        self.slices = [_pack((coarse[:, d, None] >> np.arange(ROW_BITS)) & 1 > 0) for d in range(dim)]
        self.there = _pack(np.ones((n, 1), bool))[0]
        self.times = Counter(ids.tolist())

    def search(self, q_ids: np.ndarray, q: np.ndarray, best: Best) -> None:
        q = quantised(q)
        x, dim = self.x, q.shape[1]
        wide = _bits(x) + _bits(q) + dim.bit_length()
        x, q, low = _narrow(x, wide), _narrow(q, wide), _narrow(self.low, wide)
        n, words = len(x), len(self.there)
        for i, (own, v) in enumerate(zip(q_ids, q, strict=True)):
            # score = sum v * x, and x = low + raised: only sum v * raised differs between rows.  A component below 0
            # counts as -v times the complement.
            size = np.abs(v)
            up = _shift(size.max(initial=0), QUERY_BITS)
            c = size >> up
            total = Slices(ROW_BITS + QUERY_BITS + int(dim).bit_length() + 1, words)
            for d in np.flatnonzero(c):
                s = self.slices[d] if v[d] > 0 else ~self.slices[d]
                for b in range(QUERY_BITS):
                    if c[d] >> b & 1:
                        total.add(s, b)
            unit = 1 << (self.shift + up)
            slack = -(-_bound(size, c, self.shift, up, ROW_BITS) // unit)
            least = total.kth(min(best.k + self.times[int(own)], n), self.there)
            # The sum of a row with the k-th score of the blocks before, or with a score that no long exceeds.
            base = sum(int(a) * int(b) for a, b in zip(v, low, strict=True)) - sum(int(a) * (((1 << ROW_BITS) - 1) << self.shift) for a in size[v < 0])
            before = best.kth(i)
            if before is not None and before > LEAST:
                least = max(least, (int(before) - base) // unit)
            least = min(least, (MOST - base) // unit)
            rows = np.flatnonzero(np.unpackbits(total.at_least(least - slack, self.there).view(np.uint8), bitorder="little")[:n])
            rows = rows[self.ids[rows] != own]
            score = x[rows] @ v
            if score.dtype == object:
                score = np.array([min(MOST, max(LEAST, int(s))) for s in score], np.int64)
            best.add(i, self.ids[rows], score)


def _bound(v: np.ndarray, c: np.ndarray, shift: int, up: int, bits: int) -> int:
    """How far apart the errors of two rows' coarse sums can be: |v| times what the row's lower bits hold, and
    what the query's lower bits hold times the row's range."""
    rest = sum(int(a) - (int(b) << up) for a, b in zip(v, c, strict=True)) * (((1 << bits) - 1) << shift)
    return sum(map(int, v)) * ((1 << shift) - 1) + rest


def top_k(table: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score."""
    return search(table, every, k, True, "bits", Index)
