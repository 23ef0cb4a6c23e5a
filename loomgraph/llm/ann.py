"""Approximate nearest neighbours by low-dimensional stable projections, indexed by a kd-tree.

Rows are dealt to blocks by their norms, and a block is cut in shells within which norms differ by a factor of two
at most.  In a shell, scaled to a longest norm of 1, largest inner product becomes least Euclidean distance by one more
component, sqrt(1 - |x|^2) for a row and 0 for a query of norm 1.  Rows and queries are projected by one Gaussian
(2-stable) matrix to a few dimensions, where a kd-tree over all rows of the shell gives the leaves that can hold rows near enough,
and these their rows in order of projected distance, as far as the k-th found so far asks for them.
Rows are verified with their original vectors in that order until the chi-square test holds: for a row at
distance d the squared projected distance over d^2 follows the chi-square law with as many degrees of freedom as
dimensions, so once the next row is so far that one as near as the k-th found would lie beyond it with
probability 1 - ``SURE`` at most, the search stops.  The k-th of all blocks read so far counts, and a shell whose longest
vector cannot reach it is not opened.

Equal vectors of a block are indexed once, with all their ids; scores are sums of doubles, row by row, so that equal
vectors score alike in all blocks.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do rows
with a null id; shorter vectors count as ending in zeros; ties go to the smaller id; repeated rows are
candidates each; an empty table gives an empty result; with fewer candidates than k all are returned; an inner product
beyond the range of doubles counts, and is returned, as an infinity of its sign; other columns of the input, whatever their
names, are ignored."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.vectors import Best, search

#: Projected dimensions (even; at most half of a vector's), rows of a leaf, certainty of the stopping test for one neighbour.
DIMS, LEAF, SURE = 32, 64, 0.88
#: Rows verified between two tests at first (it doubles), rows that are put in order before a k-th is known, and queries that
#: read leaves together.
CHUNK, FIRST, BATCH = 32, 512, 32
#: Projected distances are single-precision: what they may be off.
NOISE = 1e-4
SEED = 7


def chi_square_cdf(x: float, dof: int) -> float:
    """For even degrees of freedom."""
    term, total = 1.0, 1.0
    for i in range(1, dof // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def chi_square_quantile(p: float, dof: int) -> float:
    low, high = 0.0, 1.0
    while chi_square_cdf(high, dof) < p:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, dof) < p else (low, mid)
    return high


def kd_leaves(points: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Row numbers by leaf: halves at the median of the widest dimension."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            out.append(rows)
            continue
        p = points[rows]
        d = int(np.argmax(p.max(axis=0) - p.min(axis=0)))
        order = np.argpartition(p[:, d], len(rows) // 2)
        todo += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return out


def distinct(ids: np.ndarray, x: np.ndarray):
    """The distinct rows of x, all ids in order of (row, id), and where each row's ids start and end."""
    x, seen = x + 0.0, {}  # no -0.0
    which = np.array([seen.setdefault(row.tobytes(), len(seen)) for row in x], np.int64)
    order = np.lexsort((ids, which))
    stop = np.cumsum(np.bincount(which))
    start = np.concatenate([[0], stop[:-1]])
    return x[order[start]], ids[order], start, stop


def _others(ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """The first k of the sorted ids that are not ``own``."""
    a, b = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
    return np.concatenate([ids[: min(a, k)], ids[b : b + max(0, k - a)]])


def norms(x: np.ndarray) -> np.ndarray:
    """Without overflow."""
    top = np.abs(x).max(axis=1, initial=0.0)
    unit = x / np.where(top > 0, top, 1.0)[:, None]
    with np.errstate(over="ignore"):
        return top * np.sqrt((unit * unit).sum(axis=1))


class Shell:
    """Rows whose norms differ by a factor of two at most."""

    def __init__(self, x: np.ndarray, rows: np.ndarray, norm: np.ndarray, dims: int):
        dim = x.shape[1]
        #: A power of two, so that scaling loses nothing; norms beyond the range of doubles count as the largest.
        self.scale = math.ldexp(1.0, min(1023, math.frexp(min(norm.max(), np.finfo(float).max))[1]))
        unit = x[rows] / self.scale
        square = (unit * unit).sum(axis=1)
        self.longest = math.sqrt(square.max())
        unit, square = unit / self.longest, square / square.max()
        self.projection = np.random.default_rng(SEED).standard_normal((dim + 1, dims))
        points = unit @ self.projection[:dim] + np.sqrt(np.maximum(1 - square, 0.0))[:, None] * self.projection[dim]
        leaves = kd_leaves(points, LEAF)
        order = np.concatenate(leaves)
        self.rows, self.points = rows[order], points[order].astype(np.float32)
        self.square = (self.points * self.points).sum(axis=1)
        self.stop = np.cumsum([len(r) for r in leaves])
        self.start = self.stop - [len(r) for r in leaves]
        self.low = np.array([points[r].min(axis=0) for r in leaves], np.float32) - np.float32(1e-5)
        self.high = np.array([points[r].max(axis=0) for r in leaves], np.float32) + np.float32(1e-5)


class Index:
    """The index of a block; ``verified`` counts the rows scored with their original vectors."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, dims: int = DIMS, sure: float = SURE):
        self.x, self.ids, self.start, self.stop = distinct(ids, x)
        dims = max(2, min(dims, x.shape[1] // 4 * 2))
        self.limit, self.verified = chi_square_quantile(sure, dims), 0
        norm = norms(self.x)
        self.size = float(np.abs(self.x).sum(axis=1).max()) if len(self.x) else 0.0
        order = np.argsort(-norm, kind="stable")
        self.shells = []
        while len(order):
            n = max(1, int(np.searchsorted(-norm[order], -norm[order[0]] / 2)))
            self.shells.append(Shell(self.x, order[:n], norm[order[:n]], dims))
            order = order[n:]

    def search(self, q_ids: np.ndarray, q: np.ndarray, best: Best) -> None:
        for a in range(0, len(q), BATCH):
            for shell in self.shells:
                self._shell(shell, range(a, min(len(q), a + BATCH)), q_ids, q, best)

    def _score(self, rows: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Inner products with the original vectors, row by row."""
        x = self.x[rows]
        with np.errstate(over="ignore", invalid="ignore"):
            s = (x * v).sum(axis=1)
            if not np.isfinite(s).all():  # scaled down before the sum, and up again after it
                a, b = math.ldexp(1.0, -520), math.ldexp(1.0, 520)
                s = np.where(np.isfinite(s), s, ((x * a) * (v * a)).sum(axis=1) * b * b)
        return s

    def _beyond(self, shell: Shell, i: int, length: float, best: Best) -> float:
        """The squared projected distance at which the test holds; -1 if no row of the shell can reach the k-th."""
        kth = best.kth(i)
        if kth is None:
            return math.inf
        square = 2 - 2 * max(-1.0, kth / (shell.longest * shell.scale) / length)  # of the k-th so far, in the shell's geometry
        return -1.0 if square < -1e-9 else self.limit * max(square, 0.0) + NOISE

    def _shell(self, shell: Shell, some: range, q_ids: np.ndarray, q: np.ndarray, best: Best) -> None:
        """The queries of a batch share the reading of leaves; each has its own order and its own test."""
        length = norms(q[some.start : some.stop])
        left = [i for i in some if self._beyond(shell, i, length[i - some.start], best) >= 0]
        if not left:
            return
        v = q[left]
        unit = v / np.abs(v).max(axis=1)[:, None]
        at = ((unit / norms(unit)[:, None]) @ shell.projection[:-1]).astype(np.float32)
        # The least distance of a row in each leaf, and of those leaves that any query may still open, the rows' own.
        gap = np.maximum(np.maximum(shell.low[None] - at[:, None], at[:, None] - shell.high[None]), 0.0)
        far = np.einsum("qld,qld->ql", gap, gap)
        limits = np.array([self._beyond(shell, i, length[i - some.start], best) for i in left])
        leaves = np.flatnonzero((far <= limits[:, None]).any(axis=0))
        rows = np.concatenate([np.arange(shell.start[j], shell.stop[j]) for j in leaves]) if len(leaves) < len(shell.start) else slice(None)
        points = shell.points[rows]
        distance = np.maximum((at * at).sum(axis=1)[:, None] + shell.square[rows][None] - 2 * (at @ points.T), 0.0)
        numbers = shell.rows[rows]
        for d, i, w in zip(distance, left, v, strict=True):
            self._nearest(shell, d, numbers, i, q_ids[i], w, length[i - some.start], best)

    def _nearest(self, shell: Shell, d: np.ndarray, numbers: np.ndarray, i: int, own: int, v: np.ndarray, length: float, best: Best) -> None:
        """Verifies rows in order of their projected distance until the test holds."""
        chunk = CHUNK
        if best.kth(i) is None and len(d) > FIRST:
            near = np.argpartition(d, FIRST)[:FIRST]
        else:
            near = np.flatnonzero(d <= self._beyond(shell, i, length, best))
        near = near[np.argsort(d[near], kind="stable")]
        left = np.ones(len(d), bool)
        while True:
            while len(near):
                n = int(np.searchsorted(d[near[:chunk]], self._beyond(shell, i, length, best), "right"))
                self._verify(numbers[near[:n]], i, own, v, best)
                if n < min(chunk, len(near)):
                    return
                left[near[:n]] = False
                near, chunk = near[n:], chunk * 2
            near = np.flatnonzero(left & (d <= self._beyond(shell, i, length, best)))
            if not len(near):
                return
            near = near[np.argsort(d[near], kind="stable")]

    def _verify(self, rows: np.ndarray, i: int, own: int, v: np.ndarray, best: Best) -> None:
        self.verified += len(rows)
        kth = best.kth(i)
        if kth is not None and len(rows) > 64:  # only those near the k-th are scored row by row
            with np.errstate(over="ignore", invalid="ignore"):
                rough = self.x[rows] @ v
                rows = rows[~(rough < kth - 1e-9 * abs(kth) - 1e-12 * self.size * np.abs(v).max())]
        score = self._score(rows, v)
        if kth is not None:
            near = score >= kth
            rows, score = rows[near], score[near]
        # Of many rows that hold an id beside the query's own, those count that reach the k-th of them.
        a, b = self.start[rows], self.stop[rows]
        there = (b - a > 1) | (self.ids[a] != own)
        rows, score = rows[there], score[there]
        if len(rows) > best.k:
            near = score >= np.partition(score, len(score) - best.k)[len(score) - best.k]
            rows, score = rows[near], score[near]
        found = [_others(self.ids[self.start[j] : self.stop[j]], own, best.k) for j in rows]
        if found:
            best.add(i, np.concatenate(found), np.repeat(score, [len(f) for f in found]))


def nearest(table: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score."""
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v * v))
    return search(table, every, k, False, "near", Index, F.desc(F.round(F.log2(norm), 1)))
