"""Exact integer matrix products by Strassen's recursion, and heaps that merge."""

from __future__ import annotations

import numpy as np

#: Sides up to this are multiplied directly.
LEAF = 32
_EXACT = 1 << 53


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """int64 product of a leaf: in doubles where every partial sum is an exact double, else in integers modulo 2^64."""
    if a.size == 0 or b.size == 0:
        return np.zeros((a.shape[0], b.shape[1]), np.int64)
    top = max(abs(int(a.max())), abs(int(a.min()))) * max(abs(int(b.max())), abs(int(b.min()))) * a.shape[1]
    if top < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def multiply(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Product of int64 matrices of any shape, in seven half-sized products a level (Winograd's fifteen additions).

    Odd sides are padded with zeros.  Additions are exact in integers modulo
    2^64, so the result is right wherever it fits 64 bits, whatever the
    intermediate sums do.
    """
    m, k, n = *a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return product(a, b)
    a, b = np.pad(a, ((0, m % 2), (0, k % 2))), np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2  # noqa: E741
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    s1, t1 = a21 + a22, b12 - b11
    s2, t2 = s1 - a11, b22 - t1
    p1 = multiply(a11, b11, leaf)
    u2 = p1 + multiply(s2, t2, leaf)
    u3 = u2 + multiply(a11 - a21, b22 - b12, leaf)
    p5 = multiply(s1, t1, leaf)
    out = np.empty((2 * i, 2 * l), np.int64)
    out[:i, :l] = p1 + multiply(a12, b21, leaf)
    out[:i, l:] = u2 + p5 + multiply(a12 - s2, b22, leaf)
    out[i:, :l] = u3 - multiply(a22, t2 - b21, leaf)
    out[i:, l:] = u3 + p5
    return out[:m, :n]


class Heaps:
    """The ``k`` best entries of each of ``n`` heaps; best is a high score, then a small id, then a small row."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.of = np.zeros(0, np.int64)
        self.score, self.id, self.row = self.of, self.of, self.of

    def merge(self, of: np.ndarray, score: np.ndarray, ids: np.ndarray, row: np.ndarray) -> None:
        of, score, ids, row = (np.concatenate(x) for x in ((self.of, of), (self.score, score), (self.id, ids), (self.row, row)))
        by = np.lexsort((row, ids, -score, of))
        of = of[by]
        best = np.arange(len(of)) - np.searchsorted(of, of) < self.k  # places in their own heap
        self.of = of[best]
        self.score, self.id, self.row = (x[by][best] for x in (score, ids, row))

    def floor(self) -> np.ndarray:
        """The score an entry needs to enter each heap (any, if it isn't full)."""
        out = np.full(self.n, np.iinfo(np.int64).min)
        count = np.bincount(self.of, minlength=self.n)
        last = np.cumsum(count) - 1
        full = count == self.k
        out[full] = self.score[last[full]]
        return out


def top_entries(scores: np.ndarray, allowed: np.ndarray | None, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the entries that may be among the ``k`` best of their row, all ties included."""
    low = np.iinfo(np.int64).min
    s = scores if allowed is None else np.where(allowed, scores, low)
    if s.shape[1] > k:
        floor = np.maximum(floor, np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k])
    return np.nonzero((s >= floor[:, None]) & (s > low))


def windows_in(scores: np.ndarray, allowed: np.ndarray, of: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, column) of the ``k`` highest entries of each window, leftmost first among ties.

    Window w takes allowed entries of row ``of[w]`` (ascending) with a score
    of ``low[w]`` to ``high[w]``.
    """
    m = scores.shape[0]
    least, most = np.full(m, np.iinfo(np.int64).max), np.full(m, np.iinfo(np.int64).min)
    np.minimum.at(least, of, low)
    np.maximum.at(most, of, high)
    i, j = np.nonzero(allowed & (scores >= least[:, None]) & (scores <= most[:, None]))
    s = scores[i, j]
    by = np.lexsort((j, -s, i))
    i, j, s = i[by], j[by], s[by]
    # Windows sorted among the entries, each before those it may take.
    order = np.lexsort((np.repeat([1, 0], [len(i), len(of)]), -np.concatenate([s, high]), np.concatenate([i, of])))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    before = np.cumsum(order < len(i))  # entries up to each place
    first = before[place[len(i) :]]
    end = np.searchsorted(i, of, side="right")
    at = first[:, None] + np.arange(k)
    inside = at < end[:, None]
    safe = np.where(inside, at, 0)
    inside &= (s[safe] >= low[:, None]) if len(s) else False
    w, c = np.nonzero(inside)
    return w, j[at[w, c]]
