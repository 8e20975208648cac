"""Order statistics of sliding windows: how many values, and what sum of them, lie above a bound.

A window is covered by at most two blocks of each size 1, 2, 4, ...: blocks of one size are sorted side by side, and a
bound's place in a block is a binary search over all rows at once. A row costs the square of the logarithm of the window
instead of the window. Sums are added up inside blocks that lie in the window, so nothing is subtracted and values that
have left the window leave nothing behind.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def full_windows(null: np.ndarray, n: int) -> np.ndarray:
    """Last rows of the windows of n rows without a null."""
    at = np.arange(len(null))
    last_null = np.maximum.accumulate(np.where(null, at, -1))
    return np.flatnonzero((at >= n - 1) & (last_null <= at - n))


def _cover(lo: np.ndarray, hi: np.ndarray):
    """(size, rows, blocks): for each block size, which of the ranges [lo, hi) use which block of that size."""
    lo, hi, size, rows = lo.copy(), hi.copy(), 1, np.arange(len(lo))
    while len(rows):
        left = (lo & size).astype(bool) & (lo < hi)  # the lowest block that a larger one doesn't hold
        if left.any():
            yield size, rows[left], lo[left] // size
            lo[left] += size
        right = (hi & size).astype(bool) & (lo < hi)
        if right.any():
            hi[right] -= size
            yield size, rows[right], hi[right] // size
        open_ = lo < hi
        rows, lo, hi, size = rows[open_], lo[open_], hi[open_], 2 * size


def above(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray | None, sums: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """For each range [lo, hi) of x: the number of values above its bound (None: of all) and, with ``sums``, their sum.
    NaN is above all numbers."""
    order = np.argsort(x, kind="stable")
    place = np.empty(len(x), np.int64)
    place[order] = np.arange(len(x))
    under = np.zeros(len(lo), np.int64) if bound is None else np.searchsorted(x[order], bound, side="right")  # places of values up to the bound come before
    count, total = np.zeros(len(lo), np.int64), np.zeros(len(lo))
    last, keys, tails = 0, None, None
    for size, rows, blocks in _cover(lo, hi):
        if size != last:
            whole = len(x) // size * size
            p = np.sort(place[:whole].reshape(-1, size), axis=1)
            keys = (p + np.arange(len(p))[:, None] * (len(x) + 1)).reshape(-1)
            if sums:  # a block's largest value, its two largest, ...
                tails = np.cumsum(x[order][p[:, ::-1]], axis=1)
            last = size
        k = (blocks + 1) * size - np.searchsorted(keys, blocks * (len(x) + 1) + under[rows])
        count[rows] += k
        if sums:
            total[rows] += np.where(k > 0, tails[blocks, np.maximum(k, 1) - 1], 0.0)
    return count, total


def _rows(x: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    null = x.is_null().to_numpy(zero_copy_only=False)
    return x.fill_null(0.0).to_numpy(zero_copy_only=False), full_windows(null, n), np.ones(len(x), bool)


def _shown(made: np.ndarray, at: np.ndarray, missing: np.ndarray) -> pa.Array:
    out = np.zeros(len(missing))
    out[at], missing[at] = made, False
    return pa.array(out, mask=missing)


def count_greater(x: pa.Array, n: int) -> pa.Array:
    """How many of the newest n values are greater than the newest; null unless all n are there."""
    v, at, missing = _rows(x, n)
    return _shown(above(v, at - n + 1, at + 1, v[at])[0], at, missing)


def mean_deviation(x: pa.Array, n: int) -> pa.Array:
    """The mean distance of the newest n values from their mean; null unless all n are there, NaN with a NaN among them, and
    exactly 0 for equal values."""
    v, at, missing = _rows(x, n)
    lo, hi = at - n + 1, at + 1
    mean = above(v, lo, hi, None, sums=True)[1] / n
    count, total = above(v, lo, hi, mean, sums=True)
    turn = np.maximum.accumulate(np.where(np.append(True, v[1:] != v[:-1]), np.arange(len(v)), 0)) if len(v) else at
    return _shown(np.where(np.isnan(mean), mean, np.where(turn[at] <= lo, 0.0, 2 * (total - count * mean) / n)), at, missing)
