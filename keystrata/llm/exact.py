"""Exact inner products of vectors of whole numbers held as doubles."""

from __future__ import annotations

import numpy as np


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left (a x d) times right (b x d): all a x b inner products, exact, as int64.

    Products and sums that stay under 2**53 are exact as floats, and those of such rows are one matrix
    product; rows of right that might exceed it go by Python's whole numbers. An
    inner product beyond 64 bits is an error.
    """
    most = np.abs(left).max(initial=0.0) * max(1, left.shape[1])
    small = np.abs(right).max(axis=1, initial=0.0) * most < 2.0**53
    if small.all():  # also where there are no rows
        return (left @ right.T).astype(np.int64)
    out = np.empty((len(left), len(right)), np.int64)
    out[:, small] = (left @ right[small].T).astype(np.int64)
    whole = [[int(v) for v in row] for row in left]
    for b in np.flatnonzero(~small):
        other = [int(v) for v in right[b]]
        # an int beyond int64 raises here
        out[:, b] = [sum(p * q for p, q in zip(row, other, strict=True)) for row in whole]
    return out
