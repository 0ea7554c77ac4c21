"""Exact nearest centroids of a batch of points, by tiles of matrix products.

A tile of ``|x|^2 - 2 x.c + |c|^2`` finds the centroids that can be the
nearest within its rounding error; only these distances are then computed
as the square root of summed squares, which decides.  So the result is that
of the plain definition (ties go to the lowest place), at the speed of a matrix
product, in ``TILE_VALUES`` numbers whatever the number of centroids.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

# Numbers of one tile, and points that a tile has at least.
TILE_VALUES = 1 << 20
_LEAST_ROWS = 64


def distances(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    """(n, k) Euclidean distances of points X to centroids C."""
    D = np.empty((X.shape[0], C.shape[0]))
    for t in range(C.shape[0]):
        diff = X - C[t]
        D[:, t] = np.sqrt(np.einsum("ij,ij->i", diff, diff))
    return D


def _pairs(X: np.ndarray, C: np.ndarray, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Distances of the pairs (X[r], C[c])."""
    out = np.empty(len(r))
    step = max(1, TILE_VALUES // max(1, X.shape[1]))
    for s in range(0, len(r), step):
        diff = X[r[s:s + step]] - C[c[s:s + step]]
        out[s:s + step] = np.sqrt(np.einsum("ij,ij->i", diff, diff))
    return out


def _tile(X: np.ndarray, xx: np.ndarray, C: np.ndarray, cc: np.ndarray):
    """(place in C, distance, lower bound of the second distance)."""
    n, rows = len(X), np.arange(len(X))
    with np.errstate(over="ignore", invalid="ignore"):
        A = X @ C.T
        A *= -2.0
        A += cc
        A += xx[:, None]
    # a dot product of d terms is off by less than d eps |x||c|
    slack = (xx + cc.max()) * (X.shape[1] + 8) * 5e-16
    limit = A.min(axis=1) + 2.0 * slack
    r, c = np.nonzero(A <= limit[:, None])
    if len(r) < n or not np.isfinite(limit).all():  # squares beyond a double
        D = distances(X, C)
        at = D.argmin(axis=1)
        dist = D[rows, at]
        D[rows, at] = np.inf
        return at, dist, D.min(axis=1, initial=np.inf)
    exact = _pairs(X, C, r, c)
    first = np.searchsorted(r, rows)
    dist = np.minimum.reduceat(exact, first)
    wins = np.flatnonzero(exact == dist[r])  # rows ascend, and places within a row
    at = c[wins[np.searchsorted(r[wins], rows)]]
    A[rows, at] = np.inf
    return at, dist, np.sqrt(np.maximum(A.min(axis=1, initial=np.inf) - slack, 0.0))


def nearest(X: np.ndarray, chunks: Iterable[tuple[int, np.ndarray]]):
    """(place, distance, lower bound of the distance to any other) of every
    point's nearest centroid; ``chunks`` are (offset, matrix) pieces of the
    centroids in order."""
    n = len(X)
    place, best, second = np.zeros(n, dtype=np.int64), np.full(n, np.inf), np.full(n, np.inf)
    xx = np.einsum("ij,ij->i", X, X)
    for off, C in chunks:
        wide = max(1, TILE_VALUES // _LEAST_ROWS)
        for k in range(0, len(C), wide):
            part = C[k:k + wide]
            cc = np.einsum("ij,ij->i", part, part)
            rows = max(_LEAST_ROWS, TILE_VALUES // len(part))
            for s in range(0, n, rows):
                own = slice(s, s + rows)
                at, dist, other = _tile(X[own], xx[own], part, cc)
                closer = dist < best[own]
                second[own] = np.minimum(np.where(closer, best[own], dist), np.minimum(second[own], other))
                place[own] = np.where(closer, at + off + k, place[own])
                best[own] = np.where(closer, dist, best[own])
    return place, best, second
