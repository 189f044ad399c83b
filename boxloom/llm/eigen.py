"""Leading eigenvalues and eigenvectors of a symmetric matrix."""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps
# Eigenvalues closer than this share of the matrix's norm are one cluster.
_CLUSTER = 1e-3
_STEPS = 5


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and reflectors of Householder's form."""
    a = np.array(matrix, dtype=float)
    n, reflectors = len(a), []
    off = np.zeros(max(0, n - 1))
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        size = np.abs(v).max()
        if size == 0 or not np.any(v[1:]):
            off[k] = v[0]
            reflectors.append(np.zeros(len(v)))
            continue
        norm = size * np.linalg.norm(v / size)
        top = -norm if v[0] >= 0 else norm
        v[0] -= top
        v /= np.linalg.norm(v)
        off[k] = top
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        reflectors.append(v)
    if n > 1:
        off[n - 2] = a[n - 1, n - 2]
    return np.diag(a).copy(), off, reflectors


def _below(diagonal: np.ndarray, squares: np.ndarray, tiny: float, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues are below each point: negative pivots of the Sturm sequence."""
    count, q = np.zeros(len(at), int), np.full(len(at), np.inf)
    for i, d in enumerate(diagonal):
        q = d - at - (squares[i - 1] / q if i else 0)
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def bisected(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling."""
    n = len(diagonal)
    reach = np.concatenate([np.abs(off), [0]]) + np.concatenate([[0], np.abs(off)])
    low, high = (diagonal - reach).min(), (diagonal + reach).max()
    norm = max(abs(low), abs(high))
    index = n - 1 - np.arange(k)
    lo, hi = np.full(k, low - 4 * _EPS * norm), np.full(k, high + 4 * _EPS * norm)
    tiny = max(_EPS * _EPS * norm, np.finfo(float).tiny)
    while True:
        middle = lo + (hi - lo) / 2
        if not np.any((middle > lo) & (middle < hi)):
            return hi
        under = _below(diagonal, off * off, tiny, middle) > index
        lo, hi = np.where(under, lo, middle), np.where(under, middle, hi)


def _solved(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, tiny: float) -> np.ndarray:
    """Solution of the shifted tridiagonal system, by elimination with row exchanges."""
    n = len(diagonal)
    u0, u1, u2, y = np.zeros(n), np.zeros(n), np.zeros(n), right.astype(float).copy()
    a, b = diagonal[0] - shift, off[0] if n > 1 else 0.0
    for i in range(n - 1):
        c, d, e = off[i], diagonal[i + 1] - shift, off[i + 1] if i + 2 < n else 0.0
        if abs(c) > abs(a):
            u0[i], u1[i], u2[i] = c, d, e
            factor = a / c
            a, b = b - factor * d, -factor * e
            y[i], y[i + 1] = y[i + 1], y[i] - factor * y[i + 1]
        else:
            u0[i], u1[i] = a if a else tiny, b
            factor = c / u0[i]
            a, b = d - factor * b, e
            y[i + 1] -= factor * y[i]
    u0[n - 1] = a
    u0 = np.where(np.abs(u0) < tiny, tiny, u0)
    for i in range(n - 1, -1, -1):
        y[i] -= u1[i] * y[i + 1] if i + 1 < n else 0
        y[i] -= u2[i] * y[i + 2] if i + 2 < n else 0
        y[i] /= u0[i]
        if abs(y[i]) > 1e200:
            y *= 1e-200
    return y


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors as columns."""
    n = len(matrix)
    k, scale = min(k, n), np.abs(matrix).max()
    if not scale:
        return np.zeros(k), np.eye(n)[:, :k]
    # Scaled, so that no product leaves the range of doubles.
    diagonal, off, reflectors = tridiagonal(np.asarray(matrix) / scale)
    values = bisected(diagonal, off, k)
    norm = max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0))
    tiny = _EPS * norm
    vectors, shift, first = np.zeros((n, k)), np.inf, 0
    chance = np.random.default_rng(0)
    for j in range(k):
        if j and values[j - 1] - values[j] > _CLUSTER * norm:
            first = j
        # Equal shifts would give one vector twice.
        shift = min(values[j], shift - 10 * _EPS * norm) if j > first else values[j]
        y = chance.standard_normal(n)
        for _ in range(_STEPS):
            y = _solved(diagonal, off, shift, y / np.linalg.norm(y), tiny)
            y /= np.abs(y).max()
            for _ in range(2):
                y -= vectors[:, first:j] @ (vectors[:, first:j].T @ y)
        vectors[:, j] = y / np.linalg.norm(y)
    for at in range(len(reflectors) - 1, -1, -1):
        v = reflectors[at]
        vectors[at + 1 :] -= 2 * np.outer(v, v @ vectors[at + 1 :])
    return values * scale, vectors
