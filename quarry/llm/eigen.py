"""Leading eigenpairs of a symmetric matrix: Householder tridiagonal form, bisection by Sturm counts, inverse iteration.

Works on one matrix of the size of a vector's dimension, never on rows of a table.
"""

from __future__ import annotations

import numpy as np

#: Eigenvalues closer than this part of the matrix' norm form a cluster, whose vectors are made orthogonal to each other.
CLUSTER = 1e-3
STEPS = 5


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Diagonal, off-diagonal and the reflections (first row, unit vector) that lead to them."""
    a = a.copy()
    reflections = []
    for k in range(len(a) - 2):
        x = a[k + 1 :, k]
        norm = np.linalg.norm(x)
        if not np.any(x[1:]):
            continue
        beta = -np.copysign(norm, x[0])
        v = x.copy()
        v[0] -= beta
        v /= np.linalg.norm(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1 :, k] = 0
        a[k + 1, k] = beta
        reflections.append((k + 1, v))
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def count_below(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Number of eigenvalues of the tridiagonal matrix that are less than each x (signs of its Sturm sequence)."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    n, q = np.zeros(len(x), np.int64), np.ones(len(x))
    for d, e in zip(diagonal, np.insert(off, 0, 0)):
        q = d - x - e * e / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        n += q < 0
    return n


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection of the Gershgorin interval."""
    reach = np.abs(np.append(off, 0)) + np.abs(np.insert(off, 0, 0))
    low, high = np.full(k, np.min(diagonal - reach)), np.full(k, np.max(diagonal + reach))
    nth = len(diagonal) - 1 - np.arange(k)  # place in rising order
    while True:
        middle = (low + high) / 2
        open_ = (middle > low) & (middle < high)
        if not open_.any():
            return middle
        right = count_below(diagonal, off, middle) <= nth
        low, high = np.where(open_ & right, middle, low), np.where(open_ & ~right, middle, high)


def _solve(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """(T - shift) x = b for each shift and column of b, by elimination with row exchanges; small pivots become ``least``."""
    d, k = b.shape
    zero = np.zeros(k)
    u0, u1, u2, x = np.empty((d, k)), np.zeros((d, k)), np.zeros((d, k)), b.copy()
    p0, p1 = diagonal[0] - shifts, np.full(k, off[0] if d > 1 else 0.0)
    for i in range(d - 1):
        q0, q1, q2 = np.full(k, off[i]), diagonal[i + 1] - shifts, np.full(k, off[i + 1] if i + 2 < d else 0.0)
        swap = np.abs(q0) > np.abs(p0)
        u0[i], u1[i], u2[i] = np.where(swap, q0, p0), np.where(swap, q1, p1), np.where(swap, q2, zero)
        r0, r1, r2 = np.where(swap, p0, q0), np.where(swap, p1, q1), np.where(swap, zero, q2)
        u0[i] = np.where(np.abs(u0[i]) < least, least, u0[i])
        f = r0 / u0[i]
        p0, p1 = r1 - f * u1[i], r2 - f * u2[i]
        top, bottom = np.where(swap, x[i + 1], x[i]), np.where(swap, x[i], x[i + 1])
        x[i], x[i + 1] = top, bottom - f * top
    u0[d - 1] = np.where(np.abs(p0) < least, least, p0)
    x[d - 1] /= u0[d - 1]
    for i in range(d - 2, -1, -1):
        x[i] -= u1[i] * x[i + 1] + (u2[i] * x[i + 2] if i + 2 < d else 0)
        x[i] /= u0[i]
        big = np.abs(x[i:]).max(0)
        x *= np.where(big > 1e150, 1e-150, 1.0)  # only directions count
    return x


def tridiagonal_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of falling eigenvalues by inverse iteration; those of a cluster are kept orthogonal."""
    norm = max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0), np.finfo(float).tiny)
    x = np.random.default_rng(0).standard_normal((len(diagonal), len(values)))
    head = np.concatenate(([0], 1 + np.flatnonzero(values[:-1] - values[1:] > CLUSTER * norm), [len(values)]))
    for _ in range(STEPS):
        x = _solve(diagonal, off, values, x / np.abs(x).max(0), np.finfo(float).eps * norm)
        x /= np.abs(x).max(0)
        for lo, hi in zip(head[:-1], head[1:]):
            for j in range(lo, hi):
                for _ in range(2):
                    x[:, j] -= x[:, lo:j] @ (x[:, lo:j].T @ x[:, j])
                x[:, j] /= np.linalg.norm(x[:, j])
    return x


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and their unit eigenvectors (columns), whose largest entry is positive."""
    scale = np.abs(matrix).max(initial=0.0)
    k = min(k, len(matrix))
    if k == 0 or scale == 0:
        return np.zeros(k), np.eye(len(matrix), k)
    diagonal, off, reflections = tridiagonal(matrix / scale)
    values = leading_values(diagonal, off, k)
    x = tridiagonal_vectors(diagonal, off, values)
    for first, v in reversed(reflections):
        x[first:] -= 2 * np.outer(v, v @ x[first:])
    return values * scale, x * np.sign(x[np.abs(x).argmax(0), np.arange(k)])
