"""Leading eigenpairs of a symmetric matrix: tridiagonalisation, bisection, inverse iteration.

The matrix is a covariance of vector components, so its size is that of one vector, never of the
data. All three steps are numpy code over rows of the matrix.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
CLUSTER = 1e-3        # eigenvalues closer than this share of the norm are orthogonalised together
SWEEPS = 5            # of inverse iteration
SEED = 11


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Householder: (diagonal, off-diagonal, reflectors) with ``a`` = Q T Q', row k of reflectors
    being the unit vector of the k-th reflection (zero where none was needed)."""
    a = np.array(a, float)
    n, scale = len(a), np.abs(a).max(initial=0)
    v = np.zeros((max(n - 2, 0), n))
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        length = np.linalg.norm(x)
        if length <= EPS * EPS * scale or not np.any(x[1:]):
            continue
        x[0] += np.copysign(length, x[0])
        x /= np.linalg.norm(x)
        v[k, k + 1:] = x
        p = 2 * (a[k + 1:, k:] .T @ x)                    # over the columns k, k + 1, ...
        inner = p[1:] - (x @ p[1:]) * x
        a[k + 1:, k + 1:] -= np.outer(x, inner) + np.outer(inner, x)
        a[k + 1:, k] -= x * p[0]
        a[k, k + 1:] = a[k + 1:, k]
    return np.diag(a).copy(), np.diag(a, -1).copy(), v


def below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm count: how many eigenvalues of the tridiagonal matrix are less than each ``at``."""
    tiny = np.finfo(float).tiny / EPS
    count = np.zeros(len(at), np.int64)
    q = np.ones(len(at))
    squares = np.concatenate([[0.0], off * off])
    for d, s in zip(diagonal, squares, strict=True):
        q = d - at - s / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection of all of them at once."""
    n = len(diagonal)
    reach = np.abs(np.concatenate([off, [0.0]])) + np.abs(np.concatenate([[0.0], off]))
    low = np.full(k, (diagonal - reach).min())
    high = np.full(k, (diagonal + reach).max())
    margin = EPS * n * max(abs(low[0]), abs(high[0])) + np.finfo(float).tiny
    low, high = low - margin, high + margin
    rank = n - 1 - np.arange(k)                            # the j-th largest has so many below it
    for _ in range(128):
        middle = low + (high - low) / 2
        over = below(diagonal, off, middle) <= rank        # the eigenvalue is at or above the middle
        low, high = np.where(over, middle, low), np.where(over, high, middle)
        if np.all(high - low <= EPS * np.maximum(np.abs(low), np.abs(high))):
            break
    return low + (high - low) / 2


def _solver(diagonal: np.ndarray, off: np.ndarray, value: float, least: float):
    """Elimination with row exchanges of (T - value I); returns a function that solves for a side."""
    n = len(diagonal)
    d, up, up2 = [float(x) - value for x in diagonal], [*map(float, off), 0.0], [0.0] * n
    steps = []
    for i in range(n - 1):
        under = float(off[i])
        if abs(d[i]) >= abs(under):
            pivot = d[i] if abs(d[i]) > least else (least if d[i] >= 0 else -least)
            d[i], factor, swap = pivot, under / pivot, False
            d[i + 1] -= factor * up[i]
        else:
            factor, swap = d[i] / under, True
            d[i], up[i], up2[i], d[i + 1], up[i + 1] = under, d[i + 1], up[i + 1], up[i] - factor * d[i + 1], -factor * up[i + 1]
        steps.append((factor, swap))
    if abs(d[-1]) < least:
        d[-1] = least

    def solve(b: np.ndarray) -> np.ndarray:
        b = b.tolist()
        for i, (factor, swap) in enumerate(steps):
            if swap:
                b[i], b[i + 1] = b[i + 1], b[i] - factor * b[i + 1]
            else:
                b[i + 1] -= factor * b[i]
        for i in range(n - 1, -1, -1):
            s = b[i]
            if i + 1 < n:
                s -= up[i] * b[i + 1]
            if i + 2 < n:
                s -= up2[i] * b[i + 2]
            b[i] = s / d[i]
        return np.array(b)
    return solve


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x / np.abs(x).max()) / np.abs(x).max()


def vectors_of(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix, a row per value, by inverse iteration. Vectors
    of a cluster of close values are orthogonalised against each other in every sweep."""
    n = len(diagonal)
    norm = max(np.abs(diagonal).max(), np.abs(off).max(initial=0))
    rng = np.random.default_rng(SEED)
    out = np.zeros((len(values), n))
    first = 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * norm:
            first = j
        # equal values are told apart a little, so that each has a solver of its own
        solve = _solver(diagonal, off, value - (j - first) * 4 * EPS * norm, EPS * norm)
        x = _unit(rng.normal(size=n))
        for _ in range(SWEEPS):
            x = _unit(solve(x))
            for _ in range(3):
                x = _unit(x - out[first:j].T @ (out[first:j] @ x))
        out[j] = x
    return out


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) of the k largest eigenvalues of ``a``, falling; a unit vector per row."""
    n, scale = len(a), float(np.abs(a).max(initial=0))
    if not n or not scale:
        return np.zeros(0), np.zeros((0, n))
    diagonal, off, reflectors = tridiagonal(a / scale)
    values = leading_values(diagonal, off, min(k, n))
    vectors = vectors_of(diagonal, off, values)
    for v in reflectors[::-1]:                            # Q z, for all vectors at once
        vectors -= 2 * np.outer(vectors @ v, v)
    return values * scale, vectors
