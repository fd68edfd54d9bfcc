"""Leading eigenvalues and eigenvectors of a small symmetric matrix.

The matrix is brought to tridiagonal form by Householder reflections. Sturm counts (how many eigenvalues lie below a
point) drive bisection for the leading eigenvalues, each to the last bits that bisection can tell apart. Inverse
iteration gives their vectors; vectors of eigenvalues that lie close together are made orthogonal to one another in
every step. The reflections carry them back.

Its size is the number of dimensions squared; no row of the data comes here.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps

#: Eigenvalues closer than this share of the norm are a cluster; steps of inverse iteration.
CLUSTER, STEPS = 1e-3, 6


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(diagonal, beside, reflections)`` of a symmetric matrix; row k of ``reflections`` is the k-th unit vector."""
    a = np.array(matrix, dtype=float)
    size = len(a)
    reflections = np.zeros((max(size - 2, 0), size))
    for k in range(size - 2):
        below = a[k + 1:, k]
        v = below.copy()
        v[0] += np.copysign(np.linalg.norm(below), below[0])
        length = np.linalg.norm(v)
        if length == 0:
            continue
        v /= length
        reflections[k, k + 1:] = v
        # both sides at once: a - 2 v w' - 2 w v'
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1:, k] -= 2 * v * (v @ below)
        a[k, k + 1:] = a[k + 1:, k]
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def below(points: np.ndarray, diagonal: np.ndarray, beside: np.ndarray, least: float) -> np.ndarray:
    """Sturm counts: how many eigenvalues are smaller than each point."""
    pivot, count = np.ones(len(points)), np.zeros(len(points), dtype=int)
    for d, e in zip(diagonal, np.append(0.0, beside)):
        pivot = d - points - e * e / pivot
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, beside: np.ndarray, wanted: int) -> np.ndarray:
    """The ``wanted`` largest eigenvalues, falling, by bisection of all intervals together."""
    size = len(diagonal)
    around = np.abs(np.append(beside, 0)) + np.abs(np.append(0, beside))
    low, high = float((diagonal - around).min()), float((diagonal + around).max())
    norm = max(abs(low), abs(high))
    if norm == 0:
        return np.zeros(wanted)
    least = max(norm * EPS * EPS, np.finfo(float).tiny)
    margin = 2 * EPS * norm * size
    lo, hi = np.full(wanted, low - margin), np.full(wanted, high + margin)
    # the j-th largest has exactly size - 1 - j eigenvalues below it
    rank = size - 1 - np.arange(wanted)
    while True:
        middle = lo + (hi - lo) / 2
        open_ = (middle > lo) & (middle < hi) & (hi - lo > EPS * np.maximum(np.abs(lo), np.abs(hi)))
        if not open_.any():
            return middle
        above = below(middle, diagonal, beside, least) <= rank
        lo, hi = np.where(open_ & above, middle, lo), np.where(open_ & ~above, middle, hi)


def solve(diagonal: np.ndarray, beside: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """``x`` of ``(T - shift) x = right`` by elimination with row exchanges; tiny pivots are lifted to ``least``."""
    size = len(diagonal)
    main, first, second = diagonal - shift, np.append(beside, 0.0), np.zeros(size)
    x = right.copy()
    for k in range(size - 1):
        under = beside[k]
        if abs(under) > abs(main[k]):
            # rows change places
            factor = main[k] / under
            main[k], first[k], second[k], own, then = under, main[k + 1], first[k + 1], first[k], second[k]
            main[k + 1], first[k + 1] = own - factor * first[k], then - factor * second[k]
            x[k], x[k + 1] = x[k + 1], x[k] - factor * x[k + 1]
        else:
            factor = under / (main[k] if abs(main[k]) >= least else least)
            main[k + 1] -= factor * first[k]
            first[k + 1] -= factor * second[k]
            x[k + 1] -= factor * x[k]
    for k in range(size - 1, -1, -1):
        if k + 1 < size:
            x[k] -= first[k] * x[k + 1]
        if k + 2 < size:
            x[k] -= second[k] * x[k + 2]
        x[k] /= main[k] if abs(main[k]) >= least else np.copysign(least, main[k])
        largest = abs(x[k])
        if largest > 1e150:
            x /= largest
    return x


def vectors(diagonal: np.ndarray, beside: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors, a row for each of the falling ``values``, by inverse iteration."""
    size = len(diagonal)
    norm = max(np.abs(diagonal).max(), np.abs(beside).max(initial=0.0)) or 1.0
    draw = np.random.default_rng(size)
    out = np.zeros((len(values), size))
    start, shift = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * norm:
            start = j
        # equal values are set a little apart, so that each gets a solve of its own
        shift = min(float(value), shift - 2 * EPS * norm) if j > start else float(value)
        x = draw.uniform(0.5, 1.0, size)
        for _ in range(STEPS):
            x = solve(diagonal, beside, shift, x / np.linalg.norm(x), EPS * norm)
            x /= np.abs(x).max()
            for other in (*out[start:j], *out[start:j]):
                x -= (other @ x) * other
            if np.linalg.norm(x) < EPS:
                x = draw.uniform(-1.0, 1.0, size)
        out[j] = x / np.linalg.norm(x)
    return out


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """``(values, vectors)``: the largest eigenvalues, falling, and a unit eigenvector for each as a row."""
    size = len(matrix)
    wanted = min(wanted, size)
    if wanted == 0:
        return np.zeros(0), np.zeros((0, size))
    # a power of two changes no digits and keeps squares from overflowing
    scale = 2.0 ** np.frexp(np.abs(matrix).max())[1]
    diagonal, beside, reflections = tridiagonal(matrix / scale)
    values = leading_values(diagonal, beside, wanted)
    found = vectors(diagonal, beside, values)
    for v in reflections[::-1]:
        found -= 2 * np.outer(found @ v, v)
    return values * scale, found / np.linalg.norm(found, axis=1, keepdims=True)
