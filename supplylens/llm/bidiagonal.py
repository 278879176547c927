"""Singular values and right singular vectors of a small square matrix, by way of its bidiagonal form.

Householder reflections make it upper bidiagonal; dqds finds the squared singular values from the
squares of the bidiagonal's entries, with shifts that stay below the smallest one; twisted
factorisations of B'B - e I give a vector for each. Vectors of close values are made orthogonal by
inverse iteration within their group. The matrix has as many rows as a vector has entries.
"""

from __future__ import annotations

import numpy as np

_EPS = float(np.finfo(float).eps)
_TINY = 1e-280
_CLOSE = 1e-3  # values nearer to each other than this share of them are one group


def householder_bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, right): ``matrix`` = U B right', right orthogonal."""
    a = np.array(matrix, dtype=float)
    n = a.shape[0]
    right = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        norm = np.linalg.norm(x[1:])
        if norm == 0.0:
            return None
        v = x.copy()
        v[0] += np.copysign(np.hypot(x[0], norm), x[0])
        return v / np.linalg.norm(v)

    for k in range(n):
        v = reflector(a[k:, k])
        if v is not None:
            a[k:, k:] -= 2.0 * np.outer(v, v @ a[k:, k:])
        if k < n - 1:
            v = reflector(a[k, k + 1 :])
            if v is not None:
                a[k:, k + 1 :] -= 2.0 * np.outer(a[k:, k + 1 :] @ v, v)
                right[:, k + 1 :] -= 2.0 * np.outer(right[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of the bidiagonal matrix, falling; zero stays (about) zero."""
    scale = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0))
    if scale == 0.0:
        return np.zeros(len(diagonal))
    q = [max(float(x) ** 2, _TINY) for x in diagonal / scale]
    e = [float(x) ** 2 for x in above / scale]
    values: list[float] = []
    todo = [(q, e, 0.0)]  # parts without a link between them, and what has been taken off their values
    while todo:
        q, e, off = todo.pop()
        while q:
            if len(q) > 1 and 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            n, cut = len(q), None
            for i in range(n - 2, -1, -1):
                # both neighbours: a link that is nothing beside either changes no value
                if e[i] <= (_EPS / 4) ** 2 * (off + min(q[i], q[i + 1])):
                    cut = i
                    break
            if n == 1 or cut == n - 2:
                values.append(off + q.pop())
                e = e[: len(q) - 1] if q else []
                continue
            if cut is not None:
                todo.append((q[: cut + 1], e[:cut], off))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            shift = _safe_shift(q, e)
            while True:
                step = _transformed(q, e, shift)
                if step is not None:
                    break
                shift = shift / 2 if shift > _EPS * (off + q[-1]) else 0.0
            q, e = step
            off += shift
    return np.sort(np.array(values))[::-1] * scale**2


def _safe_shift(q: list[float], e: list[float]) -> float:
    """A number below the smallest value: one over the trace of the inverse, from a dqd sweep without shift."""
    d, inverse = q[0], 1.0 / q[0]
    for i in range(len(e)):
        d = d * (q[i + 1] / (d + e[i]))
        if d <= 0.0:
            return 0.0
        inverse += 1.0 / d
    return (1.0 - 4 * len(q) * _EPS) / inverse


def _transformed(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One dqds sweep; None if the shift was too large."""
    d, new_q, new_e = q[0] - shift, [], []
    for i in range(len(e)):
        if d < 0.0:
            return None
        top = d + e[i]
        if top <= 0.0:
            top = _TINY
        ratio = q[i + 1] / top
        new_q.append(top)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
    if d < 0.0:
        return None
    new_q.append(max(d, _TINY))
    return new_q, new_e


def _twisted(diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """The vector that the twisted factorisation of B'B - value I gives, of length 1."""
    n = len(diagonal)
    d, ratio = diagonal * diagonal, above / diagonal[:-1]
    down, up, s, p = np.empty(n), np.empty(n), np.empty(n), np.empty(n)

    def safe(x: float) -> float:
        return x if abs(x) > _TINY else np.copysign(_TINY, x)

    s[0] = -value
    lower, upper = np.empty(n - 1), np.empty(n - 1)
    for i in range(n - 1):
        down[i] = safe(s[i] + d[i])
        lower[i] = ratio[i] * d[i] / down[i]
        s[i + 1] = lower[i] * ratio[i] * s[i] - value
    p[n - 1] = d[n - 1] - value
    for i in range(n - 2, -1, -1):
        up[i + 1] = safe(p[i + 1] + d[i] * ratio[i] * ratio[i])
        t = d[i] / up[i + 1]
        upper[i] = ratio[i] * t
        p[i] = p[i + 1] * t - value
    gamma = s + p + value
    at = int(np.argmin(np.where(np.isfinite(gamma), np.abs(gamma), np.inf)))
    z = np.zeros(n)
    z[at] = 1.0
    for i in range(at - 1, -1, -1):
        z[i] = -lower[i] * z[i + 1]
    for i in range(at, n - 1):
        z[i + 1] = -upper[i] * z[i]
    return z / np.linalg.norm(z)


def _apart(vector: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """What is left of a vector beside others, twice for rounding."""
    for _ in range(2):
        for o in others:
            vector = vector - (o @ vector) * o
    return vector


def _solved(diagonal: np.ndarray, above: np.ndarray, value: float, x: np.ndarray) -> np.ndarray:
    """y with (B'B - value I) y = x, by elimination with row exchanges; zero pivots are made tiny."""
    n = len(diagonal)
    main = diagonal * diagonal
    main[1:] += above * above
    off = diagonal[:-1] * above
    a, b, c, y = main - value, np.append(off, 0.0), np.zeros(n), x.copy()
    for i in range(n - 1):
        below = [off[i], a[i + 1], b[i + 1]]
        if abs(below[0]) > abs(a[i]):
            (a[i], b[i], c[i]), below = below, [a[i], b[i], c[i]]
            y[i], y[i + 1] = y[i + 1], y[i]
        pivot = a[i] if a[i] != 0.0 else _EPS * max(abs(value), _TINY)
        a[i] = pivot
        m = below[0] / pivot
        a[i + 1], b[i + 1] = below[1] - m * b[i], below[2] - m * c[i]
        y[i + 1] -= m * y[i]
    for i in range(n - 1, -1, -1):
        rest = y[i] - (b[i] * y[i + 1] if i + 1 < n else 0.0) - (c[i] * y[i + 2] if i + 2 < n else 0.0)
        y[i] = rest / (a[i] if a[i] != 0.0 else _EPS * max(abs(value), _TINY))
    return y


def leading(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors): all eigenvalues of matrix' matrix, falling, and the unit vectors of the first ``most``.

    Only vectors of values that differ from zero are given, as columns: fewer than ``most`` where the rank is less.
    """
    n = matrix.shape[1]
    scale = float(np.abs(matrix).max(initial=0.0))
    if not n or scale == 0.0:
        return np.zeros(n), np.empty((n, 0))
    diagonal, above, right = householder_bidiagonal(matrix / scale)
    values = dqds(diagonal, above)
    rank = int((values > (n * _EPS) ** 2 * values[0]).sum())
    # a zero on the diagonal has no ratio; it is made so small that no value changes
    diagonal = np.where(np.abs(diagonal) < _EPS**4, _EPS**4, diagonal)
    vectors: list[np.ndarray] = []
    group: list[np.ndarray] = []
    rng = np.random.default_rng(0)
    norm = float(values[0])
    for k in range(min(most, rank)):
        if k and values[k - 1] - values[k] > _CLOSE * values[k - 1]:
            group = []
        value = float(values[k])
        vector = _twisted(diagonal, above, value) if n > 1 else np.ones(1)
        rest = _apart(vector, group)
        tries = 0
        while not np.isfinite(rest).all() or np.linalg.norm(rest) < 0.5 or _residual(diagonal, above, value, rest) > 64 * n * _EPS * norm:
            start = rng.standard_normal(n) if tries % 4 == 0 else rest / np.linalg.norm(rest)
            rest = _apart(_solved(diagonal, above, value * (1 + (tries + 1) * _EPS), _apart(start, group)), group)
            rest = rest / np.linalg.norm(rest)
            tries += 1
            if tries > 12:
                break
        group.append(rest / np.linalg.norm(rest))
        vectors.append(group[-1])
    # the reflections and groups leave errors of a few units in the last place; one more pass removes them
    basis = np.linalg.qr(right @ np.column_stack(vectors))[0] if vectors else np.empty((n, 0))
    return values * scale**2, basis


def _residual(diagonal: np.ndarray, above: np.ndarray, value: float, vector: np.ndarray) -> float:
    x = vector / np.linalg.norm(vector)
    bx = diagonal * x
    bx[:-1] += above * x[1:]
    y = diagonal * bx
    y[1:] += above * bx[:-1]
    return float(np.linalg.norm(y - value * x))
