"""Singular values and right singular vectors of a square matrix, by way of its bidiagonal form.

Householder reflections from both sides make the matrix upper bidiagonal; dqds
finds the squares of the bidiagonal's singular values to high relative accuracy,
the small ones too; twisted factorisations give each one's vector in linear time.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
TINY = np.finfo(float).tiny
CLOSE = 1e-3  # values nearer than this, relatively, may need their vectors made orthogonal


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """(v, beta, alpha): (I - beta v v') x = alpha e1."""
    alpha = -np.copysign(np.linalg.norm(x), x[0])
    v = x.copy()
    v[0] -= alpha
    size = v @ v
    return (v, 2.0 / size, alpha) if size > 0 else (v, 0.0, x[0])


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, V): the diagonal and superdiagonal of U' ``matrix`` V for orthogonal U (not kept) and V."""
    m, n = matrix.copy(), len(matrix)
    right = np.eye(n)
    for k in range(n):
        v, beta, _ = _reflector(m[k:, k])
        m[k:, k:] -= np.outer(beta * v, v @ m[k:, k:])
        if k + 2 < n:
            v, beta, _ = _reflector(m[k, k + 1:])
            m[k:, k + 1:] -= np.outer(m[k:, k + 1:] @ v, beta * v)
            right[:, k + 1:] -= np.outer(right[:, k + 1:] @ v, beta * v)
    return np.diag(m).copy(), np.diag(m, 1).copy(), right


def _shift(q: list[float], e: list[float]) -> float:
    """A lower bound of the smallest value: Newton's step from zero, one over the trace of the inverse."""
    p = q[-1]
    if p <= 0:
        return 0.0
    trace = 1 / p
    for i in range(len(q) - 2, -1, -1):
        p = p * (q[i] / (e[i] + p))
        if p <= 0:
            return 0.0
        trace += 1 / p
    return (1 - 8 * len(q) * EPS) / trace


def _transformed(q: list[float], e: list[float], shift: float):
    """One dqds step; None if the shift was above the smallest value."""
    new_q, new_e, d = [], [], q[0] - shift
    for i in range(len(e)):
        if d < 0:
            return None
        top = max(d + e[i], TINY)
        ratio = q[i + 1] / top
        new_q.append(top)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
    if d < 0:
        return None
    return [*new_q, d], new_e


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The squares of the singular values of the upper bidiagonal (a, b), falling."""
    todo, out = [((a * a).tolist(), (b * b).tolist(), 0.0)], []
    while todo:
        q, e, moved = todo.pop()
        if len(q) > 1 and q[0] < q[-1]:
            q, e = q[::-1], e[::-1]  # the other triangle has the same values; small ones belong below
        while q:
            n = len(q)
            least = (4 * EPS) ** 2
            if n == 1 or e[-1] <= least * (moved + q[-1]) or e[-1] <= TINY:
                out.append(moved + q.pop())
                if e:
                    e.pop()
                continue
            cut = next((i for i in range(n - 2, -1, -1) if e[i] <= least * moved or e[i] <= TINY), None)
            if cut is not None:
                todo.append((q[:cut + 1], e[:cut], moved))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            shift = _shift(q, e)
            while (new := _transformed(q, e, shift)) is None:
                shift = shift / 2 if shift > EPS * q[-1] else 0.0
            q, e = new
            moved += shift
    return np.sort(np.array(out))[::-1]


def _twisted(d: np.ndarray, below: np.ndarray, value: float):
    """Twisted factorisations of L D L' - ``value``: (gamma of every twist, L+ of the upper ones, U- of the lower ones)."""
    n = len(d)
    s, p = np.empty(n), np.empty(n)
    upper, lower = np.empty(n - 1), np.empty(n - 1)
    s[0] = -value
    for i in range(n - 1):
        plus = s[i] + d[i]
        plus = plus if plus else EPS * EPS * max(abs(value), TINY)
        upper[i] = d[i] * below[i] / plus
        s[i + 1] = upper[i] * below[i] * s[i] - value
    p[-1] = d[-1] - value
    for i in range(n - 2, -1, -1):
        minus = d[i] * below[i] ** 2 + p[i + 1]
        minus = minus if minus else EPS * EPS * max(abs(value), TINY)
        ratio = d[i] / minus
        lower[i] = below[i] * ratio
        p[i] = p[i + 1] * ratio - value
    return s + p + value, upper, lower


def _vector(twist: int, upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    z = np.zeros(len(upper) + 1)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -upper[i] * z[i + 1]
    for i in range(twist, len(lower)):
        z[i + 1] = -lower[i] * z[i]
    return z


def _apart(z: np.ndarray, mates: np.ndarray) -> np.ndarray:
    """``z`` at unit length, then less its part in the span of ``mates`` (orthonormal columns)."""
    z = z / np.linalg.norm(z)
    for _ in range(2):
        z = z - mates @ (mates.T @ z)
    return z


def _block_vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit vectors (columns) of the bidiagonal's cross product for its ``values``, falling; no b is zero."""
    n = len(a)
    if n == 1:
        return np.ones((1, 1))
    d, below = a * a, b / a[:-1]
    out = np.zeros((n, n))
    for j, value in enumerate(values):
        gap = min([abs(value - other) for k, other in enumerate(values) if k != j])
        for _ in range(3):
            gamma, upper, lower = _twisted(d, below, value)
            z = _vector(int(np.argmin(np.abs(gamma))), upper, lower)
            size = z @ z
            better = gamma[int(np.argmin(np.abs(gamma)))] / size  # the Rayleigh quotient's correction
            if not abs(better) < gap / 8 or abs(better) <= 2 * EPS * value:
                break
            value += better
        mates = [k for k in range(j) if values[k] - values[j] <= CLOSE * values[k]]
        order = np.argsort(np.abs(gamma), kind="stable") if mates else [int(np.argmin(np.abs(gamma)))]
        best, left = None, 0.0
        for twist in order:  # among close values the first twist may give a mate's vector again
            z = _vector(int(twist), upper, lower)
            if mates and abs(gamma[twist]) > 1000 * EPS * value * np.linalg.norm(z):
                continue  # its residual: no vector of this value
            z = _apart(z, out[:, mates])
            if (norm := np.linalg.norm(z)) > left:
                best, left = z / norm, norm
            if left > 0.3:
                break
        if left < 0.01:  # values equal to the last bit: inverse iteration from where the mates have least weight
            best = np.zeros(n)
            best[np.argmin((out[:, mates] ** 2).sum(axis=1))] = 1.0
            cross = np.diag(d + np.append(0.0, b * b)) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
            for _ in range(3):
                best = _apart(best, out[:, mates])
                best = _apart(np.linalg.solve(cross - value * (1 + 4 * EPS) * np.eye(n), best / np.linalg.norm(best)), out[:, mates])
        best = _apart(best, out[:, mates])
        out[:, j] = best / np.linalg.norm(best)
    return out


def singular(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(squares of the singular values, falling; right singular vectors as columns) of a square matrix.

    The bidiagonal is cut where a superdiagonal entry is negligible against its
    neighbours, so that equal values of different blocks have orthogonal vectors.
    """
    a, b, right = bidiagonalise(matrix)
    n, scale = len(a), float(max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)))
    if not scale:
        return np.zeros(n), right
    a = np.where(np.abs(a) < scale * EPS * 1e-3, scale * EPS * 1e-3, a)
    kept = np.abs(b) > EPS / 4 * (np.abs(a[:-1]) + np.abs(a[1:])) * 0.5
    edges = [0, *(np.flatnonzero(~kept) + 1).tolist(), n]
    values, vectors = np.zeros(n), np.zeros((n, n))
    for lo, hi in zip(edges, edges[1:], strict=False):
        found = squares(a[lo:hi], b[lo:hi - 1])
        values[lo:hi] = found
        vectors[lo:hi, lo:hi] = _block_vectors(a[lo:hi], b[lo:hi - 1], found)
    order = np.argsort(-values, kind="stable")
    return values[order], (right @ vectors)[:, order]
