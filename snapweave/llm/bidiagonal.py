"""Singular values and right singular vectors of a small square matrix, by its bidiagonal form.

Householder reflections make the matrix bidiagonal, the differential qd algorithm with shifts
(dqds) finds the squares of its singular values to high relative accuracy, and twisted
factorisations at these values give the vectors, each by one multiplication-free walk up and one
walk down from the place where it is largest.
"""

from __future__ import annotations

import math

import numpy as np

_EPS = float(np.finfo(float).eps)
_DROP = (10 * _EPS) ** 2
_CLOSE = 1e-3
"""Relative gap below which neighbouring values count as a cluster."""


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """``(v, first)``: I - 2 v v' turns ``x`` into ``first`` and zeros."""
    norm = float(np.linalg.norm(x))
    if norm == 0.0:
        return np.zeros_like(x), 0.0
    first = -math.copysign(norm, x[0])
    v = x.copy()
    v[0] -= first
    return v / np.linalg.norm(v), first


def bidiagonalize(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """``(diagonal, above, right)``: a square matrix as Q B H', H the product of the right reflections.

    ``right[i]`` is the unit vector that reflects the columns from i + 1 on.
    """
    a = np.array(matrix, float)
    size = len(a)
    diagonal, above, right = np.zeros(size), np.zeros(max(0, size - 1)), []
    for i in range(size):
        v, diagonal[i] = _reflector(a[i:, i])
        a[i:, i + 1 :] -= np.outer(2 * v, v @ a[i:, i + 1 :])
        if i + 1 < size:
            w, above[i] = _reflector(a[i, i + 1 :])
            a[i + 1 :, i + 1 :] -= np.outer(a[i + 1 :, i + 1 :] @ w, 2 * w)
            right.append(w)
    return diagonal, above, right


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One differential qd step; ``d`` is shorter than ``q`` or ends below 0 if the shift was too large."""
    new_q, new_e, d, ds = [], [], q[0] - shift, [q[0] - shift]
    for i, coupling in enumerate(e):
        if d < 0:
            break
        whole = d + coupling
        ratio = q[i + 1] / whole if whole > 0 else 0.0
        new_q.append(whole)
        new_e.append(coupling * ratio)
        d = d * ratio - shift if whole > 0 else q[i + 1] - shift
        ds.append(d)
    new_q.append(d)
    return new_q, new_e, ds


def _bottom(q: list[float], e: list[float]) -> float:
    """The smaller eigenvalue of the last two rows and columns: near the smallest of all, never below."""
    a, b = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1]
    product = q[-2] * q[-1] + (e[-2] * b if len(e) > 1 else 0.0)
    half = (a + b) / 2
    root = math.sqrt(max(0.0, half * half - product))
    return product / (half + root) if half + root > 0 else 0.0


def dqds(q: np.ndarray, e: np.ndarray) -> list[float]:
    """Squared singular values of the bidiagonal matrix with squares ``q`` on and ``e`` above the diagonal."""
    found: list[float] = []
    blocks = [([float(v) for v in q], [float(v) for v in e], 0.0)]
    while blocks:
        q_, e_, taken = blocks.pop()
        safe = None
        while q_:
            if len(q_) == 1 or e_[-1] <= _DROP * (taken + q_[-1]):
                found.append(taken + q_.pop())
                if e_:
                    e_.pop()
                safe = None
                continue
            cut = next((i for i, v in enumerate(e_) if v <= _DROP * (taken + min(q_[i], q_[i + 1]))), None)
            if cut is not None:
                blocks.append((q_[: cut + 1], e_[:cut], taken))
                q_, e_, safe = q_[cut + 1 :], e_[cut + 1 :], None
                continue
            # a close guess; if it was too large by its last element only, that tells a better one
            shift = _bottom(q_, e_) if safe is None else safe
            new_q, new_e, ds = _sweep(q_, e_, shift)
            if ds[-1] < 0 and len(ds) == len(q_):
                shift = max(0.0, (shift + ds[-1]) * (1 - 4 * _EPS))
                new_q, new_e, ds = _sweep(q_, e_, shift)
            if ds[-1] < 0:
                # without a shift nothing can fail, and the sum of 1 / d bounds the smallest value from below
                shift = 0.0
                new_q, new_e, ds = _sweep(q_, e_, shift)
                safe = (1 - 1e-6) / sum(1 / d for d in ds) if min(ds) > 0 else 0.0
            else:
                safe = None
            q_, e_, taken = new_q, new_e, taken + shift
    return found


def _twisted(diagonal: np.ndarray, above: np.ndarray, value: float, avoid: set[int]) -> tuple[np.ndarray, int]:
    """Eigenvector of B'B for ``value`` from its twisted factorisation, and the place of the twist.

    The place is that of the smallest twist element outside ``avoid``.
    """
    size = len(diagonal)
    tiny = _EPS * _EPS * float(max(np.abs(diagonal).max(), np.abs(above).max(initial=0.0))) ** 2 or 1.0
    d = [max(float(v) ** 2, tiny) for v in diagonal]
    low = [float(b) * math.copysign(1.0, a) / math.sqrt(v) for b, a, v in zip(above, diagonal, d)]
    down_l, s = [0.0] * (size - 1), [-value] * size
    for i in range(size - 1):
        pivot = d[i] + s[i] or tiny
        down_l[i] = d[i] * low[i] / pivot
        s[i + 1] = down_l[i] * low[i] * s[i] - value
    up_u, p = [0.0] * (size - 1), [d[-1] - value] * size
    for i in range(size - 2, -1, -1):
        pivot = d[i] * low[i] ** 2 + p[i + 1] or tiny
        up_u[i] = low[i] * d[i] / pivot
        p[i] = p[i + 1] * (d[i] / pivot) - value
    twist = [abs(s[i] + p[i] + value) for i in range(size)]
    at = min((i for i in range(size) if i not in avoid), key=twist.__getitem__, default=0)
    z = np.zeros(size)
    z[at] = 1.0
    for i in range(at - 1, -1, -1):
        z[i] = -down_l[i] * z[i + 1]
    for i in range(at, size - 1):
        z[i + 1] = -up_u[i] * z[i]
    largest = np.abs(z).max()
    z = z / largest if np.isfinite(largest) else np.eye(size)[at]
    return z / np.linalg.norm(z), at


def _settle(vectors: np.ndarray, diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Orthogonal vectors of a cluster: those of B on the space that the given ones span."""
    basis = np.linalg.qr(vectors.T)[0]
    image = diagonal[:, None] * basis
    image[:-1] += above[:, None] * basis[1:]
    return (basis @ np.linalg.svd(image)[2].T).T


def right_vectors(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """``(squares, vectors)``: the ``count`` largest squared singular values and their right vectors, as rows.

    Vectors are of unit length, their entry of largest size is positive.
    """
    scale = float(np.abs(matrix).max(initial=0.0))
    size = len(matrix)
    if scale == 0.0:
        return np.zeros(count), np.eye(size)[:count]
    diagonal, above, right = bidiagonalize(matrix / scale)
    top = max(np.abs(diagonal).max(), np.abs(above).max(initial=0.0))
    borders = [0, *(np.flatnonzero(np.abs(above) <= _EPS * top) + 1).tolist(), size]
    values = []
    for begin, end in zip(borders, borders[1:]):
        squares = dqds(diagonal[begin:end] ** 2, above[begin : end - 1] ** 2)
        values += [(-v, begin, end) for v in squares]
    values = sorted(values)[:count]
    vectors = np.zeros((count, size))
    for begin, end in {(b, e) for _, b, e in values}:
        rows = [n for n, (_, b, _) in enumerate(values) if b == begin]
        a, b = diagonal[begin:end], above[begin : end - 1]
        clusters, avoid = [], set()
        for n in rows:
            close = bool(clusters) and values[n][0] - values[clusters[-1][-1]][0] <= -values[n][0] * _CLOSE
            if close:
                clusters[-1].append(n)
            else:
                clusters.append([n])
                avoid = set()
            vectors[n, begin:end], at = _twisted(a, b, -values[n][0], avoid)
            avoid.add(at)
        for cluster in clusters:
            if len(cluster) > 1:
                vectors[cluster, begin:end] = _settle(vectors[cluster, begin:end], a, b)
    for i in range(len(right) - 1, -1, -1):
        part = vectors[:, i + 1 :]
        vectors[:, i + 1 :] = part - np.outer(part @ right[i], 2 * right[i])
    if np.abs(vectors @ vectors.T - np.eye(count)).max(initial=0.0) > 1e-10:
        # values far below the rounding of the largest ones have no directions of their own
        basis, turned = np.linalg.qr(vectors.T)
        vectors = (basis * np.where(np.diag(turned) < 0, -1.0, 1.0)).T
    largest = vectors[np.arange(count), np.abs(vectors).argmax(axis=1)]
    return np.array([-v for v, _, _ in values]) * scale * scale, vectors * np.where(largest < 0, -1.0, 1.0)[:, None]
