"""Leading right singular vectors of a small square matrix by the bidiagonal qd way.

Householder reflections make the matrix bidiagonal, the dqds iteration finds the
squares of its singular values to high relative accuracy, and a twisted
factorisation of the tridiagonal ``B'B - lambda`` gives the vector of each.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """(v, b) with (I - b v v') x = (+-|x|, 0, ...)."""
    v = x.copy()
    top = np.max(np.abs(x)) if len(x) else 0.0
    if top == 0 or len(x) == 1:
        return v * 0, 0.0
    v /= top
    v[0] += np.copysign(np.linalg.norm(v), v[0])
    return v, 2.0 / (v @ v)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(d, e, v): ``r = u B v'`` with the diagonal d and the superdiagonal e of B."""
    a, n = np.array(r, dtype=float), len(r)
    v = np.eye(n)
    for k in range(n):
        h, b = _reflector(a[k:, k])
        if b:
            a[k:, k:] -= np.outer(b * h, h @ a[k:, k:])
        if k + 2 < n:
            h, b = _reflector(a[k, k + 1:])
            if b:
                a[k:, k + 1:] -= np.outer(a[k:, k + 1:] @ h, b * h)
                v[:, k + 1:] -= np.outer(v[:, k + 1:] @ h, b * h)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _step(q: np.ndarray, e: np.ndarray, lo: int, hi: int, shift: float):
    """One dqds transform of the block; None if the shift is above the least value."""
    nq, ne = q.copy(), e.copy()
    d = q[lo] - shift
    least = d
    for i in range(lo, hi):
        if d < 0:
            return None
        nq[i] = d + e[i]
        if nq[i] == 0:                           # both zero: nothing is coupled here
            ne[i], d = 0.0, q[i + 1] - shift
        else:
            t = q[i + 1] / nq[i]
            ne[i], d = e[i] * t, d * t - shift
        least = min(least, d)
    if d < 0:
        return None
    nq[hi] = d
    return nq, ne, least


def dqds(d: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the bidiagonal (d, e), falling.

    Every block carries the sum of its shifts; a block splits where an off-diagonal
    quantity is negligible beside that sum, and a shift that is too large is tried
    again at a quarter and then at zero, which never fails.
    """
    scale = max(np.max(np.abs(d), initial=0.0), np.max(np.abs(e), initial=0.0))
    if scale == 0:
        return np.zeros(len(d))
    q, e = (d / scale) ** 2, np.append((e / scale) ** 2, 0.0)
    found, blocks = [], [(0, len(d) - 1, 0.0)]
    while blocks:
        lo, hi, total = blocks.pop()
        least = 0.0
        while lo <= hi:
            cut = [i for i in range(lo, hi) if e[i] <= EPS * EPS * (total + min(q[i], q[i + 1])) or e[i] < 1e-300]
            if cut:
                e[cut[-1]] = 0.0
                blocks.append((lo, cut[-1], total))
                lo, least = cut[-1] + 1, 0.0
                continue
            if lo == hi:
                found.append(total + max(q[lo], 0.0))
                break
            shift = max(0.0, least) * 0.98 if least > EPS * EPS * total else 0.0
            done = None
            while done is None:
                done = _step(q, e, lo, hi, shift)
                if done is None:
                    shift = shift / 4 if shift > 1e-3 * least else 0.0
            q, e, least = done
            total += shift
    return np.sort(np.array(found))[::-1] * scale * scale


def twisted_vector(d: np.ndarray, e: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of ``B'B`` at its eigenvalue ``value`` from the twisted factorisation
    whose twist has the smallest pivot."""
    n = len(d)
    tiny = EPS * max(np.max(np.abs(d)), np.max(np.abs(e), initial=0.0), 1e-150)
    d = np.where(np.abs(d) < tiny, tiny, d)
    q, l = d * d, np.append(e / d[:-1], 0.0) if n > 1 else np.zeros(1)
    small = tiny * tiny
    s, down = np.empty(n), np.empty(n)           # top to bottom: L D L'
    s[0] = -value
    for i in range(n - 1):
        pivot = s[i] + q[i]
        pivot = pivot if abs(pivot) > small else np.copysign(small, pivot or 1.0)
        down[i] = l[i] * q[i] / pivot
        s[i + 1] = down[i] * l[i] * s[i] - value
    p, up = np.empty(n), np.empty(n)             # bottom to top: U D U'
    p[-1] = q[-1] - value
    for i in range(n - 2, -1, -1):
        pivot = q[i] * l[i] * l[i] + p[i + 1]
        pivot = pivot if abs(pivot) > small else np.copysign(small, pivot or 1.0)
        t = q[i] / pivot
        up[i] = l[i] * t
        p[i] = p[i + 1] * t - value
    at = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[at] = 1.0
    for i in range(at - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(at, n - 1):
        z[i + 1] = -up[i] * z[i]
    z[~np.isfinite(z)] = 0.0
    return z / np.linalg.norm(z)


def _separated(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Vectors (columns) of the falling ``values``; those of close values are made orthogonal.

    Where values agree to many digits the factorisation gives each the same direction:
    the rest after the earlier ones is taken, from inverse iteration if little is left.
    """
    n, out = len(d), np.zeros((len(d), 0))
    t = np.diag(d * d + np.append(0.0, e * e))
    t[np.arange(n - 1), np.arange(1, n)] = t[np.arange(1, n), np.arange(n - 1)] = d[:-1] * e
    draw = np.random.default_rng(7)
    for k, value in enumerate(values):
        near = np.flatnonzero(np.abs(values[:k] - value) <= 1e-3 * max(abs(value), EPS * values[0]))
        z = twisted_vector(d, e, value)
        rest = z - out[:, near] @ (out[:, near].T @ z)
        if np.linalg.norm(rest) < 0.5:           # lost: another direction of the same cluster
            rest, beside = draw.standard_normal(n), t - (value + 1e-12 * values[0]) * np.eye(n)
            for _ in range(4):
                rest -= out[:, near] @ (out[:, near].T @ rest)
                rest = np.linalg.solve(beside, rest / np.linalg.norm(rest))
            rest -= out[:, near] @ (out[:, near].T @ rest)
        rest /= np.linalg.norm(rest)
        rest -= out @ (out.T @ rest)             # rounding only: once more against all
        out = np.column_stack([out, rest / np.linalg.norm(rest)])
    return out


def leading_components(r: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors): the ``wanted`` largest eigenvalues of ``r'r``, falling, and their unit
    eigenvectors as columns.  Values that are zero beside the largest are left out."""
    d, e, v = bidiagonalise(r)
    values = dqds(d, e)
    keep = values > (len(d) * EPS) ** 2 * max(values[0], 0.0) if len(values) else np.zeros(0, bool)
    values = values[keep & (values > 0)]
    few = values[:wanted]
    close = int(np.sum(values >= few[-1] * (1 - 1e-3))) if len(few) else 0     # the whole cluster of the last
    return few, (v @ _separated(d, e, values[:max(close, len(few))]))[:, :len(few)]
