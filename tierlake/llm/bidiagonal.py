"""Singular values and right singular vectors of a triangle: bidiagonal form, dqds, twisted factorisations.

The work is on one matrix as wide as the vectors are, whatever the number of rows it
came from.

* `bidiagonal` turns R by Householder reflections from both sides into an upper
  bidiagonal B and keeps those from the right.
* `squares` finds the squared singular values of B by differential qd steps with
  shifts. Differences only ever meet in the shift, so small values come out as accurate
  as large ones. A shift that was too bold leaves a negative pivot and is undone for one
  that lies below the least value for certain.
* `vectors` factors B'B - s from the top and from the bottom, twists the two together
  where the pivot is least, and reads the vector off the twisted factors. Values that
  agree in their leading digits are told apart from a shift next to them, as often as
  it takes (multiple relatively robust representations).
"""

from __future__ import annotations

import math

import numpy as np

EPS = np.finfo(float).eps
TINY = 1e-290
#: Values closer than this, in proportion, are separated from a shift beside them; so often at most.
APART, DEPTH = 1e-5, 8
#: How far, in proportion, a shift stays below the rough value it is meant for.
NEAR = 1e-8


def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """A unit vector u and the number y so that x - 2 u (u'x) is y and then zeros."""
    size = float(np.linalg.norm(x))
    if size == 0:
        return np.zeros_like(x), 0.0
    target = -math.copysign(size, x[0])
    u = x.copy()
    u[0] -= target
    return u / np.linalg.norm(u), target


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and upper diagonal of B, and the orthogonal Q for which r Q has B's singular structure."""
    a, n = r.astype(float).copy(), r.shape[1]
    q = np.eye(n)
    diagonal, upper = np.zeros(n), np.zeros(max(n - 1, 0))
    for k in range(n):
        u, diagonal[k] = reflector(a[k:, k])
        a[k:, k + 1 :] -= 2 * np.outer(u, u @ a[k:, k + 1 :])
        if k + 1 < n:
            v, upper[k] = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
            q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return diagonal, upper, q


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One qd step with a shift: the new q and e, and the pivots on the way."""
    d, new_q, new_e, pivots = q[0] - shift, [], [], []
    for k in range(len(e)):
        pivots.append(d)
        total = d + e[k]
        if total == 0:
            total = TINY
        ratio = q[k + 1] / total
        new_q.append(total)
        new_e.append(e[k] * ratio)
        d = d * ratio - shift
    pivots.append(d)
    new_q.append(d)
    return new_q, new_e, pivots


def _rough(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """All squared singular values to about NEAR, ascending: every one is bisected at the same time."""
    n = len(diagonal)
    most = float(np.max(np.abs(diagonal), initial=0) + np.max(np.abs(upper), initial=0)) ** 2
    left, right, wanted = np.zeros(n), np.full(n, most), np.arange(n)
    a = np.where(diagonal == 0, math.sqrt(TINY), diagonal)
    for _ in range(2 * -int(math.log2(NEAR))):
        middle = (left + right) / 2
        if np.all(right - left <= NEAR / 4 * right):
            break
        small = _below(a * a, upper / a[:-1], middle) <= wanted
        left, right = np.where(small, middle, left), np.where(small, right, middle)
    return np.sort(left)


def squares(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """The squared singular values, ascending."""
    found: list[float] = []
    rough = _rough(diagonal, upper)
    parts = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in upper], 0.0)]
    while parts:
        q, e, moved = parts.pop()
        while q:
            while len(q) > 1 and e[-1] <= EPS * EPS * (moved + q[-1]):
                found.append(moved + q.pop())
                e.pop()
            if len(q) == 1:
                found.append(moved + q.pop())
                break
            cut = next((k for k in range(len(e)) if e[k] <= EPS * EPS * (moved + min(q[k], q[k + 1]))), None)
            if cut is not None:
                parts.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            # Without a shift the pivots are the inverse of the inverse's diagonal, so this is below the least value.
            q, e, pivots = _step(q, e, 0.0)
            if min(pivots) <= 0:
                # The least value is the shift so far; the step brought it to the end.
                e[-1] = 0.0
                q[-1] = max(q[-1], 0.0)
                continue
            certain = (1 - 8 * EPS * len(q)) / sum(1 / x for x in pivots)
            above = int(np.searchsorted(rough, moved + certain))
            bold = rough[above] * (1 - NEAR) - moved if above < len(rough) else 0.0
            # Where the end is nearly split off, its two by two corner tells the value.
            middle = (q[-2] + e[-1] + q[-1]) / 2
            corner = middle - math.sqrt(max(middle * middle - q[-2] * q[-1], 0.0))
            corner = min(corner, min(pivots)) * (1 - 1e-3 if e[-1] > 1e-4 * q[-1] else 1 - 4 * EPS)
            for shift in sorted((x for x in (bold, corner) if x > certain), reverse=True) + [certain, 0.0]:
                new_q, new_e, pivots = _step(q, e, shift)
                if min(pivots) >= 0:
                    q, e, moved = new_q, new_e, moved + shift
                    break
    return np.sort(np.array(found))


def _safe(x: np.ndarray) -> np.ndarray:
    return np.where(np.abs(x) < TINY, np.where(x < 0, -TINY, TINY), x)


def _from_top(d: np.ndarray, low: np.ndarray, shifts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pivots, factors and remainders of L D L' - shift = L+ D+ L+', a column for each shift."""
    n = len(d)
    pivots, factors, rest = np.empty((n, len(shifts))), np.empty((n - 1, len(shifts))), np.empty((n, len(shifts)))
    rest[0] = -shifts
    for k in range(n - 1):
        pivots[k] = _safe(d[k] + rest[k])
        factors[k] = d[k] * low[k] / pivots[k]
        rest[k + 1] = factors[k] * low[k] * rest[k] - shifts
    pivots[-1] = d[-1] + rest[-1]
    return pivots, factors, rest


def _from_bottom(d: np.ndarray, low: np.ndarray, shifts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Factors and remainders of L D L' - shift = U- D- U-'."""
    n = len(d)
    factors, rest = np.empty((n - 1, len(shifts))), np.empty((n, len(shifts)))
    rest[-1] = d[-1] - shifts
    for k in range(n - 2, -1, -1):
        ratio = d[k] / _safe(d[k] * low[k] * low[k] + rest[k + 1])
        factors[k] = low[k] * ratio
        rest[k] = rest[k + 1] * ratio - shifts
    return factors, rest


def _twisted(d: np.ndarray, low: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, a column each, and how far the values are off, by the twisted factors."""
    _, down, s = _from_top(d, low, values)
    up, p = _from_bottom(d, low, values)
    gamma = s + p + values
    z = np.zeros((len(d), len(values)))
    for j, twist in enumerate(np.argmin(np.abs(gamma), axis=0)):
        z[twist, j] = 1.0
        for k in range(twist - 1, -1, -1):
            z[k, j] = -down[k, j] * z[k + 1, j]
        for k in range(twist, len(d) - 1):
            z[k + 1, j] = -up[k, j] * z[k, j]
    sizes = np.einsum("ij,ij->j", z, z)
    return z / np.sqrt(sizes), np.min(np.abs(gamma), axis=0) * np.sign(gamma[np.argmin(np.abs(gamma), axis=0), np.arange(len(values))]) / sizes


def _below(d: np.ndarray, low: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many values of L D L' lie below each shift."""
    rest, found = -shifts, np.zeros(len(shifts), np.int64)
    for k in range(len(d)):
        pivot = _safe(d[k] + rest)
        found += pivot < 0
        if k + 1 < len(d):
            rest = d[k] * low[k] * low[k] / pivot * rest - shifts
    return found


def _bisected(d: np.ndarray, low: np.ndarray, wanted: np.ndarray, guess: np.ndarray, width: float) -> np.ndarray:
    """The values with the wanted ranks, near the guesses, to more digits than part them."""
    left, right, step = guess - width, guess + width, np.full(len(guess), width)
    for _ in range(80):
        high, under = _below(d, low, left) > wanted, _below(d, low, right) <= wanted
        if not (high.any() or under.any()):
            break
        step = 2 * step
        left, right = np.where(high, left - step, left), np.where(under, right + step, right)
    for _ in range(120):
        middle = (left + right) / 2
        # The twisted factors do the rest.
        if np.all(right - left <= APART * APART * np.maximum(np.abs(left), np.abs(right)) + TINY):
            break
        small = _below(d, low, middle) <= wanted
        left, right = np.where(small, middle, left), np.where(small, right, middle)
    return (left + right) / 2


def _groups(values: np.ndarray) -> list[tuple[int, int]]:
    """Runs of ascending values that are close in proportion."""
    gaps = np.diff(values) > APART * np.maximum(np.abs(values[1:]), np.abs(values[:-1]))
    bounds = [0, *(np.flatnonzero(gaps) + 1).tolist(), len(values)]
    return list(zip(bounds[:-1], bounds[1:], strict=True))


def _tree(d: np.ndarray, low: np.ndarray, values: np.ndarray, first: int, out: np.ndarray, depth: int = 0) -> None:
    """Vectors of the values of L D L' with the ranks from `first` on go into the columns of `out`."""
    single = [a for a, b in _groups(values) if b - a == 1 or depth == DEPTH]
    alone = np.array(single if depth < DEPTH else range(len(values)), int)
    if len(alone):
        own = values[alone]
        for _ in range(3):
            z, off = _twisted(d, low, own)
            own = own + np.where(np.abs(off) < APART * np.abs(own), off, 0.0)
        out[:, alone] = z
    if depth == DEPTH:
        return
    for a, b in _groups(values):
        if b - a == 1:
            continue
        cluster = values[a:b]
        width = max(float(cluster[-1] - cluster[0]) / (b - a), 16 * EPS * float(np.max(np.abs(cluster))))
        best = None
        for shift in (cluster[0] - width, cluster[-1] + width, cluster[0] - 8 * width, cluster[-1] + 8 * width):
            pivots, factors, _ = _from_top(d, low, np.array([shift]))
            growth = float(np.max(np.abs(pivots)))
            if np.isfinite(growth) and (best is None or growth < best[0]):
                best = growth, float(shift), pivots[:, 0], factors[:, 0]
        _, shift, new_d, new_low = best
        ranks = first + np.arange(a, b)
        near = _bisected(new_d, new_low, ranks, cluster - shift, width)
        _tree(new_d, new_low, near, first + a, part := out[:, a:b].copy(), depth + 1)
        out[:, a:b] = part


def vectors(diagonal: np.ndarray, upper: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of B, falling, and the right singular vectors as columns."""
    n = len(diagonal)
    size = max(float(np.max(np.abs(diagonal), initial=0)), float(np.max(np.abs(upper), initial=0)))
    if n == 0 or size == 0:
        return np.zeros(n), np.eye(n)
    values, out = [], np.zeros((n, n))
    cuts = np.flatnonzero(np.abs(upper) <= 2 * EPS * size) + 1
    rng = np.random.default_rng(0)
    for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), n], strict=True):
        a, b = diagonal[start:end].copy(), upper[start : end - 1]
        a[np.abs(a) < EPS * EPS * size] = EPS * EPS * size
        # A few units of the last place part values that would agree in all digits.
        a *= 1 + 4 * EPS * rng.integers(-2, 3, len(a))
        own = squares(a, b)
        block = np.zeros((end - start, end - start))
        _tree(a * a, b / a[:-1], own, 0, block)
        values.append(own)
        out[start:end, start:end] = block
    found = np.concatenate(values)
    order = np.argsort(-found, kind="stable")
    found, out = found[order], out[:, order]
    if np.max(np.abs(out.T @ out - np.eye(n))) > 1e-10:
        # What rounding left between vectors of one cluster; the first of them is not turned.
        turned, triangle = np.linalg.qr(out)
        out = turned * np.where(np.diag(triangle) < 0, -1.0, 1.0)
    return found, out


def right_singular(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of r, falling, and its right singular vectors as columns."""
    diagonal, upper, q = bidiagonal(r)
    found, own = vectors(diagonal, upper)
    return found, q @ own
