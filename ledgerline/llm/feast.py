"""Eigenpairs of a symmetric matrix on an interval, by contour integration.

A filter applies the spectral projector of the eigenvalues inside (lo, hi) to a
block of vectors: Gauss quadrature of the resolvent over a circle through lo and
hi, one complex shifted solve a node. Rayleigh-Ritz on the filtered block gives
the eigenpairs, and filtering the Ritz vectors again refines them. Inertia
counts (signs of a pivoted LDL' factorisation of the shifted matrix) give the
exact number of eigenvalues in an interval: they cut the spectrum into slices and
prove that no slice misses one. The matrix is d x d for vectors of d entries, so
nothing here grows with the number of rows.
"""

from __future__ import annotations

import numpy as np

#: Quadrature nodes on the upper half circle.
NODES = 8
#: Eigenvalues that one slice holds, unless they coincide.
PER_SLICE = 8
ROUNDS = 30
#: Bunch-Parlett's bound on element growth.
ALPHA = (1 + 17 ** 0.5) / 8


def below(v: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of ``v`` under ``shift``: by Sylvester's law of
    inertia, the negative ones of D in the pivoted factorisation L D L' of
    v - shift I. A 2 x 2 pivot has one of each sign."""
    a = v - shift * np.eye(len(v))
    count = 0
    while len(a):
        off = np.abs(np.tril(a, -1))
        diag = np.abs(np.diagonal(a))
        r = int(diag.argmax())
        i, j = np.unravel_index(int(off.argmax()), off.shape)
        if diag[r] == 0 and off[i, j] == 0:
            break
        at = [r] if diag[r] >= ALPHA * off[i, j] else [int(j), int(i)]
        rest = np.setdiff1d(np.arange(len(a)), at)
        pivot = a[np.ix_(at, at)]
        count += 1 if len(at) == 2 else int(pivot[0, 0] < 0)
        side = a[np.ix_(rest, at)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(pivot, side.T)
        a = (a + a.T) / 2
    return count


def clear_of(v: np.ndarray, shift: float, scale: float) -> tuple[float, int]:
    """A shift near the given one with no eigenvalue close to it, and the number
    of eigenvalues under it."""
    gap = 1e-10 * scale
    for _ in range(60):
        n = below(v, shift - gap)
        if n == below(v, shift + gap):
            break
        shift += 3 * gap
    return shift, below(v, shift)


def slices(v: np.ndarray, k: int, floor: float) -> list[tuple[float, float, int]]:
    """Intervals (lo, hi, number of eigenvalues), highest first, that together hold
    the ``k`` largest eigenvalues above ``floor`` (all of them, if fewer)."""
    d = len(v)
    scale = float(np.abs(v).sum(axis=1).max())
    if scale == 0:
        return []
    lo, n_lo = clear_of(v, floor, scale)
    todo, out, got = [(lo, n_lo, scale * 1.001, d)], [], 0
    while todo and got < k:
        lo, n_lo, hi, n_hi = todo.pop()
        if n_hi == n_lo:
            continue
        if n_hi - n_lo <= PER_SLICE or hi - lo < 1e-8 * scale:
            out.append((lo, hi, n_hi - n_lo))
            got += n_hi - n_lo
            continue
        mid, n_mid = clear_of(v, (lo + hi) / 2, scale)
        todo += [(lo, n_lo, mid, n_mid), (mid, n_mid, hi, n_hi)]
    return out


def project(v: np.ndarray, lo: float, hi: float, block: np.ndarray) -> np.ndarray:
    """The quadrature of the resolvent's contour integral around (lo, hi),
    applied to ``block``."""
    x, w = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(0.5j * np.pi * (1 - x)) * (hi - lo) / 2
    eye = np.eye(len(v))
    return sum(0.5 * wi * (t * np.linalg.solve(((lo + hi) / 2 + t) * eye - v, block)).real for wi, t in zip(w, turn))


def eigenpairs(v: np.ndarray, lo: float, hi: float, count: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues of ``v`` in (lo, hi), falling, and their unit
    eigenvectors (columns). Raises if the filtered space does not hold exactly
    the eigenvalues that the inertia counted."""
    d = len(v)
    rng = np.random.default_rng(seed)
    # room for all that the filter damps slowly: what lies within half a radius
    reach = (hi - lo) / 4
    width = min(d, below(v, hi + reach) - below(v, lo - reach) + 2)
    block = rng.standard_normal((d, width))
    scale = float(np.abs(v).sum(axis=1).max())
    last = np.inf
    for _ in range(ROUNDS):
        u, s, _ = np.linalg.svd(project(v, lo, hi, block), full_matrices=False)
        u = u[:, s > s[0] * 1e-14]
        e, y = np.linalg.eigh(u.T @ v @ u)
        ritz = u @ y
        off = np.linalg.norm(v @ ritz - ritz * e, axis=0)
        # a Ritz value without a small residual is no eigenvalue: filtered noise
        found = (e > lo) & (e < hi) & (off <= 1e-12 * scale)
        worst = off[found].max(initial=0.0)
        # converged, or as far as rounding lets it
        if found.sum() == count and (worst <= 1e-15 * scale or worst >= last / 2):
            order = np.argsort(-e[found], kind="stable")
            return e[found][order], ritz[:, found][:, order]
        last = worst if found.sum() == count else np.inf
        block = ritz if ritz.shape[1] == width else np.hstack([ritz, rng.standard_normal((d, width - ritz.shape[1]))])
    raise ArithmeticError(f"the contour around ({lo}, {hi}) holds {count} eigenvalues, found {int(found.sum())}")
