"""Regularised incomplete beta function by its continued fraction (modified Lentz), for the tests."""

from __future__ import annotations

import math

import numpy as np


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Log-gamma of the distinct values only: a batch holds few, one or two for each cell."""
    values, at = np.unique(x, return_inverse=True)
    return np.array([math.lgamma(v) for v in values])[at]


def _betacf(a: np.ndarray, b: np.ndarray, x: np.ndarray, iters: int = 300,
            eps: float = 1e-15) -> np.ndarray:
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = np.ones_like(x)
    d = 1.0 - qab * x / qap
    d = np.where(np.abs(d) < tiny, tiny, d)
    d = 1.0 / d
    h = d.copy()
    done = np.zeros(x.shape, dtype=bool)
    for m in range(1, iters + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < tiny, tiny, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < tiny, tiny, c)
        d = 1.0 / d
        h = np.where(done, h, h * d * c)
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < tiny, tiny, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < tiny, tiny, c)
        d = 1.0 / d
        delta = d * c
        h = np.where(done, h, h * delta)
        done |= np.abs(delta - 1.0) < eps
        if done.all():
            break
    return h


def betainc(x, a, b) -> np.ndarray:
    """I_x(a, b) for arrays of equal length; x is clipped to [0, 1]."""
    x = np.clip(np.asarray(x, dtype=float), 0.0, 1.0)
    a = np.broadcast_to(np.asarray(a, dtype=float), x.shape).astype(float)
    b = np.broadcast_to(np.asarray(b, dtype=float), x.shape).astype(float)
    out = np.where(x >= 1.0, 1.0, 0.0)
    inner = (x > 0.0) & (x < 1.0)
    if not inner.any():
        return out
    xi, ai, bi = x[inner], a[inner], b[inner]
    lbeta = _lgamma(ai + bi) - _lgamma(ai) - _lgamma(bi)
    front = np.exp(lbeta + ai * np.log(xi) + bi * np.log1p(-xi))
    direct = xi < (ai + 1.0) / (ai + bi + 2.0)
    res = np.empty_like(xi)
    if direct.any():
        res[direct] = front[direct] * _betacf(ai[direct], bi[direct], xi[direct]) / ai[direct]
    flip = ~direct
    if flip.any():
        res[flip] = 1.0 - front[flip] * _betacf(bi[flip], ai[flip], 1.0 - xi[flip]) / bi[flip]
    out[inner] = res
    return out
