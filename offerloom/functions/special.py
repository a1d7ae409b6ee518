"""Tails of distributions for whole numpy columns, where Spark has no function for them."""

from __future__ import annotations

import numpy as np

_STEPS, _TINY = 300, 1e-300


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for x >= 1, by Stirling's series beyond 10."""
    x, shift = np.array(x, float), np.zeros(len(x))
    for _ in range(10):
        small = x < 10
        shift[small] -= np.log(x[small])
        x[small] += 1
    series = 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 1 / (1680 * x**7)
    return shift + (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + series


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The continued fraction of the incomplete beta function; x below the mean. Ends early when nothing moves."""
    c, d = np.ones(len(x)), 1 / np.maximum(1 - (a + b) * x / (a + 1), _TINY)
    h = d.copy()
    for m in range(1, 20 * _STEPS):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        before = h.copy()
        for step in (even, odd):
            d = 1 + step * d
            d = 1 / np.where(np.abs(d) < _TINY, _TINY, d)
            c = 1 + step / c
            c = np.where(np.abs(c) < _TINY, _TINY, c)
            h = h * d * c
        if np.all(np.abs(h - before) <= 1e-15 * np.abs(h)):
            break
    return h


def beta_tail(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """P(Beta(a, b) > x) for a, b >= 1. 1 for x <= 0 and 0 for x >= 1."""
    out = np.where(x <= 0, 1.0, 0.0)
    inner = (x > 0) & (x < 1)
    a, b, x = a[inner], b[inner], x[inner]
    if len(x):
        front = np.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * np.log(x) + b * np.log1p(-x))
        low = x < (a + 1) / (a + b + 2)
        at = lambda v, w: np.where(low, v, w)
        part = front * _beta_fraction(at(a, b), at(b, a), at(x, 1 - x)) / at(a, b)
        out[inner] = np.clip(np.where(low, 1 - part, part), 0, 1)
    return out


def chi2_one_tail(t: np.ndarray) -> np.ndarray:
    """P(chi-square of one degree of freedom > t), the complementary error function of sqrt(t / 2)."""
    x = np.sqrt(np.maximum(t, 0) / 2)
    term = total = x.copy()
    for k in range(1, 60):  # by a series of positive terms up to 2.5, by a continued fraction beyond
        term = term * 2 * x * x / (2 * k + 1)
        total = total + term
    near = 1 - 2 / np.sqrt(np.pi) * np.exp(-x * x) * total
    y, f = np.maximum(x, 2.5), np.zeros(len(x))
    for k in range(60, 0, -1):
        f = k / 2 / (y + f)
    return np.where(x < 2.5, near, np.exp(-y * y) / np.sqrt(np.pi) / (y + f))
