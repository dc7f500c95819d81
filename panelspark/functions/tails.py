"""Tail probabilities for coefficient tables, by whole columns (no scientific library is assumed)."""

from __future__ import annotations

from math import erfc, lgamma, sqrt

import numpy as np

_TINY = 1e-300
_lgamma = np.vectorize(lgamma, otypes=[float])


def _away_from_zero(v: np.ndarray) -> np.ndarray:
    return np.where(np.abs(v) > _TINY, v, _TINY)


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz), until no element moves."""
    c = np.ones_like(x)
    d = 1.0 / _away_from_zero(1.0 - (a + b) * x / (a + 1.0))
    value = d.copy()
    for m in range(1, 500):
        for top in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 / _away_from_zero(1.0 + top * d)
            c = _away_from_zero(1.0 + top / c)
            value = value * d * c
        if np.all(np.abs(d * c - 1.0) < 1e-15):
            break
    return value


def beta_regularised(a, b, x) -> np.ndarray:
    """The regularised incomplete beta function, element by element."""
    a, b, x = np.broadcast_arrays(*(np.asarray(v, float) for v in (a, b, x)))
    out = np.where(x >= 1.0, 1.0, 0.0)
    inside = (x > 0.0) & (x < 1.0)
    a, b, x = a[inside], b[inside], x[inside]
    if not len(x):
        return out
    front = np.exp(_lgamma(a + b) - _lgamma(a) - _lgamma(b) + a * np.log(x) + b * np.log1p(-x))
    low = x < (a + 1.0) / (a + b + 2.0)
    first, second, at = np.where(low, a, b), np.where(low, b, a), np.where(low, x, 1.0 - x)
    part = front * _beta_fraction(first, second, at) / first
    out[inside] = np.where(low, part, 1.0 - part)
    return out


def t_two_sided_all(t, df) -> np.ndarray:
    """P(|T| > |t|) for Student's t, element by element; NaN where t or df is unknown or df is not positive."""
    t, df = np.broadcast_arrays(np.asarray(t, float), np.asarray(df, float))
    known = np.isfinite(df) & (df > 0) & ~np.isnan(t)
    out = np.full(t.shape, np.nan)
    t, df = t[known], df[known]
    out[known] = beta_regularised(df / 2.0, 0.5, df / (df + t * t))
    return out


def _one(value: np.ndarray) -> float | None:
    return None if np.isnan(value) else float(value)


def t_two_sided(t: float | None, df: float | None) -> float | None:
    if t is None or df is None:
        return None
    return _one(t_two_sided_all(np.array([t]), np.array([df]))[0])


def f_upper(f: float | None, df1: float, df2: float) -> float | None:
    """P(F > f) for the F distribution."""
    if f is None or f != f or df1 <= 0 or df2 <= 0:
        return None
    return float(beta_regularised([df2 / 2.0], df1 / 2.0, df2 / (df2 + df1 * max(f, 0.0)))[0])


def normal_two_sided(z: float | None) -> float | None:
    return None if z is None or z != z else erfc(abs(z) / sqrt(2.0))
