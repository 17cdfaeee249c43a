"""Tail probabilities Spark SQL has no function for, as Arrow-batched UDFs.

They run on one row per test (feature, metric), never on the abundance table.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import DoubleType

_lgamma = np.vectorize(math.lgamma, otypes=[float])
_erfc = np.vectorize(math.erfc, otypes=[float])


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Γ(x), x > 0: shift to x ≥ 10 by the recurrence, then Stirling's series."""
    x = np.asarray(x, dtype=float)
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(10):
        low = y < 10
        if not low.any():
            break
        shift = np.where(low, shift + np.log(np.where(low, y, 1.0)), shift)
        y = np.where(low, y + 1, y)
    i, i2 = 1 / y, 1 / (y * y)
    series = i * (1 / 12 - i2 * (1 / 360 - i2 * (1 / 1260 - i2 * (1 / 1680 - i2 / 1188))))
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def beta_inc(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta I_x(a, b) by its continued fraction (Lentz)."""
    a, b, x = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(a, b, x))
    swap = x > (a + 1) / (a + b + 2)
    p, q, y = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    y_in = np.clip(y, 1e-300, 1 - 1e-16)
    front = np.exp(_lgamma(p + q) - _lgamma(p) - _lgamma(q) + p * np.log(y_in) + q * np.log1p(-y_in)) / p
    tiny = 1e-300
    c = np.ones_like(y_in)
    d = 1 - (p + q) * y_in / (p + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 400):
        even = m * (q - m) * y_in / ((p + 2 * m - 1) * (p + 2 * m))
        odd = -(p + m) * (p + q + m) * y_in / ((p + 2 * m) * (p + 2 * m + 1))
        for step in (even, odd):
            d = 1 + step * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + step / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            change = c * d
            h = h * change
        if np.all(np.abs(change - 1) < 1e-15):
            break
    tail = np.where(y <= 0, 0.0, front * h)
    return np.where(swap, 1 - tail, tail)


def gamma_q(a: float, x: float) -> float:
    """Upper regularised incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > 1e-17 * abs(total):
            n += 1
            term *= x / n
            total += term
        return 1 - total * front
    b = x + 1 - a
    c, d = 1e300, 1 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return front * h


def rank_sum_tail(n1: int, n2: int) -> np.ndarray:
    """P(U ≤ u) for u = 0 … n1·n2 without ties: Gaussian binomial coefficients."""
    ways = np.zeros(n1 * n2 + 1)
    ways[0] = 1.0
    for i in range(1, n1 + 1):
        up = i + n2
        for u in range(n1 * n2, up - 1, -1):
            ways[u] -= ways[u - up]
        for u in range(i, n1 * n2 + 1):
            ways[u] += ways[u - i]
    return np.cumsum(ways) / ways.sum()


def exact_two_sided(u: float, tail: np.ndarray) -> float:
    """Two-sided p of ``u`` under ``tail``, the cumulative null distribution."""
    return min(1.0, 2 * float(tail[int(min(u, len(tail) - 1 - u))]))


@F.pandas_udf(DoubleType())
def erfc(x: pd.Series) -> pd.Series:
    return pd.Series(_erfc(x.to_numpy(dtype=float)), index=x.index).where(x.notna())


@F.pandas_udf(DoubleType())
def t_two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided Student-t p-value."""
    v = df.to_numpy(dtype=float)
    q = beta_inc(v / 2, np.full_like(v, 0.5), v / (v + t.to_numpy(dtype=float) ** 2))
    return pd.Series(q, index=t.index).where(t.notna() & (df > 0))


@F.pandas_udf(DoubleType())
def chi2_upper(h: pd.Series, df: pd.Series) -> pd.Series:
    """Upper tail of the χ² distribution."""
    return pd.Series(
        [gamma_q(d / 2, x / 2) if x == x and d == d and d > 0 else None for x, d in zip(h, df)],
        index=h.index,
        dtype=float,
    )


@F.pandas_udf(DoubleType())
def rank_sum_exact(u: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    """Exact two-sided rank-sum p-value for small untied groups."""
    tails = {pair: rank_sum_tail(*pair) for pair in set(zip(n1, n2))}
    return pd.Series([exact_two_sided(a, tails[b, c]) for a, b, c in zip(u, n1, n2)], index=u.index, dtype=float)


def normal_two_sided(z: Column) -> Column:
    return erfc(F.abs(z) / F.sqrt(F.lit(2.0)))
