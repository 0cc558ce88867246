"""Student t, chi-square and Beta tails for result rows.

Spark SQL has no gamma-family functions. These vectorised UDFs run on finished results (one row per experiment or
per estimate), never on the data the results were computed from.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _beta_cf(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10_000):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if not 0.0 < x < 1.0:
        return 0.0 if x <= 0.0 else 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1) / (a + b + 2):
        return front * _beta_cf(a, b, x) / a
    return 1.0 - front * _beta_cf(b, a, 1.0 - x) / b


def gamma_q(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return 1.0 - total * front
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h * front


def t_two_sided(t: float, df: float) -> float:
    return beta_inc(df / 2, 0.5, df / (df + t * t))


def t_quantile(p: float, df: float) -> float:
    """Upper-half quantile (p >= 0.5) by bisection on the two-sided tail."""
    target, lo, hi = 2 * (1 - p), 0.0, 1.0
    while t_two_sided(hi, df) > target:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        if t_two_sided(mid, df) > target:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2


def noncentral_t_power(effect: float, n: float, alpha: float) -> float:
    """Two-sided, two-sample t-test power with ``n`` per arm, integrating the normal over the scaled chi density."""
    if not n > 1:
        return float("nan")
    df, shift = 2 * n - 2, effect * math.sqrt(n / 2)
    crit = t_quantile(1 - alpha / 2, df)
    # s = sqrt(chi2_df / df) concentrates around 1 with standard deviation 1/sqrt(2 df).
    spread = 1 / math.sqrt(2 * df)
    s = np.linspace(max(1e-9, 1 - 12 * spread), 1 + 14 * spread, 2001)
    log_density = (df - 1) * np.log(s) - df * s * s / 2
    density = np.exp(log_density - log_density.max())
    reject = np.array([0.5 * math.erfc((crit * v - shift) / math.sqrt(2)) for v in s])
    reject += np.array([0.5 * math.erfc((crit * v + shift) / math.sqrt(2)) for v in s])
    return float(np.trapezoid(reject * density, s) / np.trapezoid(density, s))


def _each(fn, *series: pd.Series) -> pd.Series:
    rows = zip(*(s.to_numpy(dtype=float, na_value=np.nan) for s in series))
    return pd.Series([None if any(math.isnan(v) for v in r) else fn(*r) for r in rows], dtype="float64")


def t_p_value(t: Column, df: Column) -> Column:
    """Two-sided p-value of a t statistic."""

    @F.pandas_udf("double")
    def tail(t: pd.Series, df: pd.Series) -> pd.Series:
        return _each(t_two_sided, t, df)

    return tail(t.cast("double"), df.cast("double"))


def t_critical(p: float, df: Column) -> Column:
    @F.pandas_udf("double")
    def quantile(df: pd.Series) -> pd.Series:
        return _each(lambda d: t_quantile(p, d) if d > 0 else float("nan"), df)

    return quantile(df.cast("double"))


def chi2_p_value(x: Column, df: Column) -> Column:
    @F.pandas_udf("double")
    def tail(x: pd.Series, df: pd.Series) -> pd.Series:
        return _each(lambda v, d: gamma_q(d / 2, v / 2) if d > 0 else 1.0, x, df)

    return tail(x.cast("double"), df.cast("double"))


def t_test_power(effect: Column, n: Column, alpha: float) -> Column:
    @F.pandas_udf("double")
    def power(effect: pd.Series, n: pd.Series) -> pd.Series:
        return _each(lambda e, k: noncentral_t_power(e, k, alpha), effect, n)

    return power(F.abs(effect).cast("double"), n.cast("double"))


def t_test_sample_size(effect: Column, alpha: float, power: float) -> Column:
    """Smallest whole n per arm whose two-sample t-test reaches ``power``; null for a zero effect."""

    def solve(effect: float) -> float:
        if effect == 0:
            return float("nan")
        lo, hi = 2, 4
        while noncentral_t_power(effect, hi, alpha) < power:
            lo, hi = hi, hi * 2
        while hi - lo > 1:
            mid = (lo + hi) // 2
            if noncentral_t_power(effect, mid, alpha) < power:
                lo = mid
            else:
                hi = mid
        return float(hi)

    @F.pandas_udf("double")
    def size(effect: pd.Series) -> pd.Series:
        return _each(lambda e: solve(abs(e)), effect)

    return size(effect.cast("double"))
