"""Lifetime value from the likelihood fits: expected purchases, probability of being active, expected spend, discounted sum.

The conditional expectation of the purchase model needs a Gauss hypergeometric function. It is summed in the form of Euler's
transformation, whose upper parameters do not grow with a customer's purchases, and whose power of 1 - z cancels against the
one in front of it. The series stops per value when a geometric bound of the rest falls below the tolerance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.operators.predictive.clv import Fit, conditional_alive, expected_spend

_LEAST = 1e-6  # how near to its removable singularity at a = 1 the model is evaluated


def hypergeometric(a: np.ndarray, b: np.ndarray, c: np.ndarray, z: np.ndarray, tolerance: float = 1e-14) -> np.ndarray:
    """2F1(a, b; c; z) for 0 <= z < 1 and c other than 0, -1, -2, ..., to ``tolerance`` relative to the largest partial sum.

    The ratio of terms k + 1 and k tends to z. Beyond the sign changes of its factors it is monotone, so that the larger of it and
    z bounds all later ratios, and term * q / (1 - q) bounds the rest.
    """
    a, b, c, z = (np.array(x, float) for x in np.broadcast_arrays(a, b, c, z))
    if np.any((z < 0) | (z >= 1) | ((c <= 0) & (c == np.floor(c)))):
        raise ValueError("hypergeometric needs 0 <= z < 1 and no pole in c")
    shape, (a, b, c, z) = a.shape, (x.ravel() for x in (a, b, c, z))
    total, left = np.ones(len(z)), np.arange(len(z))
    term, largest, k = np.ones(len(z)), np.ones(len(z)), 0
    while len(left):
        step = (a[left] + k) * (b[left] + k) / ((c[left] + k) * (k + 1)) * z[left]
        term = term * step
        total[left] += term
        largest = np.maximum(largest, np.abs(total[left]))
        k += 1
        nxt = np.abs((a[left] + k) * (b[left] + k) / ((c[left] + k) * (k + 1))) * z[left]
        q = np.maximum(nxt, z[left])
        settled = (a[left] + k > 0) & (b[left] + k > 0) & (c[left] + k > 0) & (q < 1)
        rest = np.abs(term) * q / np.where(settled, 1 - q, 1.0)
        go = (term != 0) & (~settled | (rest > tolerance * largest))
        left, term, largest = left[go], term[go], largest[go]
    return total.reshape(shape)


def expected_purchases(params: dict[str, float], x: np.ndarray, age: np.ndarray, horizon: np.ndarray) -> np.ndarray:
    """Purchases within ``horizon`` of a customer with ``x`` repeat purchases at ``age`` who is active now, times (a customer
    without repeat purchases is active). To be divided by the odds term that :func:`conditional_alive` holds."""
    r, alpha, a, b = (params[k] for k in ("r", "alpha", "a", "b"))
    near = a - 1.0
    if abs(near) < _LEAST:
        near = _LEAST
    a = 1.0 + near
    z = horizon / (alpha + age + horizon)
    c = a + b - 1 + x
    c = np.where((c <= 0) & (np.abs(c - np.round(c)) < _LEAST), np.round(c) + _LEAST, c)
    series = hypergeometric(a + b - 1 - r, near, c, z)
    positive = series > 0
    power = near * np.log1p(-z)
    close = -np.expm1(power + np.log(np.where(positive, series, 1.0)))  # keeps its digits where near is small
    return c / near * np.where(positive, close, 1 - np.exp(power) * series)


def _purchases(params: dict[str, float], horizons: list[float]):
    """Column function: expected purchases up to each horizon, evaluated once per distinct (purchases, age) of a batch."""

    @F.arrow_udf("array<double>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for x, age in batches:
            cells = np.stack((np.asarray(x, float), np.asarray(age, float)), axis=1)
            distinct, back = np.unique(cells, axis=0, return_inverse=True)
            known = ~np.isnan(distinct).any(axis=1)
            out = np.full((len(distinct), len(horizons)), np.nan)
            if known.any():
                out[known] = expected_purchases(params, distinct[known, :1], distinct[known, 1:], np.array([horizons]))
            rows = out[back.ravel()]
            yield pa.array([None if np.isnan(r[0]) else r for r in rows], pa.list_(pa.float64()))

    return run


def predict_from_fits(
    history: DataFrame, purchases: Fit, spend: Fit, annual_rate: float = 0.1, periods: int = 12, period: float = 52 / 12
) -> DataFrame:
    """expected_transactions, prob_alive, expected_value and clv of every customer under the fitted models.

    ``clv`` adds, over ``periods``, the purchases expected in the period times the expected spend, discounted to the end of each
    period at ``annual_rate`` for 52 weeks. A narrow pass: parameters travel with the plan. Rows without a
    history (nulls) have nulls. Customers without purchases or spend have the population's mean spend, which is null where it does not
    exist (q <= 1).
    """
    x, tx, age = F.col("frequency"), F.col("recency"), F.col("T")
    horizons = [period * (k + 1) for k in range(periods)]
    weights = [(1 + annual_rate) ** (-(period / 52) * (k + 1)) for k in range(periods)]
    alive = conditional_alive(x, tx, age, purchases)
    scored = history.withColumn("_paths", _purchases(purchases.params, horizons)(x, age)).withColumn("_alive", alive)

    def path(k: int) -> Column:
        return F.col("_paths")[k] * F.col("_alive")

    steps = [(path(k) - (path(k - 1) if k else F.lit(0.0))) * w for k, w in enumerate(weights)]
    discounted = steps[0]
    for step in steps[1:]:
        discounted = discounted + step
    q = spend.params["q"]
    used = (F.col("frequency") > 0) & (F.col("monetary") > 0)
    mean = spend.params["p"] * spend.params["v"] / (q - 1) if q > 1 else None
    value = F.when(used, expected_spend(x, F.col("monetary"), spend)).otherwise(F.lit(mean).cast("double"))
    return scored.select(
        "customer_id",
        path(periods - 1).alias("expected_transactions"),
        F.col("_alive").alias("prob_alive"),
        value.alias("expected_value"),
        (discounted * value).alias("clv"),
    )
