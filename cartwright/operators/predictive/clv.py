"""Lifetime value: closed-form transaction and spend models, and their maximum-likelihood fits."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.functions import attach_row
from cartwright.session import materialise


def purchase_history(rfm: DataFrame, compat: bool = False) -> DataFrame:
    """frequency, recency and T for the transaction model, plus monetary.

    By default repeat purchases, first-to-last span and age, all in weeks. ``compat`` takes total purchases, days since
    the last purchase and age in days.
    """
    zero = F.lit(0.0)
    if compat:
        f, r, t = F.col("frequency"), F.col("recency"), F.col("customer_age_days")
    else:
        f = F.col("frequency") - 1
        r = (F.col("customer_age_days") - F.col("recency")) / 7
        t = F.col("customer_age_days") / 7
    keep = ["customer_id"] if "customer_id" in rfm.columns else []
    return rfm.select(
        *keep,
        F.greatest(f.cast("double"), zero).alias("frequency"),
        F.greatest(r.cast("double"), zero).alias("recency"),
        F.greatest(t.cast("double"), F.lit(1.0)).alias("T"),
        F.col("monetary").cast("double").alias("monetary"),
    )


def transaction_params(history: DataFrame) -> DataFrame:
    """Moment estimates r, alpha, a, b and the mean frequency as one row."""
    mean, var = F.avg("frequency"), F.var_samp("frequency")
    return history.agg(
        F.when(var > 0, F.greatest(F.lit(0.5), mean * mean / var)).otherwise(1.0).alias("r"),
        F.greatest(F.lit(1.0), mean).alias("alpha"),
        F.lit(1.0).alias("a"),
        F.greatest(F.lit(0.5), F.avg("recency") / 30).alias("b"),
        mean.alias("mean_frequency"),
    )


def spend_params(history: DataFrame) -> DataFrame:
    """Moment estimates p, q, v over customers with purchases and spend."""
    used = history.filter((F.col("monetary") > 0) & (F.col("frequency") > 0))
    mean = F.avg("monetary")
    return used.agg(
        F.greatest(F.lit(0.5), mean * mean / F.nullif(F.var_samp("monetary"), F.lit(0.0))).alias("p"),
        F.greatest(F.lit(0.5), mean / 100).alias("q"),
        F.greatest(F.lit(1.0), mean).alias("v"),
    )


def discount_factor(annual_rate: float = 0.1, weeks: int = 52) -> float:
    weekly = annual_rate / 52
    return (1 - (1 + weekly) ** (-weeks)) / weekly / 52


def probability_alive(frequency: Column, recency: Column, age: Column) -> Column:
    raw = (1 - recency / (age + 1)) * 0.7 + F.log1p(frequency) / 5 * 0.3
    return F.least(F.greatest(raw, F.lit(0.01)), F.lit(0.99))


def predict_clv(history: DataFrame, annual_rate: float = 0.1, weeks: int = 52) -> DataFrame:
    """Discounted value per customer from the moment models; parameters are one row each."""
    f, m = F.col("frequency"), F.col("monetary")
    base = F.col("r") * weeks / (F.col("alpha") + weeks)
    expected = base * (1 + 0.1 * (f - F.col("mean_frequency")))
    value = (F.col("p") * F.col("v") + f * m) / (F.col("p") + f)
    alive = probability_alive(f, F.col("recency"), F.col("T"))
    return (
        attach_row(
            attach_row(history, transaction_params(history).select("r", "alpha", "mean_frequency")),
            spend_params(history).select("p", "v"),
        ).select(
            "customer_id",
            expected.alias("bgnbd_expected_transactions"),
            alive.alias("prob_alive"),
            value.alias("gg_expected_value"),
            (expected * value * alive * discount_factor(annual_rate, weeks)).alias("clv_bgnbd"),
        )
    )


def expected_purchase_curve(params: DataFrame, weeks: int = 52) -> DataFrame:
    """Expected purchases by week with the ±20 % band."""
    t = F.col("t")
    curve = params.select("r", "alpha", F.explode(F.sequence(F.lit(0), F.lit(weeks - 1))).alias("t")).select(
        "t", (F.col("r") * t / (F.col("alpha") + t)).alias("expected")
    )
    return curve.withColumns({"low": F.col("expected") * 0.8, "high": F.col("expected") * 1.2})


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between minimum and maximum, the maximum counted in the last bin."""
    span = df.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    index = F.least(F.floor((F.col(value) - F.col("lo")) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1))
    return (
        attach_row(df.select(value).filter(F.col(value).isNotNull()), span)
        .groupBy(F.coalesce(index, F.lit(0)).cast("int").alias("bin"), "lo", "hi")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("bin", (F.col("lo") + width * F.col("bin")).alias("bin_start"), "n")
    )


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std, min and max per column, one row each."""
    stats = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    return stats.select(F.inline(F.array(*columns)))


# --- maximum likelihood ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Fit:
    params: dict[str, float]
    log_likelihood: float
    iterations: int


def _lg(x: np.ndarray | float) -> np.ndarray:
    """Log gamma of positive values: shifted up to 10 by the recurrence, then Stirling's series (error below 1e-14 there)."""
    y = np.array(x, float)
    shift = np.zeros_like(y)
    for _ in range(10):
        low = y < 10
        if not low.any():
            break
        shift = np.where(low, shift + np.log(np.where(low, y, 1.0)), shift)
        y = np.where(low, y + 1, y)
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z * (1 / 1188 - z * 691 / 360360))))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def bgnbd_loglik(theta: np.ndarray, x: np.ndarray, tx: np.ndarray, big_t: np.ndarray) -> np.ndarray:
    """Per-row BG/NBD log-likelihood at log parameters (r, alpha, a, b)."""
    r, alpha, a, b = np.exp(theta)
    common = _lg(r + x) - _lg(r) + r * np.log(alpha) + _lg(a + b) + _lg(b + x) - _lg(b) - _lg(a + b + x)
    alive = -(r + x) * np.log(alpha + big_t)
    died = np.where(
        x > 0, np.log(a) - np.log(np.maximum(b + x - 1, 1e-12)) - (r + x) * np.log(alpha + tx), -np.inf
    )
    return common + np.logaddexp(alive, died)


def gamma_gamma_loglik(theta: np.ndarray, x: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Per-row Gamma-Gamma log-likelihood at log parameters (p, q, v)."""
    p, q, v = np.exp(theta)
    return (
        _lg(p * x + q) - _lg(p * x) - _lg(q) + q * np.log(v) + (p * x - 1) * np.log(m) + p * x * np.log(x)
        - (p * x + q) * np.log(x * m + v)
    )


def _total(cells: DataFrame, columns: list[str], loglik: Callable, thetas: list[np.ndarray]) -> np.ndarray:
    """Weighted log-likelihood at several parameter points, one Spark job; tasks return one number per point."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(len(thetas))
        for pdf in batches:
            args = [pdf[c].to_numpy(float) for c in columns]
            w = pdf["w"].to_numpy(float)
            sums += [float(np.dot(w, loglik(th, *args))) for th in thetas]
        yield pd.DataFrame({"point": range(len(thetas)), "ll": sums})

    rows = cells.mapInPandas(partial, "point int, ll double").groupBy("point").agg(F.sum("ll").alias("ll")).collect()
    out = np.zeros(len(thetas))
    for row in rows:
        out[row["point"]] = row["ll"]
    return out


def fit_mle(
    cells: DataFrame,
    columns: list[str],
    loglik: Callable,
    names: list[str],
    penalizer: float = 0.0,
    max_iter: int = 40,
    tolerance: float = 1e-7,
) -> Fit:
    """Maximise a likelihood over weighted distinct rows (column ``w``).

    The driver holds the parameters only. Each Newton step costs one job for the finite-difference stencil and one for
    the line search; the penalty is on the squared parameters, per customer, as in the lifetimes literature.
    """
    cells = materialise(cells, "mle")
    n = cells.agg(F.sum("w")).first()[0]
    k, h = len(names), 1e-3
    theta = np.zeros(k)

    def objective(points: list[np.ndarray]) -> np.ndarray:
        penalty = np.array([penalizer * float(np.sum(np.exp(p) ** 2)) for p in points])
        return _total(cells, columns, loglik, points) / n - penalty

    value, step = float("-inf"), 0
    for step in range(1, max_iter + 1):
        eye = np.eye(k) * h
        points = [theta] + [theta + s * eye[i] for i in range(k) for s in (1, -1)]
        pairs = [(i, j) for i in range(k) for j in range(i)]
        points += [theta + eye[i] + eye[j] for i, j in pairs] + [theta - eye[i] - eye[j] for i, j in pairs]
        f = objective(points)
        value = f[0]
        up, down = f[1 : 1 + 2 * k : 2], f[2 : 2 + 2 * k : 2]
        grad = (up - down) / (2 * h)
        hess = np.diag((up - 2 * value + down) / h**2)
        for at, (i, j) in enumerate(pairs):
            plus, minus = f[1 + 2 * k + at], f[1 + 2 * k + len(pairs) + at]
            cross = (plus + minus - up[i] - down[i] - up[j] - down[j] + 2 * value) / (2 * h**2)
            hess[i, j] = hess[j, i] = cross
        # Ascent direction even where the surface is not concave.
        lam, vec = np.linalg.eigh(hess)
        direction = vec @ ((vec.T @ grad) / np.maximum(np.abs(lam), 1e-6))
        direction *= min(1.0, 2.0 / max(np.abs(direction).max(), 1e-12))
        scales = [1.0, 0.5, 0.25, 0.1, 0.01]
        tried = objective([theta + s * direction for s in scales])
        best = int(np.argmax(tried))
        if not tried[best] > value + tolerance * (1 + abs(value)):
            break
        theta = theta + scales[best] * direction
    return Fit(dict(zip(names, map(float, np.exp(theta)))), float(value * n), step)


def fit_transactions(history: DataFrame, penalizer: float = 0.0) -> Fit:
    """BG/NBD by maximum likelihood; customers with the same history count once with a weight."""
    cells = history.groupBy("frequency", "recency", "T").agg(F.count(F.lit(1)).alias("w"))
    return fit_mle(cells, ["frequency", "recency", "T"], bgnbd_loglik, ["r", "alpha", "a", "b"], penalizer)


def fit_spend(history: DataFrame, penalizer: float = 0.0) -> Fit:
    """Gamma-Gamma by maximum likelihood over customers with purchases; ``monetary`` is scaled to its mean."""
    used = history.filter((F.col("monetary") > 0) & (F.col("frequency") > 0))
    scale = used.agg(F.avg("monetary")).first()[0]
    cells = used.groupBy("frequency", (F.col("monetary") / scale).alias("monetary")).agg(F.count(F.lit(1)).alias("w"))
    fit = fit_mle(cells, ["frequency", "monetary"], gamma_gamma_loglik, ["p", "q", "v"], penalizer)
    return Fit({**fit.params, "v": fit.params["v"] * scale}, fit.log_likelihood, fit.iterations)


def conditional_alive(frequency: Column, recency: Column, age: Column, fit: Fit) -> Column:
    """P(alive) of the fitted BG/NBD model; a customer without repeat purchases is alive."""
    r, alpha, a, b = (fit.params[k] for k in ("r", "alpha", "a", "b"))
    odds = a / (b + frequency - 1) * F.pow((alpha + age) / (alpha + recency), r + frequency)
    return F.when(frequency > 0, 1 / (1 + odds)).otherwise(1.0)


def expected_spend(frequency: Column, monetary: Column, fit: Fit) -> Column:
    p, q, v = (fit.params[k] for k in ("p", "q", "v"))
    return p * (v + frequency * monetary) / (p * frequency + q - 1)
