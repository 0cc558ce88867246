"""Weibull accelerated failure times with a ridge penalty: Newton steps over sums that tasks fold and Spark adds."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.session import materialise


@dataclass
class WeibullModel:
    """``log T = intercept + sum(coef * x) + noise / rho``; coefficients belong to the features as they are."""

    features: list[str]
    coef: np.ndarray
    intercept: float
    rho: float
    objective: float
    gradient: np.ndarray  # at the optimum, in the fit's standardised units
    iterations: int

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``weibull_scale`` (63rd percentile of the time) and ``median_T``; missing features count as zero."""
        eta = F.lit(float(self.intercept))
        for name, b in zip(self.features, self.coef):
            eta = eta + F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * float(b)
        half = math.log(2.0) ** (1 / self.rho)
        return df.withColumn("weibull_scale", F.exp(eta)).withColumn("median_T", F.col("weibull_scale") * half)


def _sums(rows: DataFrame, features: list[str], means, scales, theta: np.ndarray) -> np.ndarray:
    """Log-likelihood, gradient and upper Hessian triangle in (intercept, features, log rho), summed over all rows."""
    size = len(theta)
    tri = np.triu_indices(size)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 + size + len(tri[0]))
        for pdf in batches:
            x = np.column_stack([np.ones(len(pdf)), (pdf[features].to_numpy(float) - means) / scales])
            log_t, e, log_rho = np.log(pdf["T"].to_numpy(float)), pdf["E"].to_numpy(float), theta[-1]
            rho = math.exp(log_rho)
            u = rho * (log_t - x @ theta[:-1])
            # A step that leaves the range gives an infinite loss, which the line search turns down.
            with np.errstate(over="ignore", invalid="ignore"):
                grown = np.exp(u)
                loglik = e * (log_rho - log_t + u) - grown
                by_eta, by_shape = rho * (grown - e), e * (1 + u) - u * grown
                two_eta, mixed = -rho * rho * grown, by_eta + rho * u * grown
                two_shape = u * (e - grown) - u * u * grown
                full = np.empty((size, size))
                full[:-1, :-1] = (x * two_eta[:, None]).T @ x
                full[:-1, -1] = full[-1, :-1] = mixed @ x
                full[-1, -1] = two_shape.sum()
                total += np.concatenate([[loglik.sum()], by_eta @ x, [by_shape.sum()], full[tri]])
        yield pd.DataFrame({"at": np.arange(len(total)), "value": total})

    parts = rows.mapInPandas(fold, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    return parts.orderBy("at").toPandas()["value"].to_numpy(float)  # one number per parameter pair


def fit_weibull(
    data: DataFrame, features: list[str], penalizer: float = 0.1, least_time: float = 0.5, max_iter: int = 50, tolerance: float = 1e-10
) -> WeibullModel:
    """Maximise the mean log-likelihood less ``penalizer / 2`` times the squared coefficients of the standardised features.

    Intercept and shape are not penalised. ``T`` is the duration, ``E`` the event. A time below ``least_time`` (customers
    whose last purchase is on the snapshot day have 0 whole days) counts as ``least_time``, so every row takes part; rows
    without a time or event are left out. Missing feature values count as zero; a constant feature gets coefficient 0.
    Raises when no row is left, when no row has an event (the shape is then unbounded) and when the steps do not converge.
    """
    known = data.filter(F.col("T").isNotNull() & F.col("E").isNotNull()).select(
        F.greatest(F.col("T").cast("double"), F.lit(least_time)).alias("T"),
        F.col("E").cast("double").alias("E"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features],
    )
    rows = materialise(known, "weibull")
    log_t = F.ln("T")
    stats = rows.agg(
        F.count(F.lit(1)).alias("n"), F.sum("E").alias("events"), F.avg(log_t).alias("level"), F.stddev_pop(log_t).alias("spread"),
        *[F.avg(c).alias(f"m_{c}") for c in features], *[F.stddev_samp(c).alias(f"s_{c}") for c in features],
    ).first()
    if not stats["n"] or not stats["events"]:
        raise ValueError("a Weibull fit needs rows with a time, and an event among them")
    n = stats["n"]
    means = np.array([stats[f"m_{c}"] for c in features], float)
    scales = np.array([stats[f"s_{c}"] or 1.0 for c in features], float)
    size = len(features) + 2
    ridge = np.full(size, penalizer)
    ridge[[0, -1]] = 0.0
    tri = np.triu_indices(size)

    def evaluate(theta: np.ndarray):
        sums = _sums(rows, features, means, scales, theta) / n
        hessian = np.zeros((size, size))
        hessian[tri] = sums[1 + size :]
        hessian = hessian + np.triu(hessian, 1).T - np.diag(ridge)
        return sums[0] - ridge @ theta**2 / 2, sums[1 : 1 + size] - ridge * theta, hessian

    theta = np.zeros(size)
    theta[0], theta[-1] = stats["level"] + 0.5, math.log(min(max(1.28 / (stats["spread"] or 1.0), 0.1), 10.0))
    value, gradient, hessian = evaluate(theta)
    for step in range(1, max_iter + 1):
        # Away from the optimum the Hessian may be indefinite; its eigenvalues are then taken by size.
        lam, vec = np.linalg.eigh(-hessian)
        move = vec @ ((vec.T @ gradient) / np.maximum(np.abs(lam), 1e-10))
        scale = min(1.0, 2.0 / max(np.abs(move).max(), 1e-300))
        tried = evaluate(theta + scale * move)
        while not tried[0] >= value - 1e-13 * abs(value) and scale > 1e-6:
            scale /= 2
            tried = evaluate(theta + scale * move)
        theta, (value, gradient, hessian) = theta + scale * move, tried
        if np.abs(gradient).max() < tolerance:
            break
    if not np.abs(gradient).max() < 1e-8:
        raise ValueError(f"no optimum after {step} steps, gradient {np.abs(gradient).max():.1e}")
    coef = theta[1:-1] / scales
    return WeibullModel(features, coef, float(theta[0] - coef @ means), math.exp(theta[-1]), float(value), gradient, step)
