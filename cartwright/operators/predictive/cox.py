"""Cox proportional hazards: Newton steps over risk-set sums per day, Efron ties, ridge penalty."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.session import materialise


@dataclass
class CoxModel:
    features: list[str]
    coef: np.ndarray
    se: np.ndarray
    means: np.ndarray
    baseline: list[tuple[float, float]]  # time, cumulative hazard at the mean covariates
    log_likelihood: float
    iterations: int

    def coefficients(self, spark: SparkSession) -> DataFrame:
        """Coefficient table with hazard ratio, z, p and stars."""
        rows = []
        for name, b, se in zip(self.features, self.coef, self.se):
            z = b / se if se > 0 else float("nan")
            p = math.erfc(abs(z) / math.sqrt(2))
            stars = "***" if p < 0.001 else "**" if p < 0.01 else "*" if p < 0.05 else ""
            rows.append((name, float(b), float(math.exp(b)), float(se), float(z), float(p), stars))
        return spark.createDataFrame(
            rows, "feature string, coef double, hazard_ratio double, se double, z double, p double, stars string"
        )

    def baseline_median(self) -> float:
        """Day at which baseline survival is nearest to one half."""
        return min(self.baseline, key=lambda r: abs(math.exp(-r[1]) - 0.5))[0]

    def with_risk(self, df: DataFrame) -> DataFrame:
        """Add ``risk`` (partial hazard relative to the mean) and the scaled median time."""
        score = F.lit(0.0)
        for name, b, m in zip(self.features, self.coef, self.means):
            score = score + (F.coalesce(F.col(name).cast("double"), F.lit(0.0)) - float(m)) * float(b)
        return df.withColumn("risk", F.exp(score)).withColumn("median_T", self.baseline_median() / F.col("risk"))

    def survival_at(self, df: DataFrame, key: str, until: int = 364, step: int = 7) -> DataFrame:
        """Survival probability per customer and grid day."""
        times = np.array([t for t, _ in self.baseline])
        hazard = np.array([h for _, h in self.baseline])
        grid = list(range(0, until + 1, step))
        at = np.searchsorted(times, grid, side="right") - 1
        points = F.array(
            *[F.struct(F.lit(g).alias("at"), F.lit(float(hazard[i]) if i >= 0 else 0.0).alias("h")) for g, i in zip(grid, at)]
        )
        rows = self.with_risk(df).select(key, "risk", F.explode(points).alias("g"))
        return rows.select(key, "g.at", F.exp(-F.col("g.h") * F.col("risk")).alias("survival"))


def tie_nodes(k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares ``l / k`` and weights whose weighted sum over a term of Efron's correction equals that over l = 0 .. k - 1.

    Up to 256 ties every one is a node. Beyond, with v = k - l: the 64 smallest v one by one (the terms may have a pole at
    v = 0), the rest as an integral over panels of doubling length with 16 Gauss-Legendre nodes each, and Gregory's end
    corrections, which turn the integral into the sum. The nodes grow with log(k) and nothing cancels, unlike differences
    of digamma functions when few of many at risk have the event.
    """
    if k <= 256:
        return np.arange(k) / k, np.ones(k)
    first, depth = 65, 12
    v, w = [np.arange(1.0, first)], [np.ones(first - 1)]
    x, gauss = np.polynomial.legendre.leggauss(16)
    low = float(first)
    while low < k:
        high = min(2 * low, float(k))
        v.append((low + high) / 2 + (high - low) / 2 * x)
        w.append((high - low) / 2 * gauss)
        low = high
    gregory = [1.0]
    for m in range(1, depth + 1):
        gregory.append(-sum(gregory[i] * (-1) ** (m - i) / (m - i + 1) for i in range(m)))
    end = np.zeros(depth)
    end[0] = 0.5
    for m in range(1, depth):  # m-th difference at an end, as weights of the end's neighbours
        end[: m + 1] += abs(gregory[m + 1]) * np.array([(-1) ** j * math.comb(m, j) for j in range(m + 1)])
    v += [first + np.arange(depth), k - np.arange(depth)]
    w += [end, end]
    return 1 - np.concatenate(v) / k, np.concatenate(w)


_BLOCKS = 64


def _day_sums(data: DataFrame, features: list[str], means, scales, beta: np.ndarray, days_a_block: int) -> DataFrame:
    """Per day: sums of exp(xb), x exp(xb), xx' exp(xb) over all rows and over events, event count and event x sums.

    Tasks fold their rows into one vector per day, a second step adds the vectors of a day.
    """
    p = len(features)
    tri = np.triu_indices(p)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc: dict[int, np.ndarray] = {}
        for pdf in batches:
            x = (pdf[features].to_numpy(float) - means) / scales
            theta = np.exp(np.clip(x @ beta, -500, 500))[:, None]
            e = pdf["E"].to_numpy(float)[:, None]
            block = np.hstack([theta, theta * x, theta * (x[:, tri[0]] * x[:, tri[1]])])
            rows = np.hstack([block, e * block, e, e * x, e * (x @ beta)[:, None]])
            days, at = np.unique(pdf["T"].to_numpy(), return_inverse=True)
            by_day = np.argsort(at, kind="stable")
            sums = np.add.reduceat(rows[by_day], np.searchsorted(at[by_day], np.arange(len(days))), axis=0)
            for day, s in zip(days, sums):
                acc[day] = acc[day] + s if day in acc else s
        yield pd.DataFrame({"T": list(acc), "s": [v.tolist() for v in acc.values()]})

    def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"T": [key[0]], "s": [np.sum(np.stack(pdf["s"].to_numpy()), axis=0).tolist()]})

    kind = "T long, s array<double>"
    summed = data.mapInPandas(fold, kind).groupBy("T").applyInPandas(add, kind)
    return materialise(summed.withColumn("block", F.floor(F.col("T") / days_a_block)), "cox-days")


def _block_totals(days: DataFrame, width: int) -> dict[int, np.ndarray]:
    """At-risk sums of each block's days; at most ``_BLOCKS`` + 1 vectors reach the driver."""

    def total(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": [key[0]], "s": [np.stack(pdf["s"].to_numpy())[:, :width].sum(axis=0).tolist()]})

    rows = days.groupBy("block").applyInPandas(total, "block long, s array<double>").collect()
    return {r["block"]: np.array(r["s"]) for r in rows}


def _efron_sums(days: DataFrame, p: int, later: dict[int, np.ndarray]) -> DataFrame:
    """Per block of days: log-likelihood, gradient, information triangle, and each day's hazard step, all with Efron ties."""
    tri = np.triu_indices(p)
    width = 1 + p + len(tri[0])

    def terms(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("T")
        sums = np.stack(pdf["s"].to_numpy())
        at_risk = np.cumsum(sums[::-1, :width], axis=0)[::-1] + later[key[0]]
        event, count = sums[:, width : 2 * width], sums[:, 2 * width]
        total = np.zeros(width)
        total[0] = sums[:, -1].sum()
        total[1 : 1 + p] = sums[:, 2 * width + 1 : 2 * width + 1 + p].sum(axis=0)
        for r, d, k in zip(at_risk, event, count.astype(np.int64)):
            if k:
                share, weight = tie_nodes(int(k))
                s0 = r[0] - share * d[0]
                a = (r[1 : 1 + p] - share[:, None] * d[1 : 1 + p]) / s0[:, None]
                total[0] -= weight @ np.log(s0)
                total[1 : 1 + p] -= weight @ a
                outer = (a * weight[:, None]).T @ a
                total[1 + p :] += r[1 + p :] * (weight / s0).sum() - d[1 + p :] * (weight * share / s0).sum() - outer[tri]
        step = np.divide(count, at_risk[:, 0], out=np.zeros_like(count), where=at_risk[:, 0] > 0)
        return pd.DataFrame({"sums": [total.tolist()], "T": [pdf["T"].tolist()], "step": [step.tolist()]})

    return days.groupBy("block").applyInPandas(terms, "sums array<double>, T array<bigint>, step array<double>")


def fit_cox(data: DataFrame, features: list[str], penalizer: float = 0.1, max_iter: int = 30, tolerance: float = 1e-8) -> CoxModel:
    """Duration ``T`` in whole days, event ``E``. Features are standardised inside the fit, nulls count as zero.

    Rows meet their day's vector on the executors, and so do the days' terms: the driver adds up at most 65 blocks of days
    per step, and reads one hazard step per day.
    """
    filled = data.select("T", "E", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])
    filled = materialise(filled.withColumn("T", F.col("T").cast("long")), "cox")
    stats = filled.agg(
        F.count(F.lit(1)).alias("n"), F.min("T").alias("low"), F.max("T").alias("high"), *[F.avg(c).alias(f"m_{c}") for c in features], *[F.stddev_samp(c).alias(f"s_{c}") for c in features]
    ).first()
    n, p = stats["n"], len(features)
    means = np.array([stats[f"m_{c}"] for c in features])
    scales = np.array([stats[f"s_{c}"] or 1.0 for c in features])
    days_a_block = int(stats["high"] - stats["low"]) // _BLOCKS + 1
    tri = np.triu_indices(p)
    width = 1 + p + len(tri[0])

    def square(v: np.ndarray) -> np.ndarray:
        m = np.zeros((p, p))
        m[tri] = v
        return m + m.T - np.diag(np.diag(m))

    def evaluate(beta: np.ndarray):
        days = _day_sums(filled, features, means, scales, beta, days_a_block)
        totals = _block_totals(days, width)
        later, held = {}, np.zeros(width)
        for block in sorted(totals, reverse=True):
            later[block] = held
            held = held + totals[block]
        parts = _efron_sums(days, p, later).collect()
        sums = np.sum([r["sums"] for r in parts], axis=0)
        ll = float(sums[0]) - n * penalizer / 2 * float(beta @ beta)
        grad = sums[1 : 1 + p] - n * penalizer * beta
        info = square(sums[1 + p :]) + n * penalizer * np.eye(p)
        steps = sorted((float(t), h) for r in parts for t, h in zip(r["T"], r["step"]))
        hazard = np.cumsum([h for _, h in steps])
        return ll, grad, info, list(zip([t for t, _ in steps], hazard))

    beta, step = np.zeros(p), 0
    ll, grad, info, baseline = evaluate(beta)
    for step in range(1, max_iter + 1):
        move, scale = np.linalg.solve(info, grad), 1.0
        tried = evaluate(beta + move)
        while tried[0] < ll - 1e-9 * abs(ll) and scale > 1e-3:
            scale /= 2
            tried = evaluate(beta + scale * move)
        beta = beta + scale * move
        gain = tried[0] - ll
        ll, grad, info, baseline = tried
        if abs(gain) < tolerance * (1 + abs(ll)):
            break
    se = np.sqrt(np.diag(np.linalg.inv(info)))
    return CoxModel(features, beta / scales, se / scales, means, baseline, ll, step)
