"""Difference-in-differences and synthetic control on panels."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.functions import ratio
from cartwright.session import materialise


def panel_cells(panel: DataFrame, treatment: str, period: str, outcome: str) -> DataFrame:
    return panel.groupBy(treatment, period).agg(
        F.avg(outcome).alias("mean"), F.stddev_samp(outcome).alias("std"), F.count(outcome).alias("n")
    )


def difference_in_differences(panel: DataFrame, treatment: str, period: str, outcome: str) -> DataFrame:
    """2x2 estimate with the saturated regression read off the cell means; one conditional aggregation."""
    aggs = []
    for t in (0, 1):
        for p in (0, 1):
            y = F.when((F.col(treatment) == t) & (F.col(period) == p), F.col(outcome))
            aggs += [
                F.avg(y).alias(f"m{t}{p}"),
                (F.coalesce(F.var_pop(y), F.lit(0.0)) * F.count(y)).alias(f"ss{t}{p}"),
            ]
    total = F.var_pop(F.col(outcome)) * F.count(F.col(outcome))
    row = panel.filter(F.col(treatment).isin(0, 1) & F.col(period).isin(0, 1)).agg(*aggs, total.alias("sst"))
    did = (F.col("m11") - F.col("m10")) - (F.col("m01") - F.col("m00"))
    within = F.col("ss00") + F.col("ss01") + F.col("ss10") + F.col("ss11")
    return row.select(
        did.alias("did_estimate"),
        F.col("m00").alias("pre_control"),
        F.col("m10").alias("pre_treatment"),
        F.col("m01").alias("post_control"),
        F.col("m11").alias("post_treatment"),
        (F.col("m11") - F.col("m10")).alias("treatment_change"),
        (F.col("m01") - F.col("m00")).alias("control_change"),
        F.col("m00").alias("intercept"),
        (F.col("m10") - F.col("m00")).alias("coef_treatment"),
        (F.col("m01") - F.col("m00")).alias("coef_period"),
        did.alias("coef_did"),
        (1 - ratio(within, F.col("sst"))).alias("r_squared"),
    )


def parallel_trends(panel: DataFrame, treatment: str, time: str, outcome: str) -> DataFrame:
    return panel.groupBy(time).agg(
        F.avg(F.when(F.col(treatment) == 0, F.col(outcome))).alias("control"),
        F.avg(F.when(F.col(treatment) == 1, F.col(outcome))).alias("treated"),
    )


@dataclass
class SyntheticControl:
    weights: DataFrame  # unit, weight
    path: DataFrame  # time, actual, synthetic
    pre_period_rmse: float
    gap: float = 0.0  # the squared pre-period error is at most this far above the optimum


def _nearest_mixture(points: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kept columns and their weights: the convex mixture of smallest norm, from a feasible start (a column may have weight 0).

    The affine optimum of the kept columns is taken when all its weights are positive; otherwise the step towards it ends
    where the first weight reaches zero and that column leaves. The norm never grows, so no set of columns comes back.
    """
    kept = np.arange(points.shape[1])
    while True:
        base = points[:, kept[-1]]
        part = np.linalg.lstsq(points[:, kept[:-1]] - base[:, None], -base, rcond=None)[0]
        goal = np.append(part, 1 - part.sum())
        if (goal > 1e-12).all():
            return kept, goal
        falling = goal <= 1e-12
        ratios = np.full(len(kept), np.inf)
        ratios[falling] = weights[falling] / np.maximum(weights[falling] - goal[falling], 1e-300)
        weights = weights + min(ratios.min(), 1.0) * (goal - weights)
        stay = weights > 1e-12
        stay[np.argmin(ratios)] = False
        kept, weights = kept[stay], weights[stay] / weights[stay].sum()


def synthetic_control(
    panel: DataFrame,
    treated_unit,
    unit: str,
    time: str,
    outcome: str,
    pre_period: tuple | None = None,
    tolerance: float = 1e-9,
    max_steps: int = 10_000,
) -> SyntheticControl:
    """Convex combination of control units closest to the treated unit before the intervention.

    The nearest point of the donors' convex hull: a job scores every donor against the current residual and returns the best
    one, then the weights of the donors held are optimised exactly and those that fall to zero leave. At most one donor more
    than there are periods is held, so the driver has calendar-sized paths of few donors, whatever the size of the pool.

    It ends when the duality gap, which bounds how far the squared error is above the optimum, is at most ``tolerance`` times
    the squared size of the treated path, and raises when it does not get there. Donors lacking a pre-period value are left
    out, donors with equal paths count as the one of smallest id. Raises without a treated value or a complete donor.
    """
    before = panel if pre_period is None else panel.filter(F.col(time).between(*pre_period))
    rows = before.filter(F.col(outcome).isNotNull()).groupBy(unit, time).agg(F.avg(outcome).alias("v"))
    rows = materialise(rows, "panel")
    mine = {r[time]: r["v"] for r in rows.filter(F.col(unit) == F.lit(treated_unit)).collect()}  # one row per period
    times = sorted(mine)
    target = np.array([mine[t] for t in times])
    path = F.transform(F.array_sort(F.collect_list(F.struct(time, "v"))), lambda s: s["v"])
    donors = (
        rows.filter((F.col(unit) != F.lit(treated_unit)) & F.col(time).isin(times))
        .groupBy(unit)
        .agg(path.alias("path"))
        .filter(F.size("path") == len(times))
    )
    donors = materialise(donors, "donors")

    def best(residual: np.ndarray):
        r = F.array(*[F.lit(float(x)) for x in residual])
        score = F.aggregate(F.zip_with("path", r, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
        top = donors.select(F.struct(score.alias("s"), F.col(unit).alias("u"), "path").alias("d")).agg(F.min("d").alias("d"))
        return top.first()["d"]

    if not times:
        raise ValueError("the treated unit has no value in the pre-period")
    names, points, w = [], np.empty((len(times), 0)), np.empty(0)
    residual, gap = -target, float("inf")
    for _ in range(max_steps):
        pick = best(residual)
        if pick is None:
            raise ValueError("no donor covers the pre-period")
        point = np.array(pick["path"]) - target
        if names:
            gap = float(residual @ (residual - point))
        if gap <= tolerance * max(1.0, float(target @ target)) or pick["u"] in names:
            break
        names, points = [*names, pick["u"]], np.column_stack([points, point])
        kept, w = _nearest_mixture(points, np.append(w, 0.0 if len(w) else 1.0))
        names, points = [names[i] for i in kept], points[:, kept]
        residual = points @ w
    if gap > tolerance * max(1.0, float(target @ target)):
        raise ValueError(f"the duality gap stays at {gap:.1e}")
    current = target + residual
    spark = panel.sparkSession
    kind = panel.schema[unit].dataType.simpleString()
    weights = spark.createDataFrame([(n, float(x)) for n, x in zip(names, w) if x > 1e-9], f"{unit} {kind}, weight double")
    # The weight table has one row per picked donor.
    blended = panel.join(F.broadcast(weights), unit).groupBy(time).agg(F.sum(F.col("weight") * F.col(outcome)).alias("synthetic"))
    actual = panel.filter(F.col(unit) == F.lit(treated_unit)).groupBy(time).agg(F.avg(outcome).alias("actual"))
    rmse = float(np.sqrt(np.mean((target - current) ** 2)))
    return SyntheticControl(weights, actual.join(blended, time), rmse, gap)


def top_contributors(weights: DataFrame, unit: str, n: int = 5) -> DataFrame:
    return weights.orderBy(F.desc("weight"), unit).limit(n)
