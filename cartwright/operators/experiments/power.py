"""Power and sample size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.functions import norm_cdf, ratio, z_quantile
from cartwright.functions.tails import t_test_power
from cartwright.operators.experiments import ALPHA, MDE, POWER
from cartwright.operators.experiments.classic import cohens_h


def normal_power(h: Column, n: Column, alpha: float = ALPHA) -> Column:
    """Two-sided power of the two-proportion test with ``n`` per arm."""
    z, shift = z_quantile(1 - alpha / 2), F.abs(h) * F.sqrt(n / 2)
    return norm_cdf(shift - z) + norm_cdf(-shift - z)


def normal_sample_size(h: Column, alpha: float = ALPHA, power: float = POWER) -> Column:
    """n per arm: the one-tail closed form, then a Newton step for the opposite tail. Null for a zero effect."""
    a = F.abs(h)
    z, zb = z_quantile(1 - alpha / 2), z_quantile(power)
    n0 = 2 * ratio(F.lit((z + zb) ** 2), a * a)
    excess = norm_cdf(F.lit(-(2 * z + zb)))
    # Derivative of the power in n at n0, where the shift equals z + zb.
    slope = F.exp(F.lit(-zb * zb / 2)) / 2.5066282746310002 * (z + zb) / (2 * n0)
    return F.ceil(n0 - ratio(excess, slope)).cast("long")


def sample_size_for_proportion(baseline: Column, mde: float = MDE) -> Column:
    return normal_sample_size(cohens_h(F.least(baseline * (1 + mde), F.lit(1.0)), baseline))


def power_curves(results: DataFrame, points: int = 200, alpha: float = ALPHA) -> DataFrame:
    """Power over a sample-size grid from 100 to twice the control arm, ``points`` rows per experiment."""
    step = F.col("step") / (points - 1)
    grid = results.select(
        "experiment_name",
        "metric_type",
        F.col("cohens_h"),
        F.coalesce(F.abs(F.when(F.col("cohens_d") != 0, F.col("cohens_d"))), F.lit(0.2)).alias("d"),
        F.col("n_control"),
        F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("step"),
    ).withColumn("n", 100 + (F.col("n_control") * 2 - 100) * step)
    # Two filtered branches: the t branch alone pays for the Python worker.
    use_normal = (F.col("metric_type") == "proportion") & (F.coalesce(F.col("cohens_h"), F.lit(0.0)) != 0)
    normal = grid.filter(use_normal).withColumn("power", normal_power(F.col("cohens_h"), F.col("n"), alpha))
    student = grid.filter(~use_normal).withColumn("power", t_test_power(F.col("d"), F.col("n"), alpha))
    return normal.unionByName(student).select("experiment_name", "step", "n", "power")


def required_n_curve(results: DataFrame, points: int = 100, alpha: float = ALPHA) -> DataFrame:
    """Sample size needed per arm for power levels .3 to .999, by the normal approximation."""
    za = z_quantile(1 - alpha / 2)
    levels = [0.3 + (0.999 - 0.3) * i / (points - 1) for i in range(points)]
    grid = F.explode(F.array(*[F.struct(F.lit(p).alias("power"), F.lit(za + z_quantile(p)).alias("z")) for p in levels]))
    effect = F.when(
        F.col("metric_type") == "proportion", F.coalesce(F.nullif("cohens_h", F.lit(0.0)), F.lit(0.15))
    ).otherwise(F.coalesce(F.nullif("cohens_d", F.lit(0.0)), F.lit(0.2)))
    return results.select("experiment_name", effect.alias("effect"), grid.alias("g")).select(
        "experiment_name",
        F.round("g.power", 6).alias("power"),
        F.ceil(2 * F.col("g.z") * F.col("g.z") / (F.col("effect") * F.col("effect"))).cast("long").alias("n_required"),
    )
