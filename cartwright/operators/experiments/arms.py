"""Per-experiment moments of both arms in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.operators.experiments import PROPORTION_METRICS


def metric_type(metric: Column) -> Column:
    return F.when(metric.isin(PROPORTION_METRICS), "proportion").otherwise("continuous")


def arm_moments(sessions: DataFrame, value: str = "revenue") -> DataFrame:
    """Counts, conversions, means and variances of control (``_c``) and treatment (``_t``).

    Conditional aggregates combine on the map side: the shuffle carries one row per task and experiment, however
    unevenly sessions spread over experiments.
    """
    aggs = []
    for suffix, variant in (("c", "control"), ("t", "treatment")):
        arm = F.col("variant") == variant
        x = F.when(arm, F.col(value))
        aggs += [
            F.count(F.when(arm, 1)).alias(f"n_{suffix}"),
            F.count(F.when(arm & F.col("converted"), 1)).alias(f"conv_{suffix}"),
            F.avg(x).alias(f"mean_{suffix}"),
            F.var_samp(x).alias(f"var_{suffix}"),
            F.stddev_pop(x).alias(f"sd_pop_{suffix}"),
        ]
    return sessions.groupBy("experiment_name").agg(*aggs)
