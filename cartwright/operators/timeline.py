"""Point-in-time lookup and control charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_of_join(
    facts: DataFrame, features: DataFrame, key: str, fact_time: str, feature_time: str, slice_seconds: int = 600
) -> DataFrame:
    """Left as-of join: the latest feature row of the key at or before the fact's time.

    Both sides meet in (key, time slice) groups, so a key with most rows is split along time. What enters a slice from
    earlier ones is a single carried feature row per (key, slice). Only slices that hold rows exist, so short slices
    cost little: a key has at most as many as it has rows or as fit the calendar.
    """
    values = [c for c in features.columns if c not in (key, feature_time)]
    def time_slice(c: str) -> Column:
        return F.floor(F.unix_seconds(F.col(c).cast("timestamp")) / slice_seconds)

    payload = F.struct(F.col(feature_time).cast("timestamp").alias("at"), *values)
    feats = features.filter(F.col(feature_time).isNotNull()).select(
        key, time_slice(feature_time).alias("_slice"), payload.alias("_feature")
    )
    rows = facts.withColumn("_slice", time_slice(fact_time)).withColumn("_fact", F.struct(*facts.columns))

    # Last feature row per (key, slice), then the last one of any earlier slice: rows per key = slices in use.
    closing = feats.groupBy(key, "_slice").agg(F.max("_feature").alias("_last"))
    slots = rows.select(key, "_slice").distinct().withColumn("_wanted", F.lit(True))
    timeline = slots.join(closing, [key, "_slice"], "full")
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = timeline.withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier)).filter("_wanted")
    carried = carried.select(key, "_slice", "_carried")

    at = F.col(fact_time).cast("timestamp")
    events = rows.select(key, "_slice", at.alias("_at"), F.lit(1).alias("_kind"), "_fact").unionByName(
        feats.select(key, "_slice", F.col("_feature.at").alias("_at"), F.lit(0).alias("_kind"), "_feature"),
        allowMissingColumns=True,
    )
    # Features sort before facts of the same instant.
    so_far = Window.partitionBy(key, "_slice").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    matched = events.withColumn("_feature", F.last("_feature", ignorenulls=True).over(so_far)).filter("_kind = 1")
    found = matched.join(carried, [key, "_slice"], "left").withColumn("_f", F.coalesce("_feature", "_carried"))
    return found.select(
        *[F.col(f"_fact.{c}").alias(c) for c in facts.columns],
        F.col("_f.at").alias("feature_time"),
        *[F.col(f"_f.{c}").alias(c) for c in values],
    )


def cusum(series: DataFrame, keys: list[str], order: str, value: str, slack: float = 0.5, threshold: float = 5.0,
          baseline: int = 50) -> DataFrame:
    """Two-sided CUSUM on standardised values; mean and deviation come from the first ``baseline`` points.

    ``series`` holds one aggregated point per key and period, so a window over a key is bounded by the calendar. The
    recursion ``max(0, S + z - slack)`` equals the running total minus its lowest level so far.
    """
    by_time = Window.partitionBy(*keys).orderBy(order)
    so_far = by_time.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    base = F.when(F.col("_no") <= baseline, F.col(value))
    z = (F.col(value) - F.col("_mu")) / F.nullif(F.col("_sd"), F.lit(0.0))
    staged = (
        series.withColumn("_no", F.row_number().over(by_time))
        .withColumns({"_mu": F.avg(base).over(whole), "_sd": F.stddev_samp(base).over(whole)})
        .withColumn("_z", F.coalesce(z, F.lit(0.0)))
        .withColumns({"_up": F.sum(F.col("_z") - slack).over(so_far), "_down": F.sum(-F.col("_z") - slack).over(so_far)})
    )
    floor_up = F.least(F.lit(0.0), F.min("_up").over(so_far))
    floor_down = F.least(F.lit(0.0), F.min("_down").over(so_far))
    out = staged.withColumns({"cusum_upper": F.col("_up") - floor_up, "cusum_lower": F.col("_down") - floor_down})
    alarm = (F.col("cusum_upper") > threshold) | (F.col("cusum_lower") > threshold)
    kind = F.when(F.col("cusum_upper") > threshold, "increase").when(F.col("cusum_lower") > threshold, "decrease")
    return out.withColumns({"deviation": F.col("_z"), "is_anomaly": alarm, "anomaly_type": kind}).drop(
        "_no", "_mu", "_sd", "_z", "_up", "_down"
    )
