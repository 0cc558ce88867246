"""Scenario projections over segment means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.functions import exact_avg, exact_sum


def segment_means(customers: DataFrame, value: str = "clv_12m") -> DataFrame:
    return customers.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), exact_avg(value).alias("clv"))


def segment_conversions(customers: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Moving a share of one segment to the value level of another.

    ``scenarios`` has from_segment, to_segment, conversion_rate; all scenarios are answered in one join.
    """
    means = segment_means(customers)
    source = means.select(F.col("segment").alias("from_segment"), F.col("n").alias("_n"), F.col("clv").alias("_from"))
    target = means.select(F.col("segment").alias("to_segment"), F.col("clv").alias("_to"))
    lift = F.col("_to") - F.col("_from")
    moved = F.col("_n") * F.col("conversion_rate")
    return scenarios.join(source, "from_segment").join(target, "to_segment").select(
        "from_segment",
        "to_segment",
        "conversion_rate",
        moved.alias("customers_converted"),
        lift.alias("clv_lift_per_customer"),
        (moved * lift).alias("annual_revenue_impact"),
    )


def churn_reduction(customers: DataFrame, reduction: float, segments: Sequence[str], churn_share: float = 1.0) -> DataFrame:
    """Customers of the target segments kept, and the value they stand for."""
    picked = customers.filter(F.col("segment").isin(*segments))
    kept = F.count(F.lit(1)) * churn_share * reduction
    return picked.agg(kept.alias("customers_retained"), (kept * exact_avg("clv_12m")).alias("annual_revenue_impact"))


def price_change(transactions: DataFrame, change: float, elasticity: float = 0.0) -> DataFrame:
    """Profit effect per category of a price change; ``elasticity`` is the volume response per unit of price change."""
    revenue, cost = exact_sum("revenue"), exact_sum("cogs")
    volume = 1 + elasticity * change
    return (
        transactions.filter(F.col("revenue") > 0)
        .groupBy("category")
        .agg(revenue.alias("_r"), cost.alias("_c"))
        .select(
            "category",
            F.round("_r", 2).alias("affected_revenue"),
            F.round(F.col("_r") * ((1 + change) * volume - 1), 2).alias("revenue_change"),
            F.round(F.col("_r") * ((1 + change) * volume - 1) - F.col("_c") * (volume - 1), 2).alias("profit_change"),
        )
    )
