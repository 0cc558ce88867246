"""The standing reports as views, so that SQL users query them by name."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cartwright.operators import revenue
from cartwright.operators.experiments import results

def register_revenue_views(
    customers: DataFrame, transactions: DataFrame, rfm: DataFrame, lifetime: DataFrame | None = None
) -> list[str]:
    """Five views over order lines and scored customers; ``lifetime`` has customer_id and clv_12m, by default those of ``rfm``.

    Views are plans: each use reads the tables anew with the query's own filters and columns. Give tables read from storage,
    not long computations. Null keys form a group of their own; empty tables give empty views.
    """
    kept = rfm.drop("acquisition_channel")
    channels = customers.select("customer_id", "acquisition_channel")
    frames = {
        "vw_segment_revenue": revenue.revenue_by_segment(transactions, rfm),
        "vw_monthly_revenue": revenue.monthly_revenue(transactions),
        "vw_segment_summary": revenue.segment_summary(rfm),
        "vw_revenue_by_channel": revenue.revenue_by_channel(
            kept.join(channels, "customer_id", "left"), (rfm if lifetime is None else lifetime).select("customer_id", "clv_12m")
        ),
        "vw_daily_revenue": revenue.daily_revenue(transactions),
    }
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return list(frames)


def register_trial_view(trial_results: DataFrame) -> str:
    """The experiment dashboard over written test results."""
    results.ab_dashboard(trial_results).createOrReplaceTempView("vw_ab_dashboard")
    return "vw_ab_dashboard"
