"""Revenue, retention, channel, value and return reports over transactions and scored customers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.functions import attach_row, exact_avg, exact_sum, month_index, percent, ratio
from cartwright.operators.ordering import grouped_percentiles, with_global_order
from cartwright.operators.rfm import ntile_descending
from cartwright.session import materialise


def _when_sum(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0))


def segment_revenue_pareto(transactions: DataFrame, rfm: DataFrame) -> DataFrame:
    """Revenue per segment with running totals.

    Lines collapse to (customer, order) before the join, so a customer holding most lines is summed over many tasks and
    the join moves orders, not lines. Averages weigh each customer by line count, as a join of the lines would.
    """
    orders = (
        transactions.filter(F.col("revenue") > 0)
        .groupBy("customer_id", "order_id")
        .agg(
            F.sum(F.col("revenue").cast("decimal(18,4)")).alias("rev"),
            F.sum(F.col("gross_profit").cast("decimal(18,4)")).alias("gp"),
            F.count(F.lit(1)).alias("lines"),
        )
    )
    seg = rfm.select("customer_id", "segment", "clv_12m", "recency", "frequency", "monetary")

    def weighted(c: str, digits: int) -> Column:
        total = F.sum(F.col(c).cast("decimal(18,4)") * F.col("lines")).cast("double")
        return F.round(total / F.sum("lines"), digits)

    per_segment = (
        orders.join(seg, "customer_id")
        .groupBy("segment")
        .agg(
            F.count_distinct("customer_id").alias("n_customers"),
            F.count_distinct("order_id").alias("n_orders"),
            F.round(F.sum("rev").cast("double"), 2).alias("total_revenue"),
            F.round(F.sum("gp").cast("double"), 2).alias("gross_profit"),
            weighted("clv_12m", 2).alias("avg_clv_12m"),
            weighted("recency", 1).alias("avg_recency_days"),
            weighted("frequency", 1).alias("avg_frequency"),
            weighted("monetary", 2).alias("avg_monetary"),
        )
    )
    return with_pareto(per_segment)


def with_pareto(per_segment: DataFrame) -> DataFrame:
    """Share, margin and running columns over an aggregated (segment-sized) table."""
    running = Window.orderBy(F.desc("total_revenue"), "segment").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy()
    cumulative = F.sum(F.col("total_revenue").cast("decimal(18,4)")).over(running).cast("double")
    grand = F.sum(F.col("total_revenue").cast("decimal(18,4)")).over(everything).cast("double")
    return per_segment.select(
        "*",
        percent("total_revenue", grand).alias("pct_revenue"),
        percent("gross_profit", "total_revenue").alias("gp_margin_pct"),
        cumulative.alias("cumulative_revenue"),
        percent(cumulative, grand).alias("cumulative_pct"),
    ).orderBy(F.desc("total_revenue"), "segment")


def cohort_retention(transactions: DataFrame, wrap_years: bool = False) -> DataFrame:
    """Monthly cohorts: customers active per whole month since their first one.

    The months of a customer (bounded by the calendar) are gathered in one map-side-combined pass; distinct customers
    are then plain counts. ``wrap_years`` restarts the offset every 12 months.
    """
    active = transactions.groupBy("customer_id").agg(F.collect_set(month_index("transaction_date")).alias("months"))
    first = F.array_min("months")
    month_start = F.make_date(F.floor((first - 1) / 12).cast("int"), ((first - 1) % 12 + 1).cast("int"), F.lit(1))
    offsets = F.transform("months", lambda m: m - first)
    if wrap_years:
        offsets = F.array_distinct(F.transform(offsets, lambda m: m % 12))
    per_month = (
        active.select(month_start.alias("cohort_month"), F.explode(offsets).alias("months_since_cohort"))
        .groupBy("cohort_month", "months_since_cohort")
        .agg(F.count(F.lit(1)).alias("retained_customers"))
    )
    # Every customer is active in month 0, so the cohort size is that month's count; rows per cohort are months.
    size = F.max(F.when(F.col("months_since_cohort") == 0, F.col("retained_customers"))).over(
        Window.partitionBy("cohort_month")
    )
    return (
        per_month.withColumn("cohort_size", size)
        .withColumn("retention_rate", percent("retained_customers", "cohort_size"))
        .orderBy("cohort_month", "months_since_cohort")
    )


def cohort_matrix(retention: DataFrame, periods: int = 12) -> DataFrame:
    """Retention rates as one row per cohort and one column per period."""
    return (
        retention.filter(F.col("months_since_cohort") < periods)
        .groupBy("cohort_month", "cohort_size")
        .agg(
            *[
                F.coalesce(
                    F.max(F.when(F.col("months_since_cohort") == p, F.col("retention_rate"))), F.lit(0.0)
                ).alias(f"p{p}")
                for p in range(periods)
            ]
        )
    )


def cohort_summary(retention: DataFrame) -> DataFrame:
    """Average first-period retention and the cohort that kept most customers in it."""
    first = retention.filter(F.col("months_since_cohort") == 1)
    return first.agg(
        F.round(exact_avg("retention_rate"), 4).alias("avg_retention_p1"),
        F.max_by("cohort_month", F.struct("retention_rate", "cohort_month")).alias("best_cohort"),
        F.count(F.lit(1)).alias("n_cohorts"),
    )


def channel_roi(customers: DataFrame, rfm: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return (
        customers.select("customer_id", "acquisition_channel")
        .join(rfm.select("customer_id", "segment", "clv_12m", "monetary", "frequency", "recency"), "customer_id")
        .groupBy("acquisition_channel")
        .agg(
            F.count_distinct("customer_id").alias("total_customers"),
            F.round(exact_avg("clv_12m"), 2).alias("avg_clv_12m"),
            F.round(exact_sum("clv_12m"), 2).alias("total_clv_12m"),
            F.round(exact_avg("monetary"), 2).alias("avg_ltv"),
            F.round(exact_avg("frequency"), 2).alias("avg_orders"),
            F.round(exact_avg("recency"), 1).alias("avg_recency"),
            percent(_when_sum(F.col("segment") == "Champions"), n).alias("pct_champions"),
            percent(_when_sum(F.col("segment").isin("Hibernating", "Lost")), n).alias("pct_churned"),
        )
        .orderBy(F.desc("avg_clv_12m"), "acquisition_channel")
    )


def segment_migration(rfm: DataFrame, width: float = 0.3) -> DataFrame:
    """Customers just below the 75th percentile of the composite. Composites take at most 13 values, so the
    percentile buffer is tiny."""
    edge = rfm.agg(F.percentile("RFM_composite", F.lit(0.75)).alias("_p75"))
    close = F.col("RFM_composite").between(F.col("_p75") - width, F.col("_p75"))
    return (
        attach_row(rfm.select("segment", "RFM_composite", "clv_12m"), edge)
        .groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("n_customers"),
            F.round(F.avg("RFM_composite"), 3).alias("avg_rfm"),
            F.round(F.stddev("RFM_composite"), 3).alias("std_rfm"),
            F.round(exact_avg("clv_12m"), 2).alias("avg_clv"),
            F.count(F.when(close, 1)).alias("upgrade_candidates"),
        )
        .orderBy(F.desc("avg_rfm"), "segment")
    )


def revenue_seasonality(transactions: DataFrame) -> DataFrame:
    """Day of week (0 = Sunday) by hour."""
    return (
        transactions.filter(F.col("revenue") > 0)
        .groupBy(
            (F.dayofweek("transaction_date") - 1).alias("day_of_week"), F.hour("transaction_date").alias("hour_of_day")
        )
        .agg(
            F.count_distinct("order_id").alias("n_orders"),
            F.round(exact_sum("revenue"), 2).alias("total_revenue"),
            F.round(exact_avg("revenue"), 2).alias("avg_order_revenue"),
            F.round(exact_avg("seasonality_factor"), 3).alias("avg_seasonality"),
        )
        .orderBy(F.desc("total_revenue"), "day_of_week", "hour_of_day")
    )


def clv_deciles(rfm: DataFrame) -> DataFrame:
    """Ten equal-count value groups; the dominant segment is the most frequent one, ties by name."""
    scored = ntile_descending(
        materialise(rfm.select("customer_id", "segment", "clv_12m"), "clv"), "clv_12m", "customer_id", 10, "decile"
    )
    # (decile, segment) first: the mode then looks at a handful of counted rows.
    cells = scored.groupBy("decile", "segment").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("clv_12m").alias("lo"),
        F.max("clv_12m").alias("hi"),
        F.sum(F.col("clv_12m").cast("decimal(18,4)")).alias("total"),
    )
    deciles = cells.groupBy("decile").agg(
        F.sum("n").alias("n_customers"),
        F.round(F.min("lo"), 2).alias("min_clv"),
        F.round(F.max("hi"), 2).alias("max_clv"),
        F.round(F.sum("total").cast("double") / F.sum("n"), 2).alias("avg_clv"),
        F.sum("total").cast("double").alias("_total"),
        F.min_by("segment", F.struct(-F.col("n"), F.col("segment"))).alias("dominant_segment"),
    )
    grand = F.sum(F.col("_total").cast("decimal(18,4)")).over(Window.partitionBy()).cast("double")
    return (
        deciles.withColumn("total_clv", F.round("_total", 2))
        .withColumn("pct_total_clv", percent("_total", grand))
        .drop("_total")
        .orderBy("decile")
    )


def return_rates(transactions: DataFrame, rfm: DataFrame) -> DataFrame:
    """Returns by category and segment; lines collapse to (customer, category) before the join."""
    per_customer = transactions.groupBy("customer_id", "category").agg(
        F.count(F.lit(1)).alias("items"),
        _when_sum(F.col("is_returned")).alias("returned"),
        F.sum(F.when(F.col("revenue") < 0, F.col("revenue")).otherwise(0).cast("decimal(18,4)")).alias("lost"),
    )
    return (
        per_customer.join(rfm.select("customer_id", "segment"), "customer_id")
        .groupBy("category", "segment")
        .agg(
            F.sum("items").alias("total_items"),
            F.sum("returned").alias("returned_items"),
            percent(F.sum("returned"), F.sum("items")).alias("return_rate_pct"),
            F.round(F.abs(F.sum("lost").cast("double")), 2).alias("lost_revenue"),
        )
        .orderBy(F.desc("return_rate_pct"), "category", "segment")
    )


def revenue_by_segment(transactions: DataFrame, rfm: DataFrame) -> DataFrame:
    orders = transactions.groupBy("customer_id", "order_id").agg(
        F.sum(F.col("revenue").cast("decimal(18,4)")).alias("rev"),
        F.sum(F.col("gross_profit").cast("decimal(18,4)")).alias("gp"),
        F.count(F.lit(1)).alias("lines"),
    )
    clv = F.sum(F.col("clv_12m").cast("decimal(18,4)") * F.col("lines")).cast("double")
    return (
        orders.join(rfm.select("customer_id", "segment", "clv_12m"), "customer_id")
        .groupBy("segment")
        .agg(
            F.count_distinct("customer_id").alias("n_customers"),
            F.count_distinct("order_id").alias("n_orders"),
            F.round(F.sum("rev").cast("double"), 2).alias("total_revenue"),
            F.round(F.sum("rev").cast("double") / F.sum("lines"), 2).alias("avg_order_revenue"),
            F.round(F.sum("gp").cast("double"), 2).alias("total_gross_profit"),
            F.round(clv / F.sum("lines"), 2).alias("avg_clv_12m"),
        )
    )


def monthly_revenue(transactions: DataFrame) -> DataFrame:
    return (
        transactions.filter(F.col("revenue") > 0)
        .groupBy(F.date_format("transaction_date", "yyyy-MM").alias("month"))
        .agg(
            F.count_distinct("order_id").alias("n_orders"),
            F.count_distinct("customer_id").alias("n_customers"),
            F.round(exact_sum("revenue"), 2).alias("total_revenue"),
            F.round(exact_avg("revenue"), 2).alias("avg_order_value"),
        )
        .orderBy("month")
    )


def segment_summary(rfm: DataFrame) -> DataFrame:
    return (
        rfm.groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("n_customers"),
            F.round(exact_avg("recency"), 1).alias("avg_recency"),
            F.round(exact_avg("frequency"), 2).alias("avg_frequency"),
            F.round(exact_avg("monetary"), 2).alias("avg_monetary"),
            F.round(exact_sum("monetary"), 2).alias("total_revenue"),
            F.round(F.avg("RFM_composite"), 1).alias("avg_rfm_composite"),
        )
        .orderBy(F.desc("avg_monetary"), "segment")
    )


def revenue_by_channel(rfm_with_channel: DataFrame, customer_clv: DataFrame) -> DataFrame:
    """Every scored customer counts, whether or not a lifetime value is known for them."""
    return (
        rfm_with_channel.select("customer_id", "acquisition_channel", "monetary")
        .join(customer_clv.select("customer_id", F.col("clv_12m").alias("_clv")), "customer_id", "left")
        .groupBy("acquisition_channel")
        .agg(
            F.count_distinct("customer_id").alias("n_customers"),
            F.round(exact_sum("monetary"), 2).alias("total_revenue"),
            F.round(exact_avg("monetary"), 2).alias("avg_revenue_per_customer"),
            F.round(exact_avg("_clv"), 2).alias("avg_clv"),
        )
        .orderBy(F.desc("total_revenue"), "acquisition_channel")
    )


def daily_revenue(transactions: DataFrame) -> DataFrame:
    return (
        transactions.groupBy(F.to_date("transaction_date").alias("date"))
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            exact_sum("revenue").alias("total_revenue"),
            exact_avg("revenue").alias("avg_order_value"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
        .orderBy(F.desc("date"))
    )


def daily_new_returning(transactions: DataFrame) -> DataFrame:
    """Customers per day split by whether the day is their first; a customer's days are bounded by the calendar."""
    days = transactions.groupBy("customer_id").agg(F.collect_set(F.to_date("transaction_date")).alias("days"))
    each = days.select(F.array_min("days").alias("first_day"), F.explode("days").alias("date"))
    is_new = F.col("date") == F.col("first_day")
    return (
        each.groupBy("date")
        .agg(_when_sum(is_new).alias("new_customers"), _when_sum(~is_new).alias("returning_customers"))
        .orderBy("date")
    )


def executive_kpis(transactions: DataFrame) -> DataFrame:
    positive = F.when(F.col("revenue") > 0, F.col("revenue"))
    return transactions.agg(
        exact_sum(positive).alias("_revenue"),
        F.count_distinct("order_id").alias("total_orders"),
        F.count_distinct("customer_id").alias("total_customers"),
        exact_sum("gross_profit").alias("_gp"),
        percent(_when_sum(F.col("is_returned")), F.count("is_returned")).alias("return_rate"),
    ).select(
        F.round("_revenue", 2).alias("total_revenue"),
        "total_orders",
        "total_customers",
        F.round(ratio("_revenue", "total_orders"), 2).alias("aov"),
        percent("_gp", "_revenue").alias("gp_margin"),
        "return_rate",
    )


def revenue_by_category(transactions: DataFrame) -> DataFrame:
    return (
        transactions.filter(F.col("revenue") > 0)
        .groupBy("category")
        .agg(F.round(exact_sum("revenue"), 2).alias("revenue"))
        .orderBy(F.desc("revenue"), "category")
    )


def channel_clv(rfm_with_channel: DataFrame) -> DataFrame:
    return (
        rfm_with_channel.groupBy("acquisition_channel")
        .agg(
            F.count("customer_id").alias("n"),
            F.round(exact_sum("clv_12m"), 2).alias("total_clv"),
            F.round(exact_avg("clv_12m"), 2).alias("avg_clv"),
        )
        .orderBy(F.desc("total_clv"), "acquisition_channel")
    )


def segment_region_pivot(rfm_with_region: DataFrame, regions: list[str]) -> DataFrame:
    """Average monetary per segment and region, zero where there is nobody; regions are given, so no extra job."""
    means = [
        F.coalesce(F.round(exact_avg(F.when(F.col("region") == r, F.col("monetary"))), 2), F.lit(0.0)).alias(r)
        for r in regions
    ]
    return rfm_with_region.groupBy("segment").agg(*means)


FIVE_NUMBERS = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}


def distribution_by_segment(rfm: DataFrame, value: str, approximate: bool = False) -> DataFrame:
    """Five-number summary per segment; exact by default, ``approximate`` trades accuracy for one aggregation."""
    if approximate:
        names = list(FIVE_NUMBERS)
        picked = F.approx_percentile(value, F.array(*[F.lit(p) for p in FIVE_NUMBERS.values()]), 10_000)
        return (
            rfm.groupBy("segment")
            .agg(picked.alias("_p"))
            .select("segment", *[F.col("_p")[i].cast("double").alias(n) for i, n in enumerate(names)])
        )
    return grouped_percentiles(rfm.select("segment", value), ["segment"], value, FIVE_NUMBERS)


def clv_concentration(rfm: DataFrame) -> DataFrame:
    """Lorenz curve: share of value held by the top share of customers, one row per customer."""
    amounts = rfm.select("customer_id", F.col("clv_12m").cast("decimal(18,4)").alias("_clv"))
    ordered = with_global_order(amounts, [F.desc("_clv"), "customer_id"], sums={"_cum": "_clv"})
    totals = ordered.agg(F.sum("_clv").alias("_total"), F.count(F.lit(1)).alias("_n"))
    return attach_row(ordered, totals).select(
        "customer_id",
        F.round(F.col("_cum").cast("double") / F.nullif(F.col("_total").cast("double"), F.lit(0.0)) * 100, 6).alias(
            "cum_revenue_pct"
        ),
        F.round(F.col("rank") / F.col("_n") * 100, 6).alias("cum_customer_pct"),
    )
