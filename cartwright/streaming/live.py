"""Streaming aggregations. Each function takes a streaming or a batch DataFrame and means the same on both."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WATERMARK = "10 minutes"


def with_event_time(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Event time as an instant; watermarks do not accept zone-less timestamps."""
    return events.withColumn(ts, F.col(ts).cast("timestamp"))


def minute_metrics(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Transactions, revenue and average value per minute."""
    return (
        events.withWatermark("ts", watermark)
        .groupBy(F.window("ts", "1 minute").alias("w"))
        .agg(F.count(F.lit(1)).alias("transactions"), F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("revenue"))
        .select(
            F.col("w.start").alias("minute"),
            "transactions",
            "revenue",
            (F.col("revenue") / F.col("transactions")).alias("avg_order_value"),
        )
    )


def unique_customers(events: DataFrame, watermark: str = WATERMARK, relative_error: float = 0.02) -> DataFrame:
    """Approximate distinct customers in five-minute windows sliding by one minute (a sketch of fixed size per window)."""
    return (
        events.withWatermark("ts", watermark)
        .groupBy(F.window("ts", "5 minutes", "1 minute").alias("w"))
        .agg(F.approx_count_distinct("user_id", relative_error).alias("unique_customers"))
        .select(F.col("w.start").alias("window_start"), "unique_customers")
    )


def minute_sketches(events: DataFrame, watermark: str = WATERMARK, log_size: int = 12) -> DataFrame:
    """One mergeable sketch of the customers of each minute: state and rows of fixed size, and every event read once.

    The sketch has 2 ** ``log_size`` registers: a relative standard error of 1.04 / sqrt(2 ** log_size), 1.6 % for 12.
    """
    return (
        events.withWatermark("ts", watermark)
        .groupBy(F.window("ts", "1 minute").alias("w"))
        .agg(F.hll_sketch_agg("user_id", log_size).alias("customers"))
        .select(F.col("w.start").alias("minute"), "customers")
    )


def sliding_unique_customers(minutes: DataFrame, width: int = 5) -> DataFrame:
    """Distinct customers in windows of ``width`` minutes sliding by one, from the table of :func:`minute_sketches`.

    Sketches, not events, are copied into the windows they belong to.
    """
    starts = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda k: F.make_dt_interval(mins=-k))
    return (
        minutes.select("customers", "minute", F.explode(starts).alias("back"))
        .groupBy((F.col("minute") + F.col("back")).alias("window_start"))
        .agg(F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("unique_customers"))
    )


def breakdown(events: DataFrame, dimension: str, window: str = "1 hour", watermark: str = WATERMARK) -> DataFrame:
    """Count and revenue per window and category, device or region."""
    return (
        events.withWatermark("ts", watermark)
        .groupBy(F.window("ts", window).alias("w"), dimension)
        .agg(F.count(F.lit(1)).alias("transactions"), F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("revenue"))
        .select(F.col("w.start").alias("window_start"), dimension, "transactions", "revenue")
    )


def sessions(events: DataFrame, gap: str = "30 minutes", watermark: str = WATERMARK) -> DataFrame:
    """Customer sessions closed after ``gap`` without an event.

    For streams, where sessions are merged inside each input partition first (as ``build_session`` sets it), so that a customer with
    most events reaches the final merge as sessions. A batch has no such setting: use :func:`batch_sessions` there. Start and end
    are aggregates rather than fields of the window key: the optimizer would push a filter on the key below the merge, onto single events.
    """
    return (
        events.withWatermark("ts", watermark)
        .groupBy("user_id", F.session_window("ts", gap).alias("s"))
        .agg(
            F.min("ts").alias("session_start"),
            (F.max("ts") + F.expr(f"INTERVAL {gap}")).alias("session_end"),
            F.count(F.lit(1)).alias("events"),
            F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("value"),
        )
        .select("user_id", "session_start", "session_end", "events", "value")
    )


def batch_sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """The sessions of :func:`sessions` over a table, however many events one customer has.

    Time is cut into slices as long as the gap. All events of a customer in a slice belong to one session, so they fold to one
    partial session (first, last, count, value) by ordinary aggregation, before the shuffle. Only partial sessions then meet in the
    customer's order: their number is bounded by the slices of the calendar, not by the customer's events. A new session starts
    where a slice's first event comes ``gap`` or more after the last event before it.

    Events without a time belong to no session; those without a customer share one. Value is null where all values are.
    """
    zero = F.lit("1970-01-01").cast("timestamp")
    length = F.unix_micros(zero + F.expr(f"INTERVAL {gap}")) - F.unix_micros(zero)
    partial = (
        events.filter(F.col("ts").isNotNull())
        .groupBy("user_id", F.floor(F.unix_micros("ts") / length).alias("slice"))
        .agg(
            F.min("ts").alias("first"),
            F.max("ts").alias("last"),
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("value").cast("decimal(18,4)")).alias("total"),
        )
    )
    order = Window.partitionBy("user_id").orderBy("slice")
    quiet = F.unix_micros("first") - F.unix_micros(F.lag("last").over(order)) >= length
    numbered = partial.withColumn("fresh", F.coalesce(quiet, F.lit(True)).cast("long"))
    numbered = numbered.withColumn("number", F.sum("fresh").over(order))
    return (
        numbered.groupBy("user_id", "number")
        .agg(
            F.min("first").alias("session_start"),
            (F.max("last") + F.expr(f"INTERVAL {gap}")).alias("session_end"),
            F.sum("n").alias("events"),
            F.sum("total").cast("double").alias("value"),
        )
        .select("user_id", "session_start", "session_end", "events", "value")
    )


def deduplicated(events: DataFrame, key: str = "event_id", watermark: str = WATERMARK) -> DataFrame:
    """First arrival per event id within the watermark; state older than it is dropped."""
    return events.withWatermark("ts", watermark).dropDuplicatesWithinWatermark([key])


def running_rfm(events: DataFrame) -> DataFrame:
    """Last purchase, purchase count and spend per customer; run in update mode, it emits changed customers."""
    return events.groupBy("user_id").agg(
        F.max("ts").alias("last_purchase"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("monetary"),
    )


def running_arms(events: DataFrame) -> DataFrame:
    """Beta posterior counts per experiment arm; run in update mode."""
    return events.groupBy("experiment_name", "variant").agg(
        (1 + F.count(F.when(F.col("converted"), 1))).alias("alpha"),
        (1 + F.count(F.when(~F.col("converted"), 1))).alias("beta"),
    )
