"""Recency / frequency / monetary features, quintile scores and segment tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.functions import attach_row, elapsed_days, exact_avg, exact_sum, ratio
from cartwright.operators.ordering import rows_at_ranks
from cartwright.operators.segments import SHORT_LABELS, projected_clv, segment_by_scores
from cartwright.session import materialise
from cartwright.sources.contracts import resolve_aliases

QUINTILES = 5


def rfm_base(transactions: DataFrame, snapshot: str) -> DataFrame:
    """One row per customer from positive-amount lines.

    Lines fold to (customer, order) first, then to the customer, so orders are counted exactly by plain hash aggregates and
    a customer holding most lines is spread over tasks by order. Categories are a second, two-column pass; both results are
    already partitioned by customer when they meet.
    """
    txn = resolve_aliases(transactions).filter(F.col("revenue") > 0).dropna(subset=["customer_id"])
    at = F.lit(snapshot).cast("timestamp")
    orders = txn.groupBy("customer_id", "order_id").agg(
        F.max("transaction_date").alias("last_purchase"),
        F.min("transaction_date").alias("first_purchase"),
        F.sum(F.col("revenue").cast("decimal(18,4)")).alias("amount"),
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.col("quantity").cast("decimal(18,4)")).alias("items"),
    )
    customers = orders.groupBy("customer_id").agg(
        F.max("last_purchase").alias("last_purchase"),
        F.min("first_purchase").alias("first_purchase"),
        F.count("order_id").alias("frequency"),
        F.sum("amount").cast("double").alias("monetary"),
        (F.sum("amount").cast("double") / F.sum("lines")).alias("avg_order_value"),
        F.sum("items").cast("double").alias("total_items"),
    )
    categories = (
        txn.select("customer_id", "category")
        .distinct()
        .groupBy("customer_id")
        .agg(F.count("category").cast("int").alias("distinct_categories"))
    )
    base = customers.join(categories, "customer_id")
    base = base.withColumns(
        {
            "recency": elapsed_days(at, "last_purchase"),
            "customer_age_days": elapsed_days(at, "first_purchase"),
        }
    )
    return base.withColumns(
        {
            "purchase_rate": F.col("frequency") / F.greatest(F.col("customer_age_days") / 30, F.lit(1.0)),
            "avg_items_per_order": F.col("total_items") / F.col("frequency"),
            "log_recency": F.log1p("recency"),
            "log_frequency": F.log1p("frequency"),
            "log_monetary": F.log1p("monetary"),
        }
    )


def equal_count_scores(df: DataFrame, scores: dict[str, str], key: str, bins: int = QUINTILES) -> DataFrame:
    """Add ``{score column: value column}``: equal-count bins 1..bins of the rank over (value, key).

    All values are ranked in one layout, metric after metric. Only the ``bins - 1`` boundary rows per score reach the
    driver; scoring the table is then a projection without a shuffle. ``df`` is read several times: pass a written one.
    """
    n = df.count()
    if n == 0:
        return df.withColumns({name: F.lit(None).cast("int") for name in scores})
    values = list(scores.values())
    stacked = df.select(
        key,
        F.posexplode(F.array(*[F.col(v).cast("double") for v in values])).alias("metric", "value"),
    )
    cuts = [1 + j * (n - 1) // bins for j in range(1, bins)]
    at = rows_at_ranks(stacked, ["metric", "value", key], [m * n + c for m in range(len(values)) for c in cuts])
    out = {}
    for m, (name, value) in enumerate(scores.items()):
        score = F.lit(1)
        for c in cuts:
            row = at[m * n + c]
            x, k = F.col(value).cast("double"), F.col(key)
            beyond = (x > F.lit(row["value"])) | ((x == F.lit(row["value"])) & (k > F.lit(row[key])))
            score = score + beyond.cast("int")
        out[name] = score
    return df.withColumns(out)


def ntile_descending(df: DataFrame, value: str, key: str, tiles: int, name: str) -> DataFrame:
    """SQL ``NTILE`` over (value desc, key): the first ``n % tiles`` tiles hold one row more."""
    n = df.count()
    base, extra = divmod(n, tiles)
    last_ranks = [t * base + min(t, extra) for t in range(1, tiles)]
    at = rows_at_ranks(df.select(value, key), [F.col(value).desc(), F.col(key)], [r for r in last_ranks if r > 0])
    tile = F.lit(1)
    for rank in last_ranks:
        if rank == 0 or rank >= n:
            continue
        v, k = F.lit(at[rank][value]), F.lit(at[rank][key])
        tile = tile + ((F.col(value) < v) | ((F.col(value) == v) & (F.col(key) > k))).cast("int")
    return df.withColumn(name, tile.cast("long"))


def recency_score(df: DataFrame, bins: int = QUINTILES) -> DataFrame:
    """Reversed quintile of recency by value, right-closed edges. Days have few distinct values, so the percentile
    buffer stays small; the edges are one row."""
    probs = F.array(*[F.lit(j / bins) for j in range(1, bins)])
    edges = df.agg(F.percentile("recency", probs).alias("_edges"))
    above = [(F.col("recency") > F.col("_edges")[j]).cast("int") for j in range(bins - 1)]
    score = F.lit(bins)
    for flag in above:
        score = score - flag
    return attach_row(df, edges).withColumn("R_score", score).drop("_edges")


def rfm_scored(transactions: DataFrame, snapshot: str) -> DataFrame:
    """Features, scores (composite is the mean score), long segment labels and the value proxy."""
    base = materialise(rfm_base(transactions, snapshot), "rfm")
    scored = equal_count_scores(
        recency_score(base), {"F_score": "frequency", "M_score": "monetary"}, key="customer_id"
    )
    r, f, m = F.col("R_score"), F.col("F_score"), F.col("M_score")
    return scored.withColumns(
        {
            "RFM_score": r * 100 + f * 10 + m,
            "RFM_composite": (r + f + m) / 3,
            "segment": segment_by_scores(r, f),
            "clv_12m": projected_clv(F.col("monetary"), F.col("customer_age_days")),
        }
    )


def rfm_gold(customers: DataFrame, transactions: DataFrame, snapshot: str) -> DataFrame:
    """Medallion variant: frequency counts rows, recency is ranked like the others, composite is the score sum."""
    txn = resolve_aliases(transactions).dropna(subset=["customer_id"])
    at = F.lit(snapshot).cast("timestamp")
    base = txn.groupBy("customer_id").agg(
        F.max("transaction_date").alias("last_purchase"),
        F.count(F.lit(1)).alias("frequency"),
        exact_sum("revenue").alias("monetary"),
        exact_avg("revenue").alias("avg_order_value"),
    )
    base = materialise(base.withColumn("recency", elapsed_days(at, "last_purchase")), "rfm-gold")
    scored = equal_count_scores(
        base, {"_r": "recency", "F_score": "frequency", "M_score": "monetary"}, key="customer_id"
    ).withColumn("R_score", QUINTILES + 1 - F.col("_r"))
    r, f, m = F.col("R_score"), F.col("F_score"), F.col("M_score")
    wanted = [c for c in ("acquisition_channel", "country", "region", "registration_date") if c in customers.columns]
    return (
        scored.drop("_r")
        .withColumns(
            {
                "RFM_score": r * 100 + f * 10 + m,
                "RFM_composite": r + f + m,
                "segment": segment_by_scores(r, f, SHORT_LABELS),
            }
        )
        .join(customers.select("customer_id", *wanted), "customer_id", "left")
    )


def with_customer_columns(rfm: DataFrame, customers: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Left join of whichever of the wanted customer columns exist."""
    present = [c for c in wanted if c in customers.columns]
    return rfm.join(customers.select("customer_id", *present), "customer_id", "left")


def segment_profiles(rfm: DataFrame) -> DataFrame:
    def mean(c: str) -> Column:
        return F.round(exact_avg(c), 2)

    return rfm.groupBy("segment").agg(
        F.count("customer_id").alias("n_customers"),
        mean("recency").alias("avg_recency"),
        mean("frequency").alias("avg_frequency"),
        mean("monetary").alias("avg_monetary"),
        mean("avg_order_value").alias("avg_aov"),
        mean("RFM_composite").alias("avg_rfm_score"),
    )


def segment_distribution(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy("segment").agg(
        F.count("customer_id").alias("n"),
        exact_avg("monetary").alias("avg_monetary"),
        exact_avg("recency").alias("avg_recency"),
        exact_avg("clv_12m").alias("avg_clv"),
    )


def minmax_profiles(profiles: DataFrame, columns: Sequence[str], inverted: Sequence[str] = ("avg_recency",)) -> DataFrame:
    """Scale profile columns to 0..1 over the (few) segments; inverted columns count down."""
    spans = profiles.agg(
        *[F.min(c).alias(f"_lo_{c}") for c in columns], *[F.max(c).alias(f"_hi_{c}") for c in columns]
    )
    scaled = {}
    for c in columns:
        lo, hi = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
        unit = F.coalesce(ratio(F.col(c) - lo, hi - lo), F.lit(0.0))
        scaled[c] = 1 - unit if c in inverted else unit
    return attach_row(profiles, spans).select(
        "segment", *[F.round(expr, 6).alias(c) for c, expr in scaled.items()]
    )
