"""Rule-based customer segments and the scalar business formulas that go with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Segment, CLV multiplier, priority; and the pair for a segment outside the list.
SEGMENT_METRICS = [
    ("Champions", 1.5, 1),
    ("Loyal Customers", 1.2, 2),
    ("Potential Loyalists", 1.0, 3),
    ("At Risk", 0.5, 4),
    ("Hibernating", 0.3, 5),
    ("Lost", 0.1, 6),
    ("Regular", 0.7, 3),
]
DEFAULT_METRICS = (0.7, 3)

# The two label vocabularies for the same score rules.
LONG_LABELS = ("Champions", "Loyal Customers", "Potential Loyalists", "At Risk", "Hibernating", "Lost", "Regular")
SHORT_LABELS = ("Champions", "Loyal", "Potential Loyalist", "At Risk", "Hibernating", None, "Regular")


def segment_by_scores(r: Column, f: Column, labels: tuple = LONG_LABELS) -> Column:
    """Segment from recency and frequency scores. Both of the at-risk and hibernating rules come before the rule for
    lost customers, so that label never appears with scores in 1..5."""
    top, loyal, potential, risk, cold, lost, rest = labels
    chain = (
        F.when((r >= 4) & (f >= 4), top)
        .when((r >= 3) & (f >= 3), loyal)
        .when((r >= 4) & (f <= 2), potential)
        .when((r <= 2) & (f >= 3), risk)
        .when((r <= 2) & (f <= 2), cold)
    )
    if lost:
        chain = chain.when(r == 1, lost)
    return chain.otherwise(rest)


def segment_metrics(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SEGMENT_METRICS, "segment string, multiplier double, priority int")


def with_segment_metrics(df: DataFrame) -> DataFrame:
    """Multiplier and priority per segment from the seven-row table, defaults for other segments."""
    multiplier, priority = DEFAULT_METRICS
    return df.join(F.broadcast(segment_metrics(df.sparkSession)), "segment", "left").fillna(
        {"multiplier": multiplier, "priority": priority}
    )


def recency_days(last_purchase: Column, snapshot: Column) -> Column:
    """Calendar days, as the SQL macro counts them."""
    return F.date_diff(snapshot, last_purchase)


def simple_clv(aov: Column, frequency: Column, margin: Column, retention_months: Column) -> Column:
    return aov * frequency * margin * (retention_months / 12.0)


def projected_clv(monetary: Column, age_days: Column) -> Column:
    """Twelve-month value proxy: daily spend over at least 30 days, a year ahead, kept at 85 %."""
    return F.round(monetary / F.greatest(age_days, F.lit(30)) * 365 * 0.85, 2)


def register_sql_functions(spark: SparkSession) -> None:
    """The same formulas as SQL functions for use in ``spark.sql``."""
    statements = (
        "CREATE OR REPLACE TEMPORARY FUNCTION calculate_recency(last_purchase DATE, snapshot DATE) RETURNS INT"
        " RETURN datediff(snapshot, last_purchase)",
        "CREATE OR REPLACE TEMPORARY FUNCTION calculate_clv(aov DOUBLE, frequency DOUBLE, margin DOUBLE,"
        " retention_months DOUBLE) RETURNS DOUBLE RETURN aov * frequency * margin * (retention_months / 12D)",
        "CREATE OR REPLACE TEMPORARY FUNCTION assign_rfm_segment(r INT, f INT, m INT) RETURNS STRING RETURN CASE"
        " WHEN r >= 4 AND f >= 4 THEN 'Champions' WHEN r >= 3 AND f >= 3 THEN 'Loyal Customers'"
        " WHEN r >= 4 AND f <= 2 THEN 'Potential Loyalists' WHEN r <= 2 AND f >= 3 THEN 'At Risk'"
        " WHEN r <= 2 AND f <= 2 THEN 'Hibernating' WHEN r = 1 THEN 'Lost' ELSE 'Regular' END",
    )
    for statement in statements:
        spark.sql(statement)
