"""Cleaning, quality and segmentation scenarios."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cartwright.operators import cleaning, quality, rfm, scenarios
from cartwright.operators.revenue import cohort_retention, distribution_by_segment


def good_and_bad(spark):
    good = [("A", f"A{i}", pd.Timestamp("2024-12-01") - pd.Timedelta(days=10 * i), 500.0) for i in range(20)]
    bad = [("B", f"B{i}", pd.Timestamp("2023-01-01") - pd.Timedelta(days=30 * i), 25.0) for i in range(3)]
    pdf = pd.DataFrame(good + bad, columns=["customer_id", "order_id", "transaction_date", "revenue"])
    pdf["quantity"], pdf["category"] = 2, "Electronics"
    return spark.createDataFrame(pdf)


def test_good_customer_beats_bad_one(spark):
    rows = {r["customer_id"]: r for r in rfm.rfm_scored(good_and_bad(spark), "2025-01-01").collect()}
    a, b = rows["A"], rows["B"]
    assert a["recency"] == 31 and a["recency"] < b["recency"]
    assert a["frequency"] == 20 and a["monetary"] == 10000.0
    for score in ("R_score", "F_score", "M_score"):
        assert 1 <= b[score] <= a[score] <= 5
    assert a["clv_12m"] > b["clv_12m"] > 0


def test_one_purchase_per_customer_with_alias_columns(spark):
    rows = [(i, f"t{i}", f"2023-06-0{i}", 100.0 * i, 1, "x") for i in range(1, 6)]
    txn = spark.createDataFrame(
        rows, "customer_id long, transaction_id string, order_date string, total_amount double, quantity int, category string"
    ).withColumn("order_date", F.to_timestamp("order_date"))
    got = rfm.rfm_scored(txn, "2023-07-01").orderBy("customer_id").collect()
    assert [r["M_score"] for r in got] == [1, 2, 3, 4, 5]
    assert [r["R_score"] for r in got] == [1, 2, 3, 4, 5]
    assert all(r["frequency"] == 1 for r in got)


def test_duplicate_customers(spark):
    raw = spark.createDataFrame(
        [(1, "a@test.com", "USA"), (1, "A@TEST.COM ", "uk"), (2, "b@test.com", "Peru")],
        "customer_id long, email string, country string",
    )
    got = {r["customer_id"]: (r["email"], r["country"]) for r in cleaning.clean_customers(raw).collect()}
    assert len(got) == 2
    assert got[1][0] == "a@test.com" and got[1][1] in ("United States", "United Kingdom")
    assert got[2] == ("b@test.com", "Peru")


def test_future_and_negative_transactions_go(spark):
    raw = spark.createDataFrame(
        [("1", "2020-01-01", 100.0), ("2", "2030-01-01", 200.0), ("3", "2023-06-01", -50.0), ("1", "2021-01-01", 9.0)],
        "transaction_id string, order_date string, total_amount double",
    )
    got = cleaning.clean_transactions(raw, "2025-01-01", ["order_id"]).collect()
    assert [(r["order_id"], r["revenue"]) for r in got] == [("1", 100.0)]


def test_quality_rules(spark):
    df = spark.createDataFrame(
        [(1, "a", "Email"), (1, None, "Fax"), (None, "c", None)], "customer_id long, email string, acquisition_channel string"
    )
    checks = quality.check_table(df, quality.CUSTOMER_RULES)
    found = {(r["column"], r["check"]): r["failures"] for r in checks.collect()}
    assert found[("customer_id", "null values")] == 1
    assert found[("customer_id", "duplicate values")] == 1
    assert found[("acquisition_channel", "value not in list")] == 1
    assert found[("registration_date", "missing column")] == 1
    summary = quality.verdict(checks).first()
    assert summary["valid"] is False and len(summary["issues"]) == 5 and summary["n_records"] == 3


def test_hot_key_is_deduplicated_whole(spark):
    df = spark.range(3000).select((F.col("id") % 3 * (F.col("id") % 2)).alias("k"), F.col("id").alias("v"))
    got = {r["k"]: r["v"] for r in cleaning.keep_first(df, ["k"], ["v"]).collect()}
    assert got == {0: 0, 1: 1, 2: 5}


def test_a_task_sorts_rows_of_a_bounded_size_before_keys_fold(spark, capsys):
    """Whatever one task has joined or scanned is not what its aggregate sorts: rows are rebalanced, then fold."""
    rows = spark.range(6_000, numPartitions=1).select(
        (F.col("id") % 2 * F.col("id")).alias("k"), F.hash("id").alias("w"), F.col("id").alias("v")
    )
    first = cleaning.keep_first(rows, ["k"], ["v"])
    got = first.agg(F.count("k").alias("n"), F.sum(F.col("k") - F.col("v")).alias("off")).first()
    assert (got["n"], got["off"]) == (3_001, 0)
    first.explain()
    plan = capsys.readouterr().out
    spread = plan.index("REBALANCE_PARTITIONS_BY_COL")
    # Folded before and after the shuffle by key.
    assert plan.index("SortAggregate") < plan.index("ENSURE_REQUIREMENTS") < plan.rindex("SortAggregate") < spread



def test_cohorts_cross_years(spark):
    txn = spark.createDataFrame(
        [(1, "2022-11-05"), (1, "2024-01-09"), (2, "2022-11-20")], "customer_id long, d string"
    ).select("customer_id", F.to_timestamp("d").alias("transaction_date"))
    got = {r["months_since_cohort"]: r["retained_customers"] for r in cohort_retention(txn).collect()}
    assert got == {0: 2, 14: 1}
    wrapped = {r["months_since_cohort"]: r["retained_customers"] for r in cohort_retention(txn, wrap_years=True).collect()}
    assert wrapped == {0: 2, 2: 1}


def test_segment_conversion_lifts_value(spark):
    rows = [("Champions", 500.0)] * 50 + [("At Risk", 150.0)] * 50
    base = spark.createDataFrame(rows, "segment string, clv_12m double")
    asked = spark.createDataFrame([("At Risk", "Champions", 0.10)], "from_segment string, to_segment string, conversion_rate double")
    got = scenarios.segment_conversions(base, asked).first()
    assert got["clv_lift_per_customer"] == 350 and got["annual_revenue_impact"] == pytest.approx(1750)


def test_approximate_distribution_is_close(spark):
    df = spark.range(2000).select(F.lit("s").alias("segment"), F.col("id").cast("double").alias("clv_12m"))
    exact, near = distribution_by_segment(df, "clv_12m").first(), distribution_by_segment(df, "clv_12m", True).first()
    assert abs(exact["median"] - near["median"]) <= 2
