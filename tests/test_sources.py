"""Readers, sinks, contracts and the batch flow."""

import glob
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwright.operators import cleaning
from cartwright.plans import medallion
from cartwright.session import materialise, release, scratch_root
from cartwright.sources import contracts, readers, sinks, testtables

SF = "/root/testdata/sf0.001"


def test_csv_fallback_and_missing(spark, tmp_path):
    schema = contracts.SEGMENT_PROFILES
    df = spark.createDataFrame([("a", 1, 1.0, 1.0, 1.0, 1.0, 1.0)], schema)
    sinks.write_csv(df, str(tmp_path / "t.csv"))
    got = readers.read_with_fallback(spark, str(tmp_path / "none"), str(tmp_path / "t.csv"), schema)
    assert got.collect() == df.collect()
    assert readers.read_with_fallback(spark, str(tmp_path / "x"), str(tmp_path / "y"), schema).count() == 0


def test_sinks_round_trip(spark, tmp_path):
    txn = testtables.transactions(spark, SF)
    sinks.write_facts(txn, str(tmp_path / "facts"))
    back = spark.read.parquet(str(tmp_path / "facts"))
    assert back.count() == txn.count() and "month" in back.columns
    plan = back.filter("month = '1998-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    sinks.write_json(txn.limit(3), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 3


def test_tables_and_views(spark, tmp_path):
    df = testtables.transactions(spark, SF).limit(50)
    spark.sql("CREATE DATABASE IF NOT EXISTS shop LOCATION '%s'" % (tmp_path / "shop"))
    sinks.save_table(df, "shop.txn")
    assert readers.read_table(spark, "shop.txn").count() == 50
    assert dict(readers.read_table(spark, "shop.txn").dtypes)["transaction_date"] == "date"
    sinks.save_table(df, "shop.txn", "append")
    assert readers.read_table(spark, "shop.txn").count() == 100
    sinks.save_bucketed(df, "shop.txn_b", "customer_id", 4)
    plan = spark.table("shop.txn_b").groupBy("customer_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
    found = readers.register_views(spark, {"lines": f"{SF}/lineitem.parquet", "nothing": f"{SF}/nothing.parquet"})
    assert found == {"lines": True, "nothing": False} and spark.table("lines").count() > 0
    spark.sql("DROP DATABASE shop CASCADE")


def test_contract_and_aliases(spark):
    raw = spark.createDataFrame([("5", 1.5, "2024-01-01 10:00:00")], "transaction_id string, total_amount double, order_date string")
    named = contracts.resolve_aliases(raw)
    assert named.columns == ["order_id", "revenue", "transaction_date"]
    typed = contracts.conform(named, contracts.TRANSACTIONS)
    assert typed.schema == contracts.TRANSACTIONS and typed.first()["order_id"] == 5
    both = contracts.resolve_aliases(raw.withColumn("order_id", F.lit(9)))
    assert both.first()["order_id"] == 9 and contracts.line_key(both.columns) == ["transaction_id"]
    assert contracts.line_key(["order_id", "line_number", "x"]) == ["order_id", "line_number"] and contracts.line_key(["order_id"]) == ["order_id"]


def test_every_distinct_line_stays(spark):
    rows = [(1, 1, "2020-01-01", 5.0), (1, 2, "2020-01-01", 6.0), (1, 2, "2020-01-01", 6.0), (2, 1, "2020-01-03", -1.0)]
    raw = spark.createDataFrame(rows, "order_id long, line_number int, transaction_date string, revenue double")
    got = cleaning.clean_transactions(raw, "2025-01-01", contracts.line_key(raw.columns)).collect()
    assert sorted((r["order_id"], r["line_number"]) for r in got) == [(1, 1), (1, 2)]


def test_materialised_table_is_shared_and_released(spark):
    df = materialise(spark.range(10).withColumn("x", F.rand()))
    assert df.collect() == df.collect()
    assert scratch_root(spark) and release(spark) >= 1


def test_batch_flow(spark, tmp_path):
    customers = testtables.customers(spark, SF).withColumn("registration_date", F.lit("2020-01-01").cast("date"))
    raw = testtables.transactions(spark, SF, with_category=True).withColumnsRenamed(
        {"revenue": "total_amount", "transaction_date": "order_date"}
    )
    raw = raw.withColumn("transaction_id", F.concat_ws("-", "order_id", "line_number")).drop("order_id")
    result = medallion.run(
        spark, customers.unionByName(customers), testtables.products(spark, SF), raw, str(tmp_path), testtables.SNAPSHOT
    )
    assert result.counts["customers"] == customers.count()
    assert 0 < result.counts["transactions"] < raw.count()
    assert any("duplicate" in i for i in result.issues["customers"])
    assert any("non-positive" in i for i in result.issues["transactions"])
    medallion.views(spark, str(tmp_path))
    assert spark.sql("SELECT count(DISTINCT order_id) FROM transactions").first()[0] == result.counts["transactions"]
    assert spark.sql("SELECT min(revenue) FROM transactions").first()[0] > 0
    segments = {r["segment"] for r in spark.table("segment_profiles").collect()}
    assert len(segments) == result.counts["segments"] and "Champions" in segments


def test_missing_checkpoint_folder_is_refused_on_a_cluster(spark, monkeypatch):
    import types

    fake = types.SimpleNamespace(
        conf=types.SimpleNamespace(get=lambda *a: None), sparkContext=types.SimpleNamespace(master="yarn", applicationId="a")
    )
    with pytest.raises(ValueError):
        scratch_root(fake)


def test_report_views_answer_sql(spark):
    from cartwright.operators.rfm import rfm_scored
    from cartwright.plans import report_views

    customers, lines = testtables.customers(spark, SF), testtables.transactions(spark, SF)
    rfm = materialise(rfm_scored(testtables.transactions(spark, SF, with_category=True), testtables.SNAPSHOT), "scored")
    names = report_views.register_revenue_views(customers, lines, rfm)
    assert names == ["vw_segment_revenue", "vw_monthly_revenue", "vw_segment_summary", "vw_revenue_by_channel", "vw_daily_revenue"]
    assert spark.sql("SELECT sum(n_customers) FROM vw_segment_summary").first()[0] == rfm.count()
    assert spark.sql("SELECT sum(n_customers) FROM vw_revenue_by_channel").first()[0] == rfm.count()
    assert spark.sql("SELECT sum(n_orders) FROM vw_daily_revenue").first()[0] == lines.count()
    report_views.register_revenue_views(customers.limit(0), lines.limit(0), rfm.limit(0))
    assert all(spark.table(name).count() == 0 for name in names)
    kind = """experiment_name string, description string, metric_type string, n_control long, n_treatment long, control_mean double,
      treatment_mean double, relative_lift double, p_value_ttest double, p_value_adjusted double, observed_power double,
      is_significant boolean, recommendation string"""
    row = ("e", "d", "proportion", 5, 6, 0.1234567, 0.2, 0.61999, 0.01, 0.02, 0.8, True, "ship")
    assert report_views.register_trial_view(spark.createDataFrame([row], kind)) == "vw_ab_dashboard"
    assert spark.sql("SELECT control_mean, p_value_fdr FROM vw_ab_dashboard").first() == (0.123457, 0.02)


def test_keyed_table_replays_prunes_buckets_and_bounds_its_files(spark, tmp_path):
    import glob
    import os

    from cartwright.sources import keyed

    path, schema = str(tmp_path / "gold"), "k long, name string, v double"
    want = {}
    rng = np.random.default_rng(3)
    for version in range(6):
        rows = {int(k): (f"n{version}", float(version)) for k in rng.integers(0, 40, 12)}
        rows[None] = ("null key", float(version))
        batch = spark.createDataFrame([(k, *v) for k, v in rows.items()], schema)
        assert keyed.merge(batch, path, ["k"], version, buckets=4)
        want |= rows
        got = keyed.current(spark, path, batch.schema).collect()
        assert len(got) == len(want) and {r["k"]: (r["name"], r["v"]) for r in got} == want
        # The same version again, or an older one, changes nothing.
        other = spark.createDataFrame([(1, "wrong", -1.0)], schema)
        assert not keyed.merge(other, path, ["k"], version, buckets=4)
        assert {r["k"]: (r["name"], r["v"]) for r in keyed.current(spark, path, batch.schema).collect()} == want
        assert len(glob.glob(f"{path}/data/*/_bucket=*")) <= 8 and len(keyed.commits(spark, path)) <= 2

    # A batch of one key writes one bucket.
    one = spark.createDataFrame([(7, "x", 0.5)], schema)
    before = {r["k"] for r in keyed.current(spark, path, one.schema).collect()}
    keyed.merge(one, path, ["k"], 6, buckets=4)
    assert len(glob.glob(f"{path}/data/6/_bucket=*")) == 1
    assert {r["k"] for r in keyed.current(spark, path, one.schema).collect()} == before | {7}

    # Data without its marker is not seen, and is replaced when the version is merged again.
    os.remove(f"{path}/commits/6/_SUCCESS")
    assert {r["k"]: r["name"] for r in keyed.current(spark, path, one.schema).collect()} == {k: v[0] for k, v in want.items()}
    assert keyed.merge(spark.createDataFrame([(7, "y", 0.5)], schema), path, ["k"], 6, buckets=4)
    assert keyed.current(spark, path, one.schema).filter("k = 7").first()["name"] == "y"


def test_keyed_table_edges(spark, tmp_path):
    from cartwright.sources import keyed

    path, schema = str(tmp_path / "edges"), "k long, v double"
    empty = spark.createDataFrame([], schema)
    assert keyed.current(spark, path, empty.schema).count() == 0
    assert keyed.merge(empty, path, ["k"], 0) and keyed.current(spark, path, empty.schema).count() == 0
    repeated = spark.createDataFrame([(1, 2.0), (1, 5.0), (1, None), (2, None)], schema)
    keyed.merge(repeated, path, ["k"], 1)
    assert sorted((r["k"], r["v"]) for r in keyed.current(spark, path, empty.schema).collect()) == [(1, 5.0), (2, None)]
    keyed.merge(spark.createDataFrame([(1, None)], schema), path, ["k"], 2)  # the newer version wins, null or not
    assert keyed.current(spark, path, empty.schema).filter("k = 1").first()["v"] is None
    with pytest.raises(ValueError):
        keyed.merge(spark.createDataFrame([(1, 2)], "k long, _bucket int"), path, ["k"], 3)


def test_written_intermediates_leave_no_shuffle_files(spark):
    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    shuffles = lambda: {p for d in folders for p in glob.glob(f"{d}/*/shuffle_*.data")}
    before = shuffles()
    out = materialise(spark.range(20_000).groupBy((F.col("id") % 7_000).alias("k")).count(), "summed")
    until = time.time() + 20  # deleted in the background
    while shuffles() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffles() - before
    assert out.count() == 7_000 and out.agg(F.sum("count")).first()[0] == 20_000
