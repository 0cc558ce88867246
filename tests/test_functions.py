"""Distribution functions against published values, scalar helpers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwright.functions import elapsed_days, norm_cdf, surrogate_key, two_sided_p
from cartwright.functions import tails
from cartwright.operators.segments import register_sql_functions, segment_by_scores, with_segment_metrics


def test_norm_cdf(spark):
    zs = [-9.0, -3.2, -1.96, -0.5, 0.0, 0.3, 1.0, 2.575829, 7.5, 40.0]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    for r in df.select("z", norm_cdf(F.col("z")).alias("p"), two_sided_p(F.col("z")).alias("q")).collect():
        assert r["p"] == pytest.approx(0.5 * math.erfc(-r["z"] / math.sqrt(2)), rel=1e-10, abs=1e-15)
        assert r["q"] == pytest.approx(math.erfc(abs(r["z"]) / math.sqrt(2)), rel=1e-6, abs=1e-15)


def test_published_tails():
    assert tails.t_two_sided(2.228, 10) == pytest.approx(0.05, abs=1e-4)
    assert tails.t_two_sided(12.706, 1) == pytest.approx(0.05, abs=1e-5)
    assert tails.t_quantile(0.975, 30) == pytest.approx(2.0423, abs=1e-4)
    assert tails.gamma_q(0.5, 3.841 / 2) == pytest.approx(0.05, abs=1e-4)
    assert tails.gamma_q(2.5, 11.070 / 2) == pytest.approx(0.05, abs=1e-4)
    # Two-sample t test, d = 0.5: 64 per arm gives 80 % power.
    assert tails.noncentral_t_power(0.5, 64, 0.05) == pytest.approx(0.8015, abs=2e-4)


def test_tail_columns(spark):
    df = spark.createDataFrame([(2.228, 10.0), (None, 10.0)], "t double, d double")
    p = [r[0] for r in df.select(tails.t_p_value(F.col("t"), F.col("d"))).collect()]
    assert p[0] == pytest.approx(0.05, abs=1e-4) and p[1] is None
    n = df.limit(1).select(tails.t_test_sample_size(F.lit(0.5), 0.05, 0.8)).first()[0]
    assert n == 64


def test_elapsed_days_counts_full_periods(spark):
    row = spark.sql("SELECT timestamp'2024-12-31 13:00:00' AS a, timestamp'2025-01-01 00:00:00' AS b")
    assert row.select(elapsed_days("b", "a")).first()[0] == 0


def test_surrogate_key_takes_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, "x")], "a int, b string")
    keys = [r[0] for r in df.select(surrogate_key("a", "b")).collect()]
    assert len(set(keys)) == 2 and all(len(k) == 32 for k in keys)


def test_segment_rules_agree_with_sql_function(spark):
    register_sql_functions(spark)
    grid = spark.range(25).select((F.col("id") % 5 + 1).cast("int").alias("r"), (F.floor(F.col("id") / 5) + 1).cast("int").alias("f"))
    both = grid.select(segment_by_scores(F.col("r"), F.col("f")).alias("a"), F.expr("assign_rfm_segment(r, f, 1)").alias("b"))
    assert both.filter("a <> b").count() == 0
    assert both.filter("a = 'Lost'").count() == 0


def test_unknown_segment_gets_defaults(spark):
    got = with_segment_metrics(spark.createDataFrame([("Nobody",)], "segment string")).first()
    assert (got["multiplier"], got["priority"]) == (0.7, 3)
