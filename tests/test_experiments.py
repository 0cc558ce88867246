"""Experiment statistics: known inputs, brute force and statistical properties."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cartwright.operators.experiments import classic, monitor, power, resample
from cartwright.operators.experiments.arms import arm_moments
from cartwright.operators.experiments.results import ab_results, ab_summary, advanced_report, scorecard
from cartwright.sources.testtables import experiment_config


def sessions(spark, name="checkout_redesign", n=1000, conv=(100, 120), means=(100, 105), seed=0):
    rng = np.random.default_rng(seed)
    frames = []
    for variant, hits, mean in zip(("control", "treatment"), conv, means):
        frames.append(
            pd.DataFrame(
                {
                    "experiment_name": name,
                    "variant": variant,
                    "converted": np.arange(n) < hits,
                    "revenue": rng.normal(mean, 15, n).round(2),
                    "pre_metric": rng.normal(50, 5, n).round(2),
                    "session_date": pd.to_datetime("2024-01-01").date(),
                }
            )
        )
    pdf = pd.concat(frames, ignore_index=True)
    pdf["session_id"] = np.arange(len(pdf))
    return pdf, spark.createDataFrame(pdf)


def proportions(spark, ct, nt, cc, nc):
    row = spark.createDataFrame([("e", nc, nt, cc, ct)], "experiment_name string, n_c long, n_t long, conv_c long, conv_t long")
    return classic.proportion_tests(row).first()


def test_proportion_significance(spark):
    assert proportions(spark, 600, 10000, 400, 10000)["p_value_ttest"] < 0.001
    assert proportions(spark, 51, 1000, 50, 1000)["p_value_ttest"] > 0.05
    r = proportions(spark, 120, 1000, 100, 1000)
    assert r["z_stat"] == pytest.approx(1.42933, abs=1e-4)
    assert r["chi2_stat"] == pytest.approx(1.8435, abs=1e-3)
    assert 0 < r["p_value_chi2"] < 1
    mirrored = proportions(spark, 100, 1000, 120, 1000)
    assert mirrored["cohens_h"] == pytest.approx(-r["cohens_h"])


def test_no_conversions_gives_null_not_error(spark):
    assert proportions(spark, 0, 10, 0, 10)["z_stat"] is None


def test_mann_whitney_against_pairs(spark):
    pdf, df = sessions(spark, n=60, seed=5)
    df = df.withColumn("revenue", F.round("revenue", -1))
    pdf["revenue"] = pdf["revenue"].round(-1)
    t = pdf.loc[pdf.variant == "treatment", "revenue"].to_numpy()
    c = pdf.loc[pdf.variant == "control", "revenue"].to_numpy()
    u = (t[:, None] > c).sum() + 0.5 * (t[:, None] == c).sum()
    got = classic.mann_whitney(df).first()
    assert got["mw_stat"] == pytest.approx(u)
    assert 0 < got["p_value_mannwhitney"] <= 1


def test_welch_detects_shift(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(
        {
            "experiment_name": "e",
            "variant": ["control"] * 1000 + ["treatment"] * 1000,
            "revenue": np.concatenate([rng.normal(10, 2, 1000), rng.normal(12, 2, 1000)]),
            "converted": True,
        }
    )
    got = classic.continuous_tests(arm_moments(spark.createDataFrame(pdf))).first()
    a, b = pdf.revenue[:1000], pdf.revenue[1000:]
    assert got["t_stat"] == pytest.approx((b.mean() - a.mean()) / math.sqrt(a.var() / 1000 + b.var() / 1000))
    assert got["t_stat"] > 10


def test_benjamini_hochberg(spark):
    p = [0.0001] * 5 + [0.048, 0.049, 0.047, 0.046, 0.045, None]
    df = spark.createDataFrame([(f"e{i:02d}", v) for i, v in enumerate(p)], "experiment_name string, p_value_ttest double")
    got = classic.adjust_p_values(df).orderBy("experiment_name").collect()
    adj = [r["p_value_adjusted"] for r in got]
    order = np.argsort(p[:10])
    raw = np.array(p[:10])[order] * 10 / np.arange(1, 11)
    want = np.empty(10)
    want[order] = np.minimum.accumulate(raw[::-1])[::-1]
    assert np.allclose(adj[:10], want)
    assert all(a < 0.05 for a in adj[:5]) and adj[10] is None
    assert all(a >= b for a, b in zip(adj[:10], p[:10]))


def test_power_and_sample_size(spark):
    df = spark.createDataFrame([(0.05,)], "b double")
    big, small = df.select(
        power.sample_size_for_proportion(F.col("b"), 0.20), power.sample_size_for_proportion(F.col("b"), 0.05)
    ).first()
    assert small > big > 0
    h = abs(2 * math.asin(math.sqrt(0.06)) - 2 * math.asin(math.sqrt(0.05)))
    reached = df.select(power.normal_power(F.lit(h), F.lit(float(big))), power.normal_power(F.lit(h), F.lit(float(big - 1)))).first()
    assert reached[0] >= 0.8 > reached[1]


def test_bootstrap_ignores_partitioning_and_covers(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": np.repeat(np.arange(60), 100), "x": rng.normal(50, 10, 6000)})
    pdf["id"] = np.arange(len(pdf))
    df = spark.createDataFrame(pdf)
    a = resample.bootstrap_mean_ci(df.repartition(3), ["g"], "x", 500).orderBy("g").toPandas()
    b = resample.bootstrap_mean_ci(df.repartition(11, "x"), ["g"], "x", 500).orderBy("g").toPandas()
    assert np.allclose(a, b)
    assert ((a.ci_lower < 50) & (50 < a.ci_upper)).mean() >= 0.85


def test_bootstrap_on_folded_values_has_the_bootstrap_variance(spark):
    """Two thirds of the rows share the value 0, the others have 40 values; null, not-a-number and a group of one row."""
    rng = np.random.default_rng(4)
    n = 9000
    x = np.where(rng.random(n) < 2 / 3, 0.0, rng.integers(1, 41, n).astype(float))
    rows = [("a", float(v)) for v in x] + [("a", None), ("a", float("nan")), ("b", 7.0), (None, 3.0), (None, 3.0)]
    got = {r["g"]: r for r in resample.bootstrap_mean_ci(spark.createDataFrame(rows, "g string, x double"), ["g"], "x", 4000).collect()}
    se = x.std() / math.sqrt(n)
    low, high = got["a"]["ci_lower"], got["a"]["ci_upper"]
    assert (high - low) / (2 * 1.959964) == pytest.approx(se, rel=0.05)
    assert (high + low) / 2 == pytest.approx(x.mean(), abs=0.15 * se)
    assert set(got) == {"a", "b", None} and got["b"]["ci_lower"] == got["b"]["ci_upper"] == 7.0 and got[None]["ci_upper"] == 3.0
    whole = resample.bootstrap_mean_ci(spark.createDataFrame(rows, "g string, x double"), [], "x", 200)
    assert whole.count() == 1
    assert resample.bootstrap_mean_ci(spark.createDataFrame([], "g string, x double"), ["g"], "x", 10).count() == 0


def test_bayes_separates_and_repeats(spark):
    counts = spark.createDataFrame([("e", 5000, 100, 5000, 200)], "experiment_name string, n_c long, conv_c long, n_t long, conv_t long")
    a = resample.bayes_two_arms(counts, 20_000).first()
    assert a["bayesian_prob_treatment_better"] > 0.99
    assert a == resample.bayes_two_arms(counts.repartition(5), 20_000).first()


def sequential_brute(c, t, alpha=0.05, beta=0.2, cap=10_000):
    for i in range(1, min(len(c), len(t)) + 1):
        a, b = c[:i], t[:i]
        var = (a.var() + b.var()) / 2
        llr = (b.mean() - a.mean()) / math.sqrt(2 * var / i) * math.sqrt(2 * i) if i >= 2 and var > 0 else 0.0
        if llr > math.sqrt(2 * i * math.log(1 / alpha)):
            return i, llr, "reject_null"
        if llr < -math.sqrt(2 * i * math.log(1 / beta)):
            return i, llr, "fail_to_reject"
        if 2 * i >= cap:
            return i, llr, "max_sample_reached"
    return i, llr, None


@pytest.mark.parametrize("shift,cap", [(0.0, 10_000), (12.0, 10_000), (-12.0, 10_000), (0.0, 150)])
def test_sequential_matches_loop(spark, shift, cap):
    pdf, df = sessions(spark, n=300, means=(100, 100 + shift), seed=9)
    c = pdf.loc[pdf.variant == "control", "revenue"].to_numpy()
    t = pdf.loc[pdf.variant == "treatment", "revenue"].to_numpy()
    i, llr, decision = sequential_brute(c, t, cap=cap)
    got = monitor.sequential_test(df, max_sample=cap).first()
    assert (got["n_control"], got["decision"]) == (i, decision)
    assert got["log_likelihood_ratio"] == pytest.approx(llr, abs=1e-6)
    assert 0 <= got["always_valid_pvalue"] <= 1


def test_srm(spark):
    rows = [("ok", "control")] * 500 + [("ok", "treatment")] * 500 + [("bad", "control")] * 300 + [("bad", "treatment")] * 700
    df = spark.createDataFrame(rows, "experiment_name string, variant string")
    got = {r["experiment_name"]: r for r in monitor.srm_chi_square(df).collect()}
    assert not got["ok"]["srm_detected"] and got["ok"]["p_value"] == pytest.approx(1.0)
    assert got["bad"]["srm_detected"] and got["bad"]["chi_square"] == pytest.approx(160)
    planned = spark.createDataFrame([("bad", "control", 3.0), ("bad", "treatment", 7.0)], "experiment_name string, variant string, weight double")
    assert not monitor.srm_chi_square(df, planned).first()["srm_detected"]


def test_cuped_reduces_variance(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(100, 20, 2000)
    pdf = pd.DataFrame({"experiment_name": "e", "variant": ["control", "treatment"] * 1000, "pre_metric": x})
    pdf["revenue"] = 0.8 * x + rng.normal(0, 5, 2000)
    got = monitor.cuped(spark.createDataFrame(pdf)).first()
    c = pdf[pdf.variant == "control"]
    theta = np.cov(c.revenue, c.pre_metric)[0, 1] / c.pre_metric.var()
    assert got["theta"] == pytest.approx(theta)
    adjusted = c.revenue - theta * (c.pre_metric - c.pre_metric.mean())
    assert got["variance_reduction"] == pytest.approx(1 - adjusted.var() / c.revenue.var())
    assert got["variance_reduction"] > 0.8


def test_full_run_has_every_field(spark):
    _, a = sessions(spark, "checkout_redesign", conv=(100, 180))
    _, b = sessions(spark, "free_shipping_threshold", seed=1)
    both = a.unionByName(b.withColumn("session_id", F.col("session_id") + 10_000))
    results = ab_results(both, experiment_config(spark), replicates=200, draws=5000)
    rows = {r["experiment_name"]: r for r in results.collect()}
    assert set(rows) == {"checkout_redesign", "free_shipping_threshold"}
    prop, cont = rows["checkout_redesign"], rows["free_shipping_threshold"]
    assert prop["recommendation"].startswith("SHIP") and prop["bayesian_prob_treatment_better"] > 0.99
    assert cont["ci_control_lower"] < cont["control_mean"] < cont["ci_control_upper"]
    assert cont["ci_lift_lower"] < cont["absolute_lift"] < cont["ci_lift_upper"]
    assert cont["p_value_mannwhitney"] < 0.001 and cont["required_sample_size"] > 0
    assert ab_summary(results).filter("decision = 'SHIP'").count() == 2 or prop["relative_lift"] > 0.05
    assert scorecard(results).first()["n_experiments"] == 2


def test_advanced_report_keys(spark):
    _, df = sessions(spark, n=100)
    got = advanced_report(df, covariate="pre_metric").first()
    assert got["basic_stats"]["p_value"] is not None and got["srm"]["srm_detected"] is False
    assert got["sequential"]["n_control"] >= 1 and got["cuped"]["adjusted_p_value"] is not None
    assert got["novelty"]["reason"] == "Insufficient data"


def test_type_one_error_and_wilson_coverage(spark):
    rng = np.random.default_rng(7)
    a, b = rng.normal(size=(500, 200)), rng.normal(size=(500, 200))
    rows = [(f"e{i}", 200, 200, 0, 0, float(x.mean()), float(y.mean()), float(x.var(ddof=1)), float(y.var(ddof=1)), float(x.std()), float(y.std())) for i, (x, y) in enumerate(zip(a, b))]
    cols = "experiment_name string, n_c long, n_t long, conv_c long, conv_t long, mean_c double, mean_t double, var_c double, var_t double, sd_pop_c double, sd_pop_t double"
    tests = classic.continuous_tests(spark.createDataFrame(rows, cols))
    from cartwright.functions.tails import t_p_value

    rate = tests.select((t_p_value(F.col("t_stat"), F.col("t_df")) < 0.05).cast("int").alias("r")).agg(F.avg("r")).first()[0]
    assert 0.02 <= rate <= 0.10
    hits = spark.createDataFrame([(int(k),) for k in rng.binomial(300, 0.15, 500)], "k long")
    lo, hi = classic.wilson(F.col("k").cast("double"), F.lit(300.0))
    covered = hits.select(F.avg(((lo < 0.15) & (hi > 0.15)).cast("int"))).first()[0]
    assert covered >= 0.92
