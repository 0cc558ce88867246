"""Matching, weighting, panels."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cartwright.operators.causal import matching, panel, propensity
from cartwright.session import materialise


def observational(n=400, seed=0):
    rng = np.random.default_rng(seed)
    age, income = rng.normal(45, 12, n), rng.normal(6, 2, n)
    p = 1 / (1 + np.exp(-(0.05 * (age - 45) + 0.2 * (income - 6) - 0.4)))
    t = (rng.random(n) < p).astype(int)
    y = 50 + 0.3 * age + 10 * t + rng.normal(0, 2, n)
    return pd.DataFrame({"customer_id": np.arange(n), "age": age, "income": income, "treatment": t, "outcome": y})


def check_matching(pairs, units, caliper, ratio=1):
    p = units.set_index("customer_id")["propensity"]
    t = units.set_index("customer_id")["treatment"]
    assert pairs["c_id"].is_unique
    assert pairs["t_id"].value_counts().max() <= ratio
    assert (t[pairs["t_id"]] == 1).all() and (t[pairs["c_id"]] == 0).all()
    gap = np.abs(p[pairs["t_id"]].to_numpy() - p[pairs["c_id"]].to_numpy())
    assert (gap < caliper).all() and np.allclose(gap, pairs["distance"])
    free_t = [i for i in t[t == 1].index if (pairs["t_id"] == i).sum() < ratio]
    free_c = [i for i in t[t == 0].index if i not in set(pairs["c_id"])]
    if free_t and free_c:
        assert np.abs(p[free_t].to_numpy()[:, None] - p[free_c].to_numpy()[None, :]).min() >= caliper


@pytest.mark.parametrize("shape", ["spread", "ties", "separated"])
def test_matching_is_disjoint_within_caliper_and_maximal(spark, shape):
    rng = np.random.default_rng(1)
    n = 300
    t = rng.integers(0, 2, n)
    p = {
        "spread": rng.random(n),
        "ties": np.where(rng.random(n) < 0.4, 0.3, rng.random(n).round(2)),
        "separated": np.where(t == 1, 0.50 + rng.random(n) / 50, 0.52 + rng.random(n) / 50),
    }[shape]
    units = pd.DataFrame({"customer_id": np.arange(n), "treatment": t, "propensity": p})
    pairs = propensity.match_pairs(spark.createDataFrame(units), 0.02).toPandas()
    check_matching(pairs, units, 0.02)
    if shape == "separated":
        assert len(pairs) > 50


def test_matching_ratio(spark):
    rng = np.random.default_rng(2)
    units = pd.DataFrame({"customer_id": np.arange(200), "treatment": (np.arange(200) % 5 == 0).astype(int), "propensity": rng.random(200)})
    pairs = propensity.match_pairs(spark.createDataFrame(units), 0.05, matching_ratio=2).toPandas()
    check_matching(pairs, units, 0.05, ratio=2)
    assert (pairs["t_id"].value_counts() == 2).any()


def greedy(units, caliper):
    """Closest free pair of scores first, ties to the lower score, one unit at a time."""
    free = {a: sorted(units.loc[units["treatment"] == a, "propensity"]) for a in (0, 1)}
    out = []
    while True:
        best = min(((abs(t - c), min(t, c), t, c) for t in set(free[1]) for c in set(free[0]) if abs(t - c) < caliper), default=None)
        if best is None:
            return sorted(out)
        free[1].remove(best[2])
        free[0].remove(best[3])
        out.append(best[2:])


@pytest.mark.parametrize("per_range", [9, 1000])
@pytest.mark.parametrize("shape", ["spread", "hot", "shrinking", "blocks"])
def test_matching_equals_greedy_over_any_ranges(spark, shape, per_range):
    rng = np.random.default_rng(8)
    n = 120
    t = (rng.random(n) < 0.4).astype(int)
    p = {
        "spread": rng.random(n),
        "hot": np.where(rng.random(n) < 0.5, 0.31, rng.random(n)),
        "shrinking": 0.9 - 0.5 * 0.97 ** np.arange(n),  # every gap is smaller than the one before
        "blocks": np.where(t == 1, 0.4, 0.41) + rng.random(n) / 50,
    }[shape]
    if shape == "shrinking":
        t = np.arange(n) % 2
    units = pd.DataFrame({"customer_id": np.arange(n), "treatment": t, "propensity": p})
    pairs = propensity.match_pairs(spark.createDataFrame(units), 0.05, per_range=per_range).toPandas()
    check_matching(pairs, units, 0.05)
    score = units.set_index("customer_id")["propensity"]
    assert sorted(zip(score[pairs["t_id"]], score[pairs["c_id"]])) == greedy(units, 0.05)


def test_settled_ranges_give_what_one_heap_gives():
    rng = np.random.default_rng(9)
    for _ in range(300):
        n = int(rng.integers(2, 40))
        value = np.sort(rng.random(n))
        arm, count = rng.integers(0, 2, n), rng.integers(1, 5, n)
        whole = matching.settle(value, arm, count, -np.inf, np.inf, 0.1)[0]
        cut = int(rng.integers(1, n))
        rest = []
        parts = []
        for lo, hi in ((0, cut), (cut, n)):
            low = value[lo - 1] if lo else -np.inf
            high = value[hi] if hi < n else np.inf
            pairs, used, open_ = matching.settle(value[lo:hi], arm[lo:hi], count[lo:hi], low, high, 0.1)
            parts += [(t + lo, a, c + lo, b, k) for t, a, c, b, k in pairs]
            rest += [(i + lo, used[i]) for i in np.flatnonzero(open_)]
        if rest:
            at, used = map(np.array, zip(*rest))
            pairs = matching.settle(value[at], arm[at], count[at] - used, -np.inf, np.inf, 0.1)[0]
            parts += [(at[t], a + used[t], at[c], b + used[c], k) for t, a, c, b, k in pairs]
        assert sorted(parts) == sorted(whole)


def test_matching_odd_tables(spark):
    rows = [(1, 1, 0.5), (2, 1, None), (3, None, 0.5), (4, 0, 0.5), (5, 0, 0.9)]
    units = spark.createDataFrame(rows, "customer_id long, treatment int, propensity double")
    assert [(r["t_id"], r["c_id"], r["distance"]) for r in propensity.match_pairs(units).collect()] == [(1, 4, 0.0)]
    assert propensity.match_pairs(units.limit(0)).count() == 0
    assert propensity.match_pairs(units, 0.0).count() == 0


def test_effect_is_recovered(spark):
    units = materialise(propensity.with_propensity(spark.createDataFrame(observational()), ["age", "income"]))
    pairs = propensity.match_pairs(units, 0.1)
    att = propensity.att_from_pairs(propensity.attach_outcomes(pairs, units, "customer_id", "outcome")).first()
    assert att["ci_lower"] < att["att"] < att["ci_upper"] and abs(att["att"] - 10) < 2 and att["p_value"] < 0.001
    balance = propensity.covariate_balance(propensity.matched_units(pairs, units), ["age", "income"]).collect()
    assert {r["covariate"] for r in balance} == {"age", "income"} and all(abs(r["smd"]) < 0.4 for r in balance)
    ipw = propensity.ipw_att_bootstrap(units, replicates=200).first()
    assert abs(ipw["att"] - 10) < 2 and 0 < ipw["std_error"] < 2
    dr = propensity.doubly_robust_ate(units, ["age", "income"]).first()
    assert dr["ate"] == pytest.approx(10, abs=1)


def test_propensity_is_the_penalised_optimum(spark):
    pdf = observational(200)
    pdf["age"] = pdf["age"] / 10
    got = propensity.with_propensity(spark.createDataFrame(pdf), ["age", "income"]).toPandas().sort_values("customer_id")
    x = np.column_stack([np.ones(200), pdf["age"], pdf["income"]])
    beta = np.zeros(3)
    ridge = np.diag([0.0, 1.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        beta -= np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (p - pdf["treatment"]) + ridge @ beta)
    assert np.allclose(got["propensity"], 1 / (1 + np.exp(-x @ beta)), atol=1e-4)


def test_difference_in_differences(spark):
    rows = [(1, 0, 100.0), (1, 1, 120.0), (0, 0, 100.0), (0, 1, 102.0)] * 10
    df = spark.createDataFrame(rows, "treated int, period int, y double")
    got = panel.difference_in_differences(df, "treated", "period", "y").first()
    assert got["did_estimate"] == pytest.approx(18) and got["r_squared"] == pytest.approx(1)
    assert got["coef_treatment"] == 0 and got["coef_period"] == pytest.approx(2) and got["intercept"] == 100


def test_synthetic_control_reaches_the_optimum(spark):
    """More donors than periods, some alike, a treated path outside their hull: no exchange of weight lowers the error."""
    rng = np.random.default_rng(5)
    paths = np.vstack([rng.normal(50, 10, (60, 8)), rng.normal(50, 10, (1, 8)).repeat(5, axis=0)])
    mine = rng.normal(62, 6, 8)
    rows = [(f"u{i:02}", t, float(v)) for i, p in enumerate(paths) for t, v in enumerate(p)] + [("x", t, float(v)) for t, v in enumerate(mine)]
    rows += [("short", 0, 1.0), ("none", 1, None), (None, 2, 3.0)]
    fit = panel.synthetic_control(spark.createDataFrame(rows, "unit string, t int, y double"), "x", "unit", "t", "y", tolerance=1e-12)
    w = np.zeros(len(paths))
    for r in fit.weights.collect():
        w[int(r["unit"][1:])] = r["weight"]
    assert w.sum() == pytest.approx(1) and (w >= 0).all() and 1 < (w > 0).sum() <= 9
    slope = paths @ (w @ paths - mine)
    assert slope[w > 0].max() - slope.min() < 1e-6 and fit.gap < 1e-7
    assert fit.pre_period_rmse == pytest.approx(np.sqrt(np.mean((w @ paths - mine) ** 2)))
    with pytest.raises(ValueError):
        panel.synthetic_control(spark.createDataFrame(rows, "unit string, t int, y double"), "nobody", "unit", "t", "y")
    with pytest.raises(ValueError):
        panel.synthetic_control(spark.createDataFrame(rows[-13:], "unit string, t int, y double"), "x", "unit", "t", "y", (100, 200))


def test_nearest_mixture_of_random_hulls():
    rng = np.random.default_rng(1)
    for _ in range(200):
        points = rng.normal(0.7, 1, (rng.integers(1, 6), rng.integers(1, 9)))
        kept, w = panel._nearest_mixture(points, np.full(points.shape[1], 1 / points.shape[1]))
        x = points[:, kept] @ w
        assert w.sum() == pytest.approx(1) and (w > 0).all()
        assert (points[:, kept].T @ x == pytest.approx(x @ x, abs=1e-9))


def test_synthetic_control_finds_the_mixture(spark):
    rng = np.random.default_rng(0)
    paths = rng.normal(100, 10, (12, 20)).cumsum(axis=1)
    mine = 0.6 * paths[2] + 0.4 * paths[7]
    rows = [(f"u{i}", t, float(v)) for i, p in enumerate(paths) for t, v in enumerate(p)]
    rows += [("x", t, float(v) + (50 if t >= 15 else 0)) for t, v in enumerate(mine)]
    df = spark.createDataFrame(rows, "unit string, t int, y double")
    fit = panel.synthetic_control(df, "x", "unit", "t", "y", (0, 14), tolerance=1e-10)
    w = {r["unit"]: r["weight"] for r in fit.weights.collect()}
    assert sum(w.values()) == pytest.approx(1) and min(w.values()) >= 0
    assert w["u2"] == pytest.approx(0.6, abs=0.02) and w["u7"] == pytest.approx(0.4, abs=0.02)
    after = fit.path.filter("t >= 15").select(F.avg(F.col("actual") - F.col("synthetic"))).first()[0]
    assert after == pytest.approx(50, abs=2) and fit.pre_period_rmse < 1
    assert [r["unit"] for r in panel.top_contributors(fit.weights, "unit", 1).collect()] == ["u2"]
