"""Survival, proportional hazards, lifetime value, churn and clusters."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cartwright.operators.predictive import churn, clv, cluster, cox, lifetime, models, recommend, survival, weibull
from cartwright.session import materialise


def durations(n=120, seed=0, days=15):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    t = np.ceil(rng.exponential(8 * np.exp(-0.7 * x[:, 0] + 0.4 * x[:, 1]))).clip(1, days).astype(int)
    return pd.DataFrame({"customer_id": np.arange(n), "T": t, "E": (t < days).astype(int), "x1": x[:, 0], "x2": x[:, 1]})


def efron(beta, x, t, e, penalty):
    ll = 0.0
    theta = np.exp(x @ beta)
    for day in np.unique(t[e == 1]):
        dead = (t == day) & (e == 1)
        k = dead.sum()
        ll += (x[dead] @ beta).sum()
        for j in range(k):
            ll -= math.log(theta[t >= day].sum() - j / k * theta[dead].sum())
    return ll - len(t) * penalty / 2 * beta @ beta


def test_cox_is_at_the_penalised_efron_optimum(spark):
    pdf = durations()
    model = cox.fit_cox(spark.createDataFrame(pdf), ["x1", "x2"], penalizer=0.1)
    x = pdf[["x1", "x2"]].to_numpy()
    x = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    beta = model.coef * pdf[["x1", "x2"]].std().to_numpy()
    args = (x, pdf["T"].to_numpy(), pdf["E"].to_numpy(), 0.1)
    best = efron(beta, *args)
    assert model.log_likelihood == pytest.approx(best, rel=1e-9)
    for step in ([1e-3, 0], [-1e-3, 0], [0, 1e-3], [0, -1e-3]):
        assert efron(beta + step, *args) < best
    assert model.coef[0] > 0 > model.coef[1]
    table = {r["feature"]: r for r in model.coefficients(spark).collect()}
    assert table["x1"]["stars"] == "***" and table["x1"]["hazard_ratio"] == pytest.approx(math.exp(model.coef[0]))
    s = model.survival_at(spark.createDataFrame(pdf), "customer_id", 14, 7).orderBy("customer_id", "at").toPandas()
    assert s["survival"].between(0, 1).all()
    assert (s.groupby("customer_id")["survival"].diff().dropna() <= 1e-12).all()


@pytest.mark.parametrize("k", [1, 256, 257, 5000, 200_000])
def test_tie_nodes_stand_for_all_ties(k):
    share, weight = cox.tie_nodes(k)
    every = np.arange(k) / k
    assert len(share) <= min(k, 256) + 20 * max(k, 1).bit_length()
    for at_risk in (1.0, 1.001, 10.0, 1e6):  # in units of the events' sum
        for term in (
            lambda s: np.log(at_risk + 1 - s), lambda s: 1 / (at_risk - s), lambda s: s / (at_risk - s), lambda s: (s / (at_risk - s)) ** 2
        ):
            assert weight @ term(share) == pytest.approx(term(every).sum(), rel=1e-12, abs=1e-12)


def test_cox_day_with_thousands_of_events(spark):
    pdf = durations(900)
    pdf["T"], pdf["E"] = np.where(np.arange(900) < 600, 5, pdf["T"]), np.where(np.arange(900) < 600, 1, pdf["E"])
    model = cox.fit_cox(spark.createDataFrame(pdf), ["x1", "x2"], penalizer=0.1)
    x = pdf[["x1", "x2"]].to_numpy()
    x = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    beta = model.coef * pdf[["x1", "x2"]].std().to_numpy()
    best = efron(beta, x, pdf["T"].to_numpy(), pdf["E"].to_numpy(), 0.1)
    assert model.log_likelihood == pytest.approx(best, rel=1e-10)


def weibull_objective(params, x, t, e, penalty):
    log_rho = params[-1]
    u = math.exp(log_rho) * (np.log(t) - params[0] - x @ params[1:-1])
    return (e * (log_rho - np.log(t) + u) - np.exp(u)).mean() - penalty / 2 * (params[1:-1] ** 2).sum()


def test_weibull_is_at_the_penalised_optimum(spark):
    rng = np.random.default_rng(8)
    n = 700
    x = rng.normal(size=(n, 2)) * [1.0, 40.0] + [3.0, -10.0]
    t = np.floor(np.exp(2 + 0.5 * x[:, 0] - 0.01 * x[:, 1]) * rng.weibull(1.6, n))  # some are 0
    pdf = pd.DataFrame({"T": t.astype(int), "E": (rng.random(n) < 0.7).astype(int), "x1": x[:, 0], "x2": x[:, 1], "flat": 7.0})
    assert (pdf["T"] == 0).any()
    features = ["x1", "x2", "flat"]
    df = spark.createDataFrame(pdf)
    model = weibull.fit_weibull(df, features, penalizer=0.05)
    assert np.abs(model.gradient).max() < 1e-8
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    std = x.std(axis=0, ddof=1)
    at = np.concatenate([[model.intercept + model.coef[:2] @ x.mean(axis=0) + 7 * model.coef[2]], model.coef[:2] * std, [math.log(model.rho)]])
    args = (z, np.maximum(pdf["T"].to_numpy(float), 0.5), pdf["E"].to_numpy(), 0.05)
    best = weibull_objective(at, *args)
    assert model.objective == pytest.approx(best, rel=1e-10) and model.coef[2] == pytest.approx(0, abs=1e-12)
    for i in range(4):
        for h in (1e-5, -1e-5):
            assert weibull_objective(at + h * np.eye(4)[i], *args) < best
    loose = weibull.fit_weibull(df, features, penalizer=0.0)
    assert loose.coef[0] == pytest.approx(0.5, abs=0.15) and loose.rho == pytest.approx(1.4, abs=0.4)
    scored = model.score(df).toPandas()
    assert len(scored) == n and np.allclose(scored.median_T / scored.weibull_scale, math.log(2) ** (1 / model.rho))
    again = weibull.fit_weibull(df.repartition(5), features, penalizer=0.05)
    assert np.allclose(again.coef, model.coef, rtol=1e-9)


def test_weibull_odd_rows(spark):
    kind = "T int, E int, x double"
    rows = [(3, 1, 1.0), (0, 1, None), (9, 0, 2.0), (None, 1, 1.0), (4, None, 1.0), (5, 1, 1e6)]
    model = weibull.fit_weibull(spark.createDataFrame(rows, kind), ["x"])
    assert model.score(spark.createDataFrame(rows, kind)).filter("median_T > 0").count() == 6
    for bad in ([], [(3, 0, 1.0)], [(None, 1, 1.0)]):
        with pytest.raises(ValueError):
            weibull.fit_weibull(spark.createDataFrame(bad, kind), ["x"])


def test_concordance_odd_rows(spark):
    kind = "T int, E int, risk double"
    empty = survival.concordance(spark.createDataFrame([], kind)).first()
    assert empty["concordance_index"] is None
    rows = [(1, 1, 2.0), (2, 1, 1.0), (3, None, 1.0), (None, 1, 9.0), (4, 1, None)]
    assert survival.concordance(spark.createDataFrame(rows, kind), slices=3).first()["comparable"] == 1


def test_merge_counting():
    rng = np.random.default_rng(0)
    for size in (0, 1, 2, 7, 300):
        t, n = rng.integers(0, 20, size), rng.integers(1, 5, size)
        want = [int(n[:i][t[:i] > t[i]].sum()) for i in range(size)]
        assert survival._later_below(t, n).tolist() == want


def test_concordance_against_pairs(spark):
    rng = np.random.default_rng(3)
    pdf = durations(150, seed=5)
    # A third of the customers share one risk.
    pdf["risk"] = np.where(rng.random(150) < 1 / 3, 0.5, rng.random(150).round(1))
    won = tied = total = 0
    for a in pdf.itertuples():
        for b in pdf.itertuples():
            later = b.T > a.T or (b.T == a.T and b.E == 0)
            if a.E == 1 and a.Index != b.Index and later:
                total += 1
                won += a.risk > b.risk
                tied += a.risk == b.risk
    got = survival.concordance(spark.createDataFrame(pdf), slices=7).first()
    assert (got["concordant"], got["tied"], got["comparable"]) == (won, tied, total)
    assert got["concordance_index"] == pytest.approx((won + tied / 2) / total)


def test_kaplan_meier_known_curve(spark):
    df = spark.createDataFrame([("g", 1, 1), ("g", 2, 1), ("g", 2, 0), ("g", 3, 0), ("g", 4, 1)], "segment string, T long, E int")
    curve = survival.kaplan_meier(df, ["segment"])
    got = {r["T"]: r["survival"] for r in curve.collect()}
    assert got == pytest.approx({1: 0.8, 2: 0.6, 3: 0.6, 4: 0.0})
    assert survival.median_survival(curve, ["segment"]).first()["median_T"] == 4
    grid = {r["at"]: r["survival"] for r in survival.survival_at(curve, ["segment"], 7, 1).collect()}
    assert grid[0] == 1.0 and grid[2] == pytest.approx(0.6) and grid[7] == 0.0


def test_transaction_model_recovers_parameters(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(1500):
        lam, drop = rng.gamma(1.0, 1 / 8.0), rng.beta(1.0, 3.0)
        age, now, last, count = 60.0, 0.0, 0.0, 0
        while rng.random() > drop or count == 0:
            now += rng.exponential(1 / lam)
            if now > age:
                break
            last, count = now, count + 1
        rows.append((i, float(count), round(last, 1), age, 50.0 + count))
    history = spark.createDataFrame(rows, "customer_id long, frequency double, recency double, T double, monetary double")
    fit = clv.fit_transactions(history)
    assert 0.6 < fit.params["r"] < 1.6 and 4 < fit.params["alpha"] < 14
    alive = history.select(clv.conditional_alive(F.col("frequency"), F.col("recency"), F.col("T"), fit).alias("p"))
    low, high = alive.agg(F.min("p"), F.max("p")).first()
    assert 0 < low <= high <= 1


def test_spend_model_improves_on_start(spark):
    rng = np.random.default_rng(1)
    rows = [(float(rng.integers(1, 9)), float(rng.gamma(4, 20))) for _ in range(400)]
    history = spark.createDataFrame(rows, "frequency double, monetary double")
    fit = clv.fit_spend(history)
    x = np.array([r[0] for r in rows])
    m = np.array([r[1] for r in rows])
    start = clv.gamma_gamma_loglik(np.zeros(3), x, m / m.mean()).sum()
    assert fit.log_likelihood > start and all(v > 0 for v in fit.params.values())


def test_clv_positive_and_discounted(spark):
    assert clv.discount_factor() == pytest.approx((1 - (1 + 0.1 / 52) ** -52) / (0.1 / 52) / 52)
    rfm = spark.createDataFrame(
        [(1, 10, 31, 200, 1000.0), (2, 2, 150, 400, 80.0)],
        "customer_id long, frequency long, recency long, customer_age_days long, monetary double",
    )
    for compat in (False, True):
        rows = {r["customer_id"]: r for r in clv.predict_clv(clv.purchase_history(rfm, compat)).collect()}
        assert rows[1]["clv_bgnbd"] > rows[2]["clv_bgnbd"] > 0
        assert all(0.01 <= r["prob_alive"] <= 0.99 for r in rows.values())


def churn_table(spark, n=600):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame(
        {
            "customer_id": np.arange(n),
            "recency": rng.integers(0, 200, n),
            "frequency": rng.integers(1, 30, n),
            "monetary": rng.gamma(2, 100, n),
            "total_items": rng.integers(1, 80, n),
        }
    )
    pdf["recency"] = np.where(pdf.frequency > 12, pdf.recency % 60, 60 + pdf.recency)
    return pdf, spark.createDataFrame(pdf)


def test_churn_model_end_to_end(spark, tmp_path):
    pdf, df = churn_table(spark)
    x = churn.churn_features(df)
    assert {"recency_frequency_ratio", "monetary_per_item"} <= set(x.columns) and "category_diversity" not in x.columns
    labels = df.select(churn.churn_label(df, "2025-01-01", 60).alias("y")).agg(F.sum("y")).first()[0]
    assert labels == (pdf.recency > 60).sum()
    folds = churn.stratified_folds(df.withColumn("label", (F.col("frequency") > 12).cast("int")), "label", "customer_id", 5, "fold")
    sizes = folds.groupBy("label", "fold").count().groupBy("label").agg((F.max("count") - F.min("count")).alias("gap"))
    assert sizes.agg(F.max("gap")).first()[0] <= 1
    model = churn.fit_churn(df.select("*"), "2025-01-01", horizon_days=60, trees=5, depth=3, folds=2)
    assert model.metrics["auc"] > 0.9 and 0 <= model.metrics["cv_auc_std"] < 0.2
    scored = model.score(df)
    assert scored.filter("churn_probability < 0 or churn_probability > 1").count() == 0
    importance = churn.permutation_importance(model, df, "2025-01-01", "customer_id", 60).first()
    assert importance["feature"] in ("recency", "frequency", "recency_frequency_ratio")
    contributions = churn.sampled_shapley(model, df, "customer_id", permutations=2).collect()
    assert {r["feature"] for r in contributions} == set(model.features)
    models.save_model(spark, model, str(tmp_path / "stored"))
    loaded = models.load_model(spark, str(tmp_path / "stored"), churn.ChurnModel)
    assert loaded.features == model.features and loaded.metrics == model.metrics
    assert sorted(map(tuple, loaded.score(df).collect())) == sorted(map(tuple, scored.collect()))
    model.save(str(tmp_path / "churn"))
    from pyspark.ml import PipelineModel

    again = PipelineModel.load(str(tmp_path / "churn"))
    assert again.transform(churn.churn_features(df)).count() == len(pdf)


def test_clusters_are_found_and_labelled(spark):
    rng = np.random.default_rng(0)
    centres = np.array([[0, 0], [8, 0], [0, 8]])
    pts = np.vstack([c + rng.normal(0, 0.5, (60, 2)) for c in centres])
    pdf = pd.DataFrame(pts, columns=["a", "b"])
    pdf["customer_id"] = np.arange(len(pdf))
    pdf["RFM_composite"] = np.repeat([1.0, 3.0, 5.0], 60)
    scaled = materialise(cluster.scale_features(spark.createDataFrame(pdf), ["a", "b"]))
    picks = cluster.choose_k(scaled, range(2, 6), restarts=2, max_iter=20).toPandas()
    assert picks.loc[picks.is_recommended, "k"].tolist() == [3]
    assert picks.loc[picks.is_best_silhouette, "k"].tolist() == [3]
    model = cluster.fit_kmeans(scaled, 3, restarts=2, max_iter=20)
    labelled = cluster.label_clusters(model.transform(scaled)).toPandas()
    assert labelled.groupby("RFM_composite")["segment"].unique().map(list).to_dict() == {
        5.0: ["Champions"], 3.0: ["Loyal Customers"], 1.0: ["Potential Loyalists"]
    }
    points, shares = cluster.project_2d(scaled, ["customer_id"])
    assert points.count() == 180 and sum(shares) == pytest.approx(1)


def test_als_lists_hold_no_bought_items(spark):
    rng = np.random.default_rng(3)
    # User 0 has bought all items but three, user 1 a single one.
    bought = {(0, i) for i in range(27)} | {(1, 5)} | {(u, int(i)) for u in range(2, 20) for i in rng.integers(0, 30, u)}
    cells = spark.createDataFrame([(u, i, 1.0) for u, i in sorted(bought)], "user int, item int, w double")
    got = recommend.als_recommendations(recommend.fit_als(cells, rank=4, iterations=3), cells, n=5).collect()
    assert not {(r["user"], r["item"]) for r in got} & bought
    items = {i for _, i in bought}
    for u in range(20):
        ranks = sorted(r["rank"] for r in got if r["user"] == u)
        own = {i for v, i in bought if v == u}
        assert ranks == list(range(1, 1 + min(5, len(items - own))))


def test_hypergeometric_against_known_forms():
    z = np.linspace(0.01, 0.97, 40)
    assert lifetime.hypergeometric(1, 1, 2, z) == pytest.approx(-np.log1p(-z) / z, rel=1e-12)
    assert lifetime.hypergeometric(2.5, 1.7, 1.7, z) == pytest.approx((1 - z) ** -2.5, rel=1e-11)
    assert lifetime.hypergeometric(0.5, -0.5, 0.5, z) == pytest.approx((1 - z) ** 0.5, rel=1e-11)
    assert lifetime.hypergeometric(-2, 3, -1.5, z) == pytest.approx(1 + 4 * z + 16 * z**2, rel=1e-12)
    with pytest.raises(ValueError):
        lifetime.hypergeometric(1, 1, 2, 1.0)


def test_expected_purchases_equal_simulated_customers():
    """A customer with one repeat purchase: rate and drop-out drawn from their posterior by rejection, then the future simulated."""
    params = {"r": 2.0, "alpha": 6.0, "a": 1.5, "b": 2.5}
    rng = np.random.default_rng(3)
    n, x, tx, age, ahead = 4_000_000, 1, 5.0, 9.0, 20.0
    rate, drop = rng.gamma(2.0, 1 / 6.0, n), rng.beta(1.5, 2.5, n)
    first = rng.exponential(1 / rate)
    hit = np.abs(first - tx) < 0.1
    rate, drop = rate[hit], drop[hit]
    alive = rng.random(len(rate)) > drop
    quiet = ~alive | (rng.exponential(1 / rate) > age - tx)
    rate, drop, alive = rate[quiet], drop[quiet], alive[quiet]
    # Expected purchases of an active customer within the horizon: (1 - exp(-rate p t)) / p.
    future = alive * -np.expm1(-rate * drop * ahead) / drop
    odds = 1.5 / (2.5 + x - 1) * ((6.0 + age) / (6.0 + tx)) ** (2.0 + x)
    want = lifetime.expected_purchases(params, np.array([x]), np.array([age]), np.array([ahead]))[0] / (1 + odds)
    assert want == pytest.approx(future.mean(), abs=5 * future.std() / np.sqrt(len(future)))


def test_prediction_from_fits_odd_rows(spark):
    fits = clv.Fit({"r": 1.0, "alpha": 2.0, "a": 1.0, "b": 0.4}, 0.0, 0), clv.Fit({"p": 2.0, "q": 0.9, "v": 10.0}, 0.0, 0)
    rows = [(1, 0.0, 0.0, 5.0, 20.0), (2, 3.0, 2.0, 4.0, 30.0), (3, None, None, None, None), (2, 3.0, 2.0, 4.0, 30.0)]
    history = spark.createDataFrame(rows, "customer_id long, frequency double, recency double, T double, monetary double")
    got = lifetime.predict_from_fits(history, *fits).collect()
    by = {r["customer_id"]: r for r in got}
    assert len(got) == 4 and by[1]["prob_alive"] == 1.0 and by[1]["expected_value"] is None and by[2]["clv"] > 0
    assert by[3]["expected_transactions"] is None
    assert lifetime.predict_from_fits(history.limit(0), *fits).count() == 0


def test_models_are_loaded_as_saved(spark, tmp_path):
    pdf = durations()
    df = spark.createDataFrame(pdf)
    hazards, times = cox.fit_cox(df, ["x1", "x2"]), weibull.fit_weibull(df, ["x1", "x2"])
    spend = clv.Fit({"p": 2.0 / 3.0, "q": 0.1, "v": 1e-300}, -12.5, 7)
    cells = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("b", 2, 1.0), ("b", 3, 4.0), ("b", 1, 2.0)], "user string, item long, w double")
    path = str(tmp_path)
    models.save_model(spark, spend, f"{path}/cox")  # written over by the next
    for name, model in (("cox", hazards), ("weibull", times), ("spend", spend)):
        models.save_model(spark, model, f"{path}/{name}")
    assert models.load_model(spark, f"{path}/spend", clv.Fit) == spend
    again = models.load_model(spark, f"{path}/cox", cox.CoxModel)
    assert again.baseline == hazards.baseline and (again.coef == hazards.coef).all() and (again.se == hazards.se).all()
    key = ["customer_id", "risk", "median_T"]
    assert again.with_risk(df).select(key).exceptAll(hazards.with_risk(df).select(key)).isEmpty()
    aft = models.load_model(spark, f"{path}/weibull")
    assert aft.score(df).exceptAll(times.score(df)).isEmpty()
    for limit in (1, 2, 1000):
        similarity = recommend.item_similarity(cells, limit)
        models.save_model(spark, similarity, f"{path}/items-{limit}")
        loaded = models.load_model(spark, f"{path}/items-{limit}", recommend.Similarity)
        want = sorted(map(tuple, recommend.score_users(cells, similarity, exclude_purchased=False).collect()))
        assert sorted(map(tuple, recommend.score_users(cells, loaded, exclude_purchased=False).collect())) == want
    with pytest.raises(TypeError):
        models.load_model(spark, f"{path}/cox", clv.Fit)
    with pytest.raises(TypeError):
        models.save_model(spark, {"a": 1}, f"{path}/other")


def test_als_keeps_one_iteration_of_shuffles(spark):
    cells = spark.createDataFrame([(u, i, 1.0) for u in range(12) for i in range(u % 3, 9, 2)], "user int, item int, w double")
    model = recommend.fit_als(cells, rank=2, iterations=2)
    assert spark.sparkContext.getCheckpointDir() is not None
    assert model._java_obj.parent().getCheckpointInterval() == 1
