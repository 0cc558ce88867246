"""Lifetime value, survival and churn."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwright.operators.predictive import churn as H
from cartwright.operators.predictive import clv as V
from cartwright.operators.predictive import lifetime as E
from cartwright.operators.predictive import survival as U
from cartwright.operators.predictive import weibull as W
from cartwright.session import materialise
from cartwright.sources import testtables as T
from checks.reports import scored
from checks.sqlbase import sql

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


def rounded(df, digits, *cols):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def history(spark, d, compat=False):
    return V.purchase_history(materialise(scored(spark, d), "scored"), compat)


def _hist_cte(compat):
    if compat:
        f, r, t = "frequency", "recency", "customer_age_days"
    else:
        f, r, t = "frequency - 1", "(customer_age_days - recency) / 7", "customer_age_days / 7"
    return f"""SELECT customer_id, greatest(({f})::DOUBLE, 0.0) AS frequency, greatest(({r})::DOUBLE, 0.0) AS recency,
      greatest(({t})::DOUBLE, 1.0) AS T, monetary FROM rfm"""


TP = """SELECT CASE WHEN var_samp(frequency) > 0 THEN greatest(0.5, avg(frequency) * avg(frequency) / var_samp(frequency))
  ELSE 1.0 END AS r, greatest(1.0, avg(frequency)) AS alpha, 1.0::DOUBLE AS a, greatest(0.5, avg(recency) / 30) AS b,
  avg(frequency) AS mean_frequency FROM hist"""
SP = """SELECT greatest(0.5, avg(monetary) * avg(monetary) / var_samp(monetary)) AS p, greatest(0.5, avg(monetary) / 100) AS q,
  greatest(1.0, avg(monetary)) AS v FROM hist WHERE monetary > 0 AND frequency > 0"""
CLV = f"""SELECT customer_id, round(e, 6) AS bgnbd_expected_transactions, round(al, 8) AS prob_alive,
  round(g, 4) AS gg_expected_value, round(e * g * al * {V.discount_factor()!r}::DOUBLE, 2) AS clv_bgnbd
  FROM (SELECT customer_id, r * 52 / (alpha + 52) * (1 + 0.1::DOUBLE * (frequency - mean_frequency)) AS e,
    least(greatest((1 - recency / (T + 1)) * 0.7::DOUBLE + ln(1 + frequency) / 5 * 0.3::DOUBLE, 0.01), 0.99) AS al,
    (p * v + frequency * monetary) / (p + frequency) AS g FROM hist, tp, sp)"""


def _clv_query(compat):
    return sql(CLV, "rfm", hist=_hist_cte(compat), tp=TP, sp=SP)


def _clv(spark, d, compat):
    out = V.predict_clv(history(spark, d, compat))
    out = rounded(rounded(out, 6, "bgnbd_expected_transactions"), 8, "prob_alive")
    return rounded(rounded(out, 4, "gg_expected_value"), 2, "clv_bgnbd")


@query("clv_prediction", _clv_query(False))
def _(spark, d):
    return _clv(spark, d, False)


@query("clv_prediction_compat", _clv_query(True))
def _(spark, d):
    return _clv(spark, d, True)


@query(
    "transaction_model_params",
    sql(
        """SELECT round(r, 8) AS r, round(alpha, 8) AS alpha, a, round(b, 8) AS b,
        round(mean_frequency, 8) AS mean_frequency FROM tp""",
        "rfm",
        hist=_hist_cte(False),
        tp=TP,
    ),
)
def _(spark, d):
    return rounded(V.transaction_params(history(spark, d)), 8, "r", "alpha", "b", "mean_frequency")


@query(
    "spend_model_params",
    sql(
        "SELECT round(p, 6) AS p, round(q, 4) AS q, round(v, 4) AS v FROM sp", "rfm", hist=_hist_cte(False), sp=SP
    ),
)
def _(spark, d):
    return rounded(rounded(V.spend_params(history(spark, d)), 6, "p"), 4, "q", "v")


@query(
    "expected_purchase_curve",
    sql(
        """SELECT t::INT AS t, round(r * t / (alpha + t), 8) AS expected, round(r * t / (alpha + t) * 0.8::DOUBLE, 8) AS low,
        round(r * t / (alpha + t) * 1.2::DOUBLE, 8) AS high FROM tp, generate_series(0, 51) AS g(t)""",
        "rfm",
        hist=_hist_cte(False),
        tp=TP,
    ),
)
def _(spark, d):
    out = V.expected_purchase_curve(V.transaction_params(history(spark, d)))
    return rounded(out, 8, "expected", "low", "high")


@query(
    "recency_histogram",
    sql(
        """SELECT CAST(least(floor((recency - lo) / ((hi - lo) / 50)), 49) AS INT) AS bin, round(lo + (hi - lo) / 50
        * least(floor((recency - lo) / ((hi - lo) / 50)), 49), 6) AS bin_start, count(*) AS n
        FROM rfm, (SELECT min(recency)::DOUBLE AS lo, max(recency)::DOUBLE AS hi FROM rfm) GROUP BY 1, 2""",
        "rfm",
    ),
)
def _(spark, d):
    return rounded(V.histogram(materialise(scored(spark, d), "scored"), "recency"), 6, "bin_start")


@query(
    "clv_summary",
    sql(
        """SELECT 'clv_12m' AS "column", count(clv_12m) AS "count", round(avg(clv_12m), 4) AS mean,
        round(stddev_samp(clv_12m), 4) AS std, min(clv_12m)::DOUBLE AS min, max(clv_12m)::DOUBLE AS max FROM rfm
        UNION ALL SELECT 'frequency', count(frequency), round(avg(frequency), 4), round(stddev_samp(frequency), 4),
        min(frequency)::DOUBLE, max(frequency)::DOUBLE FROM rfm""",
        "rfm",
    ),
)
def _(spark, d):
    return rounded(V.describe(scored(spark, d), ["clv_12m", "frequency"]), 4, "mean", "std")


def _fit_row(spark, fit):
    cols = ", ".join(f"{k} double" for k in fit.params) + ", log_likelihood double"
    return spark.createDataFrame([(*fit.params.values(), fit.log_likelihood)], cols)


@query("transaction_model_mle")
def _(spark, d):
    return _fit_row(spark, V.fit_transactions(history(spark, d)))


@query("spend_model_mle")
def _(spark, d):
    return _fit_row(spark, V.fit_spend(history(spark, d)))


def _fitted(spark, d, purchases, spend):
    out = E.predict_from_fits(history(spark, d), purchases, spend)
    return rounded(rounded(out, 8, "expected_transactions", "prob_alive"), 2, "expected_value", "clv")


# Stated parameters of the checked prediction: purchases (r, alpha, a, b) and spend (p, q, v).
STATED = (
    V.Fit({"r": 1.3, "alpha": 9.5, "a": 1.7, "b": 2.6}, 0.0, 0),
    V.Fit({"p": 3.1, "q": 4.2, "v": 1500.0}, 0.0, 0),
)


def _stated_sql() -> str:
    """The series from its last term inwards (1 + r0 (1 + r1 (...))) in its plain, untransformed form, for twelve horizons."""
    r, alpha, a, b = (f"{v}::DOUBLE" for v in STATED[0].params.values())
    p, q, v = (f"{v}::DOUBLE" for v in STATED[1].params.values())
    return sql(
        f"""SELECT customer_id, round(e[12], 8) AS expected_transactions, round(alive, 8) AS prob_alive,
        round(g, 2) AS expected_value, round(g * (SELECT sum((e[k] - CASE WHEN k > 1 THEN e[k - 1] ELSE 0 END)
          * power(1.1::DOUBLE, -k / 12::DOUBLE)) FROM (SELECT unnest(range(1, 13)) AS k)), 2) AS clv FROM paths""",
        "rfm",
        hist=_hist_cte(False),
        cells=f"""SELECT *, CASE WHEN frequency > 0 THEN 1 / (1 + {a} / ({b} + frequency - 1)
            * power(({alpha} + T) / ({alpha} + recency), {r} + frequency)) ELSE 1 END AS alive,
          CASE WHEN frequency > 0 AND monetary > 0 THEN {p} * ({v} + frequency * monetary) / ({p} * frequency + {q} - 1)
            ELSE {p} * {v} / ({q} - 1) END AS g FROM hist""",
        zs=f"""SELECT *, list_transform(range(1, 13), lambda k: k * 52 / 12::DOUBLE / ({alpha} + T + k * 52 / 12::DOUBLE)) AS z
          FROM cells""",
        paths=f"""SELECT *, list_transform(z, lambda y: alive * ({a} + {b} + frequency - 1) / ({a} - 1) * (1 - power(1 - y, {r} + frequency)
          * list_reduce(list_prepend(1::DOUBLE, list_transform(range(1500, -1, -1), lambda k: ({r} + frequency + k) * ({b} + frequency + k)
            / (({a} + {b} + frequency - 1 + k) * (k + 1)) * y)), lambda acc, x: 1 + x * acc))) AS e FROM zs""",
    )


@query("clv_prediction_stated_fit", _stated_sql())
def _(spark, d):
    return _fitted(spark, d, *STATED)


@query("clv_prediction_mle")
def _(spark, d):
    known = materialise(history(spark, d), "history")
    out = E.predict_from_fits(known, V.fit_transactions(known, 0.01), V.fit_spend(known, 0.01))
    return rounded(rounded(out, 8, "expected_transactions", "prob_alive"), 2, "expected_value", "clv")


SURV = """SELECT *, date_diff('day', last_purchase, TIMESTAMP '2001-08-02 00:00:00') AS "T",
  (date_diff('day', last_purchase, TIMESTAMP '2001-08-02 00:00:00')
    <= date_diff('day', first_purchase, last_purchase) / greatest(frequency, 1) * 1.5)::INT AS "E" FROM rfm"""
KM = {
    "su": SURV,
    "dy": """SELECT segment, "T", CAST(sum("E") AS BIGINT) AS events, count(*) AS leaving FROM su GROUP BY 1, 2""",
    "ri": """SELECT *, CAST(sum(leaving) OVER (PARTITION BY segment ORDER BY "T" DESC ROWS UNBOUNDED PRECEDING) AS BIGINT)
      AS at_risk FROM dy""",
    "km": """SELECT segment, "T", events, at_risk,
      CASE WHEN max((events = at_risk)::INT) OVER w = 1 THEN 0.0
        ELSE exp(sum(CASE WHEN events < at_risk THEN ln(1 - events / at_risk) ELSE 0 END) OVER w) END AS survival
      FROM ri WINDOW w AS (PARTITION BY segment ORDER BY "T" ROWS UNBOUNDED PRECEDING)""",
}


def survival(spark, d):
    return U.survival_data(scored(spark, d), T.SNAPSHOT)


@query("survival_data", sql('SELECT customer_id, "T", "E" FROM su', "rfm", su=SURV))
def _(spark, d):
    return survival(spark, d).select("customer_id", "T", "E")


@query(
    "survival_data_recency_fallback",
    sql(
        """SELECT customer_id, recency AS "T", (recency < 2 * m)::INT AS "E"
        FROM rfm, (SELECT median(recency) AS m FROM rfm)""",
        "rfm",
    ),
)
def _(spark, d):
    plain = scored(spark, d).drop("last_purchase", "first_purchase")
    return U.survival_data(plain, T.SNAPSHOT).select("customer_id", "T", "E")


@query("kaplan_meier", sql('SELECT segment, "T", events, at_risk, round(survival, 8) AS survival FROM km', "rfm", **KM))
def _(spark, d):
    return rounded(U.kaplan_meier(survival(spark, d), ["segment"]), 8, "survival")


@query(
    "kaplan_meier_median",
    sql('SELECT segment, min("T") FILTER (survival <= 0.5 + 1e-12) AS median_T FROM km GROUP BY 1', "rfm", **KM),
)
def _(spark, d):
    return U.median_survival(U.kaplan_meier(survival(spark, d), ["segment"]), ["segment"])


@query(
    "kaplan_meier_grid",
    sql(
        """SELECT s.segment, g::INT AS at, round(coalesce((SELECT min(survival) FROM km WHERE km.segment = s.segment
        AND km."T" <= g), 1.0), 8) AS survival FROM (SELECT DISTINCT segment FROM km) s, generate_series(0, 364, 7) AS q(g)""",
        "rfm",
        **KM,
    ),
)
def _(spark, d):
    curve = materialise(U.kaplan_meier(survival(spark, d), ["segment"]), "km")
    return rounded(U.survival_at(curve, ["segment"]), 8, "survival")


@query(
    "next_purchase_days",
    sql(
        """SELECT customer_id, segment, m AS predicted_next_purchase_days FROM su LEFT JOIN (SELECT segment,
        min("T") FILTER (survival <= 0.5 + 1e-12) AS m FROM km GROUP BY 1) USING (segment)""",
        "rfm",
        **KM,
    ),
)
def _(spark, d):
    data = U.survival_data(materialise(scored(spark, d), "scored"), T.SNAPSHOT)
    return U.next_purchase_days(data).select("customer_id", "segment", "predicted_next_purchase_days")


@query(
    "concordance_by_spend",
    sql(
        """SELECT CAST(count(*) FILTER (a.risk > b.risk) AS DOUBLE) AS concordant,
        CAST(count(*) FILTER (a.risk = b.risk) AS DOUBLE) AS tied, CAST(count(*) AS DOUBLE) AS comparable,
        round((count(*) FILTER (a.risk > b.risk) + 0.5 * count(*) FILTER (a.risk = b.risk)) / count(*), 10)
          AS concordance_index
        FROM pts a JOIN pts b ON a."E" = 1 AND a.t < b.t""",
        "rfm",
        su=SURV,
        pts='SELECT 2 * "T" + 1 - "E" AS t, "E", frequency::DOUBLE AS risk FROM su',
    ),
)
def _(spark, d):
    data = survival(spark, d).select("T", "E", F.col("frequency").alias("risk"))
    return rounded(U.concordance(data), 10, "concordance_index")


@query("weibull_aft")
def _(spark, d):
    data = materialise(survival(spark, d), "survival")
    model = W.fit_weibull(data, [c for c in U.FEATURES if c in data.columns])
    return model.score(data).select("customer_id", "T", "E", "weibull_scale", "median_T")


CHURN = """SELECT customer_id, (recency > 30)::INT AS churn,
  round(recency / (frequency + 1), 8) AS recency_frequency_ratio, round(monetary / (total_items + 1), 6) AS monetary_per_item,
  round(distinct_categories / (frequency + 1), 8) AS category_diversity, R_score * F_score * M_score AS rfm_interaction,
  round(customer_age_days / 30, 8) AS customer_tenure_months FROM rfm"""


@query("churn_features", sql(CHURN, "rfm"))
def _(spark, d):
    rfm = scored(spark, d)
    labelled = rfm.withColumn("churn", H.churn_label(rfm, T.SNAPSHOT))
    x = H.churn_features(labelled, ("customer_id", "churn"))
    x = rounded(x, 8, "recency_frequency_ratio", "category_diversity", "customer_tenure_months")
    return rounded(x, 6, "monetary_per_item").select(
        "customer_id",
        "churn",
        "recency_frequency_ratio",
        "monetary_per_item",
        "category_diversity",
        "rfm_interaction",
        "customer_tenure_months",
    )


def _model(spark, d, folds=0):
    # Recency and its transforms decide the label, so they stay out of these models' inputs.
    leak = ["recency", "R_score", "RFM_score", "RFM_composite", "log_recency", "segment"]
    rfm = materialise(scored(spark, d).drop(*leak), "churn-in")
    return rfm, H.fit_churn(rfm, T.SNAPSHOT, horizon_days=60, trees=20, depth=4, folds=folds)


@query("churn_scores")
def _(spark, d):
    rfm, model = _model(spark, d)
    return model.score(rfm).select("customer_id", "churn_probability", "churn_predicted")


@query("churn_metrics")
def _(spark, d):
    _, model = _model(spark, d, folds=3)
    return H.metrics_table(spark, model)


@query("churn_feature_importance")
def _(spark, d):
    _, model = _model(spark, d)
    return model.importance(spark)


@query("churn_permutation_importance")
def _(spark, d):
    rfm, model = _model(spark, d)
    return H.permutation_importance(model, rfm, T.SNAPSHOT, "customer_id", 60)


@query("churn_contributions")
def _(spark, d):
    rfm, model = _model(spark, d)
    return H.sampled_shapley(model, rfm, "customer_id", permutations=2)
