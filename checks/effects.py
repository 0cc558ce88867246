"""Causal estimates, proportional hazards and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwright.functions import exact_sum
from cartwright.operators.causal import panel as D
from cartwright.operators.causal import propensity as A
from cartwright.operators.ordering import rank_within
from cartwright.operators.predictive import cox as X
from cartwright.operators.predictive import survival as U
from cartwright.session import materialise, scratch_path
from cartwright.sources import testtables as T
from cartwright.streaming import alarms, live
from cartwright.streaming.run import drain
from checks.reports import scored, scored_with_customers
from checks.sqlbase import money, sql

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
COVARIATES = ["frequency", "recency_years", "order_value"]


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


def rounded(df, digits, *cols):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def units(spark, d):
    """Customers of two channels as the treated arm, items bought as outcome."""
    rfm = scored_with_customers(spark, d)
    return materialise(
        rfm.select(
            "customer_id",
            F.col("acquisition_channel").isin("BUILDING", "AUTOMOBILE").cast("int").alias("treatment"),
            F.col("frequency").cast("double").alias("frequency"),
            (F.col("recency") / 365).alias("recency_years"),
            (F.col("avg_order_value") / 10000).alias("order_value"),
            F.col("total_items").alias("outcome"),
            "R_score",
            "F_score",
        ),
        "units",
    )


UNITS = """SELECT customer_id, (acquisition_channel IN ('BUILDING', 'AUTOMOBILE'))::INT AS treatment, frequency::DOUBLE AS frequency,
  recency / 365 AS recency_years, avg_order_value / 10000 AS order_value, total_items AS outcome, R_score, F_score,
  round(1 / (1 + exp(1.2::DOUBLE - 0.3::DOUBLE * R_score + 0.05::DOUBLE * F_score)), 8) AS propensity
  FROM rfm LEFT JOIN cust USING (customer_id)"""


def with_fixed_propensity(u):
    """A stated score in place of a fitted one, so that SQL can follow."""
    p = 1 / (1 + F.exp(1.2 - 0.3 * F.col("R_score") + 0.05 * F.col("F_score")))
    return u.withColumn("propensity", F.round(p, 8))


@query("propensity_scores")
def _(spark, d):
    return A.with_propensity(units(spark, d), COVARIATES).select("customer_id", "treatment", "propensity")


@query("propensity_matched_pairs")
def _(spark, d):
    return A.match_pairs(A.with_propensity(units(spark, d), COVARIATES), 0.05)


@query(
    "propensity_matched_scores",
    sql(
        """SELECT tv AS treated_score, cv AS control_score, CAST(sum(n) AS BIGINT) AS pairs, round(abs(tv - cv), 8) AS distance
        FROM (SELECT tv, cv, n FROM st WHERE n IS NOT NULL UNION ALL SELECT v, v, least(t, c) FROM ce WHERE least(t, c) > 0)
        GROUP BY tv, cv""",
        "rfm",
        "cust",
        un=UNITS,
        ce="SELECT propensity AS v, sum(treatment) AS t, count(*) - sum(treatment) AS c FROM un GROUP BY 1",
        st="""SELECT * FROM (WITH RECURSIVE go(s, tv, cv, n) AS (
          SELECT list({'v': v, 'k': (t - c)::BIGINT} ORDER BY v) FILTER (t <> c), NULL::DOUBLE, NULL::DOUBLE, NULL::BIGINT FROM ce
          UNION ALL
          SELECT list_filter(list_transform(s, lambda x, i: {'v': x.v,
              'k': CASE WHEN i IN (b, b + 1) THEN x.k - sign(x.k)::BIGINT * m ELSE x.k END}), lambda x: x.k <> 0),
            CASE WHEN s[b].k > 0 THEN s[b].v ELSE s[b + 1].v END, CASE WHEN s[b].k > 0 THEN s[b + 1].v ELSE s[b].v END, m
          FROM (SELECT *, least(abs(s[b].k), abs(s[b + 1].k)) AS m FROM (SELECT s, list_sort(list_filter(list_transform(
              range(1, len(s)), lambda i: {'d': s[i + 1].v - s[i].v, 'i': i}),
              lambda x: x.d < 0.05::DOUBLE AND s[x.i].k * s[x.i + 1].k < 0))[1].i AS b FROM go) WHERE b IS NOT NULL))
          SELECT * FROM go)""",
    ),
)
def _(spark, d):
    u = with_fixed_propensity(units(spark, d))
    score = u.select(F.col("customer_id").alias("id"), "propensity")
    pairs = A.match_pairs(u, 0.05)
    pairs = pairs.join(score.withColumnsRenamed({"id": "t_id", "propensity": "treated_score"}), "t_id")
    pairs = pairs.join(score.withColumnsRenamed({"id": "c_id", "propensity": "control_score"}), "c_id")
    counted = pairs.groupBy("treated_score", "control_score").agg(F.count(F.lit(1)).alias("pairs"))
    return counted.withColumn("distance", F.round(F.abs(F.col("treated_score") - F.col("control_score")), 8))


@query("propensity_matched_att")
def _(spark, d):
    u = A.with_propensity(units(spark, d), COVARIATES)
    return A.att_from_pairs(A.attach_outcomes(A.match_pairs(u, 0.05), u, "customer_id", "outcome"))


PAIRS = """SELECT a.customer_id AS t_id, b.customer_id AS c_id, a.outcome AS treated_outcome, b.outcome AS control_outcome
  FROM (SELECT *, row_number() OVER (ORDER BY customer_id) AS i FROM un WHERE treatment = 1) a
  JOIN (SELECT *, row_number() OVER (ORDER BY customer_id) AS i FROM un WHERE treatment = 0) b USING (i)"""


def order_pairs(u):
    """The i-th treated with the i-th control customer."""
    ranked = rank_within(u.select("customer_id", "treatment"), ["treatment"], ["customer_id"], rank="i")
    return (
        ranked.groupBy("i")
        .agg(
            F.max(F.when(F.col("treatment") == 1, F.col("customer_id"))).alias("t_id"),
            F.max(F.when(F.col("treatment") == 0, F.col("customer_id"))).alias("c_id"),
        )
        .dropna()
        .drop("i")
    )


@query(
    "att_from_pairs",
    sql(
        """SELECT round(att, 6) AS att, round(se, 6) AS std_error, n AS n_matches, round(att - 1.96::DOUBLE * se, 6) AS ci_lower,
        round(att + 1.96::DOUBLE * se, 6) AS ci_upper, round(att / se, 6) AS t_statistic
        FROM (SELECT avg(treated_outcome - control_outcome) AS att,
          stddev_samp(treated_outcome - control_outcome) / sqrt(count(*)) AS se, count(*) AS n FROM pairs)""",
        "rfm",
        "cust",
        un=UNITS,
        pairs=PAIRS,
    ),
)
def _(spark, d):
    u = units(spark, d)
    out = A.att_from_pairs(A.attach_outcomes(order_pairs(u), u, "customer_id", "outcome")).drop("p_value")
    return rounded(out, 6, "att", "std_error", "ci_lower", "ci_upper", "t_statistic")


def _balance_part(c):
    return f"""SELECT '{c}' AS covariate, avg({c}) FILTER (t = 1) AS mt, avg({c}) FILTER (t = 0) AS mc,
      sqrt((var_samp({c}) FILTER (t = 1) + var_samp({c}) FILTER (t = 0)) / 2) AS sd FROM mu"""


@query(
    "covariate_balance",
    sql(
        f"""SELECT covariate, round(mt, 8) AS mean_treated, round(mc, 8) AS mean_control, round((mt - mc) / sd, 8) AS smd,
        abs((mt - mc) / sd) < 0.1 AS balanced FROM ({" UNION ALL ".join(map(_balance_part, COVARIATES))})""",
        "rfm",
        "cust",
        un=UNITS,
        pairs=PAIRS,
        mu="""SELECT un.*, 1 AS t FROM pairs JOIN un ON t_id = customer_id
          UNION ALL SELECT un.*, 0 AS t FROM pairs JOIN un ON c_id = customer_id""",
    ),
)
def _(spark, d):
    u = units(spark, d)
    out = A.covariate_balance(A.matched_units(order_pairs(u), u), COVARIATES)
    return rounded(out, 8, "mean_treated", "mean_control", "smd")


@query(
    "propensity_histogram",
    sql(
        """SELECT treatment, CAST(least(floor(propensity * 30), 29) AS INT) AS bin, count(*) AS n FROM un GROUP BY 1, 2""",
        "rfm",
        "cust",
        un=UNITS,
    ),
)
def _(spark, d):
    return A.propensity_histogram(with_fixed_propensity(units(spark, d)))


@query(
    "ipw_att",
    sql(
        """SELECT round(avg(outcome) FILTER (treatment = 1) - sum(outcome * propensity / (1 - propensity)) FILTER (treatment = 0)
        / sum(propensity / (1 - propensity)) FILTER (treatment = 0), 6) AS att, count(*) AS n_effective
        FROM un WHERE propensity > 0.25 AND propensity < 0.75""",
        "rfm",
        "cust",
        un=UNITS,
    ),
)
def _(spark, d):
    return rounded(A.ipw_att(with_fixed_propensity(units(spark, d)), trim=0.25), 6, "att")


@query("ipw_att_bootstrap")
def _(spark, d):
    return A.ipw_att_bootstrap(A.with_propensity(units(spark, d), COVARIATES))


@query("doubly_robust_ate")
def _(spark, d):
    return A.doubly_robust_ate(A.with_propensity(units(spark, d), COVARIATES), COVARIATES)


PANEL = f"""SELECT country, (country IN ('NATION_1', 'NATION_2', 'NATION_3'))::INT AS treated,
  strftime(transaction_date, '%Y-%m') AS month, (transaction_date >= '1998-07-01')::INT AS post, {money('revenue')} AS v
  FROM txn JOIN cust USING (customer_id) WHERE revenue > 0 GROUP BY 1, 2, 3, 4"""


def panel(spark, d):
    """Monthly revenue per country; lines collapse to (customer, month) before the join."""
    per_customer = (
        T.transactions(spark, d)
        .filter("revenue > 0")
        .groupBy("customer_id", F.date_format("transaction_date", "yyyy-MM").alias("month"))
        .agg(F.sum(F.col("revenue").cast("decimal(18,4)")).alias("rev"))
    )
    monthly = (
        per_customer.join(T.customers(spark, d).select("customer_id", "country"), "customer_id")
        .groupBy("country", "month")
        .agg(F.sum("rev").cast("double").alias("v"))
    )
    return monthly.withColumns(
        {
            "treated": F.col("country").isin("NATION_1", "NATION_2", "NATION_3").cast("int"),
            "post": (F.col("month") >= "1998-07").cast("int"),
        }
    )


@query(
    "difference_in_differences",
    sql(
        """SELECT round(m11 - m10 - m01 + m00, 4) AS did_estimate, round(m00, 4) AS pre_control, round(m10, 4) AS pre_treatment,
        round(m01, 4) AS post_control, round(m11, 4) AS post_treatment, round(m11 - m10, 4) AS treatment_change,
        round(m01 - m00, 4) AS control_change, round(m00, 4) AS intercept, round(m10 - m00, 4) AS coef_treatment,
        round(m01 - m00, 4) AS coef_period, round(m11 - m10 - m01 + m00, 4) AS coef_did,
        round(1 - sse / sst, 8) AS r_squared
        FROM (SELECT avg(v) FILTER (treated = 0 AND post = 0) AS m00, avg(v) FILTER (treated = 0 AND post = 1) AS m01,
          avg(v) FILTER (treated = 1 AND post = 0) AS m10, avg(v) FILTER (treated = 1 AND post = 1) AS m11,
          var_pop(v) * count(*) AS sst FROM pa),
        (SELECT sum(s) AS sse FROM (SELECT var_pop(v) * count(*) AS s FROM pa GROUP BY treated, post))""",
        "txn",
        "cust",
        pa=PANEL,
    ),
)
def _(spark, d):
    out = D.difference_in_differences(panel(spark, d), "treated", "post", "v")
    return rounded(rounded(out, 4, *[c for c in out.columns if c != "r_squared"]), 8, "r_squared")


@query(
    "parallel_trends",
    sql(
        """SELECT month, round(avg(v) FILTER (treated = 0), 6) AS control, round(avg(v) FILTER (treated = 1), 6) AS treated
        FROM pa GROUP BY 1""",
        "txn",
        "cust",
        pa=PANEL,
    ),
)
def _(spark, d):
    return rounded(D.parallel_trends(panel(spark, d), "treated", "month", "v"), 6, "control", "treated")


@query(
    "panel_cells",
    sql(
        """SELECT treated, post, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, count(v) AS n
        FROM pa GROUP BY 1, 2""",
        "txn",
        "cust",
        pa=PANEL,
    ),
)
def _(spark, d):
    return rounded(D.panel_cells(panel(spark, d), "treated", "post", "v"), 4, "mean", "std")


@query("synthetic_control_weights")
def _(spark, d):
    fit = D.synthetic_control(materialise(panel(spark, d), "panel"), "NATION_1", "country", "month", "v", ("1995-01", "1998-06"))
    return D.top_contributors(fit.weights, "country", 25)


@query("synthetic_control_path")
def _(spark, d):
    return D.synthetic_control(
        materialise(panel(spark, d), "panel"), "NATION_1", "country", "month", "v", ("1995-01", "1998-06")
    ).path


def _cox(spark, d):
    data = materialise(U.survival_data(scored(spark, d), T.SNAPSHOT), "survival")
    return data, X.fit_cox(data, [c for c in U.FEATURES if c in data.columns])


@query("cox_coefficients")
def _(spark, d):
    return _cox(spark, d)[1].coefficients(spark)


@query("cox_predictions")
def _(spark, d):
    data, model = _cox(spark, d)
    return model.with_risk(data).select("customer_id", "T", "E", "risk", "median_T")


@query("cox_survival_grid")
def _(spark, d):
    data, model = _cox(spark, d)
    return model.survival_at(data, "customer_id")


@query("cox_concordance")
def _(spark, d):
    data, model = _cox(spark, d)
    return U.concordance(model.with_risk(data))


def event_stream(spark, d):
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    return live.with_event_time(spark.readStream.schema(schema).parquet(f"{d}/events*.parquet"))


def event_batch(spark, d):
    return live.with_event_time(spark.read.parquet(f"{d}/events.parquet"))


MINUTES = f"""SELECT minute, transactions, revenue, revenue / transactions AS avg_order_value FROM (
  SELECT date_trunc('minute', ts) AS minute, count(*) AS transactions, {money("value")} AS revenue FROM events GROUP BY 1)"""


def ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


@query("live_minute_metrics", MINUTES)
def _(spark, d):
    return ntz(live.minute_metrics(event_batch(spark, d)), "minute")


@query("live_minute_metrics_stream", MINUTES)
def _(spark, d):
    return ntz(drain(live.minute_metrics(event_stream(spark, d)), "update", ["minute"]), "minute")


@query("live_unique_customers")
def _(spark, d):
    return live.unique_customers(event_batch(spark, d))


@query(
    "live_unique_customers_stream",
    """SELECT date_trunc('minute', ts) - to_minutes(k) AS window_start, count(DISTINCT user_id) AS unique_customers
    FROM events, (SELECT unnest([0, 1, 2, 3, 4]) AS k) GROUP BY 1""",
)
def _(spark, d):
    minutes = drain(live.minute_sketches(event_stream(spark, d)), "update", ["minute"])
    return ntz(live.sliding_unique_customers(minutes), "window_start")


@query(
    "live_breakdown_stream",
    f"""SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS transactions, {money("value")} AS revenue
    FROM events GROUP BY 1, 2""",
)
def _(spark, d):
    hours = live.breakdown(event_stream(spark, d), "event_type")
    return ntz(drain(hours, "update", ["window_start", "event_type"]), "window_start")


@query(
    "customer_sessions",
    f"""SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events,
    {money("value")} AS value FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id
      ROWS UNBOUNDED PRECEDING) AS no FROM (SELECT *, coalesce((ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
        >= INTERVAL 30 MINUTE)::INT, 1) AS fresh FROM events)) GROUP BY user_id, no""",
)
def _(spark, d):
    return ntz(live.batch_sessions(event_batch(spark, d)), "session_start", "session_end")


@query(
    "live_deduplicated_stream",
    "SELECT event_id, user_id, event_type, value FROM events",
)
def _(spark, d):
    twice = event_stream(spark, d).unionByName(event_stream(spark, d))
    return drain(live.deduplicated(twice).select("event_id", "user_id", "event_type", "value"))


@query(
    "live_rfm_stream",
    f"""SELECT user_id, max(ts) AS last_purchase, count(*) AS frequency, {money("value")} AS monetary
    FROM events WHERE event_type = 'purchase' GROUP BY 1""",
)
def _(spark, d):
    bought = event_stream(spark, d).filter("event_type = 'purchase'")
    return ntz(drain(live.running_rfm(bought), "update", ["user_id"]), "last_purchase")


@query(
    "live_arms_stream",
    sql(
        """SELECT experiment_name, variant, 1 + count(*) FILTER (converted) AS alpha, 1 + count(*) FILTER (NOT converted) AS beta
        FROM ses GROUP BY 1, 2""",
        "ses",
    ),
)
def _(spark, d):
    named = T.web_sessions_from(event_stream(spark, d))
    return drain(live.running_arms(named), "update", ["experiment_name", "variant"])


@query(
    "live_revenue_alarms_stream",
    f"""WITH RECURSIVE numbered AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY "at") AS k FROM (
      SELECT event_type AS series, date_trunc('hour', ts) AS "at", {money("value")} AS value FROM events GROUP BY 1, 2)),
    level AS (SELECT series, avg(value) AS m, coalesce(nullif(stddev_samp(value), 0), 1) AS s FROM numbered WHERE k <= 50 GROUP BY 1),
    walk AS (
      SELECT series, 50::BIGINT AS k, 0::DOUBLE AS up, 0::DOUBLE AS down FROM level
      UNION ALL
      SELECT n.series, n.k, greatest(0, CASE WHEN up > 5 OR down > 5 THEN 0 ELSE up END + (value - m) / s - 0.5::DOUBLE),
        greatest(0, CASE WHEN up > 5 OR down > 5 THEN 0 ELSE down END - (value - m) / s - 0.5::DOUBLE)
      FROM walk w JOIN numbered n ON n.series = w.series AND n.k = w.k + 1 JOIN level l ON l.series = n.series)
    SELECT n.series, n."at", n.value, round(up, 6) AS cusum_upper, round(down, 6) AS cusum_lower,
      CASE WHEN up > 5 THEN 'increase' WHEN down > 5 THEN 'decrease' END AS anomaly_type
    FROM numbered n LEFT JOIN walk w ON w.series = n.series AND w.k = n.k AND w.k > 50""",
)
def _(spark, d):
    hourly = (
        event_batch(spark, d)
        .groupBy(F.col("event_type").alias("series"), F.date_trunc("hour", "ts").alias("at"))
        .agg(exact_sum("value").alias("value"))
    )
    path = scratch_path(spark, "points")
    hourly.write.parquet(path)
    stream = spark.readStream.schema(hourly.schema).parquet(path)
    return ntz(rounded(drain(alarms.cusum_stream(stream)), 6, "cusum_upper", "cusum_lower"), "at")
