"""Experiment evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwright.functions.normal import _HART_DEN, _HART_NUM
from cartwright.operators.experiments import monitor as M
from cartwright.operators.experiments import power as P
from cartwright.operators.experiments import resample as B
from cartwright.operators.experiments import results as E
from cartwright.operators.experiments.arms import arm_moments
from cartwright.operators.experiments.classic import adjust_p_values, continuous_tests, mann_whitney
from cartwright.sources import testtables as T
from checks.sqlbase import NAMES, sql

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
Z = "1.959963984540054::DOUBLE"


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


def rounded(df, digits, *cols):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def sf_abs(z: str) -> str:
    """Upper normal tail at |z| in SQL."""

    def horner(cs):
        out = repr(cs[0]) + "::DOUBLE"
        for c in cs[1:]:
            out = f"({out} * abs({z}) + {c!r}::DOUBLE)"
        return out

    tail = f"(abs({z}) + 0.65)"
    for k in (4, 3, 2, 1):
        tail = f"(abs({z}) + {k} / {tail})"
    e = f"exp(-({z}) * ({z}) / 2)"
    return (
        f"(CASE WHEN abs({z}) > 37 THEN 0.0 WHEN abs({z}) < 7.07106781186547 THEN {e} * {horner(_HART_NUM)}"
        f" / {horner(_HART_DEN)} ELSE {e} / ({tail} * 2.5066282746310002::DOUBLE) END)"
    )


MOM = """SELECT experiment_name,
  count(*) FILTER (variant = 'control') AS n_c, count(*) FILTER (variant = 'treatment') AS n_t,
  count(*) FILTER (variant = 'control' AND converted) AS conv_c,
  count(*) FILTER (variant = 'treatment' AND converted) AS conv_t,
  avg(revenue) FILTER (variant = 'control') AS mean_c, avg(revenue) FILTER (variant = 'treatment') AS mean_t,
  var_samp(revenue) FILTER (variant = 'control') AS var_c, var_samp(revenue) FILTER (variant = 'treatment') AS var_t,
  stddev_pop(revenue) FILTER (variant = 'control') AS sd_c, stddev_pop(revenue) FILTER (variant = 'treatment') AS sd_t
  FROM ses GROUP BY 1"""
ZT = """SELECT *, conv_c / n_c AS p_c, conv_t / n_t AS p_t, (conv_c + conv_t) / (n_c + n_t) AS pp,
  (conv_t / n_t - conv_c / n_c) / sqrt((conv_c + conv_t) / (n_c + n_t) * (1 - (conv_c + conv_t) / (n_c + n_t))
    * (1.0 / n_t + 1.0 / n_c)) AS z,
  abs(conv_t - n_t * (conv_c + conv_t) / (n_c + n_t)) AS dev FROM mom"""


def wil(c, n, sign):
    return (
        f"({c} / {n} + {Z} * {Z} / (2 * {n}) {sign} {Z} * sqrt({c} / {n} * (1 - {c} / {n}) / {n}"
        f" + {Z} * {Z} / (4.0 * {n} * {n}))) / (1 + {Z} * {Z} / {n})"
    )


SE = "sqrt(p_c * (1 - p_c) / n_c + p_t * (1 - p_t) / n_t)"
PROP = f"""SELECT experiment_name, n_c AS n_control, n_t AS n_treatment, conv_c, conv_t, round(p_c, 8) AS control_mean,
  round(p_t, 8) AS treatment_mean, round(p_t - p_c, 8) AS absolute_lift, round((p_t - p_c) / p_c, 8) AS relative_lift,
  round(z, 8) AS z_stat, round(2 * {sf_abs('z')}, 8) AS p_value_ttest,
  round(pow(dev - least(0.5, dev), 2) * (1 / (n_t * (conv_c + conv_t) / (n_c + n_t))
    + 1 / (n_c * (conv_c + conv_t) / (n_c + n_t)) + 1 / (n_t * (n_c + n_t - conv_c - conv_t) / (n_c + n_t))
    + 1 / (n_c * (n_c + n_t - conv_c - conv_t) / (n_c + n_t))), 8) AS chi2_stat,
  round({wil('conv_c', 'n_c', '-')}, 8) AS ci_control_lower, round({wil('conv_c', 'n_c', '+')}, 8) AS ci_control_upper,
  round({wil('conv_t', 'n_t', '-')}, 8) AS ci_treatment_lower, round({wil('conv_t', 'n_t', '+')}, 8) AS ci_treatment_upper,
  round(p_t - p_c - {Z} * {SE}, 8) AS ci_lift_lower, round(p_t - p_c + {Z} * {SE}, 8) AS ci_lift_upper,
  round(2 * asin(sqrt(p_t)) - 2 * asin(sqrt(p_c)), 8) AS cohens_h FROM zt"""
PROP_COLS = (
    "control_mean treatment_mean absolute_lift relative_lift z_stat p_value_ttest chi2_stat ci_control_lower"
    " ci_control_upper ci_treatment_lower ci_treatment_upper ci_lift_lower ci_lift_upper cohens_h"
).split()


def sessions(spark, d):
    return T.web_sessions(spark, d)


@query("ab_proportion_tests", sql(PROP, "ses", mom=MOM, zt=ZT))
def _(spark, d):
    out = E.proportion_results(arm_moments(sessions(spark, d)))
    out = out.drop("p_value_chi2", "metric_type", "observed_power", "required_sample_size")
    return rounded(out, 8, *PROP_COLS)


@query(
    "ab_continuous_tests",
    sql(
        """SELECT experiment_name, n_c AS n_control, n_t AS n_treatment, round(mean_c, 6) AS control_mean,
        round(mean_t, 6) AS treatment_mean, round(sd_c, 6) AS control_std, round(sd_t, 6) AS treatment_std,
        round(mean_t - mean_c, 6) AS absolute_lift, round((mean_t - mean_c) / mean_c, 6) AS relative_lift,
        round((mean_t - mean_c) / sqrt(var_t / n_t + var_c / n_c), 6) AS t_stat,
        round(pow(var_t / n_t + var_c / n_c, 2) / (pow(var_t / n_t, 2) / (n_t - 1) + pow(var_c / n_c, 2) / (n_c - 1)), 4)
          AS t_df,
        round((mean_t - mean_c) / sqrt((sd_c * sd_c + sd_t * sd_t) / 2), 6) AS cohens_d,
        round(sqrt(sd_c * sd_c / n_c + sd_t * sd_t / n_t), 6) AS lift_se FROM mom""",
        "ses",
        mom=MOM,
    ),
)
def _(spark, d):
    out = continuous_tests(arm_moments(sessions(spark, d)))
    cols = [c for c in out.columns if c not in ("experiment_name", "n_control", "n_treatment", "t_df")]
    return rounded(rounded(out, 6, *cols), 4, "t_df")


@query(
    "ab_mann_whitney",
    sql(
        """SELECT experiment_name, u AS mw_stat,
        round((greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5)
          / sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1)))), 6) AS mw_z
        FROM (SELECT experiment_name, sum(rk) FILTER (variant = 'treatment') - n1 * (n1 + 1) / 2 AS u, n1, n2,
          max(ties) AS ties FROM (
            SELECT experiment_name, variant,
            rank() OVER (PARTITION BY experiment_name ORDER BY revenue)
              + (count(*) OVER (PARTITION BY experiment_name, revenue) - 1) / 2 AS rk,
            CAST(count(*) FILTER (variant = 'treatment') OVER (PARTITION BY experiment_name) AS DOUBLE) AS n1,
            CAST(count(*) FILTER (variant = 'control') OVER (PARTITION BY experiment_name) AS DOUBLE) AS n2,
            ties FROM ses JOIN (SELECT experiment_name, CAST(sum(t * t * t - t) AS DOUBLE) AS ties FROM
              (SELECT experiment_name, revenue, count(*)::DOUBLE AS t FROM ses GROUP BY 1, 2) GROUP BY 1)
              USING (experiment_name))
          GROUP BY 1, n1, n2)""",
        "ses",
    ),
)
def _(spark, d):
    return rounded(mann_whitney(sessions(spark, d)), 6, "mw_z").drop("p_value_mannwhitney")


BH = """SELECT experiment_name, round(p, 8) AS p_value_ttest,
  round(least(1.0, min(p * m / rn) OVER (ORDER BY rn DESC ROWS UNBOUNDED PRECEDING)), 8) AS p_value_adjusted,
  round(least(1.0, p * m), 8) AS p_value_bonferroni
  FROM (SELECT *, row_number() OVER (ORDER BY p, experiment_name) AS rn, count(*) OVER () AS m FROM pv)"""


@query(
    "ab_multiple_testing",
    sql(BH, "ses", mom=MOM, zt=ZT, pv=f"SELECT experiment_name, 2 * {sf_abs('z')} AS p FROM zt"),
)
def _(spark, d):
    tests = E.proportion_results(arm_moments(sessions(spark, d))).select("experiment_name", "p_value_ttest")
    return rounded(adjust_p_values(tests), 8, "p_value_ttest", "p_value_adjusted", "p_value_bonferroni")


VERDICT = f"""SELECT *, 2 * {sf_abs('z')} AS p, (p_t - p_c) / p_c AS lift, 2 * {sf_abs('z')} < 0.05 AS sig,
  abs((p_t - p_c) / p_c) >= 0.05 AS prac FROM zt"""
REC = """CASE WHEN sig AND prac AND lift > 0 THEN 'SHIP - significant lift of practical size'
  WHEN sig AND lift > 0 THEN 'CONSIDER - significant lift below the minimum effect'
  WHEN sig AND lift < 0 THEN 'REJECT - treatment significantly worse'
  WHEN NOT sig AND prac THEN 'EXTEND - practical size but not significant yet'
  ELSE 'NO EFFECT - neither significant nor practical' END"""


def verdicts(spark, d):
    return E.with_verdict(E.proportion_results(arm_moments(sessions(spark, d))))


@query(
    "ab_recommendations",
    sql(
        f"""SELECT experiment_name, round(p, 8) AS p_value_ttest, round(lift, 8) AS relative_lift, sig AS is_significant,
        prac AS is_practical, {REC} AS recommendation FROM v""",
        "ses",
        mom=MOM,
        zt=ZT,
        v=VERDICT,
    ),
)
def _(spark, d):
    cols = ["experiment_name", "p_value_ttest", "relative_lift", "is_significant", "is_practical", "recommendation"]
    return rounded(verdicts(spark, d).select(*cols), 8, "p_value_ttest", "relative_lift")


@query(
    "experiment_scorecard",
    sql(
        f"""SELECT count(*) AS n_experiments, count(*) FILTER (sig) AS n_significant,
        count(*) FILTER (rec LIKE '%SHIP%') AS n_ship, round(avg(lift) FILTER (sig) * 100, 6) AS avg_significant_lift
        FROM (SELECT *, {REC} AS rec FROM v)""",
        "ses",
        mom=MOM,
        zt=ZT,
        v=VERDICT,
    ),
)
def _(spark, d):
    return rounded(E.scorecard(verdicts(spark, d)), 6, "avg_significant_lift")


@query(
    "experiment_forest",
    sql(
        f"""SELECT label, round(lift, 8) AS relative_lift,
        round(greatest(lift - (p_t - p_c - {Z} * {SE}) / p_c, 0.0), 8) AS err_low,
        round(greatest((p_t - p_c + {Z} * {SE}) / p_c - lift, 0.0), 8) AS err_high, sig AS is_significant
        FROM v JOIN (SELECT unnest({NAMES!r}) AS experiment_name,
          unnest({[n.replace('_', ' ').title().replace('5Pct', '5pct') for n in NAMES]!r}) AS label)
          USING (experiment_name)""",
        "ses",
        mom=MOM,
        zt=ZT,
        v=VERDICT,
    ),
)
def _(spark, d):
    return rounded(E.forest_table(verdicts(spark, d)), 8, "relative_lift", "err_low", "err_high")


@query("ab_test_results")
def _(spark, d):
    return E.ab_results(sessions(spark, d), T.experiment_config(spark))


@query("ab_summary_decisions")
def _(spark, d):
    return E.ab_summary(E.ab_results(sessions(spark, d), T.experiment_config(spark)))


@query("ab_dashboard")
def _(spark, d):
    return E.ab_dashboard(E.ab_results(sessions(spark, d), T.experiment_config(spark)))


@query(
    "ab_effect_sizes",
    sql(
        """SELECT experiment_name, kind AS metric_type, nc AS n_control, round(CASE WHEN kind = 'proportion'
          THEN 2 * asin(sqrt(pt)) - 2 * asin(sqrt(pc)) ELSE (mt - mc) / sqrt((vc + vt) / 2) END, 8) AS effect FROM (
        SELECT *, CASE WHEN experiment_name IN ('free_shipping_threshold', 'product_recommendation_algo') THEN 'continuous'
            ELSE 'proportion' END AS kind FROM (SELECT experiment_name, count(*) FILTER (variant = 'control') AS nc,
          avg(converted::INT) FILTER (variant = 'control') AS pc, avg(converted::INT) FILTER (variant = 'treatment') AS pt,
          avg(revenue) FILTER (variant = 'control') AS mc, avg(revenue) FILTER (variant = 'treatment') AS mt,
          var_pop(revenue) FILTER (variant = 'control') AS vc, var_pop(revenue) FILTER (variant = 'treatment') AS vt
          FROM ses GROUP BY 1))""",
        "ses",
    ),
)
def _(spark, d):
    r = E.effect_sizes(sessions(spark, d), T.experiment_config(spark))
    return r.select("experiment_name", "metric_type", "n_control", F.round(F.coalesce("cohens_h", "cohens_d"), 8).alias("effect"))


@query("ab_power_curves")
def _(spark, d):
    r = E.effect_sizes(sessions(spark, d), T.experiment_config(spark))
    return P.power_curves(r)


@query("ab_required_n_curve")
def _(spark, d):
    r = E.effect_sizes(sessions(spark, d), T.experiment_config(spark))
    return P.required_n_curve(r)


@query("ab_bootstrap_ci")
def _(spark, d):
    return B.bootstrap_mean_ci(sessions(spark, d), ["experiment_name", "variant"], "revenue")


@query("ab_bayes")
def _(spark, d):
    return B.bayes_two_arms(arm_moments(sessions(spark, d)))


@query(
    "experiment_srm_indicator",
    sql(
        """SELECT experiment_name, count(*) FILTER (variant = 'control') AS n_control,
        count(*) FILTER (variant = 'treatment') AS n_treatment, count(*) AS total,
        round(count(*) FILTER (variant = 'control') / count(*) * 100, 2) AS control_pct,
        CASE WHEN abs(count(*) FILTER (variant = 'control') / count(*) - 0.5) > 0.05 THEN 'SRM_DETECTED' ELSE 'OK' END
          AS srm_check FROM ses GROUP BY 1""",
        "ses",
    ),
)
def _(spark, d):
    return M.srm_indicator(sessions(spark, d))


@query(
    "experiment_srm_chi_square",
    sql(
        """SELECT experiment_name, CAST(sum(n) AS BIGINT) AS total, count(*) - 1 AS degrees_of_freedom,
        round(sum(pow(n - t / k, 2) / (t / k)), 8) AS chi_square,
        round(sqrt(sum(pow(n - t / k, 2) / (t / k)) / (sum(n) * (count(*) - 1))), 8) AS cramers_v
        FROM (SELECT *, CAST(sum(n) OVER (PARTITION BY experiment_name) AS DOUBLE) AS t,
          count(*) OVER (PARTITION BY experiment_name) AS k
          FROM (SELECT experiment_name, device_type, count(*) AS n FROM ses GROUP BY 1, 2)) GROUP BY 1""",
        "ses",
    ),
)
def _(spark, d):
    by_device = sessions(spark, d).select("experiment_name", F.col("device_type").alias("variant"))
    out = M.srm_chi_square(by_device).drop("p_value", "srm_detected", "effect")
    return rounded(out, 8, "chi_square", "cramers_v")


SEQ = {
    "pr": """SELECT experiment_name, i, max(x) FILTER (variant = 'control') AS c, max(x) FILTER (variant = 'treatment') AS t
      FROM (SELECT experiment_name, variant, CAST(revenue AS DECIMAL(18,4)) AS x,
        row_number() OVER (PARTITION BY experiment_name, variant ORDER BY session_id) AS i FROM ses)
      GROUP BY 1, 2 HAVING count(*) = 2 AND i <= 5000""",
    "ru": """SELECT experiment_name, i, CAST(sum(c) OVER w AS DOUBLE) / i AS mc, CAST(sum(t) OVER w AS DOUBLE) / i AS mt,
      CAST(sum(CAST(c * c AS DECIMAL(28,8))) OVER w AS DOUBLE) / i AS qc,
      CAST(sum(CAST(t * t AS DECIMAL(28,8))) OVER w AS DOUBLE) / i AS qt FROM pr
      WINDOW w AS (PARTITION BY experiment_name ORDER BY i ROWS UNBOUNDED PRECEDING)""",
    "ll": """SELECT *, CASE WHEN i >= 2 AND (qc - mc * mc + qt - mt * mt) / 2 > 0
      THEN (mt - mc) / sqrt(2 * ((qc - mc * mc + qt - mt * mt) / 2) / i) * sqrt(2 * i) ELSE 0.0 END AS llr FROM ru""",
    "de": """SELECT *, CASE WHEN llr > sqrt(2 * i * ln(1 / 0.05)) THEN 'reject_null'
      WHEN llr < -sqrt(2 * i * ln(1 / 0.2)) THEN 'fail_to_reject' WHEN 2 * i >= 10000 THEN 'max_sample_reached' END AS dec
      FROM ll""",
    "en": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY experiment_name
      ORDER BY dec IS NULL, CASE WHEN dec IS NOT NULL THEN i ELSE -i END) AS rk FROM de) WHERE rk = 1""",
}


@query(
    "sequential_test",
    sql(
        """SELECT experiment_name, i AS n_control, i AS n_treatment, round(mc, 6) AS mean_control,
        round(mt, 6) AS mean_treatment, round(llr, 6) AS log_likelihood_ratio,
        round(least(1.0, exp(-llr * llr / (4 * i))), 6) AS always_valid_pvalue,
        round(mt - mc - sqrt(2 * ln(40) / (2 * i)), 6) AS cs_lower, round(mt - mc + sqrt(2 * ln(40) / (2 * i)), 6) AS cs_upper,
        dec IS NOT NULL AS stopped, coalesce(dec IN ('reject_null', 'fail_to_reject'), false) AS stopped_early,
        dec AS decision, CASE WHEN dec IS NOT NULL THEN 2 * i END AS stopping_time FROM en""",
        "ses",
        **SEQ,
    ),
)
def _(spark, d):
    return rounded(
        M.sequential_test(sessions(spark, d)),
        6,
        "mean_control",
        "mean_treatment",
        "log_likelihood_ratio",
        "always_valid_pvalue",
        "cs_lower",
        "cs_upper",
    )


@query(
    "bandit_bernoulli_arms",
    sql(
        """SELECT experiment_name, arm, n_pulls, a AS alpha, b AS beta, round(a / (a + b), 8) AS mean_reward,
        round(sqrt(a * b / (pow(a + b, 2) * (a + b + 1))), 8) AS std_reward
        FROM (SELECT experiment_name, variant AS arm, count(*) AS n_pulls, 1.0::DOUBLE + count(*) FILTER (converted) AS a,
          1.0::DOUBLE + count(*) FILTER (NOT converted) AS b FROM ses GROUP BY 1, 2)""",
        "ses",
    ),
)
def _(spark, d):
    return rounded(M.bernoulli_arms(sessions(spark, d)), 8, "mean_reward", "std_reward")


@query(
    "bandit_continuous_arms",
    sql(
        """SELECT experiment_name, arm, n_pulls, round(coalesce(m * (m * (1 - m) / v - 1) + 1, 1), 4) AS alpha,
        round(coalesce((1 - m) * (m * (1 - m) / v - 1) + 1, 1), 4) AS beta
        FROM (SELECT experiment_name, variant AS arm, count(*) AS n_pulls FROM ses GROUP BY 1, 2)
        LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY experiment_name, arm ORDER BY k DESC) AS rk
          FROM (SELECT experiment_name, variant AS arm, row_number() OVER w AS k,
            CAST(sum(CAST(round(revenue / 500, 4) AS DECIMAL(18,4))) OVER w AS DOUBLE) / row_number() OVER w AS m,
            CAST(sum(CAST(CAST(round(revenue / 500, 4) AS DECIMAL(18,4)) * CAST(round(revenue / 500, 4) AS DECIMAL(18,4))
              AS DECIMAL(28,8))) OVER w AS DOUBLE) / row_number() OVER w - pow(CAST(sum(CAST(round(revenue / 500, 4)
              AS DECIMAL(18,4))) OVER w AS DOUBLE) / row_number() OVER w, 2) AS v FROM ses
            WINDOW w AS (PARTITION BY experiment_name, variant ORDER BY session_id ROWS UNBOUNDED PRECEDING))
          WHERE k > 1 AND v > 0 AND m > 0 AND m < 1) WHERE rk = 1) USING (experiment_name, arm)""",
        "ses",
    ),
)
def _(spark, d):
    log = sessions(spark, d).withColumn("share", F.round(F.col("revenue") / 500, 4))
    return rounded(M.continuous_arms(log, "share", "session_id").drop("mean_reward", "std_reward"), 4, "alpha", "beta")


@query("bandit_probability_best")
def _(spark, d):
    return B.probability_best(M.bernoulli_arms(sessions(spark, d)))


@query(
    "bandit_regret",
    sql(
        """SELECT experiment_name, count(*) AS total_pulls, CAST(sum(converted::INT) AS DOUBLE) AS total_reward,
        count(*) * 0.25::DOUBLE - CAST(sum(converted::INT) AS DOUBLE) AS regret FROM ses GROUP BY 1""",
        "ses",
    ),
)
def _(spark, d):
    return M.regret(sessions(spark, d), F.col("converted").cast("int"), 0.25)


@query(
    "bandit_greedy_arm",
    sql(
        """SELECT experiment_name, first(variant ORDER BY m DESC, variant) AS greedy_arm
        FROM (SELECT experiment_name, variant, (1.0 + count(*) FILTER (converted)) / (2.0 + count(*)) AS m
        FROM ses GROUP BY 1, 2) GROUP BY 1""",
        "ses",
    ),
)
def _(spark, d):
    return M.greedy_arm(M.bernoulli_arms(sessions(spark, d)))


def _cuped_sql(denominator):
    cols = []
    for s, v in (("c", "control"), ("t", "treatment")):
        f = f"FILTER (variant = '{v}')"
        cols.append(
            f"count(*) {f} AS n_{s}, avg(revenue) {f} AS y_{s}, avg(pre_metric) {f} AS x_{s},"
            f" var_samp(revenue) {f} AS vy_{s}, var_samp(pre_metric) {f} AS vx_{s}, var_pop(pre_metric) {f} AS vpx_{s},"
            f" covar_samp(revenue, pre_metric) {f} AS cov_{s}"
        )
    return sql(
        """SELECT experiment_name, round(theta, 8) AS theta, round(y_c, 6) AS adj_mean_c,
        round(y_t - theta * (x_t - x_c), 6) AS adj_mean_t, round(1 - a_c / vy_c, 8) AS variance_reduction,
        round((y_c - (y_t - theta * (x_t - x_c))) / sqrt(a_c / n_c + a_t / n_t), 6) AS adjusted_t_stat,
        round(pow(a_c / n_c + a_t / n_t, 2) / (pow(a_c / n_c, 2) / (n_c - 1) + pow(a_t / n_t, 2) / (n_t - 1)), 4)
          AS adjusted_t_df
        FROM (SELECT *, vy_c + theta * theta * vx_c - 2 * theta * cov_c AS a_c,
          vy_t + theta * theta * vx_t - 2 * theta * cov_t AS a_t FROM th)""",
        "ses",
        mm=f"SELECT experiment_name, {', '.join(cols)} FROM ses WHERE pre_metric IS NOT NULL GROUP BY 1",
        th=f"SELECT *, cov_c / {denominator} AS theta FROM mm",
    )


def _cuped(spark, d, compat):
    out = M.cuped(sessions(spark, d), compat=compat)
    out = rounded(out, 8, "theta", "variance_reduction")
    return rounded(rounded(out, 6, "adj_mean_c", "adj_mean_t", "adjusted_t_stat"), 4, "adjusted_t_df")


@query("cuped_adjustment", _cuped_sql("vx_c"))
def _(spark, d):
    return _cuped(spark, d, False)


@query("cuped_adjustment_compat", _cuped_sql("vpx_c"))
def _(spark, d):
    return _cuped(spark, d, True)


EFF = {
    "dm": """SELECT experiment_name, session_date, avg(revenue) FILTER (variant = 'control') AS mc,
      avg(revenue) FILTER (variant = 'treatment') AS mt, count(*) FILTER (variant = 'control') AS n_control,
      count(*) FILTER (variant = 'treatment') AS n_treatment FROM ses GROUP BY 1, 2""",
    "ef": """SELECT experiment_name, session_date, mt - mc AS effect, n_control, n_treatment,
      row_number() OVER (PARTITION BY experiment_name ORDER BY session_date) AS day_no,
      count(*) OVER (PARTITION BY experiment_name) AS n_days FROM dm WHERE mc IS NOT NULL AND mt IS NOT NULL""",
}


@query(
    "daily_treatment_effects",
    sql(
        """SELECT experiment_name, session_date, round(effect, 6) AS effect, n_control, n_treatment,
        CAST(day_no AS INT) AS day_no, n_days FROM ef""",
        "ses",
        **EFF,
    ),
)
def _(spark, d):
    return rounded(M.daily_effects(sessions(spark, d)), 6, "effect")


@query(
    "novelty_effect",
    sql(
        """SELECT experiment_name, n_days, round(e, 6) AS early_effect, round(l, 6) AS late_effect,
        round(e - l, 6) AS decay, round(CASE WHEN e > 0 THEN (e - l) / e ELSE 0 END, 6) AS decay_percentage,
        round((e - l) / sqrt(((ne - 1) * ve + (nl - 1) * vl) / (ne + nl - 2) * (1.0 / ne + 1.0 / nl)), 6) AS t_stat,
        CAST(ne + nl - 2 AS DOUBLE) AS t_df
        FROM (SELECT experiment_name, max(n_days) AS n_days, avg(effect) FILTER (day_no <= n_days // 2) AS e,
          avg(effect) FILTER (day_no > n_days // 2) AS l, var_samp(effect) FILTER (day_no <= n_days // 2) AS ve,
          var_samp(effect) FILTER (day_no > n_days // 2) AS vl, count(*) FILTER (day_no <= n_days // 2) AS ne,
          count(*) FILTER (day_no > n_days // 2) AS nl FROM ef GROUP BY 1)""",
        "ses",
        **EFF,
    ),
)
def _(spark, d):
    out = M.novelty(M.daily_effects(sessions(spark, d))).drop("reason", "p_value", "novelty_detected")
    return rounded(out, 6, "early_effect", "late_effect", "decay", "decay_percentage", "t_stat")


@query(
    "daily_effect_trend",
    sql(
        """SELECT experiment_name, round(regr_slope(effect, day_no - 1), 8) AS slope,
        round(regr_intercept(effect, day_no - 1), 6) AS intercept FROM ef GROUP BY 1""",
        "ses",
        **EFF,
    ),
)
def _(spark, d):
    out = M.effect_trend(M.daily_effects(sessions(spark, d)))
    return rounded(rounded(out, 8, "slope"), 6, "intercept")


@query("advanced_ab_report")
def _(spark, d):
    out = E.advanced_report(sessions(spark, d), covariate="pre_metric")
    flat = ["experiment_name"]
    for part in ("basic_stats", "srm", "sequential", "novelty", "cuped"):
        flat += [F.col(f"{part}.{f}").alias(f"{part}_{f}") for f in out.schema[part].dataType.names]
    return out.select(*flat)
