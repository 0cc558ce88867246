"""Sequential tests, logged-bandit posteriors, variance reduction, sample-ratio and novelty checks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.functions import ratio
from cartwright.functions.tails import chi2_p_value, t_p_value
from cartwright.operators.experiments import ALPHA
from cartwright.operators.experiments.classic import welch
from cartwright.operators.ordering import rank_within, running_within


def sequential_test(
    sessions: DataFrame,
    value: str = "revenue",
    order: str = "session_id",
    alpha: float = 0.05,
    beta: float = 0.20,
    max_sample: int = 10_000,
    confidence: float = 0.95,
) -> DataFrame:
    """Pairs the i-th control with the i-th treatment observation and stops at the first boundary crossing.

    The test always ends at ``max_sample`` observations, so only that many rows per experiment pass the rank filter and
    the running sums work on a bounded prefix.
    """
    arms = sessions.filter(F.col("variant").isin("control", "treatment")).select(
        "experiment_name", "variant", order, F.col(value).cast("decimal(18,4)").alias("x")
    )
    ranked = rank_within(arms, ["experiment_name", "variant"], [order], rank="i")
    pairs = (
        ranked.filter(F.col("i") <= -(-max_sample // 2))
        .groupBy("experiment_name", "i")
        .agg(
            F.max(F.when(F.col("variant") == "control", F.col("x"))).alias("c"),
            F.max(F.when(F.col("variant") == "treatment", F.col("x"))).alias("t"),
        )
        .filter(F.col("c").isNotNull() & F.col("t").isNotNull())
    )
    so_far = Window.partitionBy("experiment_name").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    running = pairs.select(
        "experiment_name",
        F.col("i"),
        *[F.sum(a).over(so_far).cast("double").alias(f"sum_{a}") for a in ("c", "t")],
        *[F.sum((F.col(a) * F.col(a)).cast("decimal(28,8)")).over(so_far).cast("double").alias(f"sq_{a}") for a in ("c", "t")],
    )
    i = F.col("i")
    mean_c, mean_t = F.col("sum_c") / i, F.col("sum_t") / i
    pooled = (F.col("sq_c") / i - mean_c * mean_c + F.col("sq_t") / i - mean_t * mean_t) / 2
    z = (mean_t - mean_c) / F.sqrt(2 * pooled / i)
    llr = F.when((i >= 2) & (pooled > 0), z * F.sqrt(2 * i)).otherwise(0.0)
    upper = F.sqrt(2 * i * math.log(1 / alpha))
    lower = -F.sqrt(2 * i * math.log(1 / beta))
    decision = (
        F.when(llr > upper, "reject_null")
        .when(llr < lower, "fail_to_reject")
        .when(2 * i >= max_sample, "max_sample_reached")
    )
    steps = running.select("experiment_name", "i", mean_c.alias("mc"), mean_t.alias("mt"), llr.alias("llr"), decision.alias("decision"))
    row = F.struct("i", "mc", "mt", "llr", "decision")
    end = steps.groupBy("experiment_name").agg(
        F.coalesce(F.min(F.when(F.col("decision").isNotNull(), row)), F.max(row)).alias("e")
    )
    n = 2 * F.col("e.i")
    diff = F.col("e.mt") - F.col("e.mc")
    width = F.sqrt(2 * math.log(2 / (1 - confidence)) / n)
    return end.select(
        "experiment_name",
        F.col("e.i").alias("n_control"),
        F.col("e.i").alias("n_treatment"),
        F.col("e.mc").alias("mean_control"),
        F.col("e.mt").alias("mean_treatment"),
        F.col("e.llr").alias("log_likelihood_ratio"),
        F.least(F.lit(1.0), F.exp(-F.col("e.llr") * F.col("e.llr") / (2 * n))).alias("always_valid_pvalue"),
        (diff - width).alias("cs_lower"),
        (diff + width).alias("cs_upper"),
        F.col("e.decision").isNotNull().alias("stopped"),
        F.coalesce(F.col("e.decision").isin("reject_null", "fail_to_reject"), F.lit(False)).alias("stopped_early"),
        F.col("e.decision").alias("decision"),
        F.when(F.col("e.decision").isNotNull(), n).alias("stopping_time"),
    )


def _beta_summary(alpha: Column, beta: Column) -> dict[str, Column]:
    total = alpha + beta
    return {
        "mean_reward": alpha / total,
        "std_reward": F.sqrt(alpha * beta / (total * total * (total + 1))),
    }


def bernoulli_arms(log: DataFrame, success: str = "converted") -> DataFrame:
    """Beta posterior per arm from logged successes and failures."""
    arms = log.groupBy("experiment_name", F.col("variant").alias("arm")).agg(
        F.count(F.col(success)).alias("n_pulls"),
        (1.0 + F.count(F.when(F.col(success), 1))).alias("alpha"),
        (1.0 + F.count(F.when(~F.col(success), 1))).alias("beta"),
    )
    return arms.withColumns(_beta_summary(F.col("alpha"), F.col("beta")))


def continuous_arms(log: DataFrame, reward: str, order: str) -> DataFrame:
    """Beta posterior matched to the running moments of a continuous reward.

    The posterior is the one of the last pull whose running mean lies in (0, 1) with positive variance; an arm without
    such a pull keeps the flat prior.
    """
    pulls = log.select(
        "experiment_name",
        F.col("variant").alias("arm"),
        order,
        F.col(reward).cast("decimal(18,4)").alias("_x"),
        (F.col(reward).cast("decimal(18,4)") * F.col(reward).cast("decimal(18,4)")).cast("decimal(28,8)").alias("_xx"),
    )
    running = running_within(pulls, ["experiment_name", "arm"], [order], {"_s": "_x", "_ss": "_xx"}, rank="pull")
    k = F.col("pull")
    mean = F.col("_s").cast("double") / k
    var = F.col("_ss").cast("double") / k - mean * mean
    total = mean * (1 - mean) / F.nullif(var, F.lit(0.0)) - 1
    usable = (k > 1) & (var > 0) & (mean > 0) & (mean < 1)
    posterior = F.when(usable, F.struct(k.alias("k"), (mean * total + 1).alias("a"), ((1 - mean) * total + 1).alias("b")))
    arms = running.groupBy("experiment_name", "arm").agg(F.max("pull").alias("n_pulls"), F.max(posterior).alias("p"))
    return arms.select(
        "experiment_name",
        "arm",
        "n_pulls",
        F.coalesce(F.col("p.a"), F.lit(1.0)).alias("alpha"),
        F.coalesce(F.col("p.b"), F.lit(1.0)).alias("beta"),
    ).withColumns(_beta_summary(F.col("alpha"), F.col("beta")))


def regret(log: DataFrame, reward: Column, optimal_mean: float) -> DataFrame:
    """Reward given up against always playing an arm with the optimal mean."""
    return log.groupBy("experiment_name").agg(
        F.count(F.lit(1)).alias("total_pulls"),
        F.sum(reward.cast("decimal(18,4)")).cast("double").alias("total_reward"),
        (F.count(F.lit(1)) * F.lit(optimal_mean) - F.sum(reward.cast("decimal(18,4)")).cast("double")).alias("regret"),
    )


def greedy_arm(arms: DataFrame) -> DataFrame:
    best = F.min_by("arm", F.struct(-F.col("mean_reward"), F.col("arm")))
    return arms.groupBy("experiment_name").agg(best.alias("greedy_arm"))


def cuped(sessions: DataFrame, value: str = "revenue", covariate: str = "pre_metric", compat: bool = False) -> DataFrame:
    """Variance reduction with a pre-experiment covariate.

    Slope and covariate mean come from control only. Adjusted means and variances follow from the arms' moments, so the
    data is scanned once. ``compat`` divides the sample covariance by the population variance.
    """
    aggs = []
    for s, variant in (("c", "control"), ("t", "treatment")):
        y = F.when(F.col("variant") == variant, F.col(value))
        x = F.when(F.col("variant") == variant, F.col(covariate))
        aggs += [
            F.count(y).alias(f"n_{s}"),
            F.avg(y).alias(f"y_{s}"),
            F.avg(x).alias(f"x_{s}"),
            F.var_samp(y).alias(f"vy_{s}"),
            F.var_samp(x).alias(f"vx_{s}"),
            F.var_pop(x).alias(f"vpx_{s}"),
            F.covar_samp(y, x).alias(f"cov_{s}"),
        ]
    both = sessions.filter(F.col(value).isNotNull() & F.col(covariate).isNotNull())
    m = both.groupBy("experiment_name").agg(*aggs)
    denominator = F.col("vpx_c") if compat else F.col("vx_c")
    m = m.withColumn("theta", F.coalesce(ratio("cov_c", denominator), F.lit(0.0)))
    theta = F.col("theta")
    for s in ("c", "t"):
        m = m.withColumns(
            {
                f"adj_mean_{s}": F.col(f"y_{s}") - theta * (F.col(f"x_{s}") - F.col("x_c")),
                f"adj_var_{s}": F.col(f"vy_{s}") + theta * theta * F.col(f"vx_{s}") - 2 * theta * F.col(f"cov_{s}"),
            }
        )
    t, df = welch(*(F.col(c) for c in ("adj_mean_c", "adj_var_c", "n_c", "adj_mean_t", "adj_var_t", "n_t")))
    return m.select(
        "experiment_name",
        "theta",
        "adj_mean_c",
        "adj_mean_t",
        (1 - ratio("adj_var_c", "vy_c")).alias("variance_reduction"),
        t.alias("adjusted_t_stat"),
        df.alias("adjusted_t_df"),
    )


def srm_indicator(sessions: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Split of control against all rows, flagged beyond ``tolerance`` from one half."""
    n_c = F.count(F.when(F.col("variant") == "control", 1))
    share = n_c / F.count(F.lit(1))
    return (
        sessions.groupBy("experiment_name")
        .agg(
            n_c.alias("n_control"),
            F.count(F.when(F.col("variant") == "treatment", 1)).alias("n_treatment"),
            F.count(F.lit(1)).alias("total"),
            F.round(share * 100, 2).alias("control_pct"),
            F.when(F.abs(share - 0.5) > tolerance, "SRM_DETECTED").otherwise("OK").alias("srm_check"),
        )
        .orderBy("experiment_name")
    )


def srm_chi_square(sessions: DataFrame, expected: DataFrame | None = None, alpha: float = ALPHA) -> DataFrame:
    """Chi-square of arm sizes against expected shares (equal by default; else experiment_name, variant, weight)."""
    counts = sessions.groupBy("experiment_name", "variant").agg(F.count(F.lit(1)).alias("n"))
    if expected is None:
        weighted = counts.withColumn("weight", F.lit(1.0))
    else:
        # Arms listed but never seen count as zero observations.
        weighted = expected.join(counts, ["experiment_name", "variant"], "left").fillna({"n": 0})
    per_test = Window.partitionBy("experiment_name")  # one row per arm
    share = F.col("weight") / F.sum("weight").over(per_test)
    cells = weighted.withColumns({"total": F.sum("n").over(per_test), "want": share * F.sum("n").over(per_test)})
    gap = F.col("n") - F.col("want")
    tests = cells.groupBy("experiment_name").agg(
        F.max("total").alias("total"),
        (F.count(F.lit(1)) - 1).alias("degrees_of_freedom"),
        F.sum(ratio(gap * gap, F.col("want"))).alias("chi_square"),
    )
    v = F.sqrt(ratio("chi_square", F.col("total") * F.col("degrees_of_freedom")))
    detected = F.col("p_value") < alpha
    size = F.when(v < 0.1, "small").when(v < 0.3, "medium").otherwise("large")
    return (
        tests.withColumn("cramers_v", v)
        .withColumn("p_value", chi2_p_value(F.col("chi_square"), F.col("degrees_of_freedom")))
        .withColumns({"srm_detected": detected, "effect": F.when(detected, size).otherwise("none")})
    )


def daily_effects(sessions: DataFrame, value: str = "revenue") -> DataFrame:
    """Treatment minus control mean per day on which both arms have data, numbered per experiment."""
    c = F.when(F.col("variant") == "control", F.col(value))
    t = F.when(F.col("variant") == "treatment", F.col(value))
    daily = (
        sessions.groupBy("experiment_name", "session_date")
        .agg(F.avg(c).alias("mc"), F.avg(t).alias("mt"), F.count(c).alias("n_control"), F.count(t).alias("n_treatment"))
        .filter(F.col("mc").isNotNull() & F.col("mt").isNotNull())
    )
    by_day = Window.partitionBy("experiment_name").orderBy("session_date")  # one row per day
    return daily.select(
        "experiment_name",
        "session_date",
        (F.col("mt") - F.col("mc")).alias("effect"),
        "n_control",
        "n_treatment",
        F.row_number().over(by_day).alias("day_no"),
        F.count(F.lit(1)).over(Window.partitionBy("experiment_name")).alias("n_days"),
    )


def novelty(effects: DataFrame, window_days: int = 7, alpha: float = ALPHA) -> DataFrame:
    """Early against late daily effects (pooled t-test); needs two windows of days."""
    early = F.col("day_no") <= F.floor(F.col("n_days") / 2)
    first, last = F.when(early, F.col("effect")), F.when(~early, F.col("effect"))
    halves = effects.groupBy("experiment_name").agg(
        F.max("n_days").alias("n_days"),
        F.avg(first).alias("early_effect"),
        F.avg(last).alias("late_effect"),
        F.var_samp(first).alias("ve"),
        F.var_samp(last).alias("vl"),
        F.count(first).alias("ne"),
        F.count(last).alias("nl"),
    )
    decay = F.col("early_effect") - F.col("late_effect")
    dof = F.col("ne") + F.col("nl") - 2
    pooled = ratio((F.col("ne") - 1) * F.col("ve") + (F.col("nl") - 1) * F.col("vl"), dof)
    t = ratio(decay, F.sqrt(pooled * (ratio(F.lit(1.0), F.col("ne")) + ratio(F.lit(1.0), F.col("nl")))))
    enough = F.col("n_days") >= 2 * window_days
    out = halves.select(
        "experiment_name",
        "n_days",
        *[F.when(enough, x).alias(name) for name, x in (
            ("early_effect", F.col("early_effect")),
            ("late_effect", F.col("late_effect")),
            ("decay", decay),
            ("decay_percentage", F.when(F.col("early_effect") > 0, decay / F.col("early_effect")).otherwise(0.0)),
            ("t_stat", t),
            ("t_df", dof.cast("double")),
        )],
        F.when(~enough, "Insufficient data").alias("reason"),
    )
    return out.withColumn("p_value", t_p_value(F.col("t_stat"), F.col("t_df"))).withColumn(
        "novelty_detected", F.coalesce((F.col("decay") > 0) & (F.col("p_value") < alpha), F.lit(False))
    )


def effect_trend(effects: DataFrame) -> DataFrame:
    """Least-squares line of the daily effect over the day index from zero."""
    day = F.col("day_no") - 1
    return effects.groupBy("experiment_name").agg(
        F.regr_slope("effect", day).alias("slope"), F.regr_intercept("effect", day).alias("intercept")
    )
