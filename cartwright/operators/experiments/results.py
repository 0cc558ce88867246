"""The full result table, decisions and report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.functions import ratio
from cartwright.functions.tails import t_critical, t_p_value, t_test_power, t_test_sample_size
from cartwright.operators.experiments import ALPHA, MDE, POWER
from cartwright.operators.experiments.arms import arm_moments, metric_type
from cartwright.operators.experiments.classic import (
    adjust_p_values,
    continuous_tests,
    mann_whitney,
    proportion_tests,
    welch,
)
from cartwright.operators.experiments.monitor import cuped, daily_effects, novelty, sequential_test, srm_chi_square
from cartwright.operators.experiments.power import normal_power, sample_size_for_proportion
from cartwright.operators.experiments.resample import bayes_two_arms, bootstrap_mean_ci


def recommendation(significant: Column, practical: Column, lift: Column) -> Column:
    """Verdict of the test runner: keyword, then the reason."""
    return (
        F.when(significant & practical & (lift > 0), "SHIP - significant lift of practical size")
        .when(significant & (lift > 0), "CONSIDER - significant lift below the minimum effect")
        .when(significant & (lift < 0), "REJECT - treatment significantly worse")
        .when(~significant & practical, "EXTEND - practical size but not significant yet")
        .otherwise("NO EFFECT - neither significant nor practical")
    )


def decision(significant: Column, lift: Column, power: Column) -> Column:
    """Verdict of the summary report, which looks at power instead of practical size."""
    return (
        F.when(significant & (lift > 0.05), "SHIP")
        .when(significant & (lift > 0), "CONSIDER")
        .when(significant & (lift < 0), "REJECT")
        .when(~significant & (power < 0.8), "EXTEND")
        .otherwise("NO_EFFECT")
    )


def with_verdict(df: DataFrame, alpha: float = ALPHA, mde: float = MDE) -> DataFrame:
    significant = F.col("p_value_ttest") < alpha
    practical = F.abs("relative_lift") >= mde
    return df.withColumns(
        {
            "is_significant": significant,
            "mde_achieved": F.abs("relative_lift"),
            "is_practical": practical,
            "recommendation": recommendation(significant, practical, F.col("relative_lift")),
        }
    )


def proportion_results(moments: DataFrame) -> DataFrame:
    """Proportion experiments up to power and required size (no simulation)."""
    return proportion_tests(moments).withColumns(
        {
            "metric_type": F.lit("proportion"),
            "observed_power": normal_power(F.col("cohens_h"), F.least("n_control", "n_treatment")),
            "required_sample_size": sample_size_for_proportion(F.col("control_mean")),
        }
    )


def effect_sizes(sessions: DataFrame, config: DataFrame) -> DataFrame:
    """Per configured experiment its kind and standardised effect (h of proportions, d of means), for the power curves."""
    kinds = config.select("experiment_name", metric_type(F.col("metric")).alias("metric_type"))
    moments = arm_moments(sessions).join(kinds, "experiment_name")
    is_prop, unknown = F.col("metric_type") == "proportion", F.lit(None).cast("double")
    columns = ["experiment_name", "metric_type", "n_control"]
    prop = proportion_results(moments.filter(is_prop)).select(*columns, "cohens_h", unknown.alias("cohens_d"))
    means = continuous_tests(moments.filter(~is_prop)).withColumn("metric_type", F.lit("continuous"))
    return prop.unionByName(means.select(*columns, unknown.alias("cohens_h"), "cohens_d"))


def ab_results(
    sessions: DataFrame, config: DataFrame, replicates: int = 2000, draws: int = 50_000, seed: int = 42
) -> DataFrame:
    """Every configured experiment evaluated at once.

    One aggregation over the sessions gives the moments of all experiments; rank test, bootstrap and simulation are
    further aggregations joined on the experiment name.
    """
    kinds = config.select("experiment_name", "description", metric_type(F.col("metric")).alias("metric_type"))
    moments = arm_moments(sessions).join(kinds, "experiment_name")
    is_prop = F.col("metric_type") == "proportion"

    prop_moments = moments.filter(is_prop)
    prop = proportion_results(prop_moments).join(bayes_two_arms(prop_moments, draws, seed), "experiment_name", "left")

    cont_names = kinds.filter(~is_prop).select("experiment_name")
    # The configured experiments are a short list, and the semi join drops other sessions before the shuffle.
    cont_sessions = sessions.join(cont_names, "experiment_name", "left_semi")
    cis = bootstrap_mean_ci(
        cont_sessions, ["experiment_name", "variant"], "revenue", replicates, seed=seed
    )
    per_arm = cis.groupBy("experiment_name").agg(
        *[
            F.max(F.when(F.col("variant") == v, F.col(f"ci_{side}"))).alias(f"ci_{v}_{side}")
            for v in ("control", "treatment")
            for side in ("lower", "upper")
        ]
    )
    n_min = F.least("n_control", "n_treatment")
    half = F.col("_t_crit") * F.col("lift_se")
    cont = (
        continuous_tests(moments.filter(~is_prop))
        .withColumn("_t_crit", t_critical(0.975, n_min - 1))
        .withColumns(
            {
                "metric_type": F.lit("continuous"),
                "p_value_ttest": t_p_value(F.col("t_stat"), F.col("t_df")),
                "ci_lift_lower": F.col("absolute_lift") - half,
                "ci_lift_upper": F.col("absolute_lift") + half,
                "observed_power": F.coalesce(t_test_power(F.col("cohens_d"), n_min, ALPHA), F.lit(0.0)),
                "required_sample_size": t_test_sample_size(
                    ratio(F.col("control_mean") * MDE, F.coalesce(F.nullif("control_std", F.lit(0.0)), F.lit(1.0))),
                    ALPHA,
                    POWER,
                ).cast("long"),
            }
        )
        .drop("_t_crit", "lift_se")
        .join(mann_whitney(cont_sessions), "experiment_name", "left")
        .join(per_arm, "experiment_name", "left")
    )
    both = prop.unionByName(cont, allowMissingColumns=True).join(
        kinds.select("experiment_name", "description"), "experiment_name"
    )
    return adjust_p_values(with_verdict(both))


def ab_summary(results: DataFrame) -> DataFrame:
    """Rounded summary with the decision matrix."""

    def pct(c: str, digits: int, name: str) -> Column:
        return F.round(F.col(c) * 100, digits).alias(name)

    return results.select(
        "experiment_name",
        "description",
        (F.col("n_control") + F.col("n_treatment")).alias("total_participants"),
        pct("control_mean", 3, "control_rate_pct"),
        pct("treatment_mean", 3, "treatment_rate_pct"),
        pct("relative_lift", 2, "relative_lift_pct"),
        F.round("p_value_ttest", 6).alias("p_value"),
        F.round("p_value_adjusted", 6).alias("p_value_fdr"),
        pct("observed_power", 1, "power_pct"),
        "required_sample_size",
        pct("bayesian_prob_treatment_better", 1, "bayesian_prob_pct"),
        decision(F.col("is_significant"), F.col("relative_lift"), F.col("observed_power")).alias("decision"),
        "is_significant",
        "is_practical",
    ).orderBy("p_value", "experiment_name")


def ab_dashboard(results: DataFrame) -> DataFrame:
    return results.orderBy("p_value_ttest", "experiment_name").select(
        "experiment_name",
        "description",
        "metric_type",
        "n_control",
        "n_treatment",
        F.round("control_mean", 6).alias("control_mean"),
        F.round("treatment_mean", 6).alias("treatment_mean"),
        F.round("relative_lift", 4).alias("relative_lift"),
        F.round("p_value_ttest", 6).alias("p_value"),
        F.round("p_value_adjusted", 6).alias("p_value_fdr"),
        F.round("observed_power", 3).alias("power"),
        "is_significant",
        "recommendation",
    )


def scorecard(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count(F.lit(1)).alias("n_experiments"),
        F.count(F.when(F.col("is_significant"), 1)).alias("n_significant"),
        F.count(F.when(F.col("recommendation").contains("SHIP"), 1)).alias("n_ship"),
        (F.avg(F.when(F.col("is_significant"), F.col("relative_lift"))) * 100).alias("avg_significant_lift"),
    )


def forest_table(results: DataFrame) -> DataFrame:
    """Relative lifts with error-bar lengths, smallest lift first."""
    base = F.nullif("control_mean", F.lit(0.0))
    low = F.col("relative_lift") - F.coalesce(F.col("ci_lift_lower") / base, F.lit(0.0))
    high = F.coalesce(F.col("ci_lift_upper") / base, F.lit(0.0)) - F.col("relative_lift")
    return results.orderBy("relative_lift", "experiment_name").select(
        F.initcap(F.replace("experiment_name", F.lit("_"), F.lit(" "))).alias("label"),
        "relative_lift",
        F.greatest(low, F.lit(0.0)).alias("err_low"),
        F.greatest(high, F.lit(0.0)).alias("err_high"),
        "is_significant",
    )


def advanced_report(
    sessions: DataFrame, value: str = "revenue", covariate: str | None = None, order: str = "session_id"
) -> DataFrame:
    """Basic statistics, sample ratio, variance reduction, sequential and novelty results, a struct each."""
    m = arm_moments(sessions, value)
    t, df = welch(*(F.col(c) for c in ("mean_c", "var_c", "n_c", "mean_t", "var_t", "n_t")))
    basic = m.select(
        "experiment_name",
        F.struct(
            F.col("n_c").alias("n_control"),
            F.col("n_t").alias("n_treatment"),
            F.col("mean_c").alias("mean_control"),
            F.col("mean_t").alias("mean_treatment"),
            F.sqrt("var_c").alias("std_control"),
            F.sqrt("var_t").alias("std_treatment"),
            t.alias("t_statistic"),
            df.alias("t_df"),
        ).alias("basic_stats"),
    ).withColumn(
        "basic_stats",
        F.col("basic_stats").withField(
            "p_value", t_p_value(F.col("basic_stats.t_statistic"), F.col("basic_stats.t_df"))
        ),
    )
    parts = {
        "srm": srm_chi_square(sessions),
        "sequential": sequential_test(sessions, value, order),
        "novelty": novelty(daily_effects(sessions, value)),
    }
    if covariate:
        adjusted = cuped(sessions, value, covariate)
        parts["cuped"] = adjusted.withColumn("adjusted_p_value", t_p_value(F.col("adjusted_t_stat"), F.col("adjusted_t_df")))
    report = basic
    for name, part in parts.items():
        fields = [c for c in part.columns if c != "experiment_name"]
        report = report.join(part.select("experiment_name", F.struct(*fields).alias(name)), "experiment_name", "left")
    return report
