"""Two-sample tests, intervals and effect sizes as projections over per-experiment moments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.functions import ratio, two_sided_p
from cartwright.functions.normal import norm_sf_abs
from cartwright.operators.experiments import Z_975
from cartwright.operators.ordering import with_global_order


def wilson(successes: Column, n: Column, z: float = Z_975) -> tuple[Column, Column]:
    p = ratio(successes, n)
    z2 = z * z
    centre = (p + ratio(F.lit(z2), 2 * n)) / (1 + ratio(F.lit(z2), n))
    half = z * F.sqrt(ratio(p * (1 - p), n) + ratio(F.lit(z2), 4 * n * n)) / (1 + ratio(F.lit(z2), n))
    return centre - half, centre + half


def proportion_z(ct: Column, nt: Column, cc: Column, nc: Column) -> Column:
    """Two-proportion z with pooled variance, treatment minus control."""
    pooled = ratio(ct + cc, nt + nc)
    se = F.sqrt(pooled * (1 - pooled) * (ratio(F.lit(1.0), nt) + ratio(F.lit(1.0), nc)))
    return ratio(ratio(ct, nt) - ratio(cc, nc), se)


def chi2_yates(ct: Column, nt: Column, cc: Column, nc: Column) -> Column:
    """2x2 chi-square with continuity correction; every cell deviates from its expectation by the same amount."""
    n, hits = nt + nc, ct + cc
    misses = n - hits
    deviation = F.abs(ct - ratio(nt * hits, n))
    corrected = deviation - F.least(F.lit(0.5), deviation)
    inverse = sum((ratio(n, arm * out) for arm in (nt, nc) for out in (hits, misses)), F.lit(0.0))
    return corrected * corrected * inverse


def cohens_h(p_t: Column, p_c: Column) -> Column:
    return 2 * F.asin(F.sqrt(p_t)) - 2 * F.asin(F.sqrt(p_c))


def proportion_tests(moments: DataFrame) -> DataFrame:
    ct, nt, cc, nc = (F.col(c).cast("double") for c in ("conv_t", "n_t", "conv_c", "n_c"))
    p_t, p_c = F.col("treatment_mean"), F.col("control_mean")
    lift = p_t - p_c
    se = F.sqrt(ratio(p_c * (1 - p_c), nc) + ratio(p_t * (1 - p_t), nt))
    lo_c, hi_c = wilson(cc, nc)
    lo_t, hi_t = wilson(ct, nt)
    return (
        moments.withColumns({"control_mean": ratio(cc, nc), "treatment_mean": ratio(ct, nt)})
        .withColumns({"z_stat": proportion_z(ct, nt, cc, nc), "chi2_stat": chi2_yates(ct, nt, cc, nc)})
        .select(
            "experiment_name",
            F.col("n_c").alias("n_control"),
            F.col("n_t").alias("n_treatment"),
            "conv_c",
            "conv_t",
            "control_mean",
            "treatment_mean",
            lift.alias("absolute_lift"),
            F.when(p_c > 0, ratio(lift, p_c)).otherwise(0.0).alias("relative_lift"),
            "z_stat",
            two_sided_p(F.col("z_stat")).alias("p_value_ttest"),
            "chi2_stat",
            two_sided_p(F.sqrt("chi2_stat")).alias("p_value_chi2"),
            lo_c.alias("ci_control_lower"),
            hi_c.alias("ci_control_upper"),
            lo_t.alias("ci_treatment_lower"),
            hi_t.alias("ci_treatment_upper"),
            (lift - Z_975 * se).alias("ci_lift_lower"),
            (lift + Z_975 * se).alias("ci_lift_upper"),
            cohens_h(p_t, p_c).alias("cohens_h"),
        )
    )


def welch(mean_1: Column, var_1: Column, n_1: Column, mean_2: Column, var_2: Column, n_2: Column):
    """Welch t of sample 1 minus sample 2 and its Welch-Satterthwaite degrees of freedom."""
    a, b = ratio(var_1, n_1), ratio(var_2, n_2)
    t = ratio(mean_1 - mean_2, F.sqrt(a + b))
    df = ratio((a + b) * (a + b), ratio(a * a, n_1 - 1) + ratio(b * b, n_2 - 1))
    return t, df


def continuous_tests(moments: DataFrame) -> DataFrame:
    """Statistics of the continuous metric; p-values and t intervals are added by the result builder."""
    lift = F.col("mean_t") - F.col("mean_c")
    t, df = welch(*(F.col(c) for c in ("mean_t", "var_t", "n_t", "mean_c", "var_c", "n_c")))
    pooled = F.sqrt((F.col("sd_pop_c") * F.col("sd_pop_c") + F.col("sd_pop_t") * F.col("sd_pop_t")) / 2)
    se = F.sqrt(
        ratio(F.col("sd_pop_c") * F.col("sd_pop_c"), F.col("n_c"))
        + ratio(F.col("sd_pop_t") * F.col("sd_pop_t"), F.col("n_t"))
    )
    return moments.select(
        "experiment_name",
        F.col("n_c").alias("n_control"),
        F.col("n_t").alias("n_treatment"),
        F.col("mean_c").alias("control_mean"),
        F.col("mean_t").alias("treatment_mean"),
        F.col("sd_pop_c").alias("control_std"),
        F.col("sd_pop_t").alias("treatment_std"),
        lift.alias("absolute_lift"),
        F.when(F.col("mean_c") > 0, ratio(lift, F.col("mean_c"))).otherwise(0.0).alias("relative_lift"),
        t.alias("t_stat"),
        df.alias("t_df"),
        F.coalesce(ratio(lift, pooled), F.lit(0.0)).alias("cohens_d"),
        se.alias("lift_se"),
    )


def mann_whitney(sessions: DataFrame, value: str = "revenue") -> DataFrame:
    """Rank-sum test per experiment with tie and continuity correction.

    Sessions collapse to counts per distinct value; average ranks then come from running counts over the value order.
    """
    arm = F.col("variant")
    cells = (
        sessions.filter(F.col(value).isNotNull() & arm.isin("control", "treatment"))
        .groupBy("experiment_name", value)
        .agg(F.count(F.lit(1)).alias("n"), F.count(F.when(arm == "treatment", 1)).alias("n_t"))
    )
    running = with_global_order(cells, ["experiment_name", value], sums={"cum": "n"})
    n, nt = F.col("n").cast("double"), F.col("n_t").cast("double")
    # Whole-table rank of the group's middle; the experiment's own offset comes off after aggregation.
    mid = F.col("cum") - n + (n + 1) / 2
    sums = running.groupBy("experiment_name").agg(
        F.min(F.col("cum") - F.col("n")).alias("base"),
        F.sum("n").cast("double").alias("total"),
        F.sum("n_t").cast("double").alias("nt"),
        F.sum(nt * mid).alias("raw_rank_sum"),
        F.sum(n * n * n - n).alias("ties"),
    )
    n1, n2, total = F.col("nt"), F.col("total") - F.col("nt"), F.col("total")
    u = F.col("raw_rank_sum") - n1 * F.col("base") - n1 * (n1 + 1) / 2
    spread = F.sqrt(n1 * n2 / 12 * (total + 1 - ratio(F.col("ties"), total * (total - 1))))
    larger = F.greatest(u, n1 * n2 - u)
    z = ratio(larger - n1 * n2 / 2 - 0.5, spread)
    p = F.when(z > 0, 2 * norm_sf_abs(z)).otherwise(2 * (1 - norm_sf_abs(z)))
    return sums.select(
        "experiment_name",
        u.alias("mw_stat"),
        z.alias("mw_z"),
        F.least(F.lit(1.0), p).alias("p_value_mannwhitney"),
    )


def adjust_p_values(df: DataFrame, p: str = "p_value_ttest", key: str = "experiment_name") -> DataFrame:
    """Benjamini-Hochberg and Bonferroni over a result table (one row per test). Null p-values stay null and do not
    count as tests."""
    tested = F.col(p).isNotNull()
    m = F.count(F.col(p)).over(Window.partitionBy())
    rank = F.row_number().over(Window.partitionBy(tested).orderBy(F.col(p), F.col(key)))
    step_up = Window.partitionBy(tested).orderBy(F.desc("_rank")).rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.withColumns({"_rank": rank, "_m": m})
        .withColumn(
            "p_value_adjusted",
            F.when(tested, F.least(F.lit(1.0), F.min(F.col(p) * F.col("_m") / F.col("_rank")).over(step_up))),
        )
        .withColumn("p_value_bonferroni", F.when(tested, F.least(F.lit(1.0), F.col(p) * F.col("_m"))))
        .drop("_rank", "_m")
    )
