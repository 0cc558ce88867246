"""Propensity model, caliper matching, matched and weighted treatment effects."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.functions import attach_row, ratio
from cartwright.functions.tails import t_p_value
from cartwright.operators.causal.matching import match_units
from cartwright.operators.experiments.resample import bootstrap_sums
from cartwright.session import materialise


def with_propensity(units: DataFrame, covariates: list[str], treatment: str = "treatment", c: float = 1.0) -> DataFrame:
    """Add ``propensity`` from a ridge logistic model; ``c`` is the inverse penalty on the summed loss."""
    assembled = VectorAssembler(inputCols=covariates, outputCol="_x").transform(units)
    data = materialise(assembled.withColumn("_label", F.col(treatment).cast("double")), "units")
    model = LogisticRegression(
        featuresCol="_x",
        labelCol="_label",
        regParam=1.0 / (c * max(data.count(), 1)),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=1000,
        tol=1e-8,
        probabilityCol="_prob",
        rawPredictionCol="_raw",
        predictionCol="_class",
    ).fit(data)
    scored = model.transform(data).withColumn("propensity", vector_to_array("_prob")[1])
    return scored.drop("_x", "_label", "_prob", "_raw", "_class")


def match_pairs(
    units: DataFrame, caliper: float = 0.05, matching_ratio: int = 1, key: str = "customer_id", per_range: int = 200_000
) -> DataFrame:
    """Greedy nearest-pair matching within a caliper, without replacement: t_id, c_id, distance, match_no.

    ``matching_ratio`` asks for that many controls per treated unit, filled one pass after the other over the controls
    that are left. Units without an arm or a score are left out.
    """
    free = units.select(F.col(key).alias("id"), F.col("treatment").cast("int").alias("treated"), F.col("propensity").cast("double"))
    free = materialise(free.dropna(), "pool")
    found: list[DataFrame] = []
    for match_no in range(1, matching_ratio + 1):
        pairs = materialise(match_units(free, caliper, per_range).withColumn("match_no", F.lit(match_no)), "pairs")
        found.append(pairs)
        if match_no < matching_ratio:
            taken = pairs.select(F.col("c_id").alias("id"), F.lit(0).alias("treated"))
            free = materialise(free.join(taken, ["id", "treated"], "left_anti"), "pool")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def attach_outcomes(pairs: DataFrame, units: DataFrame, key: str, outcome: str) -> DataFrame:
    """Pairs with both outcomes."""
    y = units.select(F.col(key).alias("_id"), F.col(outcome).alias("_y"))
    treated = y.select(F.col("_id").alias("t_id"), F.col("_y").alias("treated_outcome"))
    control = y.select(F.col("_id").alias("c_id"), F.col("_y").alias("control_outcome"))
    return pairs.join(treated, "t_id").join(control, "c_id")


def att_from_pairs(pairs: DataFrame) -> DataFrame:
    """Mean pair difference with paired standard error, normal interval and t test."""
    diff = F.col("treated_outcome") - F.col("control_outcome")
    out = pairs.agg(
        F.avg(diff).alias("att"),
        (F.stddev_samp(diff) / F.sqrt(F.count(diff))).alias("std_error"),
        F.count(diff).alias("n_matches"),
    ).withColumns(
        {
            "ci_lower": F.col("att") - 1.96 * F.col("std_error"),
            "ci_upper": F.col("att") + 1.96 * F.col("std_error"),
            "t_statistic": ratio("att", "std_error"),
        }
    )
    return out.withColumn("p_value", t_p_value(F.col("t_statistic"), F.col("n_matches") - 1))


def matched_units(pairs: DataFrame, units: DataFrame, key: str = "customer_id") -> DataFrame:
    """Covariate rows of all matched units, one per appearance in a pair."""
    sides = F.explode(
        F.array(F.struct(F.col("t_id").alias(key), F.lit(1).alias("treatment")),
                F.struct(F.col("c_id").alias(key), F.lit(0).alias("treatment")))
    )
    chosen = pairs.select(sides.alias("s")).select("s.*")
    return chosen.join(units.drop("treatment"), key)


def covariate_balance(matched: DataFrame, covariates: list[str]) -> DataFrame:
    """Standardised mean difference per covariate, all covariates in one pass."""
    stats = []
    for c in covariates:
        t, k = F.when(F.col("treatment") == 1, F.col(c)), F.when(F.col("treatment") == 0, F.col(c))
        stats.append(
            F.struct(
                F.lit(c).alias("covariate"),
                F.avg(t).alias("mean_treated"),
                F.avg(k).alias("mean_control"),
                F.sqrt((F.var_samp(t) + F.var_samp(k)) / 2).alias("_sd"),
            ).alias(c)
        )
    smd = F.coalesce(ratio(F.col("mean_treated") - F.col("mean_control"), F.col("_sd")), F.lit(0.0))
    return (
        matched.agg(*stats)
        .select(F.inline(F.array(*covariates)))
        .withColumn("smd", smd)
        .withColumn("balanced", F.abs("smd") < 0.1)
        .drop("_sd")
    )


def propensity_histogram(units: DataFrame, bins: int = 30) -> DataFrame:
    bin_no = F.least(F.floor(F.col("propensity") * bins), F.lit(bins - 1)).cast("int")
    return units.groupBy("treatment", bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def _ipw_parts(trim: float) -> tuple[Column, dict[str, Column]]:
    p, t, y = F.col("propensity"), F.col("treatment"), F.col("outcome")
    odds = F.when(t == 1, 1.0).otherwise(p / F.nullif(1 - p, F.lit(0.0)))
    keep = (p > trim) & (p < 1 - trim)
    parts = {
        "w1": F.when(t == 1, odds).otherwise(0.0),
        "wy1": F.when(t == 1, odds * y).otherwise(0.0),
        "w0": F.when(t == 0, odds).otherwise(0.0),
        "wy0": F.when(t == 0, odds * y).otherwise(0.0),
    }
    return keep, parts


def ipw_att(units: DataFrame, trim: float = 0.05) -> DataFrame:
    """Weighted effect on the treated: weight 1 for treated and p/(1-p) for control units."""
    keep, parts = _ipw_parts(trim)
    sums = units.filter(keep).agg(*[F.sum(e).alias(n) for n, e in parts.items()], F.count(F.lit(1)).alias("n_effective"))
    return sums.select((ratio("wy1", "w1") - ratio("wy0", "w0")).alias("att"), "n_effective")


def ipw_att_bootstrap(
    units: DataFrame, trim: float = 0.05, replicates: int = 1000, seed: int = 42, key: str = "customer_id"
) -> DataFrame:
    """Estimate with a bootstrap standard error; replicates lacking an arm drop out."""
    keep, parts = _ipw_parts(trim)
    rows = units.filter(keep).select(key, "propensity", "treatment", "outcome")
    sums = bootstrap_sums(rows, [], key, parts, replicates, seed)
    att = ratio("wy1", "w1") - ratio("wy0", "w0")
    se = sums.agg(F.stddev_pop(att).alias("std_error"))
    point = ipw_att(units, trim)
    return attach_row(point, se).withColumns(
        {"ci_lower": F.col("att") - 1.96 * F.col("std_error"), "ci_upper": F.col("att") + 1.96 * F.col("std_error")}
    )


def doubly_robust_ate(units: DataFrame, covariates: list[str]) -> DataFrame:
    """Augmented weighting: an outcome model per arm plus propensity-weighted residuals."""
    data = VectorAssembler(inputCols=covariates, outputCol="_x").transform(units)
    data = materialise(data, "aipw")
    for arm in (1, 0):
        model = LinearRegression(
            featuresCol="_x", labelCol="outcome", predictionCol=f"_m{arm}", solver="normal", regParam=0.0
        ).fit(data.filter(F.col("treatment") == arm))
        data = model.transform(data)
    t, y, p = F.col("treatment"), F.col("outcome"), F.col("propensity")
    score = (
        F.col("_m1")
        - F.col("_m0")
        + ratio(t * (y - F.col("_m1")), p)
        - ratio((1 - t) * (y - F.col("_m0")), 1 - p)
    )
    out = data.agg(
        F.avg(score).alias("ate"), (F.stddev_samp(score) / F.sqrt(F.count(score))).alias("std_error"), F.count(score).alias("n")
    )
    return out.withColumns(
        {"ci_lower": F.col("ate") - 1.96 * F.col("std_error"), "ci_upper": F.col("ate") + 1.96 * F.col("std_error")}
    )
