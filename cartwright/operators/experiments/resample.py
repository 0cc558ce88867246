"""Bootstrap and Monte-Carlo estimates, reproducible for any partitioning."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cumulative Poisson(1) probabilities as 64-bit thresholds; beyond 12 the mass is below 1e-10.
_POISSON_STEPS = [
    int(sum(math.exp(-1) / math.factorial(k) for k in range(m + 1)) * 2**64) for m in range(13)
]


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the SplitMix64 generator: well-spread bits from any 64-bit counter."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def poisson_weights(row_hash: np.ndarray, replicates: int, seed: int) -> np.ndarray:
    """Poisson(1) counts, rows x replicates, decided by (seed, replicate, row) alone."""
    counter = np.arange(1, replicates + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    bits = _mix(row_hash[:, None] ^ _mix(counter)[None, :])
    out = np.zeros(bits.shape, dtype=np.uint8)
    for step in _POISSON_STEPS:
        out += bits >= np.uint64(step)
    return out


_SLICE = 512


def bootstrap_sums(
    df: DataFrame, groups: Sequence[str], row_key: str, sums: dict[str, Column], replicates: int, seed: int
) -> DataFrame:
    """Per group and replicate: total weight ``w`` and weighted sums.

    A task meets each of its rows once, draws the row's weights for all replicates as one vector and keeps group x
    replicate totals, so the shuffle carries that many rows per task whatever the table size.
    """
    names = list(sums)
    rows = df.select(*groups, F.xxhash64(row_key).alias("_h"), *[e.cast("double").alias(n) for n, e in sums.items()])

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[tuple, np.ndarray] = {}
        for pdf in batches:
            parts = pdf.groupby(list(groups), dropna=False, sort=False) if groups else [((), pdf)]
            for key, part in parts:
                acc = totals.setdefault(key, np.zeros((len(names) + 1, replicates)))
                hashes = part["_h"].to_numpy(np.int64).view(np.uint64)
                values = np.column_stack([np.ones(len(part)), part[names].to_numpy(float)])
                for at in range(0, len(part), _SLICE):
                    weights = poisson_weights(hashes[at : at + _SLICE], replicates, seed)
                    acc += values[at : at + _SLICE].T @ weights.astype(float)
        for key, acc in totals.items():
            out = pd.DataFrame({g: [k] * replicates for g, k in zip(groups, key)})
            out["replicate"] = np.arange(replicates)
            for name, row in zip(["w", *names], acc):
                out[name] = row
            yield out

    schema = T.StructType(
        [rows.schema[g] for g in groups]
        + [T.StructField("replicate", T.IntegerType())]
        + [T.StructField(n, T.DoubleType()) for n in ["w", *names]]
    )
    return (
        rows.mapInPandas(fold, schema)
        .groupBy(*groups, "replicate")
        .agg(*[F.sum(n).alias(n) for n in ["w", *names]])
        .filter(F.col("w") > 0)
    )


def _cell_weights(row_hash: np.ndarray, counts: np.ndarray, replicates: int, seed: int) -> np.ndarray:
    """Poisson(count) weights, cells x replicates, decided by (seed, replicate, cell) alone."""
    out = np.empty((len(counts), replicates))
    single = counts == 1
    out[single] = poisson_weights(row_hash[single], replicates, seed)
    for at in np.flatnonzero(~single):
        out[at] = np.random.default_rng([seed, int(row_hash[at])]).poisson(counts[at], replicates)
    return out


def bootstrap_mean_ci(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    replicates: int = 2000,
    level: float = 0.95,
    seed: int = 42,
) -> DataFrame:
    """Percentile interval of the mean per group; the percentile sees one value per replicate.

    Rows of equal value fold to one cell first: the sum of n Poisson(1) weights is one Poisson(n) draw, so the work is the
    number of distinct values per group times the replicates, and a value that a third of all rows share costs one draw a
    replicate. Draws depend on (seed, replicate, group, value), not on partitioning or row keys. Nulls and not-a-number
    values are left out; an empty table gives no rows. With an expected total weight of only a few rows a replicate can
    have weight 0 and is left out.
    """
    names = list(groups)
    tail = (1 - level) / 2
    cells = (
        df.select(*names, F.col(value).cast("double").alias("_x"))
        .filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
        .groupBy(*names, "_x")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_h", F.xxhash64(*names, "_x"))
    )

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[tuple, np.ndarray] = {}
        for pdf in batches:
            for key, part in pdf.groupby(names, dropna=False, sort=False) if names else [((), pdf)]:
                acc = totals.setdefault(tuple(None if pd.isna(k) else k for k in key), np.zeros((2, replicates)))
                hashes, counts = part["_h"].to_numpy(np.int64).view(np.uint64), part["_n"].to_numpy(np.int64)
                values = np.stack([np.ones(len(part)), part["_x"].to_numpy(float)])
                for at in range(0, len(part), _SLICE):
                    weights = _cell_weights(hashes[at : at + _SLICE], counts[at : at + _SLICE], replicates, seed)
                    acc += values[:, at : at + _SLICE] @ weights
        for key, acc in totals.items():
            out = pd.DataFrame({g: [k] * replicates for g, k in zip(names, key)})
            out["replicate"], out["w"], out["wx"] = np.arange(replicates), acc[0], acc[1]
            yield out

    schema = T.StructType(
        [cells.schema[g] for g in names]
        + [T.StructField("replicate", T.IntegerType())]
        + [T.StructField(n, T.DoubleType()) for n in ("w", "wx")]
    )
    sums = (
        cells.mapInPandas(fold, schema).groupBy(*names, "replicate").agg(F.sum("w").alias("w"), F.sum("wx").alias("wx")).filter("w > 0")
    )
    return sums.groupBy(*names).agg(
        F.percentile(F.col("wx") / F.col("w"), F.lit(tail)).alias("ci_lower"),
        F.percentile(F.col("wx") / F.col("w"), F.lit(1 - tail)).alias("ci_upper"),
    )


_DRAW_BLOCK = 5_000


def _draw_blocks(df: DataFrame, draws: int) -> DataFrame:
    """One row per (row, block of draws), spread over tasks."""
    blocks = -(-draws // _DRAW_BLOCK)
    exploded = df.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return exploded.repartition("experiment_name", "block").withColumn(
        "size", F.least(F.lit(_DRAW_BLOCK), F.lit(draws) - F.col("block") * _DRAW_BLOCK)
    )


def bayes_two_arms(counts: DataFrame, draws: int = 50_000, seed: int = 42) -> DataFrame:
    """Beta(1, 1) posteriors of both arms compared by simulation.

    ``counts`` has experiment_name, n_c, conv_c, n_t, conv_t. Blocks of draws are seeded by experiment and block and
    reduced by Spark.
    """

    def simulate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                rng = np.random.default_rng([seed, r.seed_key, r.block])
                c = rng.beta(1 + r.conv_c, 1 + r.n_c - r.conv_c, r.size)
                t = rng.beta(1 + r.conv_t, 1 + r.n_t - r.conv_t, r.size)
                gain, lift = t - c, (t - c) / c
                rows.append(
                    (
                        r.experiment_name,
                        int(r.size),
                        int((gain > 0).sum()),
                        float(np.maximum(gain, 0).sum()),
                        float(np.maximum(-gain, 0).sum()),
                        float(lift.sum()),
                        float((lift * lift).sum()),
                    )
                )
            yield pd.DataFrame(rows, columns=["experiment_name", "k", "wins", "loss_c", "loss_t", "s1", "s2"])

    keyed = counts.select(
        "experiment_name", "n_c", "conv_c", "n_t", "conv_t", F.crc32("experiment_name").alias("seed_key")
    )
    parts = _draw_blocks(keyed, draws).mapInPandas(
        simulate,
        "experiment_name string, k long, wins long, loss_c double, loss_t double, s1 double, s2 double",
    )
    k = F.sum("k")
    mean = F.sum("s1") / k
    return parts.groupBy("experiment_name").agg(
        (F.sum("wins") / k).alias("bayesian_prob_treatment_better"),
        (F.sum("loss_c") / k).alias("expected_loss_control"),
        (F.sum("loss_t") / k).alias("expected_loss_treatment"),
        mean.alias("lift_posterior_mean"),
        F.sqrt(F.greatest(F.sum("s2") / k - mean * mean, F.lit(0.0))).alias("lift_posterior_std"),
    )


def probability_best(arms: DataFrame, draws: int = 10_000, seed: int = 42) -> DataFrame:
    """Share of joint draws in which each arm's posterior sample is the largest.

    ``arms`` has experiment_name, arm, alpha, beta; the arms of one experiment (a handful by design) travel together.
    """

    def simulate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                rng = np.random.default_rng([seed, r.seed_key, r.block])
                samples = np.column_stack([rng.beta(a["alpha"], a["beta"], r.size) for a in r.arms])
                wins = np.bincount(samples.argmax(axis=1), minlength=len(r.arms))
                rows += [(r.experiment_name, a["arm"], int(w), int(r.size)) for a, w in zip(r.arms, wins)]
            yield pd.DataFrame(rows, columns=["experiment_name", "arm", "wins", "k"])

    packed = arms.groupBy("experiment_name").agg(
        F.array_sort(F.collect_list(F.struct("arm", "alpha", "beta"))).alias("arms"),
        F.first(F.crc32("experiment_name")).alias("seed_key"),
    )
    return (
        _draw_blocks(packed, draws)
        .mapInPandas(simulate, "experiment_name string, arm string, wins long, k long")
        .groupBy("experiment_name", "arm")
        .agg((F.sum("wins") / F.sum("k")).alias("probability_best"))
    )
