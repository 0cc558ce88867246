"""Best partners under a sum of products, without forming the pairs.

``score(l, r) = sum over k of left[k, l] * right[k, r] + addend(l, r)``, and only the best ``n`` are wanted. Ids on both sides
hash to blocks. A task receives one (left block, right block), adds up its scores in memory while the rows stream in, and
returns the best few. What crosses the network is one row per k and block pair plus the answers, however many ids a single k
holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_IDS = 512
SCORE_DIGITS = 7  # sums of doubles depend on row order in their last bits; ranking on rounded scores is reproducible


def rounded_score(score: Column) -> Column:
    """A sum of positive products at seven significant digits, half up in double arithmetic.

    Small scores keep their order; ``round`` would tie them all at 0, and go through decimals on every candidate row.
    """
    unit = F.pow(F.lit(10.0), SCORE_DIGITS - 1 - F.floor(F.log10(F.abs(score))))
    return F.when(score == 0, score).otherwise(F.floor(score * unit + 0.5) / unit)


def _significant(score: np.ndarray) -> np.ndarray:
    """The same on an array; rows that are zero or not finite stay."""
    out = score.copy()
    some = np.isfinite(score) & (score != 0)
    shift = (SCORE_DIGITS - 1 - np.floor(np.log10(np.abs(score[some])))).astype(int)
    powers, at = np.unique(shift, return_inverse=True)
    unit = np.array([10.0 ** int(k) for k in powers])[at] if len(powers) else np.ones(0)
    out[some] = np.floor(score[some] * unit + 0.5) / unit
    return out


def block_count(ids: DataFrame) -> int:
    """Blocks needed for the distinct ids of a one-column table."""
    return max(1, -(-ids.distinct().count() // BLOCK_IDS))


def _block(c: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")


def _packed(cells: DataFrame, side: str, blocks: int) -> DataFrame:
    """One row per (k, block): ids and weights as arrays of about one block's size."""
    entries = F.collect_list(F.struct("id", F.col("w").cast("double").alias("w")))
    packed = cells.groupBy("k", _block("id", blocks).alias(f"{side}b")).agg(entries.alias("e"))
    return packed.select("k", f"{side}b", F.col("e.id").alias(f"{side}_ids"), F.col("e.w").alias(f"{side}_w"))


def best_partners(
    left: DataFrame,
    right: DataFrame,
    n: int,
    addends: DataFrame | None = None,
    per_left: bool = True,
    positive_only: bool = True,
    same_ids: bool = True,
) -> DataFrame:
    """Candidates ``l, r, score`` holding every pair that can be among the best.

    ``left`` and ``right`` have k, id, w; ``addends`` has l, r, v (minus infinity rules a pair out). With ``per_left`` each
    block pair returns the best ``n`` of every left id, an id never being its own partner where both sides hold the
    ``same_ids``; otherwise the best ``n`` pairs with l < r. Scores per left id are rounded before ranking: to significant
    digits if all products are positive, to seven decimals if their signs may cancel (``positive_only`` off); those of pairs
    are counts and stay. Ties go to the smaller ids. The caller ranks the candidates of all block pairs.
    """
    lblocks, rblocks = block_count(left.select("id")), block_count(right.select("id"))
    every = F.explode(F.sequence(F.lit(0), F.lit(rblocks - 1)))
    # Joining on (k, right block) spreads a k with very many ids over tasks.
    routed = _packed(left, "l", lblocks).withColumn("rb", every)
    products = routed.join(_packed(right, "r", rblocks), ["k", "rb"]).select("lb", "rb", "l_ids", "l_w", "r_ids", "r_w")
    if addends is not None:
        single = addends.select(
            _block("l", lblocks).alias("lb"),
            _block("r", rblocks).alias("rb"),
            F.array("l").alias("l_ids"),
            F.array(F.col("v").cast("double")).alias("l_w"),
            F.array("r").alias("r_ids"),
            F.array(F.lit(1.0)).alias("r_w"),
        )
        products = products.unionByName(single)
    digits = float(10**SCORE_DIGITS)

    def add_up(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at: tuple[dict, dict] = ({}, {})
        acc = np.zeros((64, 64))

        def positions(side: int, ids: np.ndarray) -> np.ndarray:
            known = at[side]
            for i in ids:
                if i not in known:
                    known[i] = len(known)
            return np.fromiter((known[i] for i in ids), int, len(ids))

        def fit() -> np.ndarray:
            need = [max(s, 1 << (max(len(a), 1) - 1).bit_length()) for s, a in zip(acc.shape, at)]
            return np.pad(acc, [(0, m - s) for m, s in zip(need, acc.shape)])

        for pdf in batches:
            lone = (pdf["l_ids"].str.len() == 1) & (pdf["r_ids"].str.len() == 1)
            if lone.any():
                some = pdf[lone]
                rows = positions(0, np.concatenate(some["l_ids"].to_numpy()))
                cols = positions(1, np.concatenate(some["r_ids"].to_numpy()))
                acc = fit()
                values = np.concatenate(some["l_w"].to_numpy()) * np.concatenate(some["r_w"].to_numpy())
                np.add.at(acc, (rows, cols), values)
            for row in pdf[~lone].itertuples(index=False):
                rows, cols = positions(0, row.l_ids), positions(1, row.r_ids)
                acc = fit()
                acc[np.ix_(rows, cols)] += np.outer(row.l_w, row.r_w)
        ids = [np.array(list(a)) for a in at]
        orders = [np.argsort(x, kind="stable") for x in ids]
        a, b = ids[0][orders[0]], ids[1][orders[1]]
        exact = acc[np.ix_(orders[0], orders[1])]
        if not per_left:
            score = exact
        else:
            score = _significant(exact) if positive_only else np.floor(exact * digits + 0.5) / digits
        usable = np.isfinite(score)
        if positive_only:  # judged before rounding: a small score is still one
            usable &= exact > 0
        if not per_left:
            usable &= a[:, None] < b[None, :]
        elif same_ids:
            usable &= a[:, None] != b[None, :]
        score = np.where(usable, score, -np.inf)
        if per_left:
            picked = np.argsort(-score, axis=1, kind="stable")[:, :n]
            rows = np.repeat(np.arange(len(a)), picked.shape[1])
            cols = picked.ravel()
        else:
            rows, cols = np.unravel_index(np.argsort(-score, axis=None, kind="stable")[:n], score.shape)
        out = pd.DataFrame({"l": a[rows], "r": b[cols], "score": score[rows, cols]})
        yield out[np.isfinite(out["score"])]

    kinds = left.schema["id"].dataType.simpleString(), right.schema["id"].dataType.simpleString()
    return products.groupBy("lb", "rb").applyInPandas(add_up, f"l {kinds[0]}, r {kinds[1]}, score double")
