"""Whole-table ranks, running totals, order statistics and percentiles without a single-partition window.

Rows are laid out once by range of the full sort key, so ties on a hot value spread over partitions through the
remaining sort columns. The layout is written, which freezes the positions: a recomputed task reads the same rows.
Offsets between partitions are one row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.functions import attach_row
from cartwright.session import materialise

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above bit 33


def with_global_order(
    df: DataFrame,
    order_by: Sequence[Column | str],
    sums: dict[str, str] | None = None,
    rank: str = "rank",
) -> DataFrame:
    """Add the 1-based ``rank`` over ``order_by`` and inclusive running sums ``{new column: source column}``.

    ``order_by`` should be a unique key for a reproducible rank.
    """
    sums = sums or {}
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    laid_out = materialise(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_pos", F.monotonically_increasing_id()),
        "ordered",
    ).withColumn("_part", F.shiftright("_pos", _ROW_BITS))

    # One row per partition: safe to window over and to broadcast.
    totals = laid_out.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(src).alias(f"_t_{dst}") for dst, src in sums.items()]
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        *[F.sum(f"_t_{dst}").over(before).alias(f"_o_{dst}") for dst in sums],
    )

    local = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    out = laid_out.join(F.broadcast(offsets), "_part").withColumn(
        rank, F.col("_n0") + F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    )
    for dst, src in sums.items():
        out = out.withColumn(dst, F.sum(src).over(local) + F.coalesce(F.col(f"_o_{dst}"), F.lit(0)))
    return out.drop("_part", "_pos", "_n0", *[f"_o_{dst}" for dst in sums])


def rows_at_ranks(df: DataFrame, order_by: Sequence[Column | str], ranks: Sequence[int]) -> dict[int, dict]:
    """The rows standing at the given 1-based ranks, at most ``len(ranks)`` of them."""
    wanted = sorted(set(ranks))
    found = with_global_order(df, order_by).filter(F.col("rank").isin(wanted)).collect()
    return {r["rank"]: r.asDict() for r in found}


def rank_within(
    df: DataFrame,
    groups: Sequence[str],
    order_by: Sequence[Column | str],
    rank: str = "rank",
) -> DataFrame:
    """1-based rank inside each group, computed from the whole-table rank so that a hot group is not one task."""
    ordered = with_global_order(df, [*groups, *order_by], rank="_g")
    starts = ordered.groupBy(*groups).agg(F.min("_g").alias("_g0"))
    keep = [c for c in ordered.columns if c != "_g"]
    return _attach(ordered, starts, groups).select(*keep, (F.col("_g") - F.col("_g0") + 1).alias(rank))


def running_within(
    df: DataFrame,
    groups: Sequence[str],
    order_by: Sequence[Column | str],
    sums: dict[str, str],
    rank: str = "rank",
) -> DataFrame:
    """Rank and inclusive running sums inside each group. Pass exact (decimal or integer) columns to ``sums``: the
    group's value is a difference of whole-table totals."""
    ordered = with_global_order(df, [*groups, *order_by], sums, rank="_g")
    before = F.struct("_g", *[(F.col(dst) - F.coalesce(F.col(src), F.lit(0))).alias(dst) for dst, src in sums.items()])
    starts = ordered.groupBy(*groups).agg(F.min_by(before, "_g").alias("_start"))
    keep = [c for c in ordered.columns if c != "_g" and c not in sums]
    return _attach(ordered, starts, groups).select(
        *keep,
        (F.col("_g") - F.col("_start._g") + 1).alias(rank),
        *[(F.col(dst) - F.col(f"_start.{dst}")).alias(dst) for dst in sums],
    )


def _attach(rows: DataFrame, per_group: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Join per-group values back on null-safe group equality."""
    renamed = per_group.withColumnsRenamed({g: f"_k_{g}" for g in groups})
    cond = F.lit(True)
    for g in groups:
        cond = cond & rows[g].eqNullSafe(renamed[f"_k_{g}"])
    return rows.join(renamed, cond).drop(*[f"_k_{g}" for g in groups])


def grouped_percentiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    probs: dict[str, float],
) -> DataFrame:
    """Exact linearly interpolated percentiles ``{column: probability}`` per group (all rows if no groups)."""
    cells = df.filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_c"))
    running = with_global_order(cells, [*groups, value], sums={"_cum": "_c"}).withColumn(
        "_before", F.col("_cum") - F.col("_c")
    )
    bounds = running.groupBy(*groups).agg(F.min("_before").alias("_base"), F.sum("_c").alias("_size"))
    placed = (_attach(running, bounds, groups) if groups else attach_row(running, bounds)).select(
        *groups,
        F.col(value).alias("_v"),
        (F.col("_before") - F.col("_base")).alias("_from"),
        (F.col("_cum") - F.col("_base")).alias("_to"),
        "_size",
    )
    aggs = []
    for name, p in probs.items():
        pos = (F.col("_size") - 1) * F.lit(float(p))
        for side, at in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            inside = (F.col("_from") <= at) & (at < F.col("_to"))
            aggs.append(F.max(F.when(inside, F.col("_v"))).alias(f"_{side}_{name}"))
    picked = placed.groupBy(*groups).agg(F.max("_size").alias("_size"), *aggs)
    out = []
    for name, p in probs.items():
        pos = (F.col("_size") - 1) * F.lit(float(p))
        lo, hi = F.col(f"_lo_{name}").cast("double"), F.col(f"_hi_{name}").cast("double")
        out.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    return picked.select(*groups, *out)
