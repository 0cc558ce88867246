"""Time-to-next-purchase analysis: event derivation, product-limit curves and concordance."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwright.functions import attach_row, elapsed_days
from cartwright.session import materialise

# Covariates of the survival models.
FEATURES = [
    "frequency", "monetary", "avg_order_value", "total_items", "distinct_categories", "purchase_rate", "R_score",
    "F_score", "M_score", "RFM_score", "clv_12m", "log_recency", "log_frequency", "log_monetary",
]


def survival_data(rfm: DataFrame, as_of: str) -> DataFrame:
    """Add duration ``T`` (whole days) and event ``E``.

    With first and last purchase known, the event is a purchase within 1.5 times the customer's usual gap; otherwise
    recency below twice its median decides. The median is over whole days, so its buffer is small.
    """
    cols = set(rfm.columns)
    if {"last_purchase", "first_purchase"} <= cols:
        gap = elapsed_days("last_purchase", "first_purchase") / F.greatest(F.col("frequency"), F.lit(1))
        t = elapsed_days(F.lit(as_of).cast("timestamp"), "last_purchase")
        return rfm.withColumn("T", t).withColumn("E", (F.col("T") <= gap * 1.5).cast("int"))
    median = rfm.agg(F.median("recency").alias("_median"))
    t = F.col("recency") if "last_purchase" in cols else F.coalesce("recency", F.col("_median")).cast("long")
    return (
        attach_row(rfm, median)
        .withColumn("T", t)
        .withColumn("E", (F.col("T") < F.col("_median") * 2).cast("int"))
        .drop("_median")
    )


def kaplan_meier(data: DataFrame, groups: list[str]) -> DataFrame:
    """Product-limit curve per group. Customers collapse to counts per day first; windows run over days."""
    days = data.groupBy(*groups, "T").agg(F.sum("E").alias("events"), F.count(F.lit(1)).alias("leaving"))
    down = Window.partitionBy(*groups).orderBy(F.desc("T")).rowsBetween(Window.unboundedPreceding, 0)
    up = Window.partitionBy(*groups).orderBy("T").rowsBetween(Window.unboundedPreceding, 0)
    at_risk = days.withColumn("at_risk", F.sum("leaving").over(down))
    share = 1 - F.col("events") / F.col("at_risk")
    log_step = F.when(share > 0, F.ln(share)).otherwise(0.0)
    gone = F.max((share <= 0).cast("int")).over(up)
    survival = F.when(gone == 1, 0.0).otherwise(F.exp(F.sum(log_step).over(up)))
    return at_risk.withColumn("survival", survival).select(*groups, "T", "events", "at_risk", "survival")


def median_survival(curve: DataFrame, groups: list[str]) -> DataFrame:
    """First time the curve is at or below one half; null if it never gets there."""
    return curve.groupBy(*groups).agg(F.min(F.when(F.col("survival") <= 0.5 + 1e-12, F.col("T"))).alias("median_T"))


def survival_at(curve: DataFrame, groups: list[str], until: int = 364, step: int = 7) -> DataFrame:
    """Curve value at grid times, 1 before the first observed day."""
    grid = curve.select(*groups).distinct().withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(until), F.lit(step))))
    points = curve.select(*groups, F.col("T").cast("int").alias("at"), "survival")
    merged = grid.withColumn("_grid", F.lit(True)).join(points, [*groups, "at"], "full")
    so_far = Window.partitionBy(*groups).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    return (
        merged.withColumn("survival", F.coalesce(F.last("survival", ignorenulls=True).over(so_far), F.lit(1.0)))
        .filter("_grid")
        .select(*groups, "at", "survival")
    )


def next_purchase_days(data: DataFrame, group: str = "segment") -> DataFrame:
    """Each customer with the median time of their group's curve."""
    medians = median_survival(kaplan_meier(data, [group]), [group])
    return data.join(medians, group, "left").withColumnRenamed("median_T", "predicted_next_purchase_days")


def _later_below(t: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Per position, the total ``n`` of earlier positions with a larger ``t``.

    Merge counting, one vectorised pass per block size: a position in a block's right half meets the left half's rows
    that come after it in time order.
    """
    size = len(t)
    at = np.arange(size)
    day = np.unique(t, return_inverse=True)[1].astype(np.int64)
    out = np.zeros(size, dtype=np.int64)
    for level in range(max(size - 1, 0).bit_length()):
        block, right = at >> (level + 1), (at >> level) & 1
        # Of equal times the left half comes first, so that it is not counted as later.
        order = np.argsort((block * (int(day.max()) + 1) + day) * 2 + right)
        held = np.where(right[order] == 0, n[order], 0)
        last = np.searchsorted(block[order], block[order], side="right") - 1
        seen = np.cumsum(held)
        out[order] += np.where(right[order] == 1, seen[last] - seen, 0)
    return out


def concordance(data: DataFrame, risk: str = "risk", slices: int | None = None) -> DataFrame:
    """Concordance index: among comparable pairs, how often the higher risk has the shorter time.

    Pairs are never formed. Customers collapse to (risk, time) counts laid out by risk range. Pairs within a range are
    counted by merging; for pairs of two ranges a table of ranges x days holds the customers that leave after each day,
    summed over the lower ranges by a window per day, so it grows in proportion to the ranges. A censored time counts as
    just after an event on the same day. Equal risks count one half. Rows without risk, time or event are left out; an
    empty table has a null index.
    """
    order = (2 * F.col("T") + (1 - F.col("E"))).cast("long")
    cells = (
        data.select(F.col(risk).cast("double").alias("risk"), order.alias("t"), "E")
        .filter(F.col("risk").isNotNull() & F.col("t").isNotNull())
        .groupBy("risk", "t")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("E").cast("long").alias("events"))
    )
    cells = materialise(cells, "risk-cells")
    slices = slices or cells.count() // 100_000 + 1  # a slice stays of one size, their number grows
    laid = materialise(
        cells.repartitionByRange(slices, "risk", "t")
        .sortWithinPartitions("risk", "t")
        .withColumn("_pos", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("_pos", 33)),
        "concordance",
    )

    def within(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["risk", "t"])
        # Cells of the same risk before a cell have earlier days, so only lower risks count here.
        later = _later_below(rows["t"].to_numpy(np.int64), rows["n"].to_numpy(np.int64))
        return pd.DataFrame({"won": [int(rows["events"].to_numpy(np.int64) @ later)]})

    inside = laid.groupBy("part").applyInPandas(within, "won long")
    grid = laid.select("t").distinct().withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)).cast("array<bigint>")))
    held = laid.groupBy("part", "t").agg(F.sum("n").alias("n"), F.sum("events").alias("events"))
    after = Window.partitionBy("part").orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, -1)
    lower = Window.partitionBy("t").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    across = (
        grid.join(held, ["part", "t"], "left")
        .withColumn("later", F.coalesce(F.sum("n").over(after), F.lit(0)))
        .withColumn("won", F.col("events") * F.sum("later").over(lower))
        .select("won")
    )
    won = inside.unionAll(across)
    later_same_risk = Window.partitionBy("risk").orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, -1)
    tied = laid.withColumn("later", F.coalesce(F.sum("n").over(later_same_risk), F.lit(0)))
    later_days = Window.orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, -1)
    per_day = cells.groupBy("t").agg(F.sum("n").alias("n"), F.sum("events").alias("events"))
    pairs = per_day.withColumn("later", F.coalesce(F.sum("n").over(later_days), F.lit(0)))
    count_later = F.sum(F.col("events") * F.col("later")).cast("double")
    totals = attach_row(won.agg(F.sum("won").cast("double").alias("concordant")), tied.agg(count_later.alias("tied")))
    totals = attach_row(totals, pairs.agg(count_later.alias("comparable")))
    return totals.withColumn(
        "concordance_index",
        (F.col("concordant") + F.col("tied") / 2) / F.nullif(F.col("comparable"), F.lit(0.0)),
    )
