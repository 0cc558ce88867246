"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a fixed shuffled order, repeated up to ``max_repeats`` times. A document's
virtual finish time is the words its source has sent up to its end, divided by the source's target. The mix is the
queue entries in order of finish time, up to the total budget. Both orders are laid out by range, so neither a hot source nor the
whole mix is one task.

Defined cases: a null text has size 0 and is taken 0 words; a null source is a source of its own, last in order;
repeated rows are documents of their own; an empty table gives an empty mix; weights repeat over any number of sources.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.operators.ordering import running_within, with_global_order
from cartwright.session import materialise


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than space and the controls 9 to 13."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[float], max_repeats: int = 3, budget: float | None = None
) -> DataFrame:
    """Target words per source: the budget shared by weight, no target above ``max_repeats`` times its source.

    What a capped source cannot use is shared again by weight. The result is the water level at which shares and
    caps add up to the budget, found on one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighted = per_source.withColumn(
        "weight", F.get(cycle, ((F.row_number().over(order) - 1) % len(weights)).cast("int"))
    ).withColumn("cap", F.col("source_size") * float(max_repeats))
    # Sources by rising cap per weight: those before the level are capped, the others get level times weight.
    rising = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    after = rising.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything).cast("double") if budget is None else F.lit(float(budget))
    levels = weighted.select(
        "*",
        ((total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)).alias("_level"),
    )
    # Past the turning point the level only falls, so the first fitting one is the largest.
    level = F.max(F.when(F.col("_level") * F.col("weight") <= F.col("cap"), F.col("_level"))).over(everything)
    return levels.withColumn("_water", level).select(
        "source", "source_size", F.least(F.coalesce(F.col("_water") * F.col("weight"), "cap"), "cap").alias("target")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float],
    max_repeats: int = 3,
    budget: float | None = None,
    seed: int = 17,
    key: str = "doc_id",
    size: Column | None = None,
) -> DataFrame:
    """One row per document: key, source, size, source_size, target, copies, taken."""
    sized = materialise(
        docs.select(
            F.col(key).alias("_key"),
            F.col("source"),
            (word_count(F.col("text")) if size is None else size).alias("size"),
            F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string"))).alias("_shuffle"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "mix-sizes",
    )
    targets = materialise(source_targets(sized, weights, max_repeats, budget), "mix-targets")
    # _row only separates repeated rows; it is frozen by the write above.
    queued = running_within(sized, ["source"], ["_shuffle", "_key", "_row"], {"_sent": "size"}).drop("rank")
    renamed = targets.withColumnRenamed("source", "_s")
    placed = queued.join(renamed, queued["source"].eqNullSafe(renamed["_s"])).drop("_s")
    placed = materialise(placed, "mix-queue")
    entries = (
        placed.filter(F.col("size") > 0)
        .withColumn("_turn", F.explode(F.array(*[F.lit(i) for i in range(max_repeats)])))
        .withColumn("_finish", (F.col("_turn") * F.col("source_size") + F.col("_sent")) / F.col("target"))
        # Finish time 1 is the target; a document that crosses it is still in the queue for the last places.
        .filter(F.col("_finish") - F.col("size") / F.col("target") <= 1.0)
        .select("_row", "size", "_finish", "_shuffle", "_turn")
    )
    total = targets.agg(F.sum("target").alias("_budget"))
    sent = with_global_order(entries, ["_finish", "_shuffle", "_row", "_turn"], {"_mixed": "size"})
    within = sent.crossJoin(F.broadcast(total)).filter(F.col("_mixed") <= F.col("_budget"))  # one row
    copies = within.groupBy("_row").agg(F.count(F.lit(1)).alias("copies"))
    return (
        placed.join(copies, "_row", "left")
        .withColumn("copies", F.coalesce("copies", F.lit(0)))
        .select(
            F.col("_key").alias(key),
            "source",
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
        )
    )
