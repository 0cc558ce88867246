"""Items found together in the same group (order, customer).

Small groups go through a self-join, at most ``light_limit`` partners per row. A large group would square its size there, so
large groups are only ever multiplied block by block (``blocks``), which returns the best candidates. Nothing is capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.functions import attach_row, ratio
from cartwright.operators.blocks import best_partners
from cartwright.session import materialise

LIGHT_LIMIT = 1000


def split_by_size(cells: DataFrame, group: str, light_limit: int = LIGHT_LIMIT) -> tuple[DataFrame, DataFrame | None]:
    """Cells of groups within the limit and, if there are any, cells of larger groups."""
    large = cells.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > light_limit).select(group)
    large = materialise(large, "large-groups")
    if large.isEmpty():
        return cells, None
    return cells.join(large, group, "left_anti"), cells.join(large, group, "left_semi")


def light_pairs(cells: DataFrame, group: str, item: str, weight: str) -> DataFrame:
    """item_a < item_b and ``dot``, the sum of w_a * w_b over common groups; for groups of limited size."""
    a = cells.select(group, F.col(item).alias("item_a"), F.col(weight).alias("_wa"))
    b = cells.select(F.col(group).alias("_g"), F.col(item).alias("item_b"), F.col(weight).alias("_wb"))
    pairs = a.join(b, (F.col(group) == F.col("_g")) & (F.col("item_a") < F.col("item_b")))
    return pairs.groupBy("item_a", "item_b").agg(F.sum(F.col("_wa") * F.col("_wb")).alias("dot"))


def frequent_pairs(transactions: DataFrame, k: int = 50, light_limit: int = LIGHT_LIMIT) -> DataFrame:
    """The ``k`` product pairs found together in most orders, ties by product ids, with support, confidence and lift.

    A pair cannot occur more often than its rarer product: products in fewer orders than the k-th pair of the small orders
    has are left out of the block products. Category is taken as an attribute of the product.
    """
    lines = transactions.filter(F.col("revenue") > 0)
    baskets = materialise(lines.select("order_id", "product_id").distinct().withColumn("one", F.lit(1.0)), "baskets")
    light, heavy = split_by_size(baskets, "order_id", light_limit)
    counts = light_pairs(light, "order_id", "product_id", "one")
    in_orders = baskets.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    ranking = [F.desc("dot"), F.col("item_a"), F.col("item_b")]
    if heavy is not None:
        counts = materialise(counts, "light-pairs")
        top = counts.orderBy(*ranking).limit(k).agg(F.min("dot").alias("m"), F.count(F.lit(1)).alias("c")).first()
        floor = top["m"] if top["c"] == k else 0
        reachable = in_orders.filter(F.col("n") >= floor).select("product_id")
        heavy = materialise(heavy.join(reachable, "product_id", "left_semi"), "heavy-baskets")
        inside = heavy.select(F.col("product_id").alias("item_a")).distinct()
        known = counts.join(inside, "item_a", "left_semi").join(
            inside.select(F.col("item_a").alias("item_b")), "item_b", "left_semi"
        )
        cells = heavy.select(F.col("order_id").alias("k"), F.col("product_id").alias("id"), F.col("one").alias("w"))
        addends = known.select(F.col("item_a").alias("l"), F.col("item_b").alias("r"), F.col("dot").alias("v"))
        both = best_partners(cells, cells, k, addends, per_left=False)
        # A pair with a large order in it shows up with its small-order count too; the full count is the larger.
        counts = counts.orderBy(*ranking).limit(k).unionByName(
            both.select(F.col("l").alias("item_a"), F.col("r").alias("item_b"), F.col("score").alias("dot"))
        )
        counts = counts.groupBy("item_a", "item_b").agg(F.max("dot").alias("dot"))
    best = counts.orderBy(*ranking).limit(k)

    # k rows from here on, against per-product aggregates.
    catalogue = lines.groupBy("product_id").agg(F.min("category").alias("cat"))
    total = baskets.agg(F.count_distinct("order_id").alias("n_orders"))
    for side in ("a", "b"):
        info = catalogue.join(in_orders, "product_id").select(
            F.col("product_id").alias(f"item_{side}"), F.col("cat").alias(f"cat_{side}"), F.col("n").alias(f"n_{side}")
        )
        best = F.broadcast(best).join(info, f"item_{side}")
    n = F.col("n_orders")
    return (
        attach_row(best, total)
        .select(
            F.col("item_a").alias("product_a"),
            F.col("item_b").alias("product_b"),
            "cat_a",
            "cat_b",
            F.col("dot").cast("long").alias("co_occurrences"),
            ratio("dot", n).alias("support"),
            ratio("dot", "n_a").alias("confidence"),
            ratio(F.col("dot") * n, F.col("n_a") * F.col("n_b")).alias("lift"),
        )
        .orderBy(F.desc("co_occurrences"), "product_a", "product_b")
    )
