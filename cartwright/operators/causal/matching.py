"""Greedy nearest-pair matching along one score, without replacement, in a number of jobs that depends on the input size alone.

The rule: of all free treated and control units closer than the caliper, the closest pair is taken, until there is none; ties go to the
lower score. Units of one score and arm are alike, so the search runs on cells (score, arm, count): units of both arms at one
score are paired first, and what is left of a score is one cell however many units share it.

Cells are cut into ranges of the score. Inside a range a heap takes the closest neighbouring cells of different arms. What lies beyond
a range is not known, only where it begins; a cell is *open* as soon as something beyond, or another open cell, could take it at the
distance the heap has reached. A pair of cells that are not open is taken in every case. Open cells stay for the next round, whose
ranges are ``_WIDER`` times as wide, until one range holds the last of them. Chains of shrinking gaps across a border are open cells
like others. The rounds thus give what one heap over all cells would give.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwright.operators.ordering import rank_within
from cartwright.session import materialise

_WIDER = 16
_BLOCK = 1_024  # ranks of a cell that are looked up together


def settle(
    value: np.ndarray, arm: np.ndarray, count: np.ndarray, low: float, high: float, caliper: float
) -> tuple[list[tuple[int, int, int, int, int]], np.ndarray, np.ndarray]:
    """Pairs of cells (treated, its first unit, control, its first unit, units) that are certain, units used, and open cells.

    ``value`` ascends strictly; ``low`` and ``high`` are the nearest scores outside (infinite where there is nothing).
    """
    n = len(value)
    used, left = np.zeros(n, np.int64), count.copy()
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    open_ = np.zeros(n, bool)
    heap = [(value[i + 1] - value[i], i, i + 1) for i in range(n - 1) if arm[i] != arm[i + 1]]
    heapq.heapify(heap)
    pairs = []
    edges = {"first": 0 if n else -1, "last": n - 1}
    below, above = [-math.inf, -math.inf], [math.inf, math.inf]  # nearest open cell of each arm on either side

    def close_in(distance: float, strict: bool) -> None:
        """Open the outermost cells that something outside could have taken by now."""
        while 0 <= edges["first"] < n and not open_[edges["first"]]:
            b = edges["first"]
            threat = value[b] - max(low, below[1 - arm[b]])
            if not (threat < distance or (threat == distance and not strict)):
                break
            open_[b], below[arm[b]], edges["first"] = True, value[b], after[b]
        while 0 <= edges["last"] < n and not open_[edges["last"]]:
            b = edges["last"]
            threat = min(high, above[1 - arm[b]]) - value[b]
            if not (threat < distance or (threat == distance and not strict)):
                break
            open_[b], above[arm[b]], edges["last"] = True, value[b], before[b]

    def drop(i: int) -> None:
        b, a = before[i], after[i]
        if b >= 0:
            after[b] = a
        if a < n:
            before[a] = b
        if edges["first"] == i:
            edges["first"] = a
        if edges["last"] == i:
            edges["last"] = b

    while heap and heap[0][0] < caliper:
        distance, i, j = heapq.heappop(heap)
        if left[i] == 0 or left[j] == 0 or after[i] != j:
            continue
        close_in(distance, strict=False)
        if open_[i] or open_[j]:
            continue
        t, c = (i, j) if arm[i] else (j, i)
        k = int(min(left[i], left[j]))
        pairs.append((t, int(used[t]), c, int(used[c]), k))
        used[[i, j]] += k
        left[[i, j]] -= k
        b, a = before[i], after[j]
        if left[i] == 0:
            drop(i)
        else:
            b = i
        if left[j] == 0:
            drop(j)
        else:
            a = j
        if b >= 0 and a < n and arm[b] != arm[a]:
            heapq.heappush(heap, (value[a] - value[b], b, a))
    close_in(caliper, strict=True)
    return pairs, used, open_ & (left > 0)


def _round(caliper: float) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("value").to_numpy(), kind="stable")
        value, arm, count, used = (table.column(c).to_numpy()[order] for c in ("value", "arm", "count", "used"))
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        pairs, now, open_ = settle(
            value, arm, count, -math.inf if low is None else low, math.inf if high is None else high, caliper
        )
        t, t_at, c, c_at, n = (np.array(x, np.int64) for x in (zip(*pairs) if pairs else ([],) * 5))
        rest = np.flatnonzero(open_)
        none = np.full(len(rest), np.nan)
        return pa.table(
            {
                "t_value": np.concatenate((value[t], value[rest])),
                "t_at": np.concatenate((used[t] + t_at, used[rest] + now[rest])),
                "c_value": pa.array(np.concatenate((value[c], none)), from_pandas=True),
                "c_at": np.concatenate((used[c] + c_at, np.zeros(len(rest), np.int64))),
                "n": np.concatenate((n, count[rest] - now[rest])),
                "arm": np.concatenate((np.full(len(t), -1), arm[rest])).astype(np.int32),
            }
        )

    return run


def match_cells(cells: DataFrame, caliper: float, per_range: int = 200_000) -> DataFrame:
    """t_value, t_at, c_value, c_at, n: n treated units of a score from its t_at-th on are paired with n control units.

    ``cells`` has value, treated and control (counts). A score occurs once.
    """
    both = F.least("treated", "control")
    cells = materialise(cells.select("value", "treated", "control"), "cells")
    columns = ["t_value", "t_at", "c_value", "c_at", "n"]
    zero = F.lit(0).cast("long")
    found = cells.filter(both > 0).select(
        F.col("value").alias("t_value"), zero.alias("t_at"), F.col("value").alias("c_value"), zero.alias("c_at"), both.alias("n")
    )
    found = found if caliper > 0 else found.limit(0)
    rest = cells.filter("treated != control").select(
        "value",
        (F.col("treated") > F.col("control")).cast("int").alias("arm"),
        F.abs(F.col("treated") - F.col("control")).alias("count"),
        both.alias("used"),
    )
    ranges = max(1, -(-rest.count() // per_range))
    while True:
        # The written layout fixes which range a cell belongs to; its bounds are one row a range.
        laid = materialise(rest.repartitionByRange(ranges, "value").withColumn("range", F.spark_partition_id()), "cells")
        spans = laid.groupBy("range").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
        near = Window.orderBy("range")
        spans = spans.select("range", F.lag("hi").over(near).alias("low"), F.lead("lo").over(near).alias("high"))
        settled = laid.join(F.broadcast(spans), "range").groupBy("range").applyInArrow(
            _round(caliper), "t_value double, t_at long, c_value double, c_at long, n long, arm int"
        )
        settled = materialise(settled, "settled")
        found = found.unionByName(settled.filter("arm < 0").select(*columns))
        if ranges == 1:
            return found
        rest = settled.filter("arm >= 0").select(F.col("t_value").alias("value"), "arm", F.col("n").alias("count"), F.col("t_at").alias("used"))
        ranges = -(-ranges // _WIDER)


def match_units(units: DataFrame, caliper: float, per_range: int = 200_000) -> DataFrame:
    """t_id, c_id, distance for units ``id, treated (0 or 1), propensity``; a unit's turn in its score follows a hash of its id."""
    arms = units.withColumn("turn", F.xxhash64("id"))
    cells = units.groupBy(F.col("propensity").alias("value")).agg(
        F.sum(F.col("treated").cast("long")).alias("treated"), F.sum(1 - F.col("treated").cast("long")).alias("control")
    )
    pairs = match_cells(cells, caliper, per_range)
    pairs = materialise(pairs.withColumn("pair", F.monotonically_increasing_id()), "cell-pairs")
    ranked = materialise(rank_within(arms, ["propensity", "treated"], ["turn", "id"], "place"), "ranked")
    place = F.col("place") - 1
    ranked = ranked.select("id", "treated", "propensity", place.alias("place"), F.floor(place / _BLOCK).alias("block"))

    def side(arm: int, value: str, at: str, name: str) -> DataFrame:
        last = F.col(at) + F.col("n") - 1
        blocks = F.explode(F.sequence(F.floor(F.col(at) / _BLOCK), F.floor(last / _BLOCK)))
        wanted = pairs.select("pair", F.col(value).alias("_value"), F.col(at).alias("_at"), "n", blocks.alias("_block"))
        held = ranked.filter(F.col("treated") == arm)
        joined = held.join(wanted, (F.col("propensity") == F.col("_value")) & (F.col("block") == F.col("_block")))
        inside = (F.col("place") >= F.col("_at")) & (F.col("place") < F.col("_at") + F.col("n"))
        return joined.filter(inside).select(
            "pair", (F.col("place") - F.col("_at")).alias("step"), F.col("id").alias(f"{name}_id"), F.col("propensity").alias(f"{name}_p")
        )

    return side(1, "t_value", "t_at", "t").join(side(0, "c_value", "c_at", "c"), ["pair", "step"]).select(
        "t_id", "c_id", F.abs(F.col("t_p") - F.col("c_p")).alias("distance")
    )
