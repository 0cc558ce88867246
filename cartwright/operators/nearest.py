"""Nearest vectors by dot product, exact, without forming the pairs.

Ids hash to blocks, one row a block, whose points lie in boxes (a k-d tree's leaves). A task has one left block and reads all
right blocks one after the other. As ``2 x.y = |x|^2 + |y|^2 - |x - y|^2``, the distance of two boxes bounds the products of
their points, and a box is read only if it may hold one of the ``n`` best of a point in the left box.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.operators.blocks import SCORE_DIGITS, _block
from cartwright.operators.products import _blocks_of, _coded, _place, _ranked, _unpacked
from cartwright.session import materialise

BLOCK_VALUES = 4_000_000  # numbers of a block
LEFT_POINTS = 60_000
LEAST_POINTS = 2_000  # smaller tables are not cut further for the sake of parallel tasks
LEAF = 64
READ = 16  # boxes read at a time


def _leaves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the points by boxes of at most ``LEAF``, halves along the widest side, and where each box begins."""
    order, starts, open_ = np.arange(len(x)), [], [(0, len(x))]
    while open_:
        lo, hi = open_.pop()
        if hi - lo <= LEAF:
            starts.append(lo)
            continue
        part = x[order[lo:hi]]
        wide = part[:, np.argmax(part.max(axis=0) - part.min(axis=0))]
        mid = (hi - lo) // 2
        order[lo:hi] = order[lo:hi][np.argpartition(wide, mid)]
        open_ += [(lo, lo + mid), (lo + mid, hi)]
    return order, np.array(sorted(starts), np.int32)


def _points(held: dict[str, pa.Array]) -> dict[str, pa.Array]:
    """Ids and vectors by box; the vectors of a repeated id add up."""
    codes, ids = _coded(held.pop("id"))
    vectors = held.pop("x")
    x = np.zeros((len(ids), len(vectors.values) // len(vectors)))
    np.add.at(x, codes, vectors.flatten().to_numpy().reshape(len(vectors), -1))
    order, starts = _leaves(x)
    return {"ids": ids.take(pa.array(order)), "x": pa.array(x[order].ravel()), "starts": pa.array(starts)}


class _Boxes:
    def __init__(self, block: dict[str, pa.Array]):
        self.ids, starts = block["ids"], block["starts"].to_numpy()
        self.x = block["x"].to_numpy().reshape(len(self.ids), -1)
        self.at = np.append(starts, len(self.ids))
        self.low, self.high = np.minimum.reduceat(self.x, starts), np.maximum.reduceat(self.x, starts)
        self.square = np.maximum.reduceat((self.x * self.x).sum(axis=1), starts)

    def bounds(self, low: np.ndarray, high: np.ndarray, square: float) -> np.ndarray:
        """At least the products of each box's points with those of one box."""
        apart = np.maximum(np.maximum(self.low - high, low - self.high), 0)
        return (self.square + square - (apart * apart).sum(axis=1)) / 2


def _rounded(score: np.ndarray) -> np.ndarray:
    return np.floor(score * 10.0**SCORE_DIGITS + 0.5) / 10.0**SCORE_DIGITS


def _search(left: _Boxes, right: _Boxes, floor: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Left point, right point and score of the best ``n`` on the right that reach the left points' ``floor``."""
    own = pc.index_in(left.ids, right.ids).fill_null(-1).to_numpy()
    place = pc.rank(right.ids).to_numpy().astype(np.int64)
    found = []
    for box in range(len(left.at) - 1):
        a, b = int(left.at[box]), int(left.at[box + 1])
        x, least = left.x[a:b], floor[a:b].copy()
        bounds = right.bounds(left.low[box], left.high[box], left.square[box])
        near = np.argsort(-bounds, kind="stable")
        row, col, score = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        done = 0
        while done < len(near):
            # The scores of the points left are below the floor of every row; slack for rounding.
            wanted = int(np.searchsorted(-bounds[near], -(least.min() - 2.0 / 10**SCORE_DIGITS), "right"))
            if wanted <= done:
                break
            some = near[done : min(wanted, done + READ)]
            done += len(some)
            cols = np.concatenate([np.arange(right.at[i], right.at[i + 1]) for i in some])
            scores = _rounded(x @ right.x[cols].T)
            scores[own[a:b, None] == cols] = -np.inf
            if scores.shape[1] > n:
                reach = np.maximum(least, np.partition(scores, -n, axis=1)[:, -n])
            else:
                reach = least
            r, c = np.nonzero((scores >= reach[:, None]) & (scores > -np.inf))
            row, col, score = np.concatenate([row, r]), np.concatenate([col, cols[c]]), np.concatenate([score, scores[r, c]])
            top = _ranked(row, place[col], score, n)
            row, col, score = row[top], col[top], score[top]
            last = _place(row) == n - 1
            least[row[last]] = np.maximum(least[row[last]], score[last])
        found.append((row + a, col, score))
    return tuple(np.concatenate(x) for x in zip(*found))


def nearest(vectors: DataFrame, n: int) -> DataFrame:
    """``l, r, score, rank``: the ``n`` other ids of every id with the largest dot product at seven decimals, ties to the
    smaller id. ``vectors`` has id and x, an array of one length in all rows; null or non-finite numbers rule an id out."""
    odd = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = materialise(vectors.select("id", F.col("x").cast("array<double>").alias("x")).filter(~odd & F.col("id").isNotNull()), "vectors")
    kind = usable.schema["id"].dataType.simpleString()
    total, length = usable.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    r_blocks = max(1, -(-total * (length or 1) // BLOCK_VALUES))
    l_blocks = max(1, -(-total // LEFT_POINTS), min(-(-total // LEAST_POINTS), 3 * cores))
    rows = [_blocks_of(usable.withColumn("b", _block("id", c)), c, _points).select("cells") for c in (r_blocks, l_blocks)]
    right = materialise(rows[0].withColumnRenamed("cells", "right"), "right-points", compression="none")
    pairs = right.coalesce(1).join(rows[1].withColumnRenamed("cells", "left").hint("shuffle_replicate_nl"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            for i in range(batch.num_rows):
                if left is None:
                    left = _Boxes(_unpacked(batch.column("left")[i]))
                    row, score, partner = np.zeros(0, int), np.zeros(0), left.ids.slice(0, 0)
                right = _Boxes(_unpacked(batch.column("right")[i]))
                floor = np.full(len(left.ids), -np.inf)
                last = _place(row) == n - 1
                floor[row[last]] = score[last]
                r, c, s = _search(left, right, floor, n)
                row, score = np.concatenate([row, r]), np.concatenate([score, s])
                partner = pa.concat_arrays([partner, right.ids.take(pa.array(c))])
                top = _ranked(row, pc.rank(partner, tiebreaker="dense").to_numpy().astype(np.int64), score, n)
                row, score, partner = row[top], score[top], partner.take(pa.array(top))
            del batch
        if left is not None:
            found = [left.ids.take(pa.array(row)), partner, pa.array(score), pa.array(_place(row).astype(np.int32) + 1)]
            yield pa.RecordBatch.from_arrays(found, ["l", "r", "score", "rank"])

    return pairs.mapInArrow(search, f"l {kind}, r {kind}, score double, rank int")
