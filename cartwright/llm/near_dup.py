"""Near-duplicate vectors by collision counting on random one-dimensional projections.

Every line is a random direction on which vectors are sorted; two vectors collide on it when their projections lie within a
window centred on either. One direction tells near and far vectors apart by a factor of about three at best, so that counting over
whole lines means nearly all pairs. A line is therefore sorted within the cells of a few random hyperplanes of its own: a
collision needs the same cell and the window. Pairs with at least ``needed`` collisions over all lines are verified by
their cosine in double precision. The number of lines is calibrated so that a pair at the threshold itself reaches
``needed`` with probability ``recall``; nearer pairs do so nearly always.

Equal vectors are folded first and carry their number. Cells are packed into tasks of bounded size; a cell above ``block``
rows is split into blocks that meet pairwise, so no group lands whole in one task. Tasks return counts per vector and the stars of
their components, never pairs; a pair is counted on the line of its ``needed``-th collision only.

Defined cases: vectors that are null, zero or hold null or non-finite components link with nothing and are their own
component; vectors of different length never link; equal vectors of different rows link; rows with a null id get no
links, a null component and kept false. Repeated rows count as other vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import components
from cartwright.session import materialise

_NEEDED = 2
_WINDOW = 2.0  # half width of a window in standard deviations of the projected difference at the threshold


def calibrate(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """Hyperplanes per line and number of lines for ``n`` vectors."""
    bits = max(2, math.ceil(math.log2(max(n, 64) / 16)))
    alike = 1 - math.acos(threshold) / math.pi
    hit = alike**bits * math.erf(_WINDOW / math.sqrt(2))
    lines = _NEEDED
    while True:
        miss = sum(math.comb(lines, j) * hit**j * (1 - hit) ** (lines - j) for j in range(_NEEDED))
        if 1 - miss >= recall:
            return bits, lines
        lines += 1


def directions(dim: int, bits: int, lines: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Hyperplanes (dim x lines*bits) and unit projection directions (dim x lines), the same wherever they are drawn."""
    rng = np.random.default_rng([seed, dim, bits, lines])
    planes = rng.standard_normal((dim, lines * bits))
    lines_at = rng.standard_normal((dim, lines))
    return planes, lines_at / np.linalg.norm(lines_at, axis=0)


def _codes(unit: np.ndarray, bits: int, lines: int) -> tuple[np.ndarray, np.ndarray]:
    planes, at = directions(unit.shape[1], bits, lines)
    signs = (unit @ planes > 0).reshape(len(unit), lines, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64)), unit @ at


def _unit(column: pa.Array, dim: int) -> np.ndarray:
    flat = np.asarray(column.flatten()).astype(np.float64).reshape(-1, dim)
    top = np.abs(flat).max(1, keepdims=True)
    flat = flat / top  # no overflow in the norm
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _assign(vectors: DataFrame, bits: int, lines: int) -> DataFrame:
    """(line, cell, rep) rows: the cell of each vector on each line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column(2))
            for dim in np.unique(dims):
                rows = batch.filter(pa.array(dims == dim))
                codes, _ = _codes(_unit(rows.column(1), int(dim)), bits, lines)
                n = len(codes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.tile(np.arange(lines, dtype=np.int32), n)),
                        pa.array((codes.ravel() << 20) | int(dim)),
                        pa.array(np.repeat(np.asarray(rows.column(0)), lines)),
                    ],
                    names=["line", "cell", "rep"],
                )

    return vectors.select("rep", "vec", "dim").mapInArrow(run, "line int, cell long, rep long")


def _search(line: np.ndarray, cell: np.ndarray, role: np.ndarray, rep: np.ndarray, copies: np.ndarray, unit: np.ndarray,
            bits: int, lines: int, threshold: float):
    """Links of one task: rows of packed cells. ``role`` 0 meets everything in its cell, 1 only role 2 and the reverse."""
    codes, proj = _codes(unit, bits, lines)
    width = _WINDOW * math.sqrt(2 * (1 - threshold)) / math.sqrt(unit.shape[1])
    order = np.lexsort((proj[np.arange(len(rep)), line], cell, line))
    starts = np.flatnonzero(np.diff(line[order], prepend=-1) | (np.diff(cell[order], prepend=-1) != 0))
    found = np.zeros(len(rep), np.int64)
    ea, eb = [], []
    for s, e in zip(starts, np.append(starts[1:], len(order))):
        if e - s < 2:
            continue
        at = order[s:e]
        j = line[at[0]]
        p = proj[at, j]
        upto = np.searchsorted(p, p + width, side="right")
        step = 256
        for lo in range(0, len(at), step):  # query-centred windows over the sorted line, a stripe at a time
            hi = min(lo + step, len(at))
            top = int(upto[hi - 1])
            cos = unit[at[lo:hi]] @ unit[at[lo:top]].T
            cols = np.arange(lo, top)
            ok = (cos >= threshold) & (cols > np.arange(lo, hi)[:, None]) & (cols < upto[lo:hi, None])
            a, b = np.nonzero(ok)
            a, b = at[lo + a], at[lo + b]
            fits = (role[a] == 0) & (role[b] == 0) | (role[a] + role[b] == 3)
            a, b = a[fits], b[fits]
            for c in range(0, len(a), 100_000):
                x, y = a[c : c + 100_000], b[c : c + 100_000]
                hits = (codes[x, : j + 1] == codes[y, : j + 1]) & (np.abs(proj[x, : j + 1] - proj[y, : j + 1]) <= width)
                own = hits.sum(1) == _NEEDED
                x, y = x[own], y[own]
                np.add.at(found, x, copies[y])
                np.add.at(found, y, copies[x])
                ea.append(rep[x])
                eb.append(rep[y])
    return found, np.concatenate(ea or [np.empty(0, np.int64)]), np.concatenate(eb or [np.empty(0, np.int64)])


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.9,
    recall: float = 0.99,
    block: int = 1024,
    key: str = "vec_id",
    column: str = "embedding",
) -> DataFrame:
    """One row per vector: key, n_links, component_id, kept."""
    from cartwright.llm.common import local_components

    spark = vectors.sparkSession
    numbers = F.transform(column, lambda x: x.cast("double"))
    sound = (
        F.col(column).isNotNull()
        & (F.size(column) > 0)
        & F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists(numbers, lambda x: x != 0)
        & F.col(key).isNotNull()
    )
    rows = materialise(
        vectors.select(F.col(key).alias("_key"), F.when(F.coalesce(sound, F.lit(False)), numbers).alias("vec"))
        .withColumn("h", F.xxhash64("vec")),
        "vectors",
    )
    whole = rows.filter("vec is not null")
    classes = materialise(
        whole.groupBy("vec", "h").agg(F.min("_key").alias("low"), F.count(F.lit(1)).alias("copies"))
        .select(F.monotonically_increasing_id().alias("rep"), "vec", F.size("vec").alias("dim"), "h", "low", "copies"),
        "classes",
    )
    n = classes.count()
    if n == 0:
        return rows.select(
            F.col("_key").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("_key").alias("component_id"),
            F.col("_key").isNotNull().alias("kept"),
        )
    bits, lines = calibrate(n, threshold, recall)
    assigned = materialise(_assign(classes, bits, lines), "cells")
    sizes = assigned.groupBy("line", "cell").agg(F.count(F.lit(1)).alias("size"))
    # Cells of one vector have no pair; small cells share tasks, large ones are cut into blocks that meet pairwise.
    sizes = materialise(sizes.filter("size > 1").withColumn("parts", F.ceil(F.col("size") / block).cast("int")), "sizes")
    packs = max(1, math.ceil(n * lines / block))
    placed = assigned.join(sizes, ["line", "cell"]).withColumn("mine", F.pmod(F.hash("rep"), F.col("parts")))
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(
        F.least("mine", o).alias("b1"), F.greatest("mine", o).alias("b2"),
        F.when(F.col("parts") == 1, 0).when(o == F.col("mine"), 0).when(F.col("mine") < o, 1).otherwise(2).alias("role"),
    ))
    spread = placed.select("rep", "line", "cell", "parts", F.explode(pairs).alias("p")).select(
        "rep", "line", "cell", F.col("p.role").alias("role"),
        F.when(F.col("parts") == 1, F.pmod(F.hash("line", "cell"), F.lit(packs)))
        .otherwise(F.hash("line", "cell", "p.b1", "p.b2")).alias("task"),
        (F.col("parts") > 1).alias("split"),
    )
    tasks = spread.join(classes.select("rep", "vec", "dim", "copies"), "rep")

    def run(table: pa.Table) -> pa.Table:
        t = {c: np.asarray(table.column(c)) for c in ("line", "cell", "role", "rep", "copies", "dim")}
        out, ea, eb = [], [], []
        for dim in np.unique(t["dim"]):
            m = t["dim"] == dim
            unit = _unit(table.filter(pa.array(m)).column("vec").combine_chunks(), int(dim))
            f, a, b = _search(*(t[c][m] for c in ("line", "cell", "role", "rep", "copies")), unit, bits, lines, threshold)
            out.append((t["rep"][m], f))
            ea.append(a)
            eb.append(b)
        reps, found = (np.concatenate(x) for x in zip(*out))
        nodes, roots = local_components(np.concatenate(ea), np.concatenate(eb))
        got = found > 0
        return pa.table({
            "a": pa.array(np.concatenate((reps[got], nodes))), "b": pa.array(np.concatenate((reps[got], roots))),
            "n": pa.array(np.concatenate((found[got], np.zeros(len(nodes), np.int64)))),
        })

    found = materialise(tasks.groupBy("task", "split").applyInArrow(run, "a long, b long, n long"), "links")
    links = found.filter("n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("links"))
    parts = components(found.filter("n = 0").select("a", "b"))
    labelled = classes.select("rep", "h", "vec", "low", "copies").join(links, "rep", "left").join(
        parts.withColumnRenamed("node", "rep"), "rep", "left"
    ).withColumn("part", F.coalesce("component", "rep"))
    lows = labelled.groupBy("part").agg(F.min("low").alias("component_id"))
    labelled = materialise(labelled.join(lows, "part").select(
        F.col("h").alias("_h"), F.col("vec").alias("_vec"), "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    ), "labelled")
    return rows.join(labelled, (F.col("h") == F.col("_h")) & (F.col("vec") == F.col("_vec")), "left").select(
        F.col("_key").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "_key").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "_key") == F.col("_key"), F.lit(False)).alias("kept"),
    )
