"""Helpers of the corpus operators: word hashing on Arrow batches, local components, component search, file systems."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.session import materialise

_CHUNK = 250_000  # bytes of text hashed at a time; bounds the temporaries of a batch


def text_slices(batch: pa.RecordBatch, column: str, limit: int = _CHUNK) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of ``batch`` with about ``limit`` bytes of text each; a longer text is a slice of its own."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), dtype=np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def give_back() -> None:
    """Return what this Python worker has freed to the system: a worker serves stage after stage, and its peaks would add up."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (bijective)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def _power_table(base: np.uint64, n: int) -> np.ndarray:
    table = _powers.get(int(base))
    if table is None or len(table) < n:
        table = np.empty(max(n, _CHUNK + 1), np.uint64)
        table[0] = 1
        table[1:] = base
        table = np.multiply.accumulate(table)
        _powers[int(base)] = table
    return table[:n]


# Byte classes of the word rule: upper case folded, white space (space, 9 to 13) marked.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUE = mix64(np.arange(1, 257, dtype=np.uint64))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of ``texts`` in order, and the number of words of each text (nulls have none).

    A word is a run of bytes other than white space, with A-Z folded. Its hash is a difference of prefix sums of a polynomial over
    the whole slice, so no word is cut out.
    """
    # One byte buffer of all texts, each followed by a space.
    joined = pa.array(texts).cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1, joined.offset * 8)
    raw = np.frombuffer(joined.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    n = len(joined)
    data = np.full(len(raw) + n, 32, np.uint8)
    place = np.ones(len(data), bool)
    place[offsets[1:] + np.arange(n)] = False
    data[place] = raw
    ends_at = offsets[1:] + np.arange(n)  # place of the closing space of each text
    space = _SPACE[data]
    edge = np.diff(np.concatenate(([True], space)).astype(np.int8))
    starts = np.flatnonzero(edge == -1)
    stops = np.flatnonzero(edge == 1)
    counts = np.diff(np.concatenate(([0], np.searchsorted(starts, ends_at))))
    if not len(starts):
        return np.empty(0, np.uint64), counts
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[_FOLD[data]] * _power_table(_BASE, len(data)), out=sums[1:])
    hashes = (sums[stops] - sums[starts]) * _power_table(_INVERSE, len(data))[starts]
    return mix64(hashes + (stops - starts).astype(np.uint64)), counts


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct hashes of ``width``-word shingles of each text; fewer words make one shingle, none make none."""
    words, counts = word_hashes(texts)
    out, at = [], 0
    salts = mix64(np.arange(101, 101 + width, dtype=np.uint64)) | np.uint64(1)
    rolled = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for i in range(width):
        rolled += words[i : len(words) - width + 1 + i] * salts[i]
    rolled = mix64(rolled)
    for n in counts:
        if n == 0:
            out.append(np.empty(0, np.uint64))
        elif n < width:
            whole = (words[at : at + n] * salts[:n]).sum(dtype=np.uint64) + np.uint64(n)
            out.append(mix64(np.array([whole])))
        else:
            out.append(np.unique(rolled[at : at + n - width + 1]))
        at += n
    return out


def local_components(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct nodes of the edges ``a-b`` and the smallest node of each one's component."""
    nodes, flat = np.unique(np.concatenate((a, b)), return_inverse=True)
    u, v = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def _forest(edges: DataFrame) -> DataFrame:
    """Each partition's edges as a forest of stars: same components, at most one edge per node and partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, held = [], [], 0
        for batch in batches:
            a.append(np.asarray(batch.column(0)))
            b.append(np.asarray(batch.column(1)))
            held += batch.num_rows
            if held > 500_000:
                nodes, roots = local_components(np.concatenate(a), np.concatenate(b))
                a, b, held = [nodes], [roots], len(nodes)
                if held > 250_000:  # does not shrink any more: pass it on
                    yield from _star(nodes, roots)
                    a, b, held = [], [], 0
        if a:
            yield from _star(*local_components(np.concatenate(a), np.concatenate(b)))

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def _star(nodes: np.ndarray, roots: np.ndarray) -> Iterator[pa.RecordBatch]:
    keep = nodes != roots
    yield pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(roots[keep])], names=["a", "b"])


_FINISH = 400_000  # edges that one task merges in memory; below the size at which ``_forest`` passes partial stars on


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the edges ``a, b`` (longs): the smallest node reachable.

    Every partition first shrinks its edges to a forest, and neighbouring partitions are merged, each time to about ``_FINISH``
    edges (6 MB) a task, as long as that shrinks them. What one task then holds is final. More edges
    go through large-star and small-star rounds, each written to the shared folder, until they are stars; a hub's neighbours
    are spread by splitting skewed joins, and the rounds grow with the logarithm of the longest path. Both ways are exact.
    """
    edges = materialise(_forest(edges.filter("a != b")), "edges")
    held, tasks = edges.count(), 2
    while tasks > 1:
        tasks = -(-held // _FINISH) or 1
        edges = materialise(_forest(edges.coalesce(tasks)), "edges")
        before, held = held, edges.count()
        if held > 0.8 * before:
            break
    if tasks > 1:
        edges = _star_rounds(edges)
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _star_rounds(edges: DataFrame) -> DataFrame:
    """Edges ``a, b`` from every node that is not the smallest of its component to the smallest one."""
    edges = materialise(edges.distinct(), "edges")
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lows = materialise(both.groupBy("a").agg(F.min("b").alias("low")), "lows")
        # Large star: larger neighbours move to the smallest node around.
        m = F.least("low", F.col("a"))
        large = both.join(lows.withColumnRenamed("a", "_n"), F.col("a") == F.col("_n")).filter("b > a").select(
            F.col("b").alias("a"), m.alias("b")
        )
        large = materialise(large.filter("a != b").distinct(), "large")
        # Small star: smaller neighbours (all edges now point down) meet at the smallest.
        lows = materialise(large.groupBy("a").agg(F.min("b").alias("low")), "lows")
        small = large.join(lows.withColumnRenamed("a", "_n"), F.col("a") == F.col("_n")).select(
            F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("low").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")
        ).select("e.a", "e.b")
        new = materialise(small.filter("a != b").distinct(), "edges")
        # Done when no node has two parents and no parent is a child: the edges are stars.
        parents = new.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        unfinished = parents.filter("n > 1").limit(1).count() or new.join(
            new.select(F.col("a").alias("b")), "b", "left_semi"
        ).limit(1).count()
        edges = new
        if not unfinished:
            return edges
