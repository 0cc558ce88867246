"""Best partners under a sum of products where both sides are too long for pairs.

``score(l, r) = sum over k of left[k, l] * right[k, r]``, and only the best ``n`` of every ``l`` are wanted. The left side may
itself be a product, ``left[k, l] = sum over j of own[j, l] * through[j, k]``, which is never written. Ids hash to blocks of a
bounded number of cells, one row a block. A task has one left block and reads all right blocks one after the other, keeping
the best ``n`` found so far. Neither pairs nor sums nor candidates are shuffled or written, only the blocks.

Sparse rows with positive products are added up by hash bucket of the partner first. A bucket's sum is at least the score of
each partner in it, so only the products of buckets that reach the ``n``-th best score so far are added up by partner.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.operators.blocks import SCORE_DIGITS, _block, _significant
from cartwright.operators.ordering import with_global_order
from cartwright.session import materialise

BLOCK_CELLS = 2_000_000  # cells of a block, 12 bytes each
LEFT_CELLS = 1_000_000  # of a left block, which goes with every other block
LEFT_WAYS = 8_000_000  # cells of a left block once it is multiplied with what lies between, 12 bytes each
LEAST_CELLS = 20_000  # smaller tables are not cut further for the sake of parallel tasks
BUFFER = 300_000  # products held at a time, to stay in the processor's cache
NEAR = 500_000  # products and sums of full rows held at a time


def _coded(ids: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Position of every value among the distinct ones, and those."""
    found = ids.dictionary_encode()
    return found.indices.to_numpy(), found.dictionary


def _starts(codes: np.ndarray, size: int) -> np.ndarray:
    """Where the cells of each of ``size`` codes begin once ordered by code, and the end."""
    return np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=size))]).astype(np.int32)


def _left_block(held: dict[str, pa.Array]) -> dict[str, pa.Array]:
    """Distinct ids, their cells one id after the other (``at``: starts, ``of``: codes of k), and partners ruled out."""
    codes, ids = _coded(held.pop("id"))
    real = held["k"].is_valid()
    k, w = (held.pop(c).filter(real).to_numpy(zero_copy_only=False) for c in ("k", "w"))
    real = real.to_numpy(zero_copy_only=False)
    by = np.argsort(codes[real], kind="stable")
    ruled = held["r"].is_valid()
    columns = {"ids": ids, "at": pa.array(_starts(codes[real], len(ids))), "of": pa.array(k[by]), "w": pa.array(w[by])}
    return columns | {"out": pa.array(codes[ruled.to_numpy(zero_copy_only=False)]), "not": held.pop("r").filter(ruled)}


def _right_block(held: dict[str, pa.Array]) -> dict[str, pa.Array]:
    """Sorted distinct ids and the cells one k after the other (``ks``: distinct codes, ``of``: positions of ids)."""
    codes, ids = _coded(held.pop("id"))
    order = pc.sort_indices(ids)
    place = np.empty(len(ids), np.int32)
    place[order.to_numpy()] = np.arange(len(ids), dtype=np.int32)
    k = held.pop("k").to_numpy()
    by = np.argsort(k, kind="stable")
    ks, at = np.unique(k[by], return_index=True)
    columns = {"ids": ids.take(order), "ks": pa.array(ks), "at": pa.array(np.append(at, len(by)).astype(np.int32))}
    return columns | {"of": pa.array(place[codes[by]]), "w": pa.array(held.pop("w").to_numpy(zero_copy_only=False)[by])}


def _through_block(held: dict[str, pa.Array]) -> dict[str, pa.Array]:
    """The cells one j after the other, every ``count``-th code of j in turn (``of``: codes of k)."""
    j = held.pop("j").to_numpy()
    by = np.argsort(j, kind="stable")
    columns = {"at": pa.array(_starts(j, int(j.max()) + 1)), "of": pa.array(held.pop("via").to_numpy()[by])}
    return columns | {"w": pa.array(held.pop("w").to_numpy(zero_copy_only=False)[by])}


def _blocks_of(df: DataFrame, count: int, block: Callable[[dict[str, pa.Array]], dict[str, pa.Array]]) -> DataFrame:
    """One row per block ``b`` of the rows of ``df``: its number and what ``block`` makes of them, as Arrow bytes."""

    names = df.columns

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {c: [] for c in names}
        for some in iter(lambda: list(islice(batches, 32)), []):  # copied at once, as all columns of a batch share its memory
            for c, chunks in held.items():
                chunks.append(pa.concat_arrays([batch.column(c) for batch in some]))
            del some
        if not sum(map(len, held["b"])):
            return
        number = next(c for c in held.pop("b") if len(c)).slice(0, 1)
        columns = block({c: pa.concat_arrays(held.pop(c)) for c in list(held)})  # one column at a time is there twice
        lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns.values()]
        packed = pa.RecordBatch.from_arrays(lists, list(columns))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, packed.schema) as stream:
            stream.write_batch(packed)
        del columns, lists, packed
        cells = sink.getvalue()
        offsets = pa.py_buffer(np.array([0, cells.size], np.int32))
        yield pa.RecordBatch.from_arrays([number, pa.Array.from_buffers(pa.binary(), 1, [None, offsets, cells])], ["b", "cells"])

    return df.repartitionById(count, F.col("b")).mapInArrow(gather, "b int, cells binary")


def _unpacked(cells: pa.BinaryScalar) -> dict[str, pa.Array]:
    batch = pa.ipc.open_stream(cells.as_buffer()).read_next_batch()
    return {name: batch.column(name)[0].values for name in batch.schema.names}


def _ranked(row: np.ndarray, col: np.ndarray, score: np.ndarray, n: int) -> np.ndarray:
    """Positions of the best ``n`` per row, ties to the smaller column."""
    order = np.lexsort((col, -score, row))
    since = _place(row[order])
    return order[since < n]


def _place(rows: np.ndarray) -> np.ndarray:
    """Place of each entry among those of its row; ``rows`` is sorted."""
    new = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]])) if len(rows) else np.zeros(0, int)
    return np.arange(len(rows)) - np.repeat(new, np.diff(np.append(new, len(rows))))


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... for counts[i] places, one after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


def _plain(w: np.ndarray) -> bool:
    return not len(w) or bool(np.isfinite(w.sum()) and w.min() >= 0)


class _Left:
    """Rows of a left block: parts of cells (starts of rows, codes of k, weights) and the best partners so far."""

    def __init__(self, block: dict[str, pa.Array], through: int):
        self.ids, self.through = block["ids"], through
        self.own = tuple(block[c].to_numpy() for c in ("at", "of", "w"))
        self.parts = [] if through else [self.own]
        self.out_row, self.out_id = block["out"].to_numpy(), block["not"]
        self.row, self.score, self.partner = np.zeros(0, int), np.zeros(0), None

    def close(self) -> None:
        """No further parts come."""
        self.before = sum((p[0].astype(np.int64) for p in self.parts), np.zeros(len(self.ids) + 1, np.int64))  # cells before each row
        self.clean = all(_plain(w) for *_, w in self.parts)

    def extend(self, block: dict[str, pa.Array], number: int) -> None:
        """Takes the ways over the cells of one block that lies between."""
        at, j, w = self.own
        t_at, via, t_w = (block[c].to_numpy() for c in ("at", "of", "w"))
        used = np.flatnonzero((j % self.through == number) & (j // self.through < len(t_at) - 1))
        local = j[used] // self.through
        counts = (t_at[local + 1] - t_at[local]).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(counts)])
        cell = _spread(t_at[local].astype(np.int64), counts)
        self.parts.append((ends[np.searchsorted(used, at)], via[cell], np.repeat(w[used], counts) * t_w[cell]))

    def floor(self, n: int) -> np.ndarray:
        """Score of the ``n``-th best partner of every row so far, minus infinity if there are fewer."""
        floor = np.full(len(self.ids), -np.inf)
        last = _place(self.row) == n - 1
        floor[self.row[last]] = self.score[last]
        return floor

    def take(self, row: np.ndarray, score: np.ndarray, partner: pa.Array, n: int) -> None:
        row, score = np.concatenate([self.row, row]), np.concatenate([self.score, score])
        partner = partner if self.partner is None else pa.concat_arrays([self.partner, partner])
        if len(row):
            top = _ranked(row, pc.rank(partner, tiebreaker="dense").to_numpy(), score, n)
            self.row, self.score, self.partner = row[top], score[top], partner.take(pa.array(top))


class _Pair:
    """Scores of one left and one right block."""

    def __init__(self, left: _Left, right: dict, codes: int, n: int, positive_only: bool, same_ids: bool, common: list[int] | None = None):
        self.n, self.positive_only, self.left = n, positive_only, left
        self.rows, self.cols = len(left.ids), len(right["ids"])
        self.r_of, self.r_w = right["of"].to_numpy(), right["w"].to_numpy()
        ks, at = right["ks"].to_numpy(), right["at"].to_numpy()
        self.sizes, self.starts = np.zeros(codes, np.int32), np.zeros(codes, np.int32)
        self.sizes[ks], self.starts[ks] = np.diff(at), at[:-1]
        self.before, self.right_ids = left.before, right["ids"]
        total = sum(int(self.sizes[k].sum(dtype=np.int64)) for _, k, _ in left.parts)
        # In nanoseconds, by what was measured: 20 a product in buckets; 6 a sum of a full row, 12 a product not in the dense part.
        self.met = common is not None  # only pairs that share another k
        full = np.intersect1d(ks, common) if self.met else ks[np.diff(at) * 4 >= max(self.cols, 1)]
        rest = total - sum(int(np.bincount(k, minlength=codes)[full] @ self.sizes[full]) for _, k, _ in left.parts) if len(full) else total
        self.per_cell = (rest if self.met else total) / max(1, int(self.before[-1]))  # products
        self.few = positive_only and 20 * total < 6 * self.rows * self.cols + 12 * rest
        self.clean = left.clean and _plain(self.r_w)
        # k that a large share of the right ids has are multiplied as a dense matrix.
        self.dense = np.zeros((0, self.cols))
        if not self.few:
            self.dense = np.zeros((len(full), self.cols))
            self.slot = np.full(codes, -1, np.int32)
            self.slot[full] = np.arange(len(full))
            for i, f in enumerate(full):
                span = slice(self.starts[f], self.starts[f] + self.sizes[f])
                np.add.at(self.dense[i], self.r_of[span], self.r_w[span])
            self.sizes[full] = 0
        out = [(np.zeros(0, int), np.zeros(0, int))]
        if same_ids:
            own = pc.index_in(left.ids, right["ids"]).fill_null(-1).to_numpy()
            out.append((np.flatnonzero(own >= 0), own[own >= 0]))
        if len(left.out_row):
            col = pc.index_in(left.out_id, right["ids"]).fill_null(-1).to_numpy()
            out.append((left.out_row[col >= 0], col[col >= 0]))
        row, col = (np.concatenate(x) for x in zip(*out))
        order = np.lexsort((col, row))
        self.out_row, self.out_col = row[order], col[order]

    def rounded(self, score: np.ndarray) -> np.ndarray:
        unit = float(10**SCORE_DIGITS)
        return _significant(score) if self.positive_only else np.floor(score * unit + 0.5) / unit

    def cells(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """row (from ``a``), k and weight of the left cells of rows a to b."""
        found = []
        for at, k, w in self.left.parts:
            span = slice(int(at[a]), int(at[b]))
            found.append((np.repeat(np.arange(b - a), np.diff(at[a : b + 1])), k[span], w[span]))
        return tuple(np.concatenate(x) if len(x) > 1 else x[0] for x in zip(*found))

    def products(self, a: int, b: int, size: int, unit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """row (from ``a``) times ``unit``, column and value of the single products of rows a to b, some at a time."""
        row, k, w = self.cells(a, b)
        counts = self.sizes.take(k)
        some = np.flatnonzero(counts)
        row, k, w, counts = row.take(some) * unit, k.take(some), w.take(some), counts.take(some)
        ends = np.cumsum(counts, dtype=np.int64)
        starts, lo = self.starts.take(k), 0
        while lo < len(k):
            done = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, done + size, "right")))
            cell = np.zeros(ends[hi - 1] - done, np.int32)  # left cell of each product
            cell[ends[lo : hi - 1] - done] = 1
            cell = np.cumsum(cell, dtype=np.int64)
            at = (starts[lo:hi] - (ends[lo:hi] - counts[lo:hi] - done)).take(cell)
            at += np.arange(len(at))
            value = w[lo:hi].take(cell)
            value *= self.r_w.take(at)
            yield row[lo:hi].take(cell), self.r_of.take(at), value
            lo = hi

    def ruled_out(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        span = slice(*np.searchsorted(self.out_row, [a, b]))
        return self.out_row[span] - a, self.out_col[span]

    def from_full(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best of rows a to b from a matrix of all their scores."""
        acc = np.zeros((b - a) * self.cols)
        for row, col, value in self.products(a, b, NEAR, self.cols):
            acc += np.bincount(row + col, value, len(acc)) if len(row) * 4 > len(acc) else 0
            if len(row) * 4 <= len(acc):
                np.add.at(acc, row + col, value)
        acc = acc.reshape(b - a, self.cols)
        if len(self.dense):
            row, k, w = self.cells(a, b)
            slot = self.slot[k]
            used = slot >= 0
            share = np.zeros((b - a, len(self.dense)))
            np.add.at(share, (row[used], slot[used]), w[used])
            acc += share @ self.dense
        if self.positive_only:
            acc[acc <= 0] = -np.inf
        acc[~np.isfinite(acc)] = -np.inf  # of a null weight
        acc[self.ruled_out(a, b)] = -np.inf
        # The n-th largest of the maxima of strips is at most the n-th largest of all.
        strip = max(1, min(64, self.cols // (4 * self.n)))
        whole = self.cols // strip * strip
        peaks = acc[:, :whole].reshape(b - a, -1, strip).max(axis=2)
        if peaks.shape[1] > self.n:
            floor = np.partition(peaks, -self.n, axis=1)[:, -self.n]
            slack = np.abs(floor) * 1e-5 if self.positive_only else 2.0 / 10**SCORE_DIGITS
            floor = np.where(np.isfinite(floor), floor - slack, floor)
        else:
            floor = np.full(b - a, -np.inf)
        row, col = np.nonzero((acc >= floor[:, None]) & (acc > -np.inf))
        return row, col, self.rounded(acc[row, col])

    def from_buckets(self, a: int, b: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best of rows a to b, whose ``n``-th best score so far is ``floor``, from sums by hash bucket of the column."""
        expected = (self.before[b] - self.before[a]) * self.per_cell
        width = 1 << int(np.ceil(np.log2(min(max(16, expected / 2 / (b - a)), 1 << 16))))
        width = min(width, 1 << max(4, int(self.cols - 1).bit_length()))

        def in_buckets() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            for bucket, col, value in self.products(a, b, BUFFER if expected > 4 * BUFFER else 8 * BUFFER, width):
                bucket += col & (width - 1)
                yield bucket, col, value

        held = list(in_buckets()) if expected <= 4 * BUFFER else None
        sums = np.zeros((b - a) * width)
        for bucket, _, value in held or in_buckets():
            bound = value if self.clean else np.where(np.isnan(value), np.inf, np.maximum(value, 0))
            sums += np.bincount(bucket, bound, len(sums))
        sums = sums.reshape(b - a, width)
        out_row, out_col = self.ruled_out(a, b)
        out = out_row * self.cols + out_col

        def exact(wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            keys, values = [np.zeros(0, int)], [np.zeros(0)]
            for bucket, col, value in held or in_buckets():
                kept = np.flatnonzero(wanted.ravel().take(bucket))
                keys.append(bucket[kept] // width * self.cols + col[kept])
                values.append(value[kept])
            key, value = np.concatenate(keys), np.concatenate(values)
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
            total = np.add.reduceat(value[order], first) if len(key) else value
            key = key[first]
            usable = (total > 0) & np.isfinite(total) & ~np.isin(key, out)
            return key[usable] // self.cols, key[usable] % self.cols, self.rounded(total[usable])

        floor = floor.copy()
        unknown = np.flatnonzero(~np.isfinite(floor))
        if len(unknown):
            most = int(np.bincount(out_row, minlength=1).max()) + 2 * self.n
            strip = width // min(width, 1 << (4 * most).bit_length())
            if most < width // strip:  # about the largest buckets give a first floor
                least = np.full(b - a, np.inf)
                peaks = sums[unknown].reshape(len(unknown), -1, strip).max(axis=2)
                least[unknown] = np.partition(peaks, -most, axis=1)[:, -most]
                row, col, score = exact((sums > 0) & (sums >= least[:, None]))
                top = _ranked(row, col, score, self.n)
                last = _place(row[top]) == self.n - 1
                floor[row[top][last]] = score[top][last]
        return exact((sums > 0) & (sums >= (floor - np.abs(floor) * 1e-5)[:, None]))

    def from_met(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sums of rows a to b from their sorted products, and of the dense part for the pairs found."""
        keys, values = [np.zeros(0, int)], [np.zeros(0)]
        for row, col, value in self.products(a, b, 8 * BUFFER, self.cols):
            row += col
            order = np.argsort(row, kind="stable")
            row = row[order]
            first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            keys.append(row[first])
            values.append(np.add.reduceat(value[order], first))
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, np.concatenate(values), len(key))
        row, k, w = self.cells(a, b)
        slot = self.slot[k]
        used = slot >= 0
        share = np.zeros((b - a, len(self.dense)))
        np.add.at(share, (row[used], slot[used]), w[used])
        out_row, out_col = self.ruled_out(a, b)
        usable = np.isfinite(total) & ~np.isin(key, out_row * self.cols + out_col)
        row, col, total = key[usable] // self.cols, key[usable] % self.cols, total[usable]
        for of_left, of_right in zip(share.T, self.dense):
            total += of_left[row] * of_right[col]
        usable = np.isfinite(total)
        return row[usable], col[usable], self.rounded(total[usable])

    def best(self) -> None:
        """Adds the best of this pair to the best of the left block."""
        floor = self.left.floor(self.n)
        found, a = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0))], 0
        while a < self.rows and self.cols:
            if self.few or self.met:
                step = self.before[a] + max(1, int(BUFFER / max(self.per_cell, 1e-9)))
                b = min(self.rows, a + BUFFER // 16, max(a + 1, int(np.searchsorted(self.before, step, "right")) - 1))
                row, col, score = self.from_met(a, b) if self.met else self.from_buckets(a, b, floor[a:b])
            else:
                b = min(self.rows, a + max(1, NEAR // self.cols))
                row, col, score = self.from_full(a, b)
            top = _ranked(row, col, score, self.n)
            found.append((row[top] + a, col[top], score[top]))
            a = b
        row, col, score = (np.concatenate(x) for x in zip(*found))
        kept = np.flatnonzero(score >= floor[row])
        self.left.take(row[kept], score[kept], self.right_ids.take(pa.array(col[kept])), self.n)


def _numbered(ids: DataFrame) -> tuple[DataFrame, int]:
    """The distinct values of a one-column table as ``of`` with ``code`` from 0, and how many there are."""
    distinct = materialise(ids.toDF("of").filter(F.col("of").isNotNull()).distinct(), "distinct")
    codes = with_global_order(distinct, ["of"], rank="code").select("of", (F.col("code") - 1).cast("int").alias("code"))
    codes = materialise(codes, "codes")
    return codes, codes.count()


def best_of_products(
    left: DataFrame,
    right: DataFrame,
    n: int,
    ruled_out: DataFrame | None = None,
    positive_only: bool = True,
    same_ids: bool = True,
    through: DataFrame | None = None,
    ways: int | None = None,
    met_without: list | None = None,
) -> DataFrame:
    """``l, r, score, rank``: the best ``n`` of every left id.

    ``left`` and ``right`` have k, id, w, several cells of one k and id adding up; ``ruled_out`` has l, r, and a column r of
    ``left`` rules out partners as well. No id is its own partner where both sides hold the ``same_ids``. Scores are rounded
    before ranking as in ``blocks.best_partners``, ties go to the smaller id. With ``through`` (k, via, w) a left cell of k
    stands for its product with every cell of that k there, whose ``via`` is the k of the right side; ``ways`` is the number
    of these. With ``met_without``, a few k that many ids have, only pairs that share another k are wanted.
    """
    cores = left.sparkSession.sparkContext.defaultParallelism
    on_left, most = (left.count(), min(LEFT_CELLS, BLOCK_CELLS)) if ways is None else (ways, LEFT_WAYS)
    double = F.col("w").cast("double").alias("w")
    partner = right.schema["id"].dataType
    kinds = left.schema["id"].dataType.simpleString(), partner.simpleString()
    codes, number_of_codes = _numbered(right.select("k"))
    common = None
    if met_without is not None:
        common = [r["code"] for r in codes.filter(F.col("of").isin(met_without)).collect()]  # as many as were given at most
    r_blocks = max(1, -(-right.count() // BLOCK_CELLS))
    l_blocks = max(1, -(-on_left // most), min(-(-on_left // LEAST_CELLS), 3 * cores))
    coded = right.join(codes, F.col("k") == F.col("of")).select("id", F.col("code").alias("k"), double)
    r_rows = materialise(_blocks_of(coded.withColumn("b", _block("id", r_blocks)), r_blocks, _right_block), "right-blocks", compression="none")
    rows, t_blocks = r_rows.select(F.lit(-1).alias("between"), "cells"), 0
    if through is not None:
        between, _ = _numbered(through.select("k"))
        t_blocks = max(1, -(-through.count() // BLOCK_CELLS))
        via = codes.select(F.col("of").alias("v"), F.col("code").alias("via_code"))
        coded = through.join(via, F.col("via") == F.col("v")).join(between, F.col("k") == F.col("of"))
        coded = coded.select(
            F.floor(F.col("code") / t_blocks).cast("int").alias("j"),
            F.col("via_code").alias("via"),
            double,
            F.pmod("code", F.lit(t_blocks)).alias("b"),
        )
        t_rows = materialise(_blocks_of(coded, t_blocks, _through_block), "between-blocks", compression="none")
        rows = t_rows.select(F.col("b").alias("between"), "cells").coalesce(1).union(rows.coalesce(1))  # in this order
        codes = between
    if "r" not in left.columns:
        left = left.withColumn("r", F.lit(None).cast(partner))
    left = left.join(codes, F.col("k") == F.col("of"), "left").select("id", F.col("code").alias("k"), double, F.col("r").cast(partner).alias("r"))
    left = left.filter("k IS NOT NULL OR r IS NOT NULL")
    if ruled_out is not None:
        left = left.unionByName(
            ruled_out.select(
                F.col("l").alias("id"), F.lit(None).cast("int").alias("k"), F.lit(0.0).alias("w"), F.col("r").cast(partner).alias("r")
            )
        )
    l_rows = _blocks_of(left.withColumn("b", _block("id", l_blocks)), l_blocks, _left_block).select(F.col("cells").alias("left"))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            for i in range(batch.num_rows):
                number, cells = batch.column("between")[i].as_py(), _unpacked(batch.column("cells")[i])
                if block is None:
                    block, met = _Left(_unpacked(batch.column("left")[i]), t_blocks), False
                if number >= 0 and met:
                    raise RuntimeError("a block that lies between came after a right one")
                if number >= 0:
                    block.extend(cells, number)
                    continue
                if not met:
                    block.close()
                    met = True
                _Pair(block, cells, number_of_codes, n, positive_only, same_ids, common).best()
            del batch, cells  # before the next batch is there
        if block is not None and len(block.row):
            found = [block.ids.take(pa.array(block.row)), block.partner, pa.array(block.score), pa.array(_place(block.row).astype(np.int32) + 1)]
            yield pa.RecordBatch.from_arrays(found, ["l", "r", "score", "rank"])

    # A task per left block, which is held; the rows of the other side come one after the other.
    pairs = rows.coalesce(1).join(l_rows.hint("shuffle_replicate_nl"))
    return pairs.mapInArrow(multiply, f"l {kinds[0]}, r {kinds[1]}, score double, rank int")
