"""Alignment of two tokenizers over the same texts, and how often their ids meet in the whole corpus.

Encoding. A text is cut before a space or line feed that stands alone between characters which are no white space. Neither
tokenizer has a token across such a cut (checked on loading for the pieces, and a property of the byte-level pattern), so
each unit between cuts is encoded once per task and its ids are reused. A very long text costs no more memory than its units.

Merging. The token ends of A and of B over a batch of texts are two ascending lists of byte offsets. Diagonal binary searches
cut their merge into pieces of equal work; a piece is merged on its own and emits one link for every stretch between
neighbouring ends (the one A and the one B token that hold it) and marks the ends that both lists have. A cut never parts
equal ends. Groups that cross a piece border are stitched by counting the marks over all pieces.

Counting. A task gathers the id pairs of about ``chunk`` bytes of text in one table, and its documents refer to places in it.
The tables are summed over the corpus by a shuffle and the totals sent back to the chunk they belong to; no table of all pairs
is broadcast, and a document's links are never expanded into rows.

Defined cases: null and empty texts, and texts whose joined tokens of A or B are not the text with a space before it, have no
tokens: zeros and an empty digest. Repeated rows repeat, and count as often. Other columns are ignored. An empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from cartwright.session import materialise

_SPACE = "▁"
_UNITS = 300_000  # units remembered by a worker; a full table is started anew, which changes no result
_BATCH = 1_000_000  # bytes of text merged at a time
_PIECE = 65_536  # ends of a merge piece
# White space and characters that some library may take for it, besides the plain space and the line feed.
_STRANGE = r"\x00-\x09\x0b-\x1f\x7f-\xa0 ᠎ -‏ -  -⁯　﻿"
_ODD = re.compile(rf"[{_STRANGE}]|[ \n][ \n]|\A[ \n]|[ \n]\Z")
_CUT = re.compile(rf"(?<=[^ \n{_STRANGE}])(?=[ \n][^ \n{_STRANGE}])")


def _byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Both tokenizers, the bytes of their tokens, and the units met so far."""

    def __init__(self, a_file: str, b_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(a_file)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        alphabet = _byte_alphabet()
        self.a_bytes = [b""] * self._a.get_vocab_size()
        for token, i in self._a.get_vocab().items():
            known = all(c in alphabet for c in token)
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if known else token.encode()
        self.b_bytes = []
        for i in range(self._b.get_piece_size()):
            piece = self._b.id_to_piece(i)
            if "\n" in piece or re.search(f"[^{_SPACE}]{_SPACE}", piece):
                raise ValueError(f"piece {piece!r} joins units; this model needs other cutting places")
            self.b_bytes.append(
                bytes([int(piece[3:-1], 16)]) if self._b.is_byte(i) else piece.replace(_SPACE, " ").encode()
            )
        if [self._a.encode(x, add_special_tokens=False).ids for x in (" b c", " b", " c")] != [
            [*self._plain(" b"), *self._plain(" c")], self._plain(" b"), self._plain(" c")
        ]:
            raise ValueError("tokenizer A does not cut before a space")
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        self._start_anew()

    def _start_anew(self) -> None:
        self._place: dict[str, int] = {}
        self._ids = [[], []]  # parts of the ids of A and of B, in order of units
        self._counts: list[list[np.ndarray]] = [[], []]
        self._good: list[np.ndarray] = []
        self._tables = None

    def _plain(self, text: str) -> list[int]:
        return self._a.encode(text, add_special_tokens=False).ids

    def _encode_b(self, unit: str) -> list[int]:
        """The library puts a space before a text, which a unit that starts with a line feed does not have."""
        return self._b.encode(unit[1:], num_threads=1) if unit[0] == " " else self._b.encode(unit, num_threads=1)[1:]

    def _add(self, a: np.ndarray, b: np.ndarray, a_n: np.ndarray, b_n: np.ndarray, good: np.ndarray) -> None:
        for side, ids, counts in ((0, a, a_n), (1, b, b_n)):
            self._ids[side].append(np.asarray(ids, np.int32))
            self._counts[side].append(np.asarray(counts, np.int64))
        self._good.append(good)

    def _learn_many(self, units: list[str]) -> bool:
        """Encode plain units joined to one text and cut the ids at their ends; false if the text is not rendered exactly."""
        text = "".join(units)
        raw, ends = text.encode(), np.cumsum([len(u.encode()) for u in units])
        found = []
        for ids, table, sizes in (
            (self._plain(text), self.a_bytes, self.a_len),
            (self._encode_b(text), self.b_bytes, self.b_len),
        ):
            if b"".join(map(table.__getitem__, ids)) != raw:
                return False
            stops = np.searchsorted(np.cumsum(sizes[ids]), ends, side="left") + 1
            found.append((ids, np.diff(stops, prepend=0)))
        (a, a_n), (b, b_n) = found
        self._add(a, b, a_n, b_n, np.ones(len(units), bool))
        return True

    def _learn(self, units: list[str]) -> None:
        plain = [u for u in units if len(u) > 1 and not _ODD.search(u[1:]) and _SPACE not in u]
        rest = sorted(set(units).difference(plain))
        for at in range(0, len(plain), 10_000):
            part = plain[at : at + 10_000]
            if self._learn_many(part):
                self._place.update(zip(part, range(len(self._place), len(self._place) + len(part))))
            else:
                rest += part
        for u in rest:
            a, b, raw = self._plain(u), self._encode_b(u), u.encode()
            same = b"".join(map(self.a_bytes.__getitem__, a)) == raw == b"".join(map(self.b_bytes.__getitem__, b))
            self._add(a, b, [len(a)], [len(b)], np.array([same]))
            self._place[u] = len(self._place)
        self._tables = None

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """A's ids and B's ids of all texts in a row, with the number of each text, and which texts are rendered exactly."""
        units, of = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if _ODD.search(text):
                parts = _CUT.split(" " + text)
            else:
                parts = [p if p[0] == "\n" else " " + p for p in text.replace("\n", " \n").split(" ")]
            units += parts
            of[i] = len(parts)
        new = set(units).difference(self._place)
        if len(self._place) + len(new) > _UNITS and self._place:
            self._start_anew()
            new = set(units)
        if new:
            self._learn(sorted(new))
        if self._tables is None:
            self._ids = [[np.concatenate(x)] for x in self._ids]
            self._counts = [[np.concatenate(x)] for x in self._counts]
            self._good = [np.concatenate(self._good)]
            self._tables = [np.cumsum(x[0]) - x[0] for x in self._counts]
        at = np.fromiter(map(self._place.__getitem__, units), np.int64, len(units))
        first = np.cumsum(of) - of
        out = []
        for side in (0, 1):
            counts = self._counts[side][0][at]
            before = np.cumsum(counts) - counts
            take = np.arange(counts.sum()) + np.repeat(self._tables[side][at] - before, counts)
            out.append((self._ids[side][0][take], np.add.reduceat(counts, first)))
        exact = np.logical_and.reduceat(self._good[0][at], first)
        return out[0], out[1], exact


def diagonals(a: np.ndarray, b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of ``a`` and of ``b`` lie before each border of merge pieces of about ``size`` values.

    All diagonals are searched at once. On diagonal d the split is the largest i with a[i-1] <= b[d-i]; equal values then stay
    together, as a border that would part a value of ``a`` from its equal in ``b`` takes the latter as well.
    """
    total = len(a) + len(b)
    d = np.arange(size, total, size)
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while np.any(low < high):
        mid = (low + high + 1) // 2
        j = d - mid
        fits = (j >= len(b)) | (a[mid - 1] <= b[np.minimum(j, len(b) - 1)])
        open_ = low < high
        low = np.where(open_ & fits, mid, low)
        high = np.where(open_ & ~fits, mid - 1, high)
    i, j = low, d - low
    tied = (i > 0) & (j < len(b))
    tied[tied] = a[i[tied] - 1] == b[j[tied]]
    j = j + tied
    return np.concatenate(([0], i, [len(a)])), np.concatenate(([0], j, [len(b)]))


def merge_ends(a: np.ndarray, b: np.ndarray, size: int = _PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every distinct end of ``a`` and ``b`` in order: the token of A and of B before it, and whether both end there.

    ``a`` and ``b`` ascend strictly and have the same last value.
    """
    i, j = diagonals(a, b, size)
    a_at, b_at, both = [], [], []
    for k in range(len(i) - 1):
        x, y = a[i[k] : i[k + 1]], b[j[k] : j[k + 1]]
        ends = np.sort(np.concatenate((x, y)), kind="stable")
        twice = np.zeros(len(ends), bool)
        twice[:-1] = ends[1:] == ends[:-1]
        first = np.ones(len(ends), bool)
        first[1:] = ~twice[:-1]
        ends = ends[first]
        both.append(twice[first])
        a_at.append(i[k] + np.searchsorted(x, ends))
        b_at.append(j[k] + np.searchsorted(y, ends))
    empty = np.empty(0, np.int64)
    return tuple(np.concatenate(parts) if parts else empty for parts in (a_at, b_at, both))


_WIDTH = 5


def _group_text(a_ids: np.ndarray, b_ids: np.ndarray, a_group: np.ndarray, b_group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes ``a1,a2|b1;...`` of all tokens in a row (every token with the mark after it) and the end of each group in them."""
    group = np.concatenate((a_group, b_group))
    kind = np.repeat(np.array([0, 1], np.int8), (len(a_ids), len(b_ids)))
    order = np.argsort(group * 2 + kind, kind="stable")
    ids, group, kind = np.concatenate((a_ids, b_ids))[order].astype(np.int64), group[order], kind[order]
    last = np.ones(len(ids), bool)
    last[:-1] = (group[1:] != group[:-1]) | (kind[1:] != kind[:-1])
    mark = np.where(last, np.where(kind == 0, ord("|"), ord(";")), ord(",")).astype(np.uint8)
    digits = 1 + sum((ids >= 10**k).astype(np.int64) for k in range(1, _WIDTH))
    stop = np.cumsum(digits + 1)
    out = np.empty(stop[-1] if len(stop) else 0, np.uint8)
    out[stop - 1] = mark
    left = ids.copy()
    for k in range(_WIDTH):
        on = digits > k
        out[stop[on] - 2 - k] = 48 + left[on] % 10
        left //= 10
    return out, stop[last & (kind == 1)]


def align(pair: Pair, texts: list[str | None], size: int = _PIECE) -> dict[str, list | np.ndarray]:
    """Counts, group text digest and links (id pair codes and the text they belong to) of each text."""
    n = len(texts)
    keep = [i for i, t in enumerate(texts) if t]
    out = {k: np.zeros(n, np.int64) for k in ("n_a", "n_b", "n_groups", "n_links")}
    out["groups"] = [""] * n
    out["codes"], out["of"] = np.empty(0, np.int64), np.empty(0, np.int64)
    if keep:
        (a_ids, a_n), (b_ids, b_n), exact = pair.encode([texts[i] for i in keep])
        for k in np.flatnonzero(~exact):  # a unit differs: the whole text decides
            raw = (" " + texts[keep[k]]).encode()
            sides = ((a_ids, a_n, pair.a_bytes), (b_ids, b_n, pair.b_bytes))
            exact[k] = all(
                b"".join(map(table.__getitem__, ids[c[:k].sum() : c[: k + 1].sum()])) == raw for ids, c, table in sides
            )
        a_ids, b_ids = a_ids[np.repeat(exact, a_n)], b_ids[np.repeat(exact, b_n)]
        a_n, b_n = a_n[exact], b_n[exact]
        rows = np.array(keep, np.int64)[exact]
    if not keep or not len(rows):
        return out
    a_end, b_end = np.cumsum(pair.a_len[a_ids]), np.cumsum(pair.b_len[b_ids])
    a_at, b_at, both = merge_ends(a_end, b_end, size)
    # A text ends where both lists end, so links and groups never cross texts.
    link_ends = np.searchsorted(a_at, np.cumsum(a_n) - 1, side="right")
    n_links = np.diff(link_ends, prepend=0)
    group_of_link = np.cumsum(both) - both
    n_groups = np.diff(np.cumsum(both)[link_ends - 1], prepend=0)
    new_a, new_b = np.diff(a_at, prepend=-1) > 0, np.diff(b_at, prepend=-1) > 0
    data, stops = _group_text(a_ids, b_ids, group_of_link[new_a], group_of_link[new_b])
    ends = stops[np.cumsum(n_groups) - 1]
    start = 0
    for row, end in zip(rows.tolist(), ends.tolist()):
        out["groups"][row] = hashlib.sha256(data[start : end - 1]).hexdigest()
        start = end
    out["n_a"][rows], out["n_b"][rows], out["n_groups"][rows], out["n_links"][rows] = a_n, b_n, n_groups, n_links
    out["codes"] = b_ids[b_at].astype(np.int64) << 20 | a_ids[a_at]
    out["of"] = np.repeat(rows, n_links)
    return out


@lru_cache(maxsize=2)
def _pair(a_file: str, b_file: str) -> Pair:
    return Pair(a_file, b_file)


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def _pack(places: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending places and their counts as compressed differences."""
    return zlib.compress(np.concatenate((np.diff(places, prepend=0), counts)).astype("<u4").tobytes(), 1)


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, counts = np.frombuffer(zlib.decompress(data), "<u4").reshape(2, -1).astype(np.int64)
    return np.cumsum(steps), counts


def _chunks(key: str, a_file: str, b_file: str, chunk: int, schema: pa.Schema) -> Callable:
    """Rows of a chunk: one with its pair table (``codes`` ascending, ``counts``), then one a document with its packed places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, task, number = _pair(a_file, b_file), TaskContext.get().partitionId(), 0
        docs: list[dict] = []
        size = 0

        def rows(values: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(values, schema)

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal docs, size, number
            name, number = f"{task}-{number}", number + 1
            table, inverse = np.unique(np.concatenate([d["pairs"][0] for d in docs]), return_inverse=True)
            total = np.bincount(inverse, np.concatenate([d["pairs"][1] for d in docs]), len(table)).astype(np.int64)
            yield rows([{"chunk": name, "codes": table, "counts": total}])
            at = 0
            for first in range(0, len(docs), 1_000):
                part = docs[first : first + 1_000]
                for d in part:
                    counts = d.pop("pairs")[1]
                    d["chunk"], d["packed"] = name, _pack(inverse[at : at + len(counts)], counts)
                    at += len(counts)
                yield rows(part)
            docs, size = [], 0

        def take(keys: list, texts: list[str | None]) -> None:
            found = align(pair, texts)
            stops = np.cumsum(found["n_links"])
            for i, value in enumerate(keys):
                codes = found["codes"][stops[i] - found["n_links"][i] : stops[i]]
                numbers = {k: int(found[k][i]) for k in _NUMBERS}
                docs.append({key: value, **numbers, "groups": found["groups"][i], "pairs": np.unique(codes, return_counts=True)})

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()
            start = 0
            while start < len(keys):
                stop, now = start + 1, sizes[start]
                while stop < len(keys) and now + sizes[stop] <= _BATCH:
                    now += sizes[stop]
                    stop += 1
                take(keys[start:stop], texts.slice(start, stop - start).to_pylist())
                size += now
                start = stop
                if size >= chunk:
                    yield from close()
        if docs:
            yield from close()

    return run


def align_tokenizers(docs: DataFrame, a_file: str, b_file: str, key: str = "doc_id", chunk: int = 16_000_000) -> DataFrame:
    """key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document.

    ``n_best`` counts links whose id pair is, over all documents, a most frequent one of its B id; ``count_sum`` adds the corpus
    counts of all links. ``chunk`` bounds a pair table: about that many bytes of text, or one longer text.
    """
    kind = docs.schema[key].dataType.simpleString()
    numbers = ", ".join(f"{k} long" for k in _NUMBERS)
    columns = StructType.fromDDL(
        f"chunk string, `{key}` {kind}, {numbers}, groups string, packed binary, codes array<long>, counts array<long>"
    )
    run = _chunks(key, a_file, b_file, chunk, to_arrow_schema(columns))
    # The written table fixes which documents a chunk holds: a task that runs again writes its chunks again, whole.
    aligned = materialise(docs.select(key, "text").mapInArrow(run, columns), "aligned")
    entries = aligned.filter("packed IS NULL").select("chunk", F.posexplode(F.arrays_zip("codes", "counts")).alias("place", "e"))
    entries = entries.select("chunk", "place", F.col("e.codes").alias("code"), F.col("e.counts").alias("n"))
    totals = entries.groupBy("code").agg(F.sum("n").alias("total")).withColumn("b", F.shiftright("code", 20))
    totals = materialise(totals, "totals")
    best = totals.groupBy("b").agg(F.max("total").alias("top"))
    totals = totals.join(best, "b").select("code", "total", (F.col("total") == F.col("top")).alias("best"))
    back = entries.select(F.col("chunk").alias("home"), "place", "code").join(totals, "code").groupBy("home").agg(
        F.collect_list(F.struct("place", "total", "best")).alias("known")
    )

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        known = [c.flatten() for c in right.column("known").chunks]
        total, best_ = np.zeros(1, np.int64), np.zeros(1, bool)
        for structs in known:
            place, sums, tops = (np.asarray(x.to_numpy(zero_copy_only=False)) for x in structs.flatten())
            total, best_ = np.zeros(len(place), np.int64), np.zeros(len(place), bool)
            total[place], best_[place] = sums, tops
        n_best, sums = [], []
        for packed in left.column("packed").to_pylist():
            places, counts = _unpack(packed)
            n_best.append(int(counts[best_[places]].sum()))
            sums.append(int((counts * total[places]).sum()))
        out = left.select([key, *_NUMBERS, "groups"])
        return out.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))

    found = aligned.filter("packed IS NOT NULL").select("chunk", key, *_NUMBERS, "groups", "packed")
    found = found.groupBy("chunk").cogroup(back.groupBy("home"))
    result = found.applyInArrow(finish, f"`{key}` {kind}, {numbers}, groups string, n_best long, count_sum long")
    return result.select(key, *_NUMBERS, "n_best", "count_sum", F.col("groups").alias("groups_sha256"))
