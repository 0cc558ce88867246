"""Token ids as raw binary shards with a minimal perfect hash index for keyed access.

Layout of a store (any folder that all executors see):

``payload-NNNNN.bin``
    The ids of the documents of one shard in ascending key order, little-endian, 16 bits each if the vocabulary allows, else 32.
``index-NNNNN.npz``
    One bucket of keys: the displacement table of its minimal perfect hash and, per slot, a fingerprint of the key, the shard, the
    first id's place in the shard and the number of ids.
``manifest`` (Parquet)
    ids and documents per shard.

A lookup hashes the key to a bucket and to a displacement, which gives the slot; the stored fingerprint tells keys that were never
added, up to one in 2^32. Files are written under another name first and then renamed, so a repeated task leaves the
same file.

Defined cases: a null text is an empty document (its end id only); rows sharing a key are documents of their own, told
apart by their order in the store; null keys come first; an empty table gives an empty store; texts of any length are encoded whole.
"""

from __future__ import annotations

import io
import os
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwright.llm.common import mix64
from cartwright.session import materialise, scratch_path

_MARK = re.compile(r"(?<=[^\W\d_])[.,](?= |$)")
_MEMO = 400_000  # encoded chunks kept; a full table is started anew


# --- encoding -----------------------------------------------------------------------------------------------------------------


class ChunkEncoder:
    """Ids of texts by a tokenizer that drops white space and never joins across it: each chunk is encoded once."""

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        # Spark runs a task on every core already; a thread pool beside each only adds memory and CPU time.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_file(tokenizer_file)
        self.dtype = np.dtype("<u2" if self._tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self._memo: dict[str, bytes] = {"": b""}
        self._ends = np.zeros(self._tokenizer.get_vocab_size(), bool)
        for piece, i in self._tokenizer.get_vocab().items():
            self._ends[i] = piece.endswith("</w>")

    @staticmethod
    def _chunks(text: str) -> list[str]:
        # Only these three split chunks here; other white space stays inside a chunk for the library to drop.
        text = text.replace("\n", " ").replace("\t", " ")
        if "<|" not in text:  # special tokens are told by case
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return text.split(" ")
            # In Latin-1 the normaliser only folds case, and a mark between a letter and a space is a piece of its own.
            text = _MARK.sub(r" \g<0>", text.lower())
        return text.split(" ")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Raw ids of each text, without special tokens."""
        split = [self._chunks(t) if t else [""] for t in texts]
        met = set().union(*split)
        missing = list(met.difference(self._memo))
        if len(self._memo) + len(missing) > _MEMO:
            self._memo.clear()  # before the new entries are made, so that two tables are never held
            self._memo[""] = b""
            missing = [x for x in met if x]
        # Words of Latin letters are one piece each and end with an end-of-word id: many are encoded as one text.
        words = [x for x in missing if x.isalpha() and max(x) <= "\xff"]
        rest = [x for x in missing if not (x.isalpha() and max(x) <= "\xff")]
        for at in range(0, len(words), 5_000):
            part = words[at : at + 5_000]
            lines = [" ".join(part[i : i + 50]) for i in range(0, len(part), 50)]
            ids = [np.array(e.ids, np.int64) for e in self._tokenizer.encode_batch_fast(lines, add_special_tokens=False)]
            flat = np.concatenate(ids)
            stops = (np.flatnonzero(self._ends[flat]) + 1) * self.dtype.itemsize
            raw = flat.astype(self.dtype).tobytes()
            starts = [0, *stops[:-1].tolist()]
            self._memo.update(zip(part, (raw[i:j] for i, j in zip(starts, stops.tolist()))))
        for at in range(0, len(rest), 10_000):
            part = rest[at : at + 10_000]
            for chunk, e in zip(part, self._tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self._memo[chunk] = np.array(e.ids, self.dtype).tobytes()
        look = self._memo.__getitem__
        return [b"".join(map(look, chunks)) for chunks in split]


@lru_cache(maxsize=2)
def encoder(tokenizer_file: str) -> ChunkEncoder:
    return ChunkEncoder(tokenizer_file)


# --- files --------------------------------------------------------------------------------------------------------------------


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _put(uri: str, name: str, data: bytes) -> None:
    system, root = _open(uri)
    task = TaskContext.get()
    spare = f"{root}/_{name}-{task.taskAttemptId() if task else 0}"
    system.create_dir(root, recursive=True)
    with system.open_output_stream(spare) as out:
        out.write(data)
    system.move(spare, f"{root}/{name}")


# --- minimal perfect hash -----------------------------------------------------------------------------------------------------


def build_mph(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Displacements and the slot of every key (distinct 64-bit hashes): a bijection onto 0 .. n-1.

    Keys are grouped by hash, about four to a group; large groups first, each takes the first displacement that puts all
    its keys on free slots.
    """
    n = len(keys)
    groups = max(1, n // 4)
    group = (mix64(keys) % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    ids, starts, counts = np.unique(group[order], return_index=True, return_counts=True)
    taken = np.zeros(n, bool)
    shift = np.zeros(groups, np.uint32)
    slots = np.empty(n, np.int64)
    tries = np.arange(256, dtype=np.uint64)
    for g in np.argsort(-counts, kind="stable"):
        own = order[starts[g] : starts[g] + counts[g]]
        base = 0
        while True:
            # 256 displacements at a time.
            at = (mix64(keys[own][None, :] + mix64(tries + np.uint64(base + 1))[:, None]) % np.uint64(n)).astype(np.int64)
            free = ~taken[at].any(1)
            if len(own) > 1:
                ranked = np.sort(at, axis=1)
                free &= (ranked[:, 1:] != ranked[:, :-1]).all(1)
            good = np.flatnonzero(free)
            if len(good):
                break
            base += 256
        shift[ids[g]] = base + good[0]
        slots[own] = at[good[0]]
        taken[slots[own]] = True
    return shift, slots


def mph_slots(keys: np.ndarray, shift: np.ndarray, n: int) -> np.ndarray:
    """Slots of keys (constant time each; keys never added get an arbitrary slot)."""
    group = (mix64(keys) % np.uint64(len(shift))).astype(np.int64)
    return (mix64(keys + mix64(shift[group].astype(np.uint64) + np.uint64(1))) % np.uint64(n)).astype(np.int64)


def _fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix64(keys ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)


# --- store --------------------------------------------------------------------------------------------------------------------


class TokenStore:
    """A written store: its folder, the width of its ids and the number of index buckets."""

    def __init__(self, path: str, dtype: str, buckets: int):
        self.path, self.dtype, self.buckets = path, dtype, buckets

    def manifest(self, spark) -> DataFrame:
        return spark.read.parquet(f"{self.path}/manifest")

    def lookup(self, keys: DataFrame) -> DataFrame:
        """``keys`` (any columns and a long ``hash``) with shard, place and count; rows of unknown keys get nulls."""
        path, columns = self.path, [c for c in keys.columns if c != "hash"]
        buckets = self.buckets
        schema = ", ".join(f"`{c}` {keys.schema[c].dataType.simpleString()}" for c in columns)

        def run(table: pa.Table) -> pa.Table:
            hashes = np.asarray(table.column("hash").combine_chunks()).view(np.uint64)
            bucket = int(hashes[0] % np.uint64(buckets))
            system, root = _open(path)
            name = f"{root}/index-{bucket:05d}.npz"
            out = {c: table.column(c) for c in columns}
            if system.get_file_info(name).type == pafs.FileType.NotFound:
                none = pa.nulls(len(hashes), pa.int64())
                return pa.table({**out, "shard": none, "place": none, "count": none})
            with system.open_input_stream(name) as f:
                index = np.load(io.BytesIO(f.read()))
            slots = mph_slots(hashes, index["shift"], len(index["mark"]))
            known = index["mark"][slots] == _fingerprints(hashes)
            for c in ("shard", "place", "count"):
                out[c] = pa.array(index[c][slots], mask=~known)
            return pa.table(out)

        bucket = F.expr(f"pmod(cast(conv(hex(hash), 16, 10) as decimal(20, 0)), {buckets})").cast("int")
        return keys.withColumn("_bucket", bucket).groupBy("_bucket").applyInArrow(
            run, f"{schema}, shard long, place long, count long"
        )

    def read(
        self, found: DataFrame, columns: list[str], make: Callable[[bytes], object] = bytes, field: str = "ids binary"
    ) -> DataFrame:
        """``columns`` of ``found`` (a lookup's result) and ``field``, what ``make`` gives of the raw ids, read shard by shard."""
        path, width = self.path, np.dtype(self.dtype).itemsize
        schema = ", ".join(f"`{c}` {found.schema[c].dataType.simpleString()}" for c in columns)
        name, kind = field.split()[0], pa.int64() if field.endswith(" long") else pa.binary()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            system, root = _open(path)
            shard, source = None, None
            for batch in batches:
                made = []
                for s, p, c in zip(*(batch.column(x).to_pylist() for x in ("shard", "place", "count"))):
                    if s != shard:
                        shard, source = s, system.open_input_file(f"{root}/payload-{s:05d}.bin")
                    made.append(make(source.read_at(c * width, p * width)))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in columns], pa.array(made, kind)], names=[*columns, name]
                )

        rows = found.filter("shard is not null").repartition("shard", F.floor(F.col("place") / (1 << 20)))
        return rows.sortWithinPartitions("shard", "place").mapInArrow(run, f"{schema}, {field}")


def key_hash(key: str, copy: str):
    """Hash of a document key and its number among rows of the same key."""
    return F.xxhash64(F.lit(23), F.col(key), F.col(copy))


def write_store(
    docs: DataFrame, tokenizer_file: str, end_id: int | None = 1, key: str = "doc_id", shard_docs: int = 8192
) -> tuple[TokenStore, DataFrame]:
    """Encode ``docs`` and write a store; also returns its document list: key, copy, shard, hash."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    n = docs.count()
    shards = max(1, -(-n // shard_docs))
    dtype = encoder(tokenizer_file).dtype.str
    tail = b"" if end_id is None else np.array([end_id], dtype).tobytes()
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, shard = encoder(tokenizer_file), TaskContext.get().partitionId()
        width = np.dtype(dtype).itemsize
        at, previous, copy, task = 0, object(), 0, TaskContext.get()
        system, root = _open(path)
        system.create_dir(root, recursive=True)
        spare = f"{root}/_payload-{shard:05d}-{task.taskAttemptId()}"
        rows = 0
        with system.open_output_stream(spare) as out:
            for batch in batches:
                keys, texts = batch.column(0).to_pylist(), batch.column(1)
                copies, places, counts = [], [], []
                for lo in range(0, len(keys), 64):
                    for k, ids in zip(keys[lo : lo + 64], tool.encode(texts.slice(lo, 64).to_pylist())):
                        out.write(ids)
                        out.write(tail)
                        copy = copy + 1 if k == previous else 0
                        previous = k
                        copies.append(copy)
                        places.append(at)
                        counts.append((len(ids) + len(tail)) // width)
                        at += counts[-1]
                rows += len(keys)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(copies, pa.int64()), pa.array([shard] * len(keys), pa.int64()),
                     pa.array(places, pa.int64()), pa.array(counts, pa.int64())],
                    names=[key, "copy", "shard", "place", "count"],
                )
        if rows:
            system.move(spare, f"{root}/payload-{shard:05d}.bin")
        else:
            system.delete_file(spare)

    # Equal keys stay in one range, so their order in the shard is their order in the store.
    laid = docs.select(key, "text").repartitionByRange(shards, F.col(key).asc_nulls_first())
    laid = laid.sortWithinPartitions(F.col(key).asc_nulls_first(), F.xxhash64("text"))
    listed = materialise(
        laid.mapInArrow(run, f"`{key}` {kind}, copy long, shard long, place long, count long")
        .withColumn("hash", key_hash(key, "copy")),
        "token-list",
    )
    buckets = max(1, -(-n // 4096))

    def index(table: pa.Table) -> pa.Table:
        hashes = np.asarray(table.column("hash").combine_chunks()).view(np.uint64)
        bucket = int(hashes[0] % np.uint64(buckets))
        shift, slots = build_mph(hashes)
        columns = {"shift": shift, "mark": np.empty(len(slots), np.uint32)}
        columns["mark"][slots] = _fingerprints(hashes)
        for c in ("shard", "place", "count"):
            columns[c] = np.empty(len(slots), np.int64)
            columns[c][slots] = np.asarray(table.column(c).combine_chunks())
        held = io.BytesIO()
        np.savez(held, **columns)
        _put(path, f"index-{bucket:05d}.npz", held.getvalue())
        return pa.table({"bucket": pa.array([bucket], pa.int64()), "n": pa.array([len(slots)], pa.int64())})

    bucket = F.expr(f"pmod(cast(conv(hex(hash), 16, 10) as decimal(20, 0)), {buckets})").cast("int")
    built = listed.withColumn("_bucket", bucket).groupBy("_bucket").applyInArrow(index, "bucket long, n long")
    materialise(built, "token-index")
    listed.groupBy("shard").agg(F.sum("count").alias("ids"), F.count(F.lit(1)).alias("docs")).write.parquet(f"{path}/manifest")
    return TokenStore(path, dtype, buckets), listed.select(key, "copy", "hash")


def store_digests(store: TokenStore, listed: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document, from the files: key, start, n_tokens, ids_crc32 (of the ids as 32-bit integers)."""
    dtype = store.dtype
    found = materialise(store.lookup(listed), "found")
    shards = store.manifest(listed.sparkSession)
    # One row per shard.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.select(F.col("shard").alias("_s"), F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("_base"))
    placed = found.join(F.broadcast(offsets), F.col("shard") == F.col("_s"))

    def crc(raw: bytes) -> int:
        return zlib.crc32(np.frombuffer(raw, dtype).astype("<u4").tobytes())

    rows = placed.withColumn("start", F.col("_base") + F.col("place")).withColumn("n_tokens", F.col("count"))
    return store.read(rows, [key, "start", "n_tokens"], crc, "ids_crc32 long")
