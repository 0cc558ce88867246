"""Exact self-join of documents by n-gram Jaccard similarity: T-occurrence search with DivideSkip, spread over Spark.

Two sets of s and t shingles reach the similarity only with T = ceil(num (s + t) / (num + den)) shingles in common. Inside a task the
documents form an inverted index. A query sets its L longest lists aside, merges the short ones (one sort of their
concatenation counts occurrences), keeps documents with at least T - L hits, and probes the long lists for those by binary search.

Which documents share a task: similar sets differ in at most d = (s + t)(den - num) / (den + num) shingles, so when shingles are dealt
to d + 1 + E parts by their hash, at least E + 1 parts are equal. Documents of neighbouring size classes with an equal non-empty part
are candidates (a document with more than E empty parts also offers those, so nothing is lost; E grows with the parts that sets
of a class are expected to leave empty, as those are equal in unrelated documents).

A part that holds nothing but a common shingle is equal in unrelated documents and chains them to one large component. Candidate
components above a block are therefore split by a prefix filter: with its shingles ordered by how often they occur in the large
components, rarest first, a set of s has s - ceil(num s / den) + 1 of them before the end that any partner must reach, and similar sets
share one of those. Counts are kept by hash bucket over all these documents, and bits tell shingles that occur once, which come first;
as any fixed order is exact, buckets that coincide only cost time. It is repeated on what stays large, where counts are finer, as long
as that shrinks.

Candidate components are searched; small ones are packed together, those still large are cut into blocks. Blocks are joined by
searching one document per component found so far, and what is still apart then is searched block against block, so no component is
one task and no pair of different components is left out. Links inside one component are not needed for its id and are skipped.

Copies (equal sets) are folded to one representative before the search. Shingles are 64-bit hashes, copies are told by
two independent 64-bit sums and the set size.

Defined cases: null, empty and white-space texts have no shingles and link with nothing; fewer words than ``width`` make
one shingle; rows with a null key are counted, link with nothing and have a null component; rows sharing a key count as
one document; texts of any length are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import components, give_back, mix64, shingle_sets, text_slices
from cartwright.session import materialise

_EMPTY_PARTS = 3
_BUCKETS = 1 << 20  # of shingle counts
_BITS = 1 << 25  # that tell shingles met once
_CHUNKS = 16


def size_classes(largest: int, num: int, den: int) -> np.ndarray:
    """Lower bounds of size classes: partners of a set are at most one class away."""
    bounds = [1]
    while bounds[-1] <= largest:
        bounds.append(bounds[-1] * den // num + 1)
    bounds.append(bounds[-1] * den // num + 1)
    return np.array(bounds)


def part_count(level: int, bounds: np.ndarray, num: int, den: int) -> tuple[int, int]:
    """Parts of the sets that meet in size class ``level``, and how many of them may be empty (E)."""
    largest, smallest = int(bounds[level + 1]) - 1, int(bounds[max(0, level - 1)])
    parts = 2 * largest * (den - num) // (den + num) + 1
    empty = max(_EMPTY_PARTS, math.ceil(2 * parts * math.exp(-smallest / parts)) if parts > 40 else 0)
    return parts + empty, empty


def signatures(shingles: np.ndarray, bounds: np.ndarray, num: int, den: int) -> np.ndarray:
    """Hashes of the parts of one set in its own size class and the next."""
    own = int(np.searchsorted(bounds, len(shingles), side="right")) - 1
    mixed = mix64(shingles)
    out = []
    for level in (own, own + 1):
        parts, empty = part_count(level, bounds, num, den)
        part = (shingles % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        ids, starts = np.unique(part[order], return_index=True)
        sums = np.add.reduceat(mixed[order], starts)
        if parts - len(ids) > empty:
            missing = np.setdiff1d(np.arange(parts), ids)
            ids, sums = np.append(ids, missing), np.append(sums, np.zeros(len(missing), np.uint64))
        tag = mix64(ids.astype(np.uint64) + np.uint64(level << 40))
        out.append(mix64(sums ^ tag))
    return np.concatenate(out)


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles % np.uint64(_BUCKETS)).astype(np.int64)


def _bit(shingles: np.ndarray) -> np.ndarray:
    return (shingles // np.uint64(_BUCKETS) % np.uint64(_BITS)).astype(np.int64)


def frequencies(shingles: np.ndarray, counts: np.ndarray, more: np.ndarray) -> np.ndarray:
    """By the tables of :func:`shingle_counts`: 0 for shingles that surely occur once, else the count of their bucket."""
    bit = _bit(shingles)
    return counts[_bucket(shingles)] * (more[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1)


def prefix_signatures(
    shingles: np.ndarray, tables: tuple[np.ndarray, np.ndarray], cluster: int, bounds: np.ndarray, num: int, den: int
) -> np.ndarray:
    """Hashes of the rarest shingles of one set, of which similar sets in ``cluster`` share one in a common size class."""
    own = int(np.searchsorted(bounds, len(shingles), side="right")) - 1
    ahead = len(shingles) - -(-num * len(shingles) // den) + 1
    rarest = shingles[np.lexsort((shingles, frequencies(shingles, *tables)))[:ahead]]
    salts = mix64(mix64(np.array([cluster]).view(np.uint64)) + np.array([own, own + 1], np.uint64))
    return mix64(rarest ^ salts[:, None]).ravel()


def shingle_counts(docs: DataFrame, tasks: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Over the sets of ``docs`` (text): shingles by bucket, and bits met more than once. Both are as large for every input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, met = np.zeros(_BUCKETS, np.int64), np.zeros(_BITS, np.uint8)
        for batch in batches:
            for rows in text_slices(batch, "text"):
                shingles = np.concatenate(shingle_sets(rows.column("text"), width))
                np.add.at(counts, _bucket(shingles), 1)
                bits, times = np.unique(_bit(shingles), return_counts=True)
                met[bits] = np.minimum(met[bits] + np.minimum(times, 2), 2)
        tables = (counts.astype(np.uint32), np.packbits(met > 0), np.packbits(met > 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(_CHUNKS), pa.int32()), *(pa.array([c.tobytes() for c in np.split(t, _CHUNKS)], pa.binary()) for t in tables)],
            names=["chunk", "counts", "once", "more"],
        )
        give_back()

    def add(table: pa.Table) -> pa.Table:
        total, seen, again = np.zeros(_BUCKETS // _CHUNKS, np.uint32), *np.zeros((2, _BITS // 8 // _CHUNKS), np.uint8)
        for row in zip(*(table.column(c) for c in ("counts", "once", "more"))):
            counts, once, more = (np.frombuffer(x.as_buffer(), kind) for x, kind in zip(row, (np.uint32, np.uint8, np.uint8)))
            total += counts
            again |= more | (seen & once)
            seen |= once
        out = [pa.array([t.tobytes()], pa.binary()) for t in (total, seen, again)]
        return pa.table([table.column("chunk")[:1], *out], names=["chunk", "counts", "once", "more"])

    schema = "chunk int, counts binary, once binary, more binary"
    found = docs.select("text").coalesce(tasks).mapInArrow(run, schema).groupBy("chunk").applyInArrow(add, schema)
    chunks = materialise(found, "counts").select("chunk", "counts", "more").orderBy("chunk").collect()
    return tuple(np.concatenate([np.frombuffer(c[name], kind) for c in chunks]) for name, kind in (("counts", np.uint32), ("more", np.uint8)))


def document_sets(docs: DataFrame, width: int) -> DataFrame:
    """doc, n, f1, f2 of every row of ``docs`` (doc, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch, "text"):
                sets = shingle_sets(rows.column("text"), width)
                sums = [(mix64(s).sum(dtype=np.uint64), mix64(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)) for s in sets]
                flat = np.array(sums, np.uint64).reshape(-1, 2).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc"), pa.array(map(len, sets), pa.int64()), pa.array(flat[:, 0]), pa.array(flat[:, 1])],
                    names=["doc", "n", "f1", "f2"],
                )
            give_back()

    return docs.select("doc", "text").mapInArrow(run, "doc long, n long, f1 long, f2 long")


def candidate_edges(
    docs: DataFrame, groups: int, width: int, num: int, den: int, sign: Callable[[np.ndarray, int, np.ndarray], np.ndarray] | None = None
) -> DataFrame:
    """Edges a, b between documents (doc, cluster, text) that share a signature; every list of equal signatures becomes a star.

    ``sign`` gives the signatures of a set, its cluster and the size classes; without it, those of its parts.
    """
    sign = sign or (lambda s, cluster, bounds: signatures(s, bounds, num, den))

    def emit(sig: np.ndarray, doc: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((doc, sig))
        sig, doc = sig[order], doc[order]
        first = np.concatenate(([True], sig[1:] != sig[:-1]))
        # Documents of this batch with a part in common: one of them stands for the others from here on.
        heads = doc[np.maximum.accumulate(np.where(first, np.arange(len(sig)), 0))]
        pairs = np.unique(np.stack((doc[~first], heads[~first]), 1), axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(1, -1)), pa.array([pairs[:, 0].tobytes()], pa.binary()), pa.array([pairs[:, 1].tobytes()], pa.binary())],
            names=["grp", "left", "right"],
        )
        sig, doc = sig[first], doc[first]
        grp = (sig.view(np.uint64) % np.uint64(groups)).astype(np.int64)
        order = np.argsort(grp, kind="stable")
        ids, starts = np.unique(grp[order], return_index=True)
        cuts = list(zip(starts, np.append(starts[1:], len(order))))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids),
                pa.array([sig[order[s:e]].tobytes() for s, e in cuts], pa.binary()),
                pa.array([doc[order[s:e]].tobytes() for s, e in cuts], pa.binary()),
            ],
            names=["grp", "left", "right"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_sig, held_doc, held = [], [], 0
        bounds = size_classes(1 << 12, num, den)
        for batch in batches:
            for rows in text_slices(batch, "text"):
                keys = (np.asarray(rows.column(c)) for c in ("doc", "cluster"))
                for doc, cluster, s in zip(*keys, shingle_sets(rows.column("text"), width)):
                    if len(s):
                        if len(s) >= bounds[-2]:
                            bounds = size_classes(2 * len(s), num, den)
                        sig = sign(s, cluster, bounds).view(np.int64)
                        held_sig.append(sig)
                        held_doc.append(np.full(len(sig), doc))
                        held += len(sig)
                if held > 400_000:
                    yield from emit(np.concatenate(held_sig), np.concatenate(held_doc))
                    held_sig, held_doc, held = [], [], 0
            give_back()
        if held:
            yield from emit(np.concatenate(held_sig), np.concatenate(held_doc))
        give_back()

    def meet(table: pa.Table) -> pa.Table:
        left = np.frombuffer(b"".join(table.column("left").to_pylist()), np.int64)
        right = np.frombuffer(b"".join(table.column("right").to_pylist()), np.int64)
        if table.column("grp")[0].as_py() >= 0:
            order = np.lexsort((right, left))
            sig, doc = left[order], right[order]
            first = np.concatenate(([True], sig[1:] != sig[:-1]))
            heads = doc[np.maximum.accumulate(np.where(first, np.arange(len(sig)), 0))]
            left, right = doc[~first], heads[~first]
        pairs = np.unique(np.stack((left, right), 1), axis=0)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    lists = docs.select("doc", "cluster", "text").mapInArrow(run, "grp long, left binary, right binary")
    # Group -1 holds the edges found inside a batch; it only passes through, dealt over as many tasks as the others.
    spread = F.when(F.col("grp") >= 0, F.col("grp")).otherwise(-1 - F.pmod(F.hash("left"), F.lit(groups)))
    found = lists.groupBy(spread.alias("g")).applyInArrow(meet, "a long, b long")
    # Near copies meet in many groups: their edges come together here, else every task's forest would hold them again.
    return found.repartition("a")


def search_links(
    ids: np.ndarray, sets: list[np.ndarray], part: np.ndarray, role: np.ndarray, num: int, den: int
) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the groups ``part`` of a task's documents. Role 0 asks and is found, 1 only asks, 2 is only found."""
    _, root = np.unique(part, return_inverse=True)
    root = root.copy()
    sizes = np.array([len(s) for s in sets])
    found = [i for i in range(len(sets)) if role[i] != 1]
    flat = np.concatenate([sets[i] for i in found] or [np.empty(0, np.uint64)])
    owner = np.repeat(np.array(found, np.int64), sizes[found] if found else 0)
    order = np.argsort(flat, kind="stable")  # lists hold documents in rising order
    flat, owner = flat[order], owner[order]
    keys, starts = np.unique(flat, return_index=True)
    stops = np.append(starts[1:], len(flat))
    ea, eb = [], []
    for i in np.argsort(sizes, kind="stable"):
        if role[i] == 2 or not sizes[i]:
            continue
        if (root == root[i]).all():
            continue
        s = int(sizes[i])
        at = np.searchsorted(keys, sets[i])
        at[at == len(keys)] = 0
        at = at[keys[at] == sets[i]] if len(keys) else at[:0]
        least = -(-num * s // den)  # the smallest overlap any partner needs
        aside = least - max(1, least // 20)
        lengths = stops[at] - starts[at]
        by = at[np.argsort(lengths, kind="stable")]
        short, long = by[: max(0, len(by) - aside)], by[max(0, len(by) - aside) :]
        if not len(short):
            continue
        merged = np.concatenate([owner[starts[k] : stops[k]] for k in short])
        docs, hits = np.unique(merged, return_counts=True)
        need = -(-num * (s + sizes[docs]) // (num + den))  # T of each document found
        ok = (hits >= need - len(long)) & (root[docs] != root[i]) & (np.minimum(sizes[docs], s) * den >= np.maximum(sizes[docs], s) * num)
        docs, hits, need = docs[ok], hits[ok], need[ok]
        for k in np.argsort(-hits, kind="stable"):
            j = int(docs[k])
            if root[j] == root[i]:
                continue
            total = int(hits[k])
            if len(long):  # binary probes of the long lists, all at once: is shingle k's list holding j?
                inside = np.searchsorted(sets[j], keys[long])
                inside[inside == len(sets[j])] = 0
                total += int((sets[j][inside] == keys[long]).sum())
            if total >= need[k]:
                ea.append(ids[i])
                eb.append(ids[j])
                root[root == root[j]] = root[i]
    return np.array(ea, np.int64), np.array(eb, np.int64)


def _search(dealt: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Verified edges of the tasks in ``dealt`` (rep, cluster, task, part, role, text)."""

    def run(table: pa.Table) -> pa.Table:
        ids, part, role = (np.asarray(table.column(c)) for c in ("rep", "part", "role"))
        sets = []
        for batch in table.select(["text"]).combine_chunks().to_batches():
            for rows in text_slices(batch, "text"):
                sets += shingle_sets(rows.column("text"), width)
        cluster = np.asarray(table.column("cluster"))
        ea, eb = [], []
        for c in np.unique(cluster):
            at = np.flatnonzero(cluster == c)
            a, b = search_links(ids[at], [sets[i] for i in at], part[at], role[at], num, den)
            ea.append(a)
            eb.append(b)
        return pa.table({"a": pa.array(np.concatenate(ea)), "b": pa.array(np.concatenate(eb))})

    rows = dealt.select("rep", "cluster", "task", "part", "role", "text")
    return materialise(rows.groupBy("task").applyInArrow(run, "a long, b long"), "verified")


def _groups(n: int) -> int:
    """Groups of candidate lists for ``n`` documents."""
    return max(64, 1 << max(0, math.ceil(math.log2(max(1, n) / 4096))))


def _clusters(reps: DataFrame, near: DataFrame) -> DataFrame:
    """rep, cluster, size of the representatives that share a candidate component with another one."""
    members = reps.distinct().join(near, F.col("rep") == F.col("node")).select("rep", F.col("component").alias("cluster"))
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return materialise(members.join(sizes, "cluster").select("rep", "cluster", "size"), "members")


def _split_clusters(held: DataFrame, block: int, width: int, num: int, den: int) -> DataFrame:
    """``held`` (rep, cluster, size, text) with the clusters above ``block`` split by the rarest shingles of their documents."""
    small, before = [], math.inf
    while True:
        large = held.filter(F.col("size") > block)
        n = large.count()
        if not n or n > 0.8 * before:
            return reduce(DataFrame.union, small, held)
        small.append(held.filter(F.col("size") <= block))
        before = n
        tables = held.sparkSession.sparkContext.broadcast(shingle_counts(large, -(-n // 8192), width))
        sign = lambda s, cluster, bounds, tables=tables: prefix_signatures(s, tables.value, cluster, bounds, num, den)
        docs = large.select(F.col("rep").alias("doc"), "cluster", "text")
        near = components(candidate_edges(docs, _groups(n), width, num, den, sign))
        held = materialise(_with_texts(_clusters(large.select("rep"), near), docs.drop("cluster")), "candidate-texts")


def _with_texts(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """``rows`` (rep and more) with their texts, which are dealt by key at every size, so that the work grows as on small inputs."""
    return texts.join(rows.hint("merge"), F.col("doc") == F.col("rep")).select(*rows.columns, "text")


def jaccard_components(
    docs: DataFrame, width: int = 3, num: int = 90, den: int = 100, block: int = 512, key: str = "doc_id"
) -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id (smallest key reachable by links)."""
    texts = docs.select(F.col(key).cast("long").alias("doc"), "text")
    sets = materialise(document_sets(texts, width), "sets")
    keyed = sets.filter("doc is not null and n > 0")
    classes = materialise(keyed.groupBy("n", "f1", "f2").agg(F.min("doc").alias("rep")), "classes")
    texts = texts.filter("doc is not null")
    whole = texts.withColumn("cluster", F.lit(0).cast("long"))
    near = components(candidate_edges(whole, _groups(sets.count()), width, num, den))
    # Representatives by candidate component; a component of one representative holds copies only.
    members = _clusters(classes.select("rep"), near)
    # All texts are shuffled once; what follows reads those of candidates only.
    held = _split_clusters(materialise(_with_texts(members, texts), "candidate-texts"), block, width, num, den)
    packs = max(1, math.ceil(held.count() / max(1, block // 4)))
    alone = F.col("size") <= block
    piece = lambda salt: F.pmod(F.xxhash64("rep", F.lit(salt)), F.ceil(F.col("size") / block))
    task: Column = F.when(alone, F.struct(F.lit(0).alias("kind"), F.pmod(F.hash("cluster"), F.lit(packs)).cast("long").alias("c"),
                                          F.lit(0).cast("long").alias("x"))).otherwise(
        F.struct(F.lit(1).alias("kind"), F.col("cluster").alias("c"), piece(0).cast("long").alias("x")))
    zero = F.lit(0).alias("role")
    edges = _search(held.select("rep", "cluster", task.alias("task"), F.col("rep").alias("part"), zero, "text"), width, num, den)
    large = held.filter(~alone).select("rep", "cluster", "size").distinct()
    if large.limit(1).count():
        blocks = held.filter(~alone).select(F.col("rep").alias("doc"), "text")
        edges = materialise(edges.union(_join_blocks(blocks, large, edges, block, width, num, den)), "verified")
    linked = components(edges)
    labelled = materialise(classes.join(linked, F.col("rep") == F.col("node"), "left").select(
        "n", "f1", "f2", F.coalesce("component", "rep").alias("part")
    ), "labelled")
    # A document key with several texts ties its classes together.
    out = sets.alias("s").join(
        labelled.alias("l"),
        (F.col("s.n") == F.col("l.n")) & (F.col("s.f1") == F.col("l.f1")) & (F.col("s.f2") == F.col("l.f2"))
        & F.col("s.doc").isNotNull(), "left",
    )
    return out.select(
        F.col("s.doc").alias(key), F.col("s.n").alias("n_shingles"), F.coalesce("l.part", "s.doc").alias("component_id")
    )


def _parts(members: DataFrame, edges: DataFrame) -> DataFrame:
    """rep, cluster, part: the component of each member by the edges found so far."""
    found = components(edges)
    return materialise(members.select("rep", "cluster").join(found, F.col("rep") == F.col("node"), "left").select(
        "rep", "cluster", F.coalesce("component", "rep").alias("part")
    ), "parts")


def _join_blocks(texts: DataFrame, large: DataFrame, edges: DataFrame, block: int, width: int, num: int, den: int) -> DataFrame:
    """Edges between the blocks of large candidate components; ``texts`` (doc, text) are theirs."""
    extra = edges.limit(0)
    salt = 0
    while True:
        parts = _parts(large, edges.union(extra))
        # One document per component found so far, blocks of them dealt anew each round.
        heads = parts.filter("rep = part")
        sizes = heads.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        heads = materialise(heads.join(sizes, "cluster"), "heads")
        n = heads.count()
        if not n:
            return extra
        salt += 1
        x = F.pmod(F.xxhash64("rep", F.lit(salt)), F.ceil(F.col("size") / block)).cast("long")
        task = F.struct(F.lit(2).alias("kind"), F.col("cluster").alias("c"), x.alias("x"))
        dealt = heads.select("rep", "cluster", task.alias("task"), "part", F.lit(0).alias("role"))
        new = _search(_with_texts(dealt, texts), width, num, den)
        extra = materialise(extra.union(new), "verified")
        if new.count() < n / 8:  # heads hardly meet any more
            break
    # Whatever is outside a cluster's largest component asks all documents of the cluster, block against block.
    parts = _parts(large, edges.union(extra))
    counts = parts.groupBy("cluster", "part").agg(F.count(F.lit(1)).alias("n"))
    main = counts.groupBy("cluster").agg(
        F.max_by("part", F.struct("n", "part")).alias("main"), F.sum("n").alias("all"), (F.sum("n") - F.max("n")).alias("rest")
    ).filter("rest > 0")
    rows = materialise(parts.join(main, "cluster"), "apart")
    n_ask, n_all = F.ceil(F.col("rest") / block), F.ceil(F.col("all") / block)
    mine_ask, mine = F.pmod(F.xxhash64("rep", F.lit(-1)), n_ask), F.pmod(F.xxhash64("rep", F.lit(-2)), n_all)
    deal = lambda df, a, b, role: df.select("rep", "cluster", F.struct(F.lit(3).alias("kind"), F.col("cluster").alias("c"), (F.lit(a) * 1_000_003 + b).alias("x")).alias("task"), "part", F.lit(role).alias("role"))  # noqa: E731,E501
    # One asking block of every cluster at a time: a round copies each text about twice, all at once would do so for every block.
    for a in range(rows.agg(F.max(n_ask)).first()[0] or 0):
        asks = rows.filter("part <> main").filter(mine_ask == a).withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), n_all - 1)))
        told = rows.filter(n_ask > a)
        both = deal(asks, a, F.col("b"), 1).union(deal(told, a, mine, 2))
        extra = materialise(extra.union(_search(_with_texts(both, texts), width, num, den)), "verified")
    return extra
