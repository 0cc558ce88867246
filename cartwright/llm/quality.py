"""Quality scores by nearest-neighbour voting over latent-semantic vectors.

A text becomes counts of hashed byte pairs (character shapes and letter pairs alike), its repetition and shape statistics included;
they are damped, weighted by inverse document frequency over the whole corpus, and projected to a few latent dimensions
found by a singular value decomposition of the labelled texts. The labelled vectors are broadcast; every document's
cosine products with all of them are computed exactly in blocks, and the labels of the nearest ones vote, weighted by
similarity.

The labelled sample is bounded by ``max_labelled`` rows, a parameter: the rows of smallest hash of their key, so the sample is the
same on every run. Corpus statistics cover all documents.

Defined cases: null and empty texts are scored by the prior share of label 1; labels that are null or whose document is missing are
not learned; without any usable label every score is 0.5; repeated labels of a document count once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import give_back, text_slices
from cartwright.session import materialise

WIDTH = 1024  # hashed byte pairs
_SHAPES = 8  # classes of bytes, for pairs and triples of shapes
_EXTRA = _SHAPES**3 + 16
FEATURES = WIDTH + _EXTRA

# Byte classes: 0 space, 1 line feed, 2 lower case, 3 upper case, 4 digit, 5 sentence marks, 6 other ASCII, 7 beyond ASCII.
_CLASS = np.full(256, 6, np.int64)
_CLASS[[9, 11, 12, 13, 32]] = 0
_CLASS[10] = 1
_CLASS[97:123] = 2
_CLASS[65:91] = 3
_CLASS[48:58] = 4
_CLASS[[33, 34, 39, 44, 45, 46, 58, 59, 63]] = 5
_CLASS[128:] = 7


def text_features(text: bytes) -> np.ndarray:
    """Damped counts of one text: letter pairs, shape triples and repetition levels."""
    out = np.zeros(FEATURES, np.float32)
    if len(text) < 3:
        return out
    data = np.frombuffer(text, np.uint8)
    pairs = (data[:-1].astype(np.int64) * 31 + data[1:] * 7) % WIDTH
    shape = _CLASS[data]
    triples = (shape[:-2] * _SHAPES + shape[1:-1]) * _SHAPES + shape[2:]
    out[:WIDTH] = np.bincount(pairs, minlength=WIDTH)
    out[WIDTH : WIDTH + _SHAPES**3] = np.bincount(triples, minlength=_SHAPES**3)
    out *= 1000.0 / len(data)
    out = np.log1p(out)
    # Repetition: share of distinct words and lines and of what a compressor saves, as soft levels.
    words, lines = text.split(), text.split(b"\n")
    packed = len(zlib.compress(text, 1)) / len(text)
    for at, share in enumerate((len(set(words)) / max(1, len(words)), len(set(lines)) / len(lines), packed)):
        level = min(4, int(share * 5))
        out[WIDTH + _SHAPES**3 + at * 5 + level] = 4.0
    return out


def _matrix(texts: pa.Array) -> np.ndarray:
    return np.stack([text_features((t.as_py() or "").encode()) for t in texts]) if len(texts) else np.zeros((0, FEATURES), np.float32)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Number of documents with each feature, and of all documents: one small row per task, added up in Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for part in text_slices(batch, "text"):
                total += (_matrix(part.column("text")) > 0).sum(0)
                n += part.num_rows
        at = np.arange(FEATURES + 1)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(total, n))], names=["f", "n"])

    rows = docs.select("text").mapInArrow(run, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(FEATURES + 1, np.int64)  # FEATURES + 1 rows, however many documents
    for r in rows:
        out[r["f"]] = r["n"]
    return out[:-1], int(out[-1])


def labelled_sample(docs: DataFrame, labels: DataFrame, usable: Column, max_labelled: int, key: str) -> pd.DataFrame:
    """At most ``max_labelled`` labelled texts; ``usable`` says which keys may be learned from."""
    order = F.xxhash64(F.lit(5), F.col("_k"))
    chosen = (
        labels.filter(F.col("quality").isin(0, 1)).select(F.col(key).alias("_k"), "quality").filter(usable)
        .groupBy("_k").agg(F.max("quality").alias("quality"))
        .orderBy(order, "_k").limit(max_labelled)
    )
    chosen = materialise(chosen, "labelled")
    joined = docs.select(F.col(key).alias("_d"), "text").join(F.broadcast(chosen), F.col("_d") == F.col("_k"))
    # The sample is bounded by rows; its features, not its texts, come to the driver.

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                rows = _matrix(part.column("text")).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_k"), part.column("quality"), pa.array([r.tobytes() for r in rows], pa.binary())],
                    names=["_k", "quality", "features"],
                )

    kind = labels.schema[key].dataType.simpleString()
    rows = joined.select("_k", "quality", "text").mapInArrow(run, f"_k {kind}, quality int, features binary")
    return rows.dropDuplicates(["_k"]).toPandas().sort_values("_k").reset_index(drop=True)


class NeighbourModel:
    """Projection and labelled vectors; small enough to broadcast whatever the corpus size."""

    def __init__(self, sample: pd.DataFrame, df: np.ndarray, n_docs: int, dims: int = 48, k: int = 25):
        self.k = k
        self.prior = float(sample["quality"].mean()) if len(sample) else 0.5
        self.idf = np.log((1.0 + n_docs) / (1.0 + df)).astype(np.float32) + 0.25
        rows = np.stack([np.frombuffer(f, np.float16) for f in sample["features"]]) if len(sample) else np.zeros((0, FEATURES))
        weighted = self._weigh(rows.astype(np.float32))
        self.labels = sample["quality"].to_numpy(np.float32)
        if len(sample) > 1:
            _, vectors = np.linalg.eigh(weighted.T.astype(np.float64) @ weighted)
            self.basis = np.ascontiguousarray(vectors[:, ::-1][:, :dims]).astype(np.float32)
        else:
            self.basis = np.zeros((FEATURES, 1), np.float32)
        self.vectors = self._project(weighted)

    def _weigh(self, rows: np.ndarray) -> np.ndarray:
        rows = rows * self.idf
        norm = np.linalg.norm(rows, axis=1, keepdims=True)
        return rows / np.where(norm > 0, norm, 1)

    def _project(self, weighted: np.ndarray) -> np.ndarray:
        out = weighted @ self.basis
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm > 0, norm, 1)

    def score(self, texts: pa.Array, block: int = 512) -> np.ndarray:
        out = np.empty(len(texts))
        for at in range(0, len(texts), block):
            rows = _matrix(texts.slice(at, block))
            seen = rows.any(1)
            near = self._project(self._weigh(rows)) @ self.vectors.T
            if near.shape[1] > 1:
                k = min(self.k, near.shape[1])
                top = np.argpartition(-near, k - 1, axis=1)[:, :k]
                sims = np.maximum(np.take_along_axis(near, top, 1), 0) ** 8 + 1e-9  # close neighbours outvote far ones
                votes = (sims * self.labels[top]).sum(1) / sims.sum(1)
            else:
                votes = np.full(len(rows), self.prior)
            out[at : at + len(rows)] = np.where(seen, votes, self.prior)
        return np.clip(out, 0.0, 1.0)


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    max_labelled: int = 4096,
    dims: int = 48,
    k: int = 25,
    key: str = "doc_id",
    keep: bool = False,
) -> DataFrame:
    """key and score (with ``keep`` all columns of ``docs`` and ``_score``). ``usable`` is a condition on ``_k``, the key."""
    df, n = document_frequencies(docs)
    model = NeighbourModel(labelled_sample(docs, labels, usable, max_labelled, key), df, n, dims, k)
    held = docs.sparkSession.sparkContext.broadcast(model)
    if keep:  # only texts go to Python and only scores come back
        @F.arrow_udf("double")
        def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in texts:
                rows = pa.RecordBatch.from_arrays([batch], names=["text"])
                parts = [held.value.score(part.column("text")) for part in text_slices(rows, "text")]
                yield pa.array(np.concatenate(parts or [np.empty(0)]))
                give_back()

        return docs.withColumn("_score", scored("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                scores = pa.array(held.value.score(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column(key), scores], names=[key, "score"])

    return docs.select(key, "text").mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, score double")


def learnable(column: str = "_k") -> Column:
    """The contract's training part: keys whose crc32 (of the key as text) mod 3 is not 1."""
    return F.crc32(F.col(column).cast("string")) % 3 != 1
