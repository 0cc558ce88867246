"""Personal data: exact patterns, and further spans by a skip-chain conditional random field.

Base spans follow fixed patterns (email, ip, card, phone). The field labels the *carriers* of a document: its stretches
without white space that hold a digit or an at sign, at most ``_LONGEST`` characters of which carry features. Every other word is
outside all entities and is no node.

Potentials. A carrier's own potential is a softmax over a few discrete features of its shape; one that fails a check by itself
speaks against an entity by ``_FAILED``. Carriers with only white space between
share a chain potential. Carriers of one document that repeat each other (equal letters and digits), or are similar (equal last
seven digits, or an equal name before the at sign), share a skip potential; each is linked to the one before it in its
group, so links grow with the carriers and not with their pairs.

Training. Base spans are the labels. A carrier inside a stretch that fails its check (a wrong checksum, a part above 255, too
many digits) is left out of training if it would pass alone, as its label is what the field is to decide; else it is none. One pass counts (features, label), neighbouring labels
and repeated labels over all documents; these tables have a size bound of their own, and the weights are fitted from them.

Inference. Loopy sum-product messages over the carriers of a batch of documents, with base spans as observed labels, for a fixed
number of rounds. Carriers whose best label is an entity of marginal ``least`` or more, outside base spans, become spans;
neighbouring parts of a phone number join to one span.

Defined cases: null and empty texts have no spans; texts of any length are read whole; repeated rows give equal rows; other columns
are ignored; an empty table gives an empty result. Offsets are code points.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
_LABELS = 1 + len(KINDS)  # 0: none
_LONGEST = 200
_FAILED = 8.0  # log odds for no entity that a failed check of the carrier by itself is worth

# The patterns of the base spans. The look-behinds only skip starts inside a run that was already tried.
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = str.maketrans("", "", " -().+")
_SENSITIVE = re.compile(r"[0-9@]")
_CARRIER = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")


def _luhn(digits: str) -> bool:
    """Whether the checksum over the digits, every second one from the right doubled, is a multiple of ten."""
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(2 * int(d) - 9 * (d > "4") for d in even)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches around each at sign: the run of name characters before it, not before the last match, and a domain after it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Spans (kind, start, end) of the fixed patterns, and stretches that match a pattern but fail its check."""
    found: list[tuple[int, int, int]] = []
    failed: list[tuple[int, int, int]] = []
    if not text or not _SENSITIVE.search(text):
        return found, failed
    if "@" in text:
        found += [(1, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        good = all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split("."))
        (found if good else failed).append((2, *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().translate(_DIGITS)
        if 13 <= len(digits) <= 19:
            (found if _luhn(digits) else failed).append((3, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            n = len(m.group().translate(_DIGITS))
            (found if 9 <= n <= 15 else failed).append((4, *m.span()))
    return found, failed


def _features(word: str) -> tuple[int, ...]:
    """Discrete shape of a carrier; the number of different values is bounded by the product of the sizes in ``_SIZES``."""
    digits = sum(c.isdigit() for c in word[:_LONGEST])
    core = word.rstrip(".,;:!?")
    return (
        int(np.searchsorted((1, 4, 7, 9, 13, 20), digits, side="right")),
        min(word.count("."), 4),
        int("@" in word),
        int(any(c.isalpha() for c in word)),
        int(word[0] == "+"),
        int("-" in core or "(" in core),
        _alone(word),
    )


_SIZES = (7, 5, 2, 2, 2, 2, 3)


def _alone(word: str) -> int:
    """1 if the carrier is a base span by itself, 2 if it fails a check, else 0."""
    found, failed = base_spans(word[:_LONGEST])
    return 1 if found else 2 if failed else 0


class Graph:
    """Carriers of a batch of documents with observed labels, features, chain and skip edges."""

    def __init__(self):
        self.doc: list[int] = []
        self.span: list[tuple[int, int]] = []
        self.seen: list[int] = []  # observed label; -1: open, left out of training; -2: open, trained as none
        self.features: list[int] = []
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []

    def add(self, doc: int, text: str, found: list, failed: list) -> None:
        marks = sorted([(a, b, k) for k, a, b in found] + [(a, b, -1) for _, a, b in failed])
        last: dict[tuple[str, str], int] = {}
        at, before = 0, -1
        for m in _CARRIER.finditer(text):
            start, stop = m.span()
            word = m.group()
            while at < len(marks) and marks[at][1] <= start and (at + 1 < len(marks)):
                at += 1
            label, k = -2, at
            while k < len(marks) and marks[k][0] < stop:
                if marks[k][1] > start:
                    label = max(label, marks[k][2])
                k += 1
            node = len(self.seen)
            # The core leaves out marks around the word.
            left, right = 0, len(word)
            while left < right and not (word[left].isalnum() or word[left] in "+(@"):
                left += 1
            while right > left and not (word[right - 1].isalnum() or word[right - 1] == ")"):
                right -= 1
            core = word[left:right] or word
            self.doc.append(doc)
            self.span.append((start + left, start + max(right, left + 1)))
            shape = _features(core)
            self.seen.append(-2 if label == -1 and shape[-1] != 1 else label)
            self.features.append(int(np.ravel_multi_index(shape, _SIZES)))
            if before >= 0 and text[self._stop : start].isspace():
                self.chain.append((node - 1, node))
            before, self._stop = node, stop
            plain = "".join(c for c in core.lower() if c.isalnum())
            digits = "".join(c for c in core if c.isdigit())
            groups = [("same", plain)] if plain else []
            if len(digits) >= 7 and len(digits) == len(plain):
                groups.append(("tail", digits[-7:]))
            if "@" in core[1:]:
                groups.append(("name", core.lower().split("@", 1)[0]))
            linked = set()
            for group in groups:
                if group in last and last[group] not in linked:
                    linked.add(last[group])
                    self.skip.append((last[group], node))
                last[group] = node


def _graphs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list, Graph]]:
    """Keys, base spans of every document and the graph of a batch."""
    for batch in batches:
        graph, spans = Graph(), []
        for i, text in enumerate(batch.column(1).to_pylist()):
            found, failed = base_spans(text)
            spans.append(found)
            if text and _SENSITIVE.search(text):
                graph.add(i, text, found, failed)
        yield batch.column(0), spans, graph


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training tables of a task: (what, x, y, n) with features and label, neighbouring labels, repeated labels."""
    total: dict[tuple[int, int, int], int] = {}
    for _, _, graph in _graphs(batches):
        if not graph.seen:
            continue
        seen = np.array(graph.seen)
        label = np.where(seen == -2, 0, seen)
        rows = [np.stack((np.zeros(len(seen), int), graph.features, label))]
        for what, edges in ((1, graph.chain), (2, graph.skip)):
            if edges:
                a, b = np.array(edges).T
                rows.append(np.stack((np.full(len(a), what), label[a], label[b])))
        table = np.concatenate(rows, axis=1)
        keys, n = np.unique(table[:, (table >= 0).all(axis=0)], axis=1, return_counts=True)
        for key, count in zip(map(tuple, keys.T.tolist()), n.tolist()):
            total[key] = total.get(key, 0) + count
    if total:
        what, x, y = zip(*total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(what), pa.array(x), pa.array(y), pa.array(list(total.values()))], names=["what", "x", "y", "n"]
        )


class Model:
    """Weights of the field: log potentials per feature value, per neighbouring pair and per repeated pair of labels."""

    def __init__(self, shapes: np.ndarray, chain: np.ndarray, skip: np.ndarray, rounds: int = 300, ridge: float = 1e-2):
        """``shapes``: rows (features, label, count); ``chain`` and ``skip``: counts of label pairs."""
        self.offsets = np.cumsum((0, *_SIZES))
        width = self.offsets[-1] + 1
        self.weights = np.zeros((width, _LABELS))
        if len(shapes):
            x = self._design(shapes[:, 0])
            n = shapes[:, 2].astype(float)
            share = n / n.sum()
            y = np.eye(_LABELS)[shapes[:, 1]]
            # Every label counts alike, so that rare kinds are learnt.
            size = np.maximum((y * share[:, None]).sum(axis=0), 1e-12)
            share = share / size[shapes[:, 1]] / (size > 1e-12).sum()
            step, speed = 2.0, np.zeros_like(self.weights)
            for _ in range(rounds):
                p = self._soft(x @ self.weights)
                slope = x.T @ ((p - y) * share[:, None]) + ridge * self.weights / len(shapes)
                speed = 0.9 * speed - step * 0.1 * slope
                self.weights += speed
            self.weights[:, size <= 1e-12] = 0.0
            self.weights[-1, size <= 1e-12] = -20.0
        self.chain = self._ratio(chain)
        self.skip = self._ratio(skip + 5.0 * np.eye(_LABELS))

    @staticmethod
    def _soft(z: np.ndarray) -> np.ndarray:
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    @staticmethod
    def _ratio(counts: np.ndarray) -> np.ndarray:
        """Log of how much more often two labels meet than by chance, symmetric and smoothed."""
        both = counts + counts.T + 0.5
        one = both.sum(axis=1)
        return np.clip(np.log(both * both.sum() / one[:, None] / one[None, :]), -4.0, 4.0)

    def _design(self, features: np.ndarray) -> np.ndarray:
        parts = np.unravel_index(features, _SIZES)
        x = np.zeros((len(features), self.weights.shape[0]))
        for part, offset in zip(parts, self.offsets):
            x[np.arange(len(features)), offset + part] = 1.0
        x[:, -1] = 1.0
        return x

    def marginals(self, graph: Graph, rounds: int = 10) -> np.ndarray:
        """Label probabilities of all carriers by loopy message passing (damped, log space)."""
        own = np.log(np.maximum(self._soft(self._design(np.array(graph.features)) @ self.weights), 1e-9))
        own[np.unravel_index(np.array(graph.features), _SIZES)[-1] == 2, 0] += _FAILED
        seen = np.array(graph.seen)
        known = np.flatnonzero(seen >= 1)
        own[known] = -30.0
        own[known, seen[known]] = 0.0
        edges = np.array(graph.chain + graph.skip, int).reshape(-1, 2)
        if not len(edges):
            return self._soft(own)
        table = np.concatenate((np.repeat(self.chain[None], len(graph.chain), 0), np.repeat(self.skip[None], len(graph.skip), 0)))
        source, target = edges.T.ravel(), edges[:, ::-1].T.ravel()  # both directions of every edge
        table = np.concatenate((table, table))  # symmetric
        back = np.concatenate((np.arange(len(edges), 2 * len(edges)), np.arange(len(edges))))
        sent = np.zeros((len(source), _LABELS))
        for _ in range(rounds):
            belief = own.copy()
            np.add.at(belief, target, sent)
            z = (belief[source] - sent[back])[:, :, None] + table
            top = z.max(axis=1)
            new = top + np.log(np.exp(z - top[:, None, :]).sum(axis=1))
            new -= new.max(axis=1, keepdims=True)
            sent = 0.5 * sent + 0.5 * new
        belief = own.copy()
        np.add.at(belief, target, sent)
        return self._soft(belief)


def train(docs: DataFrame) -> Model:
    """The field's weights from the base spans of all documents. Gathered are at most shapes x labels + two label tables."""
    counted = docs.select(F.lit(0).alias("_"), "text").mapInArrow(_counts, "what long, x long, y long, n long")
    rows = counted.groupBy("what", "x", "y").agg(F.sum("n").alias("n")).orderBy("what", "x", "y").collect()
    shapes = np.array([(r.x, r.y, r.n) for r in rows if r.what == 0], np.int64).reshape(-1, 3)
    tables = np.zeros((2, _LABELS, _LABELS))
    for r in rows:
        if r.what:
            tables[r.what - 1, r.x, r.y] = r.n
    return Model(shapes, tables[0], tables[1])


def added_spans(graph: Graph, probability: np.ndarray, spans: list[list[tuple[int, int, int]]], least: float) -> None:
    """Append to each document's spans what the field finds outside its base spans."""
    label = np.where(probability[:, 1:].max(axis=1, initial=0.0) >= least, probability[:, 1:].argmax(axis=1) + 1, 0)
    joined = {b for a, b in graph.chain}
    base: dict[int, list[tuple[int, int]]] = {}
    for node in np.flatnonzero((label > 0) & (np.array(graph.seen) < 1)).tolist():
        doc, (start, stop), kind = graph.doc[node], graph.span[node], int(label[node])
        if doc not in base:
            base[doc] = sorted((a, b) for _, a, b in spans[doc])
        taken = base[doc]
        k = int(np.searchsorted([b for _, b in taken], start, side="right"))
        if k < len(taken) and taken[k][0] < stop:
            continue
        previous = spans[doc][-1] if spans[doc] else None
        if previous and kind == 4 and node in joined and label[node - 1] == kind and graph.seen[node - 1] < 1 and previous[2] == graph.span[node - 1][1]:
            spans[doc][-1] = (kind, previous[1], stop)
        else:
            spans[doc].append((kind, start, stop))


def find_personal_data(docs: DataFrame, key: str = "doc_id", least: float = 0.9, model: Model | None = None) -> DataFrame:
    """key, base and spans: arrays of (kind, start, end), base ones and all, by kind as in ``KINDS``, then start."""
    model = model or train(docs)
    kind = docs.schema[key].dataType.simpleString()
    span = "array<struct<kind: string, start: long, end: long>>"
    shape = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def rows(spans: list[list[tuple[int, int, int]]]) -> pa.Array:
        return pa.array([[(KINDS[k - 1], a, b) for k, a, b in sorted(s)] for s in spans], shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, spans, graph in _graphs(batches):
            base = rows(spans)
            if graph.seen:
                added_spans(graph, model.marginals(graph), spans, least)
            yield pa.RecordBatch.from_arrays([keys, base, rows(spans)], names=[key, "base", "spans"])

    return docs.select(key, "text").mapInArrow(run, f"`{key}` {kind}, base {span}, spans {span}")
