"""Exact token counts of a sentencepiece BPE model by a compiled finite-state transducer.

No piece of the vocabulary joins a character other than a space to a following space, nor (checked on loading) holds a
line feed; merges therefore never cross those places. The tokenizer is a deterministic transducer whose state is the path
read since the last such place, whose states are compiled when first met, and whose transitions into a new segment emit the
token count of the segment that ends. Counts come from the library once per distinct segment.

A text is cut into chunks anywhere. A chunk's state map is (open head, count, open tail): what it does from any starting
state is to finish the head, add its count, and leave the tail as the new state. Maps compose associatively, so the chunks'
maps are combined by a parallel prefix scan.

Defined cases: a null or empty text has 0 bytes and 0 tokens; any length is counted whole; repeated rows repeat.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_MEMO = 1_000_000  # compiled states kept; a full table is started anew, which changes no count
_CHUNK = 65_536
_SPACE = "▁"
_SEGMENT = re.compile(r"\n| +[^ \n]*|[^ \n]+")
_EDGE = re.compile(r"[ \n]")


class CountTransducer:
    """Lazily compiled segment transducer of one model."""

    def __init__(self, model_file: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        for piece in pieces:
            if "\n" in piece or re.search(f"[^{_SPACE}]{_SPACE}", piece):
                raise ValueError(f"piece {piece!r} joins segments; this model needs other cutting places")
        self._emit: dict[str, int] = {}
        base = self._tokens("\n")
        # The library puts a space before a text: its tokens before a line feed are not part of the segment after it.
        self._lead = base - 1
        self._emit["\n"] = 1
        self._feed = self._model.encode("\n")[-1]
        self._opens = np.array([piece.startswith(_SPACE) for piece in pieces])

    def _tokens(self, text: str) -> int:
        return len(self._model.encode(text, num_threads=1))

    def _compile(self, segments: list[str]) -> None:
        """Emitted counts of segments not met before; the library reads many segments as one text."""
        if len(self._emit) + len(segments) > _MEMO:
            self._emit = {"\n": 1}
        words, lines, rest = [], [], []
        for s in segments:
            if s[0] != " ":
                lines.append(s)
            elif len(s) > 1 and s[1] != " ":
                words.append(s)
            else:
                rest.append(s)
        if words:  # each word starts at the one piece of it that begins with a space
            ids = np.array(self._model.encode("".join(words)[1:], num_threads=1))
            self._emit.update(zip(words, np.diff(np.flatnonzero(self._opens[ids]), append=len(ids)).tolist()))
        if lines:
            ids = np.array(self._model.encode("\n" + "\n".join(lines), num_threads=1))
            starts = np.flatnonzero(ids == self._feed)
            self._emit.update(zip(lines, (np.diff(starts, append=len(ids)) - 1).tolist()))
        for s in rest:
            self._emit[s] = self._tokens(s[1:]) if len(s) > 1 else self._tokens("\n" + s) - self._lead - 1

    def _know(self, segments: Iterable[str]) -> None:
        met = set(segments)
        missing = met.difference(self._emit)
        if missing:
            self._compile(list(missing))
            if len(missing) < len(met):  # the table may have been started anew
                self._compile(list(met.difference(self._emit)))

    def _sum(self, segments: list[str]) -> int:
        """Tokens of segments: spaces and a word, a word after a line feed, or a line feed."""
        self._know(segments)
        return sum(map(self._emit.__getitem__, segments))

    def state_map(self, chunk: str) -> tuple[str, int | None, str]:
        """(head, count, tail) of a chunk; count None marks a chunk without any cutting place (all head)."""
        first = _EDGE.search(chunk)
        # A chunk that starts with spaces may continue spaces of the chunk before: they belong to the head.
        at = first.start() if first else len(chunk)
        while at < len(chunk) and at == 0 and chunk[0] == " ":
            run = len(chunk) - len(chunk.lstrip(" "))
            nxt = _EDGE.search(chunk, run)
            at = nxt.start() if nxt else len(chunk)
        if at >= len(chunk):
            return chunk, None, ""
        segments = _SEGMENT.findall(chunk, at)
        if segments[-1] == "\n":
            return chunk[:at], self._sum(segments), ""
        return chunk[:at], self._sum(segments[:-1]), segments[-1]

    def compose(self, left: tuple, right: tuple) -> tuple:
        """The map of two neighbouring chunks."""
        if left[1] is None and right[1] is None:
            return left[0] + right[0], None, ""
        if left[1] is None:
            return left[0] + right[0], right[1], right[2]
        if right[1] is None:
            return left[0], left[1], left[2] + right[0]
        middle = self._sum(_SEGMENT.findall(left[2] + right[0]))
        return left[0], left[1] + middle + right[1], right[2]

    def count(self, text: str | None, chunk: int = _CHUNK) -> int:
        return self.count_all([text], chunk)[0]

    def count_all(self, texts: list[str | None], chunk: int = _CHUNK) -> list[int]:
        """Token counts of many texts; new segments of the short ones are compiled together."""
        out = []
        for at in range(0, len(texts), 64):
            parts = [" " + t.replace(_SPACE, " ") if t else "" for t in texts[at : at + 64]]
            short = [_SEGMENT.findall(p) if len(p) <= chunk else [] for p in parts]
            self._know(chain.from_iterable(short))
            emit = self._emit.__getitem__
            counts = [sum(map(emit, s)) for s in short]
            out += [n if len(p) <= chunk else self._scan(p, chunk) for n, p in zip(counts, parts)]
        return out

    def _scan(self, text: str, chunk: int) -> int:
        maps = [self.state_map(text[i : i + chunk]) for i in range(0, len(text), chunk)]
        while len(maps) > 1:  # scan as a tree of pairwise compositions
            pairs = [self.compose(a, b) for a, b in zip(maps[::2], maps[1::2])]
            maps = pairs + maps[len(pairs) * 2 :]
        head, inner, tail = maps[0]
        return (inner or 0) + self._sum(_SEGMENT.findall(head) + _SEGMENT.findall(tail))


@lru_cache(maxsize=2)
def transducer(model_file: str) -> CountTransducer:
    return CountTransducer(model_file)


def count_tokens(docs: DataFrame, model_file: str, limit: int = 4096, key: str = "doc_id") -> DataFrame:
    """key, n_bytes, n_tokens, over_limit of every document; a narrow pass without a shuffle."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = transducer(model_file)
        for batch in batches:
            texts = batch.column(1)
            sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).cast(pa.int64())
            counts = counter.count_all(texts.to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(counts, pa.int64()), pa.array([c > limit for c in counts])],
                names=[key, "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(key, "text").mapInArrow(run, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
