"""Words that differ by one letter, found with an index of variable-length grams.

Gram dictionary. All grams of ``_LOW`` letters belong to it, and a longer gram when it occurs at more than ``max_list`` places of
the vocabulary (counted over the distinct words, level by level). The dictionary holds all parts of its grams, and at
most letters of the vocabulary / ``max_list`` grams a length, which bounds what is broadcast.

Decomposition. At every place of a word stands the longest gram of the dictionary, at most half the word long; a gram that ends
where its left neighbour's ends is dropped. A frequent stretch is thus indexed by long grams, a rare one by short ones.

Affected grams. An edit touches the grams that hold it, one that ends just before it if a dictionary gram continues it, and one
just behind it if a dictionary gram ends with it and may swallow it. The fewest grams that any one edit leaves are a word's bound T. It is at least one, as a
gram is at most half the word long, so the count test alone decides and no word needs another way.

Merging. Of a word's n grams, the n - T + 1 rarest lists hold every word that shares T grams with it. They are the probes. Lists are
keyed by word length, gram and place from the left or right end. Long lists are cut by a hash of the indexed word, and the
probes copied to every part. A task counts shared grams of the words of one list part at once; pairs that reach the bound are
verified letter by letter, and a pair found in several lists is reported by the first of them.

Words are held as Latin-1 bytes, in which each of their letters is one byte and byte order is code-point order.

Defined cases: null and empty texts have no words; runs of any length count whole; documents repeated with one key repeat
their runs; a null key makes no crc and leaves its runs unchanged; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.session import materialise

_LOW = 2  # shortest gram
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NONE = 255


def count_words(docs: DataFrame, key: str = "doc_id", least_length: int = 7, least_count: int = 2, noise: int = 31) -> DataFrame:
    """word, n: runs of letters, A-Z folded, without the letter that a crc of document and run picks in one run of ``noise``.

    A run's crc depends on document and run alone, so runs are counted a document first.
    """
    run = F.translate("run", _UPPER, _UPPER.lower())
    runs = docs.select(F.col(key).cast("string").alias("_key"), F.explode(F.regexp_extract_all(
        "text", F.lit(r"[A-Za-zÀ-ÿ]{%d,}" % least_length), F.lit(0))).alias("run"))
    runs = runs.select("_key", run.alias("run"))
    crc = F.crc32(F.concat("_key", F.lit(":"), "run").cast("binary"))
    place = (crc % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    word = F.when(crc % noise == 0, cut).otherwise(F.col("run"))
    return (
        runs.select(word.alias("word"))
        .filter(F.length("word") >= least_length)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= least_count)
    )


def gram_dictionary(words: DataFrame, max_list: int, high: int) -> list[np.ndarray]:
    """Sorted codes of the frequent grams of ``_LOW + 1`` to ``high`` letters, one array a length.

    A gram is counted only where the gram one letter shorter is frequent. Counts are gathered a task before they are shuffled.
    """
    levels: list[np.ndarray] = []
    for size in range(_LOW + 1, high + 1):
        known = list(levels)

        def run(batches: Iterator[pa.RecordBatch], size: int = size, known: list = known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [_codes(m, size, known) for _, m in _by_length(batch.column(0))]
                codes, counts = np.unique(np.concatenate(found or [np.empty(0, np.int64)]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["code", "n"])

        counted = words.select(F.col("word")).mapInArrow(run, "code long, n long")
        frequent = counted.groupBy("code").agg(F.sum("n").alias("n")).filter(F.col("n") > max_list).select("code")
        levels.append(np.sort(np.array([r.code for r in frequent.collect()], np.int64)))
        if not len(levels[-1]):
            break
    return levels


def _by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and letters (rows x length, bytes) of the words (Latin-1 bytes) of each length."""
    sizes = np.asarray(pa.compute.binary_length(words), np.int64)
    raw = np.frombuffer(b"".join(words.to_pylist()), np.uint8)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        yield rows, raw[starts[rows][:, None] + np.arange(size)]


def _packed(letters: np.ndarray, size: int) -> np.ndarray:
    """Codes of the grams of ``size`` (up to 7) letters at every place."""
    places = letters.shape[1] - size + 1
    out = np.zeros((len(letters), max(places, 0)), np.int64)
    for k in range(size):
        out = out << 8 | letters[:, k : k + places]
    return out


def _member(sorted_codes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    if not len(sorted_codes):
        return np.zeros(codes.shape, bool)
    at = np.minimum(np.searchsorted(sorted_codes, codes), len(sorted_codes) - 1)
    return sorted_codes[at] == codes


def _codes(letters: np.ndarray, size: int, known: list[np.ndarray]) -> np.ndarray:
    codes = _packed(letters, size)
    if known:
        codes = codes[_member(known[-1], codes >> 8)]
    return codes.ravel()


def decompose(letters: np.ndarray, levels: list[np.ndarray], cap: int) -> np.ndarray:
    """Length of the gram kept at every place of each word (words of one length), 0 where none is kept."""
    n, size = letters.shape
    lengths = np.zeros((n, size), np.uint8)
    lengths[:, : size - _LOW + 1] = _LOW
    alive = None
    for k, level in enumerate(levels):
        q = _LOW + 1 + k
        if q > cap or q > size or not len(level):
            break
        now = _member(level, _packed(letters, q))
        if alive is not None:
            now &= alive[:, : now.shape[1]]
        lengths[:, : now.shape[1]][now] = q
        alive = now
    ends = np.arange(size) + lengths
    swallowed = np.zeros((n, size), bool)
    swallowed[:, 1:] = (ends[:, 1:] == ends[:, :-1]) & (lengths[:, 1:] > 0)
    lengths[swallowed] = 0
    return lengths


def _open(letters: np.ndarray, lengths: np.ndarray, levels: list[np.ndarray], cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Kept grams that a dictionary gram of the next length continues to the right, and to the left."""
    right, left = np.zeros(lengths.shape, bool), np.zeros(lengths.shape, bool)
    for k, level in enumerate(levels):
        q = _LOW + k
        if q >= cap or q > letters.shape[1] or not len(level):
            break
        codes = _packed(letters, q)
        here = lengths[:, : codes.shape[1]] == q
        right[:, : codes.shape[1]] |= here & _member(np.unique(level >> 8), codes)
        left[:, : codes.shape[1]] |= here & _member(np.unique(level & ((1 << 8 * q) - 1)), codes)
    return right, left


def bounds(letters: np.ndarray, lengths: np.ndarray, levels: list[np.ndarray], cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Fewest grams that survive one replaced letter, and one inserted letter, of each word."""
    n, size = lengths.shape
    kept = lengths > 0
    ends = np.arange(size) + lengths
    open_right, open_left = _open(letters, lengths, levels, cap)
    # The first edit place at which a gram left of it is safe, and the last one at which a gram right of it is.
    safe_after = np.where(kept, ends + open_right, size + 2)
    out = []
    for inserted in (False, True):
        safe_before = np.where(kept, np.arange(size) - open_left - (not inserted), -1)
        least = np.full(n, size, np.int64)
        for i in range(size + inserted):
            least = np.minimum(least, ((safe_after <= i) | (safe_before >= i)).sum(axis=1))
        out.append(least)
    return out[0], out[1]


def _cap(size: int, high: int) -> int:
    return min(size // 2, high)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _word_hash(letters: np.ndarray) -> np.ndarray:
    h = np.zeros(len(letters), np.uint64)
    for k in range(letters.shape[1]):
        h = _mix(h * np.uint64(31) + letters[:, k])
    return h


class _Weights:
    """Vocabulary-wide counts of the frequent grams; a list has a part more for every ``part`` occurrences of its gram."""

    def __init__(self, counts: dict[int, int], part: int):
        self.part = part
        self.codes = np.array(sorted(counts), np.int64)
        self.counts = np.array([counts[c] for c in sorted(counts)], np.int64)

    def frequency(self, codes: np.ndarray) -> np.ndarray:
        """Vocabulary-wide count of each gram (tagged codes)."""
        if not len(self.codes):
            return np.zeros(codes.shape, np.int64)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.counts[at], 0)


def _tagged(letters: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Code of the kept gram at every place, its length in the top byte; 0 where none is kept."""
    out = np.zeros(lengths.shape, np.int64)
    for q in np.unique(lengths).tolist():
        if q:
            codes = _packed(letters, q)
            on = lengths[:, : codes.shape[1]] == q
            out[:, : codes.shape[1]][on] = codes[on] | (q << 56)
    return out


def _entries(levels: list[np.ndarray], weights: _Weights, high: int):
    """Index and probe rows of a batch of words, keyed by a hash of list and part."""

    def keys(size: int, codes: np.ndarray, side: int, place: np.ndarray) -> np.ndarray:
        return _mix(_mix(codes) + _mix(place.astype(np.uint64) * np.uint64(4) + np.uint64(side + 1) + np.uint64(size << 20)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_all = np.asarray(batch.column(1), np.int64)
            for rows, letters in _by_length(batch.column(0)):
                size, n = letters.shape[1], n_all[rows]
                word_hash = _word_hash(letters)
                # As an indexed word: for words of its own length, and as the longer one for those a letter shorter.
                for probe_size in (size, size - 1):
                    lengths = decompose(letters, levels, _cap(probe_size, high))
                    codes = _tagged(letters, lengths)
                    row, place = np.nonzero(lengths)
                    gram = codes[row, place]
                    parts = 1 + weights.frequency(gram) // weights.part
                    part = (word_hash[row] % parts.astype(np.uint64)).astype(np.int64)
                    sides = ((0, place),) if probe_size == size else ((0, place), (1, size - place))
                    for side, at in sides:
                        key = _mix(keys(probe_size, gram, side, at) + part.astype(np.uint64))
                        yield from _rows(key, letters, lengths, row, n, None, None, None)
                    if probe_size < size:
                        continue
                    # As a probing word: its n - T + 1 rarest lists.
                    same, longer = bounds(letters, lengths, levels, _cap(size, high))
                    if min(same.min(), longer.min()) < 1:
                        raise ValueError("words of at least four letters are needed")
                    frequency = np.where(lengths > 0, weights.frequency(codes), np.iinfo(np.int64).max)
                    order = np.argsort(frequency, axis=1, kind="stable")
                    rank = np.empty_like(order)
                    np.put_along_axis(rank, order, np.arange(size)[None, :].repeat(len(order), 0), axis=1)
                    probes = (lengths > 0).sum(axis=1) - np.minimum(same, longer) + 1
                    rank = np.where((rank < probes[:, None]) & (lengths > 0), np.minimum(rank, _NONE - 1), _NONE).astype(np.uint8)
                    row, place = np.nonzero(rank != _NONE)
                    gram = codes[row, place]
                    parts = 1 + weights.frequency(gram) // weights.part
                    copy = np.repeat(np.arange(len(row)), parts)
                    part = np.arange(len(copy)) - np.repeat(np.cumsum(parts) - parts, parts)
                    row, place, gram = row[copy], place[copy], gram[copy]
                    for side, at in ((0, place), (1, size - place)):
                        key = _mix(keys(size, gram, side, at) + part.astype(np.uint64))
                        yield from _rows(key, letters, lengths, row, n, rank, np.stack((same, longer)), (place, side))

    return run


def _rows(key, letters, lengths, row, n, rank, least, found) -> Iterator[pa.RecordBatch]:
    size = letters.shape[1]
    for at in range(0, len(row), 200_000):
        cut = slice(at, at + 200_000)
        r = row[cut]
        body = [letters[r], lengths[r]]
        if rank is not None:
            body.append(rank[r])
        flat = np.concatenate(body, axis=1)
        zero = np.zeros(len(r), np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(key[cut].astype(np.int64)),
                pa.array(np.full(len(r), size, np.int32)),
                _binary(flat),
                pa.array(n[r]),
                pa.array(zero - 1 if found is None else found[0][cut].astype(np.int32) * 2 + found[1]),
                pa.array(zero if least is None else least[0][r].astype(np.int32)),
                pa.array(zero if least is None else least[1][r].astype(np.int32)),
            ],
            names=["key", "size", "body", "n", "probe", "same", "longer"],
        )


_ENTRY = "key long, size int, body binary, n long, probe int, same int, longer int"
_BLOCK = 150_000  # pairs of a list part that are counted at a time; stays in a core's cache


def _code_bytes(letters: np.ndarray, lengths: np.ndarray, none: int) -> np.ndarray:
    """A byte for the gram at each place (equal grams, equal bytes), ``none`` where none is kept."""
    n, size = letters.shape
    code = (lengths.astype(np.uint16) * 37 + letters * 5).astype(np.uint16)
    code[:, :-1] += letters[:, 1:].astype(np.uint16) * 11
    code = (code % 251).astype(np.uint8)
    return np.where(lengths > 0, code, np.uint8(none))


def _shared(s: np.ndarray, s_len: np.ndarray, t: np.ndarray, t_len: np.ndarray, shift: int) -> np.ndarray:
    """Whether the gram of s at each place is that of t at the place ``shift`` further (pairs in rows)."""
    size = s.shape[1]
    moved, moved_len = t[:, shift : shift + size], t_len[:, shift : shift + size]
    wrong = np.zeros((len(s), size + 1), np.int32)
    np.cumsum(s != moved, axis=1, out=wrong[:, 1:])
    stop = np.minimum(np.arange(size) + s_len, size)
    return (s_len > 0) & (s_len == moved_len) & (np.take_along_axis(wrong, stop, axis=1) == wrong[:, :-1])


def _one_edit(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Whether each pair of a block (letters in the first axis) differs by one replaced or, if t is longer, inserted letter."""
    size = len(s)
    total = np.zeros((s.shape[1], t.shape[1]), np.uint8 if size < 120 else np.int32)
    if len(t) == size:
        for p in range(size):
            total += s[p] != t[p]
        return total == 1
    for shift, order in ((0, range(size)), (1, range(size - 1, -1, -1))):
        alive = np.ones(total.shape, bool)
        for p in order:
            alive &= s[p] == t[p + shift]
            total += alive
    return total >= size


def _meet(probe: dict, index: dict) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of probes and indexed words of one list part that differ by one letter and meet here first."""
    size, longer = probe["letters"].shape[1], index["letters"].shape[1] > probe["letters"].shape[1]
    s_code, t_code = _code_bytes(probe["letters"], probe["lengths"], 251), _code_bytes(index["letters"], index["lengths"], 252)
    least = probe["longer"] if longer else probe["same"]
    step = max(1, _BLOCK // max(1, len(t_code)))
    s_code, t_code = np.ascontiguousarray(s_code.T), np.ascontiguousarray(t_code.T)
    s_letter, t_letter = np.ascontiguousarray(probe["letters"].T), np.ascontiguousarray(index["letters"].T)
    found = []
    for at in range(0, s_code.shape[1], step):
        s = s_code[:, at : at + step, None]
        count = (s[0] == t_code[0]).astype(np.uint8 if size < 120 else np.int32)
        equal = np.empty(count.shape, bool)
        for p in range(size):
            if p:
                np.equal(s[p], t_code[p], out=equal)
                np.add(count, equal, out=count)
            if longer:
                np.equal(s[p], t_code[p + 1], out=equal)
                np.add(count, equal, out=count)
        reached = count >= least[at : at + step, None].astype(count.dtype)
        if 50 * np.count_nonzero(reached) > count.size:  # most pairs reach a low bound: letters of the whole block are cheaper
            reached &= _one_edit(s_letter[:, at : at + step, None], t_letter)
        hit = np.flatnonzero(reached)
        if len(hit):
            i, j = np.divmod(hit, count.shape[1])
            found.append((i + at, j))
    if found:
        i, j = (np.concatenate(x) for x in zip(*found))
        for cut in range(0, len(i), 200_000):
            a, b = i[cut : cut + 200_000], j[cut : cut + 200_000]
            x, y = probe["letters"][a], index["letters"][b]
            if longer:
                same = (x == y[:, :-1]).cumprod(axis=1).sum(axis=1) + (x == y[:, 1:])[:, ::-1].cumprod(axis=1).sum(axis=1)
                good = same >= size
            else:
                good = (x != y).sum(axis=1) == 1
            a, b, x, y = a[good], b[good], x[good], y[good]
            if not len(a):
                continue
            # The first list in order of rank (left keys before right ones) in which the pair meets.
            rank, x_len, y_len = probe["rank"][a].astype(np.int32) * 2, probe["lengths"][a], index["lengths"][b]
            far = np.int32(2 * _NONE)
            meets = np.where((rank < far) & _shared(x, x_len, y, y_len, 0), rank, far).min(axis=1)
            if longer:
                meets = np.minimum(meets, np.where((rank < far) & _shared(x, x_len, y, y_len, 1), rank + 1, far).min(axis=1))
            here = np.take_along_axis(rank, (probe["probe"][a] // 2)[:, None], axis=1)[:, 0] + probe["probe"][a] % 2
            yield a[meets == here], b[meets == here]


def _binary(letters: np.ndarray) -> pa.Array:
    """Rows of letters as binary values."""
    n, size = letters.shape
    offsets = np.arange(0, (n + 1) * size, size, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters))])


def _links(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Links of every run of equal keys, both ways. Rows are sorted by key, indexed words before probes, then length."""
    table = table.combine_chunks()
    key, sizes, n, place = (table.column(c).to_numpy() for c in ("key", "size", "n", "probe"))
    bounds_ = {c: table.column(c).to_numpy() for c in ("same", "longer")}
    body = table.column("body").chunk(0)
    offsets = np.frombuffer(body.buffers()[1], np.int32, len(body) + 1, body.offset * 4)
    raw = np.frombuffer(body.buffers()[2], np.uint8)
    probing = place >= 0
    # Stretches of equal key, kind and length.
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (probing[1:] != probing[:-1]) | (sizes[1:] != sizes[:-1])
    starts = np.flatnonzero(new)
    stops = np.append(starts[1:], len(key))
    keys, kinds, lengths = key[starts], probing[starts], sizes[starts]
    for p in np.flatnonzero(kinds).tolist():
        lo, hi, size = int(starts[p]), int(stops[p]), int(lengths[p])
        probe = None
        at = p - 1
        while at >= 0 and keys[at] == keys[p]:
            first, last, other = int(starts[at]), int(stops[at]), int(lengths[at])
            at -= 1
            if probe is None:
                block = raw[offsets[lo] : offsets[hi]].reshape(hi - lo, 3 * size)
                probe = {"letters": block[:, :size], "lengths": block[:, size : 2 * size], "rank": block[:, 2 * size :]}
                probe |= {"probe": place[lo:hi]} | {c: v[lo:hi] for c, v in bounds_.items()}
            block = raw[offsets[first] : offsets[last]].reshape(last - first, 2 * other)
            index = {"letters": block[:, :other], "lengths": block[:, other:]}
            for a, b in _meet(probe, index):
                s, t = _binary(probe["letters"][a]), _binary(index["letters"][b])
                n_s, n_t = pa.array(n[lo + a]), pa.array(n[first + b])
                yield pa.RecordBatch.from_arrays([s, t, n_t], names=["word", "near", "near_n"])
                if other > size:  # words of one length find each other
                    yield pa.RecordBatch.from_arrays([t, s, n_s], names=["word", "near", "near_n"])


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a sorted partition, list by list; what is held ends at a border of lists."""

    def joined(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small: list[pa.RecordBatch] = []
        for batch in found:
            small.append(batch)
            if len(small) >= 5_000:
                yield from pa.Table.from_batches(small).combine_chunks().to_batches()
                small = []
        if small:
            yield from pa.Table.from_batches(small).combine_chunks().to_batches()

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        key = batch.column(0)
        if rows < 50_000 or key[0] == key[batch.num_rows - 1]:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column("key").to_numpy()
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1
        yield from joined(_links(table.slice(0, cut)))
        held, rows = table.slice(cut).to_batches(), table.num_rows - cut
    if rows:
        yield from joined(_links(pa.Table.from_batches(held)))


def near_words(words: DataFrame, max_list: int = 2_000, part: int = 20_000, high: int = 7) -> DataFrame:
    """word, near, near_n: every ordered pair of distinct words (Latin-1 bytes of at least four letters, with ``n``) one edit apart."""
    spark = words.sparkSession
    letters = words.agg(F.sum(F.length("word")).alias("s"), F.count(F.lit(1)).alias("c")).first()
    max_list = max(max_list, (letters.s or 0) // 50_000)
    levels = gram_dictionary(words, max_list, high)
    grams = _gram_counts(words, levels, max_list)
    weights = _Weights(grams, part)
    entries = words.select("word", "n").mapInArrow(_entries(levels, weights, high), _ENTRY)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = entries.repartition(max(tasks, (letters.c or 0) // 50_000), "key").sortWithinPartitions("key", F.col("probe") >= 0, "size")
    return dealt.mapInArrow(_lists, "word binary, near binary, near_n long")


def _gram_counts(words: DataFrame, levels: list[np.ndarray], least: int) -> dict[int, int]:
    """Counts of the frequent grams, shortest and dictionary ones (tagged codes); rarer ones count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, letters in _by_length(batch.column(0)):
                for q in range(_LOW, _LOW + 1 + len(levels)):
                    codes = _packed(letters, q)
                    if q > _LOW:
                        codes = codes[_member(levels[q - _LOW - 1], codes)]
                    found.append(codes.ravel() | (q << 56))
            codes, counts = np.unique(np.concatenate(found or [np.empty(0, np.int64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["code", "n"])

    counted = words.select("word").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    return {r.code: r.n for r in counted.filter(F.col("n") > least).collect()}


def spelling_variants(docs: DataFrame, key: str = "doc_id", ratio: int = 10, **limits: int) -> DataFrame:
    """word, form, root, n, n_near, form_n: the near word of largest count if ``ratio`` times as frequent, followed to the last."""
    words = materialise(count_words(docs, key), "words")
    coded = words.select(F.encode("word", "ISO-8859-1").alias("word"), "n")
    links = near_words(coded, **limits)
    best = links.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best")
    )
    best = best.select(F.decode("word", "ISO-8859-1").alias("near_word"), "n_near", F.decode("best.near", "ISO-8859-1").alias("near"), (-F.col("best.m")).alias("near_n"))
    joined = words.join(best, words["word"] == best["near_word"], "left")
    is_form = F.coalesce(F.col("near_n") >= ratio * F.col("n"), F.lit(False))
    found = materialise(
        joined.select(
            "word",
            F.when(is_form, F.col("near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    return found.join(_roots(found, ratio).withColumnRenamed("word", "_word"), F.col("word") == F.col("_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(found: DataFrame, ratio: int) -> DataFrame:
    """word, root of all words with a form. Counts grow ``ratio`` times a step, which bounds the steps; each round doubles them."""
    top = found.agg(F.max("n").alias("m")).first().m or 1
    steps, power = 1, ratio
    while power < top:
        steps, power = steps + 1, power * ratio
    roots = found.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    done = 1
    while done < steps:
        far = roots.select(F.col("word").alias("_from"), F.col("root").alias("_to"))
        roots = materialise(
            roots.join(far, F.col("root") == F.col("_from"), "left").select("word", F.coalesce("_to", "root").alias("root")), "roots"
        )
        done *= 2
    return roots
