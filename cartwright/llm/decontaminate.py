"""Benchmark decontamination with a broadcast hash set of normalised n-grams (DataFrame functions only).

A window is ``n`` consecutive words of a benchmark item, or the whole item if it is shorter. Documents are scanned word by
word: a word that anchors some window (the longest word of the window) looks up the hash of the surrounding words in the
broadcast set, and the words of the hit are compared before it counts. Anchoring loses nothing, as every occurrence of a window
contains its anchor at the same place.

The set grows with the benchmark, not with the documents. Its rows are counted first; beyond ``broadcast_windows`` the
lookup becomes a shuffle join on the anchor word.

Defined cases: a null or wordless text has no words and is clean; a null or wordless item has no windows; repeated
documents are separate rows; items with equal windows are all reported; an empty benchmark leaves everything clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.session import materialise

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Everything that is not a word character: ASCII other than digits and letters. Upper case is a word character here,
# as texts are split before their case is folded.
_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _fold(words: Column) -> Column:
    return F.transform(words, lambda w: F.translate(w, _UPPER, _LOWER))


def _split(text: Column) -> Column:
    """Pieces between breaks; the first and the last may be empty."""
    return F.split(F.coalesce(text, F.lit("")), _BREAK)


def _n_words(pieces: Column) -> Column:
    first, last = (F.get(pieces, i) == "" for i in (F.lit(0), F.size(pieces) - 1))
    alone = (F.size(pieces) == 1) & first
    return F.when(alone, 0).otherwise(F.size(pieces) - first.cast("int") - last.cast("int"))


def benchmark_windows(benchmark: DataFrame, n: int = 10) -> DataFrame:
    """Distinct windows: folded text, hash, length in words, anchor word, anchor offset and the items that hold them."""
    words = _fold(F.filter(_split(F.col("text")), lambda w: w != ""))
    # Written once, so that no later expression splits the item again for every window.
    items = materialise(
        benchmark.select(F.col("item_id").cast("string").alias("item"), words.alias("w")).filter(F.size("w") > 0), "items"
    )
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(1)))
    windows = items.select("item", "w", F.explode(starts).alias("i")).select("item", F.slice("w", F.col("i"), n).alias("win"))
    longest = F.array_max(F.transform("win", lambda w: F.length(w)))
    grouped = windows.groupBy("win").agg(F.sort_array(F.collect_set("item")).alias("items"))
    placed = grouped.withColumn(
        "offset", (F.array_position(F.transform("win", lambda w: F.length(w)), longest) - 1).cast("int")
    )
    text = F.array_join("win", " ")
    return placed.select(
        text.alias("win"),
        F.xxhash64(F.lower(text)).alias("win_hash"),
        F.size("win").alias("win_len"),
        "offset",
        F.lower(F.get("win", F.col("offset"))).alias("anchor"),
        "items",
    )


def find_hits(
    docs: DataFrame, benchmark: DataFrame, n: int = 10, key: str = "doc_id", broadcast_windows: int = 500_000
) -> DataFrame:
    """One row per document: key, n_words, n_hit, hit_positions (0-based word positions), items (sorted item ids)."""
    windows = materialise(benchmark_windows(benchmark, n), "windows")
    if windows.count() <= broadcast_windows:
        windows = F.broadcast(windows)
    words = docs.select(
        F.col(key).alias("_key"), F.monotonically_increasing_id().alias("_row"), _split(F.col("text")).alias("w")
    )
    scanned = words.select("_key", "_row", "w", F.posexplode("w").alias("pos", "word"))
    # Everything down to the filter runs inside one generated stage: the word array is never copied for a position.
    start = F.col("pos") - F.col("offset")
    around = F.array_join(F.slice("w", F.greatest(start, F.lit(0)) + 1, F.col("win_len")), " ")
    same = (
        (F.lower("word") == F.col("anchor"))
        & (start >= 0)
        & (F.xxhash64(F.lower(around)) == F.col("win_hash"))
        & (F.translate(around, _UPPER, _LOWER) == F.col("win"))
    )
    lead = F.when(F.get("w", F.lit(0)) == "", 1).otherwise(0)
    hits = scanned.join(windows, same, "left").filter(F.col("win_len").isNotNull() | (F.col("pos") == 0)).select(
        "_key",
        "_row",
        F.when(F.col("pos") == 0, _n_words(F.col("w"))).alias("n_words"),
        F.when(F.col("win_len").isNotNull(), F.struct((start - lead).alias("start"), "win_len", "items")).alias("hit"),
    )
    # The groups are bounded by the words of one document.
    per_doc = hits.groupBy("_row").agg(
        F.first("_key").alias("_key"), F.max("n_words").alias("n_words"), F.collect_list("hit").alias("hits")
    )
    spread = F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["win_len"] - 1)))
    return per_doc.select(
        F.col("_key").alias(key),
        F.col("n_words").cast("long").alias("n_words"),
        F.sort_array(F.array_distinct(spread)).alias("hit_positions"),
        F.sort_array(F.array_distinct(F.flatten(F.col("hits.items")))).alias("items"),
    ).select(key, "n_words", F.size("hit_positions").cast("long").alias("n_hit"), "hit_positions", "items")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, n: int = 10, mode: str = "documents", key: str = "doc_id"
) -> DataFrame:
    """``docs`` without contaminated documents, or (``mode="spans"``) with the hit words cut out of their texts.

    ``key`` must be unique in ``docs``; rows with a null key are kept as they are.
    """
    hits = find_hits(docs.filter(F.col(key).isNotNull()), benchmark, n, key).filter(F.col("n_hit") > 0)
    hits = hits.select(F.col(key).alias("_hit_key"), F.col("hit_positions").alias("_hit_at"))
    if mode == "documents":
        return docs.join(hits, docs[key] == F.col("_hit_key"), "left_anti")
    # Words and the breaks around them alternate; both lists are walked together.
    words = F.filter(_split(F.col("text")), lambda w: w != "")
    breaks = F.split(F.col("text"), _WORD)
    kept = F.concat_ws("", F.transform(breaks, lambda b, i: F.concat(
        b,
        F.when((i < F.size(words)) & ~F.array_contains("_hit_at", i), F.coalesce(F.get(words, i), F.lit(""))).otherwise(""),
    )))
    cut = docs.join(hits, docs[key] == F.col("_hit_key"), "left")
    text = F.when(F.col("_hit_at").isNull(), F.col("text")).otherwise(kept)
    return cut.select(*[text.alias(c) if c == "text" else docs[c] for c in docs.columns])
