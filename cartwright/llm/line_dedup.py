"""Removal of passages that repeat across a corpus, by hashing lines and sentences.

Texts are cut into units behind line ends and behind sentence ends; each unit is normalised (A-Z folded, white space runs as one
space, trimmed) and hashed. Digests are grouped globally; the earliest occurrence by (document key, position) stays. A
*repeated passage* of a document is a longest run of neighbouring units that all occur elsewhere too (units without visible
characters are passed over), of at least ``min_chars`` normalised characters in all. So one stock line does not mark a document, and a
passage is found over several lines, from the middle of a line, or in a script without spaces. Later occurrences inside
repeated passages are removed, keeping the original character offsets of what was cut.

``min_chars=0`` is the plain form: every repeated unit counts by itself. ``LINES`` and ``PARAGRAPHS`` are other ways to cut.

Digests are counted by partial aggregation, so a unit found in a third of all documents is one small row per task, and the join
back to the occurrences is left to skew splitting. What is ordered together is one document's units.

Defined cases: null and empty texts have no units and stay as they are; units without visible characters are never removed;
repeated rows count as later occurrences; rows without a key rank last and are treated like the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.session import materialise

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACES = "[\\x20\\x09-\\x0D]+"
# A unit reaches up to and including what ends it: a line feed, or sentence marks with a space (full-width ones alone).
SENTENCES = r"(?s).*?(?:\n|[.!?]+[ \t]|[。！？]|\z)"
LINES = r"(?s).*?(?:\n|\z)"
PARAGRAPHS = r"(?s).*?(?:\n[ \t]*\n|\z)"


def normalise(unit: Column) -> Column:
    return F.translate(F.btrim(F.regexp_replace(unit, _SPACES, " ")), _UPPER, _LOWER)


def units(docs: DataFrame, pattern: str = SENTENCES, key: str = "doc_id") -> DataFrame:
    """_row, _key, unit number, characters, normalised characters and digest of every unit; one row with unit null without any."""
    cut = docs.select(
        F.col(key).alias("_key"),
        F.monotonically_increasing_id().alias("_row"),
        F.filter(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), lambda u: u != "").alias("parts"),
    )
    listed = cut.select("_key", "_row", F.posexplode_outer("parts").alias("unit", "part"))
    normal = normalise(F.col("part"))
    return listed.select(
        "_key", "_row", "unit", F.length("part").alias("size"), F.length(normal).alias("chars"),
        F.when(normal != "", F.sha2(normal, 256).substr(1, 32)).alias("digest"),
    )


def repeated_units(docs: DataFrame, pattern: str = SENTENCES, min_chars: int = 200, key: str = "doc_id") -> DataFrame:
    """One row per document: _row, key, n_units, n_repeated (units in repeated passages, kept ones included), n_removed, removed
    (array of start/end character offsets of the later occurrences, in order)."""
    listed = materialise(units(docs, pattern, key), "units")
    rank = F.struct(F.col("_key").isNull().alias("last"), F.col("_key"), F.col("_row"), F.col("unit"))
    firsts = listed.filter(F.col("digest").isNotNull()).groupBy("digest").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = materialise(firsts.filter("n > 1").select(
        F.col("digest").alias("_digest"), F.col("first._row").alias("_first_row"), F.col("first.unit").alias("_first_unit")
    ), "firsts")
    marked = listed.join(firsts, F.col("digest") == F.col("_digest"), "left")
    order = Window.partitionBy("_row").orderBy("unit")
    repeated, blank = F.col("_digest").isNotNull(), F.col("digest").isNull()
    # A run ends at every unit that occurs nowhere else; with the plain form every unit is a run.
    ends = (~repeated & ~blank) if min_chars else F.lit(True)
    placed = marked.select(
        "_row", "_key", "unit", "size", "chars", repeated.alias("repeated"),
        ((F.col("_row") != F.col("_first_row")) | (F.col("unit") != F.col("_first_unit"))).alias("later"),
        (F.sum("size").over(order) - F.col("size")).alias("start"),
        F.sum(ends.cast("int")).over(order).alias("run"),
    )
    length = F.sum(F.when(F.col("repeated"), F.col("chars"))).over(Window.partitionBy("_row", "run"))
    inside = F.col("repeated") & (length >= min_chars)
    span = F.struct(F.col("start").alias("start"), (F.col("start") + F.col("size")).alias("end"))
    cut = placed.withColumn("inside", F.coalesce(inside, F.lit(False)))
    return cut.groupBy("_row").agg(
        F.first("_key").alias(key),
        F.count("unit").alias("n_units"),
        F.count(F.when(F.col("inside"), 1)).alias("n_repeated"),
        F.count(F.when(F.col("inside") & F.col("later"), 1)).alias("n_removed"),
        F.sort_array(F.collect_list(F.when(F.col("inside") & F.col("later"), span))).alias("removed"),  # bounded by one document
    )


def remove_repeats(docs: DataFrame, pattern: str = SENTENCES, min_chars: int = 200, key: str = "doc_id") -> DataFrame:
    """``docs`` with later occurrences cut from their texts and ``removed_spans`` added; keys must be unique."""
    found = repeated_units(docs.filter(F.col(key).isNotNull()), pattern, min_chars, key).filter("n_removed > 0")
    marks = found.select(F.col(key).alias("_found"), F.col("removed").alias("removed_spans"))
    joined = docs.join(marks, docs[key] == F.col("_found"), "left").drop("_found")
    # What stays lies between the end of one span and the start of the next.
    starts = F.concat(F.array(F.lit(0).cast("long")), F.col("removed_spans.end"))
    stops = F.concat(F.col("removed_spans.start"), F.array(F.length("text").cast("long")))
    kept = F.array_join(F.zip_with(starts, stops, lambda a, b: F.substr("text", (a + 1).cast("int"), (b - a).cast("int"))), "")
    text = F.when(F.col("removed_spans").isNull(), F.col("text")).otherwise(kept)
    return joined.select(*[text.alias(c) if c == "text" else F.col(c) for c in docs.columns], "removed_spans")
