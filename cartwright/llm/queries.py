"""Registered queries of the corpus operators and the SQL they are compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.llm import decontaminate, html_extract, jaccard_join, line_dedup, mixing, near_dup, personal_data, quality, spelling, sql
from cartwright.llm import token_align, token_count, token_store, url_filter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The rules of the URL query (action, host, path).
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.filter_urls(_table(spark, sf_dir, "pages"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.find_hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), [5, 2, 1])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(_table(spark, sf_dir, "pages"))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, listed = token_store.write_store(
        _table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json")
    )
    return token_store.store_digests(store, listed)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.repeated_units(_table(spark, sf_dir, "documents"))
    spans = F.transform("removed", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string")))
    return found.select("doc_id", "n_units", "n_repeated", "n_removed", F.concat_ws(",", spans).alias("removed_spans"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score_documents(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), quality.learnable()
    )
    return scored.select(
        "doc_id",
        (~quality.learnable("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align_tokenizers(
        _table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    )


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find_personal_data(_table(spark, sf_dir, "documents"))

    def written(spans: str):
        return F.concat_ws(
            ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        )

    def number(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(number, personal_data.KINDS),
        F.sha2(written("base"), 256).alias("base_sha256"),
        written("spans").alias("spans"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filter,
        op2_near_duplicates,
        op3_jaccard_join,
        op4_decontaminate,
        op5_token_store,
        op6_token_counts,
        op7_line_dedup,
        op8_mixing,
        op9_html_text,
        op10_quality,
        op11_spelling_variants,
        op12_token_alignment,
        op13_personal_data,
    )
}
ORACLES = {
    "op1_url_filter": sql.URLS,
    "op3_jaccard_join": sql.JACCARD,
    "op4_decontaminate": sql.DECONTAMINATE,
    "op7_line_dedup": sql.LINES,
    "op8_mixing": sql.MIXING,
}
