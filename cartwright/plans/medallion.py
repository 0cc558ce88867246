"""Bronze to silver to gold in one Spark application."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cartwright.operators import cleaning, quality, rfm
from cartwright.sources import sinks
from cartwright.sources.contracts import line_key, resolve_aliases


@dataclass(frozen=True)
class FlowResult:
    counts: dict[str, int]
    issues: dict[str, list[str]]


def run(
    spark: SparkSession,
    customers: DataFrame,
    products: DataFrame,
    transactions: DataFrame,
    out: str,
    as_of: str,
    key: list[str] | None = None,
) -> FlowResult:
    """Validate, clean, write silver, score from silver, write gold.

    Silver is written once and read back, so gold does not clean the raw tables again. Validation reports and does not
    stop the flow. ``key`` identifies a transaction row; by default it follows from the columns.
    """
    key = key or line_key(resolve_aliases(transactions).columns)
    checks = {
        "customers": quality.verdict(quality.check_table(customers, quality.CUSTOMER_RULES)),
        "transactions": quality.verdict(quality.check_table(resolve_aliases(transactions), quality.transaction_rules(as_of))),
    }
    issues = {name: list(df.first()["issues"]) for name, df in checks.items()}

    sinks.write_parquet(cleaning.clean_customers(customers), f"{out}/silver/customers")
    sinks.write_parquet(products, f"{out}/silver/products")
    sinks.write_facts(cleaning.clean_transactions(transactions, as_of, key), f"{out}/silver/transactions")
    clean_customers = spark.read.parquet(f"{out}/silver/customers")
    clean_transactions = spark.read.parquet(f"{out}/silver/transactions")

    sinks.write_parquet(rfm.rfm_gold(clean_customers, clean_transactions, as_of), f"{out}/gold/rfm_segmented")
    scored = spark.read.parquet(f"{out}/gold/rfm_segmented")
    sinks.write_parquet(rfm.segment_profiles(scored), f"{out}/gold/segment_profiles")

    counts = {
        "customers": clean_customers.count(),
        "products": spark.read.parquet(f"{out}/silver/products").count(),
        "transactions": clean_transactions.count(),
        "segments": spark.read.parquet(f"{out}/gold/segment_profiles").count(),
    }
    return FlowResult(counts, issues)


def views(spark: SparkSession, out: str) -> None:
    """Register the flow's tables as views."""
    for layer, names in {"silver": ("customers", "products", "transactions"), "gold": ("rfm_segmented", "segment_profiles")}.items():
        for name in names:
            spark.read.parquet(f"{out}/{layer}/{name}").createOrReplaceTempView(name)
