"""Data-quality checks: one pass per table for all column rules, failing rows and key checks as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ColumnRule:
    column: str
    dtype: str | None = None  # leading text of the Spark type name
    non_null: bool = False
    unique: bool = False
    allowed: Sequence[str] = field(default_factory=tuple)
    positive: bool = False
    not_after: str | None = None


CUSTOMER_RULES = (
    ColumnRule("customer_id", dtype="bigint", unique=True, non_null=True),
    ColumnRule("email", dtype="string", non_null=True),
    ColumnRule("registration_date", non_null=True),
    # The accepted acquisition channels.
    ColumnRule(
        "acquisition_channel",
        dtype="string",
        allowed=("Organic", "Paid Search", "Social Media", "Email", "Referral", "Direct"),
    ),
)


def transaction_rules(as_of: str) -> tuple[ColumnRule, ...]:
    return (
        ColumnRule("order_id", non_null=True),
        ColumnRule("customer_id", non_null=True),
        ColumnRule("product_id"),
        ColumnRule("transaction_date", not_after=as_of),
        ColumnRule("revenue", non_null=True, positive=True),
    )


def check_table(df: DataFrame, rules: Sequence[ColumnRule]) -> DataFrame:
    """One row per (column, check) with the number of offending rows; 0 means the check passed.

    A missing column or wrong type is settled from the schema. All row checks share one aggregation; only the unique
    checks need their distinct counts. Duplicates are rows beyond the first of each value.
    """
    types = dict(df.dtypes)
    entries: list[tuple[str, str, Column]] = []
    for r in rules:
        if r.column not in types:
            entries.append((r.column, "missing column", F.lit(1).cast("long")))
            continue
        c = F.col(r.column)
        if r.dtype:
            wrong = 0 if types[r.column].startswith(r.dtype) else 1
            entries.append((r.column, f"type {r.dtype}", F.lit(wrong).cast("long")))
        if r.non_null:
            entries.append((r.column, "null values", F.count(F.when(c.isNull(), 1))))
        if r.unique:
            entries.append((r.column, "duplicate values", F.count(c) - F.count_distinct(c)))
        if r.allowed:
            entries.append((r.column, "value not in list", F.count(F.when(~c.isin(*r.allowed), 1))))
        if r.positive:
            entries.append((r.column, "non-positive values", F.count(F.when(c <= 0, 1))))
        if r.not_after:
            late = c.cast("timestamp") > F.lit(r.not_after).cast("timestamp")
            entries.append((r.column, "future dates", F.count(F.when(late, 1))))
    row = df.agg(F.count(F.lit(1)).alias("n_records"), *[e.alias(f"_{i}") for i, (_, _, e) in enumerate(entries)])
    checks = F.array(
        *[
            F.struct(F.lit(col).alias("column"), F.lit(check).alias("check"), F.col(f"_{i}").alias("failures"))
            for i, (col, check, _) in enumerate(entries)
        ]
    )
    return row.select("n_records", F.explode(checks).alias("c")).select("n_records", "c.*")


def verdict(checks: DataFrame) -> DataFrame:
    """valid, issues, n_records as one row; there are only as many issues as rules."""
    text = F.concat_ws(" ", F.lit("Column"), "column", F.lit("failed:"), "check")
    return checks.agg(
        (F.max("failures") == 0).alias("valid"),
        F.array_sort(F.collect_list(F.when(F.col("failures") > 0, text))).alias("issues"),
        F.max("n_records").alias("n_records"),
    )


def non_positive_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) <= 0)


def out_of_range_rows(df: DataFrame, column: str, low: Column, high: Column) -> DataFrame:
    return df.filter((F.col(column) < low) | (F.col(column) > high))


def orphan_rows(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key is set but has no parent; distinct parent keys keep the build side small."""
    keys = parent.select(F.col(parent_key).alias(key)).distinct()
    return child.filter(F.col(key).isNotNull()).join(keys, key, "left_anti")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
