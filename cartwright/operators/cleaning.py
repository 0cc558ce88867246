"""Standardising and de-duplicating raw tables, and deriving money columns from order lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.sources.contracts import resolve_aliases

# Lower-case spelling to standard country name.
COUNTRY_NAMES = {
    "usa": "United States",
    "uk": "United Kingdom",
    "canada": "Canada",
    "australia": "Australia",
    "germany": "Germany",
    "france": "France",
    "japan": "Japan",
}


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``order_by``, remaining columns breaking ties.

    An aggregate, not a window: copies of a key fold together on the map side, so a key with a third of all rows does
    not gather in one task. The aggregate sorts whatever a task holds, after a join several large sorts in the same task, so
    rows go through ``rebalance`` first: by all columns, as by the keys alone the fold before the shuffle would be gone.
    A task then sorts rows of about the advisory size however large the table is.
    """
    rest = [c for c in df.columns if c not in keys]
    ordered = [*order_by, *[c for c in rest if c not in order_by]]
    spread = df.hint("rebalance", *df.columns) if rest else df
    picked = spread.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])


def standard_country(c: Column) -> Column:
    mapping = F.create_map(*[F.lit(x) for pair in COUNTRY_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(mapping, F.lower(c)), c)


def clean_customers(df: DataFrame, order_by: Sequence[str] = ("email",)) -> DataFrame:
    out = df.withColumns({"email": F.trim(F.lower("email")), "country": standard_country(F.col("country"))})
    return keep_first(out, ["customer_id"], [c for c in order_by if c in out.columns])


def clean_transactions(df: DataFrame, as_of: str, key: Sequence[str]) -> DataFrame:
    """Typed dates, nothing after ``as_of``, positive amounts, first row per key by date.

    ``key`` names what identifies a row of the table, an order line as a rule (``contracts.line_key``): rows of one key are
    repeats, and all but the first go.
    """
    out = resolve_aliases(df).withColumn("transaction_date", F.col("transaction_date").cast("timestamp"))
    out = out.filter((F.col("transaction_date") <= F.lit(as_of).cast("timestamp")) & (F.col("revenue") > 0))
    return keep_first(out, list(key), ["transaction_date"])


def _cents(x: Column) -> Column:
    """Round to cents half away from zero on the decimal value, not on its binary neighbour."""
    return F.round(x.cast("decimal(20,6)"), 2).cast("double")


def price_lines(lines: DataFrame) -> DataFrame:
    """Final price, revenue, cost, profit and the yearly sine factor from unit price, unit cost, discount and quantity.

    Returned lines count as negative revenue; profit keeps its sign.
    """
    final = F.col("unit_price") * (1 - F.coalesce("discount_pct", F.lit(0.0)))
    q = F.col("quantity")
    return lines.withColumns(
        {
            "final_price": _cents(final),
            "revenue": _cents(final * q) * F.when(F.col("is_returned"), -1.0).otherwise(1.0),
            "cogs": _cents(F.col("unit_cost") * q),
            "gross_profit": _cents((final - F.col("unit_cost")) * q),
            "seasonality_factor": F.round(
                1 + 0.3 * F.sin((F.month("transaction_date") - 3) * F.lit(3.141592653589793) / 6), 3
            ),
        }
    )


def at_most(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Repeatable sample of at most ``n`` rows: the smallest seeded hashes of the key."""
    return df.orderBy(F.xxhash64(F.lit(seed), key), key).limit(n)
