"""Scalar and aggregate column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_sum(c: Column | str) -> Column:
    """Sum through DECIMAL so the result does not depend on the order rows arrive in; DOUBLE out."""
    return F.sum(_col(c).cast("decimal(18,4)")).cast("double")


def exact_avg(c: Column | str) -> Column:
    """Mean on top of :func:`exact_sum`; null when there is no non-null value."""
    return exact_sum(c) / F.nullif(F.count(_col(c)), F.lit(0))


def ratio(num: Column | str, den: Column | str) -> Column:
    """Division that yields null for a zero denominator."""
    return _col(num) / F.nullif(_col(den), F.lit(0))


def percent(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    return F.round(ratio(num, den) * 100, digits)


def elapsed_days(later: Column | str, earlier: Column | str) -> Column:
    """Whole 24-hour periods between two timestamps (not calendar days)."""
    micros = F.unix_micros(_col(later).cast("timestamp")) - F.unix_micros(_col(earlier).cast("timestamp"))
    return F.floor(micros / DAY_MICROS).cast("long")


def month_index(c: Column | str) -> Column:
    """Months since year 0, so that differences count whole calendar months across years."""
    return F.year(_col(c)) * 12 + F.month(_col(c))


def surrogate_key(*cols: Column | str) -> Column:
    """MD5 over the field list, nulls as empty text, fields joined with a dash."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def attach_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Add the columns of ``row``, an aggregate without grouping and therefore exactly one row, to every row."""
    return df.crossJoin(F.broadcast(row))
