"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_facts(df: DataFrame, path: str, date_col: str = "transaction_date", mode: str = "overwrite") -> None:
    """Fact table partitioned by month so date filters prune folders.

    Rows go out under ``rebalance``: files per month stay near the advisory size and a month holding most rows is split
    over tasks instead of being written by one.
    """
    month = F.date_format(date_col, "yyyy-MM")
    df.withColumn("month", month).hint("rebalance", "month").write.mode(mode).partitionBy("month").parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def timestamps_to_dates(df: DataFrame) -> DataFrame:
    kinds = (T.TimestampType, T.TimestampNTZType)
    return df.withColumns({f.name: F.to_date(f.name) for f in df.schema.fields if isinstance(f.dataType, kinds)})


def save_table(df: DataFrame, table: str, mode: str = "overwrite") -> None:
    """Catalog table with date-typed time columns; ``mode`` is overwrite (replace) or append."""
    timestamps_to_dates(df).write.mode(mode).saveAsTable(table)


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, mode: str = "overwrite") -> None:
    """Catalog table bucketed and sorted on the join key, so later joins on it need no shuffle."""
    df.write.mode(mode).bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def write_jdbc(df: DataFrame, url: str, table: str, batch: int = 500, mode: str = "overwrite") -> None:
    options = {"url": url, "dbtable": table, "batchsize": str(batch)}
    timestamps_to_dates(df).write.format("jdbc").options(**options).mode(mode).save()
