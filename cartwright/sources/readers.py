"""Parquet, CSV, catalog and streaming readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def read_with_fallback(spark: SparkSession, parquet: str, csv: str, schema: T.StructType) -> DataFrame:
    """Parquet when it exists, else CSV, else an empty table with the contract's columns."""
    if path_exists(spark, parquet):
        return read_parquet(spark, parquet)
    if path_exists(spark, csv):
        return read_csv(spark, csv, schema)
    return spark.createDataFrame([], schema)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """External database table; pass partitionColumn, lowerBound, upperBound, numPartitions for a parallel read."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def stream_parquet(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def stream_kafka(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Broker source; needs the Kafka connector on the classpath."""
    return (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()
    )


def register_views(spark: SparkSession, paths: dict[str, str]) -> dict[str, bool]:
    """Register a view per existing path; tells which names were found instead of failing on a missing one."""
    found = {}
    for name, path in paths.items():
        found[name] = path_exists(spark, path)
        if found[name]:
            spark.read.parquet(path).createOrReplaceTempView(name)
    return found
