"""Tables that are merged by key: each version rewrites the buckets of its keys alone and becomes visible by one marker."""

from __future__ import annotations

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartwright.session import materialise

_RESERVED = {"_bucket", "_fresh"}


def _file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _delete(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def commits(spark: SparkSession, path: str) -> list[int]:
    """Versions whose marker is complete, in order."""
    fs, folder = _file_system(spark, f"{path}/commits")
    if not fs.exists(folder):
        return []
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit() and fs.exists(hadoop(f"{path}/commits/{n}/_SUCCESS")))


def _manifest(spark: SparkSession, path: str, version: int) -> dict[int, int]:
    """Which version holds each bucket: one row per bucket."""
    rows = spark.read.schema("bucket int, version long").parquet(f"{path}/commits/{version}").collect()
    return {r["bucket"]: r["version"] for r in rows}


def _folder(path: str, bucket: int, version: int) -> str:
    return f"{path}/data/{version}/_bucket={bucket}"


def merge(df: DataFrame, path: str, keys: list[str], version: int, buckets: int = 16) -> bool:
    """Put the rows of ``df`` into the table at ``path`` in place of those with the same ``keys``; False if that was done before.

    Keys are dealt to ``buckets`` by hash (the same number for the life of a table; a bucket should fit one task). Buckets without
    a key of ``df`` are neither read nor written. The marker of the version is written last: what fails before it leaves the table
    as it was, and the same version can be merged again. A version not above the newest one changes nothing. Files of the version
    before stay for its readers; older ones are deleted, so there are at most two files a bucket.

    Null keys are keys. Of several rows of one key the largest stays (by the other columns, in order). An empty ``df`` makes an
    empty version. One writer at a time.
    """
    clash = _RESERVED & set(df.columns)
    if clash:
        raise ValueError(f"reserved column names: {sorted(clash)}")
    spark = df.sparkSession
    done = commits(spark, path)
    if done and version <= done[-1]:
        return False
    before = _manifest(spark, path, done[-1]) if done else {}
    fresh = materialise(df.withColumn("_bucket", F.pmod(F.hash(*keys), F.lit(buckets))), "fresh")
    changed = [r[0] for r in fresh.select("_bucket").distinct().collect()]  # at most ``buckets`` rows
    held = [_folder(path, b, before[b]) for b in changed if b in before]
    rows = fresh.withColumn("_fresh", F.lit(1))
    if held:
        bucket = F.pmod(F.hash(*keys), F.lit(buckets))
        rows = rows.unionByName(
            spark.read.schema(df.schema).parquet(*held).withColumns({"_bucket": bucket, "_fresh": F.lit(0)})
        )
    if changed:
        rest = [c for c in df.columns if c not in keys]
        newest = F.max(F.struct("_fresh", *rest)).alias("v")
        # Laid out by bucket once; the grouping needs no other exchange.
        merged = rows.repartition(len(changed), "_bucket").groupBy("_bucket", *keys).agg(newest)
        merged = merged.select("_bucket", *[F.col(c) if c in keys else F.col(f"v.{c}").alias(c) for c in df.columns])
        merged.write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/data/{version}")
    after = before | {b: version for b in changed}
    marker = spark.createDataFrame(sorted(after.items()), "bucket int, version long")
    marker.coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/{version}")
    for old in done[:-1]:
        for b, v in _manifest(spark, path, old).items():
            if before.get(b) != v and after.get(b) != v:
                _delete(spark, _folder(path, b, v))
        _delete(spark, f"{path}/commits/{old}")
    return True


def current(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table as of its newest version."""
    done = commits(spark, path)
    held = _manifest(spark, path, done[-1]) if done else {}
    if not held:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[_folder(path, b, v) for b, v in sorted(held.items())])
