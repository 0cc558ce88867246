"""Session settings and written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Deletes the shuffle files of a query when it ends, instead of when the driver's garbage collector finds it unused.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_scratch: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def build_session(app: str = "cartwright", master: str | None = None, **settings: str) -> SparkSession:
    """Session with the settings every job here relies on; cluster values win through ``settings``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Streams merge sessions inside each input partition before the shuffle; batch plans have no such setting.
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder for written intermediates: the cluster's shared checkpoint folder, or a temporary one in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="cartwright-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder under the scratch root, remembered for :func:`release`."""
    app = spark.sparkContext.applicationId
    path = f"{scratch_root(spark)}/cartwright/{app}/{label}-{uuid.uuid4().hex}"
    _written.setdefault(app, []).append(path)
    return path


def materialise(df: DataFrame, label: str = "stage", **options: str) -> DataFrame:
    """Write ``df`` once and read it back.

    ``options`` are those of the Parquet writer. Cuts lineage for inputs that several later jobs scan, survives executor loss, and unlike ``checkpoint()`` computes
    the input a single time and keeps column pruning and filter pushdown for its readers. The shuffles of the write have no
    other reader and are deleted with it, so that those of a chain of steps do not add up on disk.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the intermediates this application wrote; call once their readers are done."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = _written.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
    return len(paths)
