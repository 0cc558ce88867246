"""Running a stream over what is available and reading its result back."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cartwright.session import scratch_path
from cartwright.sources import keyed


def to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything available, then stop; a later call continues from the checkpoint."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def upsert(stream: DataFrame, path: str, checkpoint: str, keys: list[str], buckets: int = 8) -> None:
    """Update-mode result merged by key into the table at ``path`` (see :mod:`cartwright.sources.keyed`), one version a micro-batch.

    A batch that is run again after a failure finds its version there or writes it anew.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        keyed.merge(batch, path, keys, batch_id, buckets)

    query = (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()


def drain(stream: DataFrame, mode: str = "append", keys: list[str] | None = None) -> DataFrame:
    """Run a stream over the available input and return its result as a table."""
    spark = stream.sparkSession
    base = scratch_path(spark, "stream")
    if mode == "update":
        if not keys:
            raise ValueError("an update-mode result is merged by its keys")
        upsert(stream, f"{base}/out", f"{base}/checkpoint", keys)
        return keyed.current(spark, f"{base}/out", stream.schema)
    to_table(stream, f"{base}/out", f"{base}/checkpoint", mode)
    return spark.read.schema(stream.schema).parquet(f"{base}/out")
