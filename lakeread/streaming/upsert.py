"""A stream of changes, appended to a log and merged when read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import latest_by_key, merge_on_read


def write_changes(changes: DataFrame, log: str, checkpoint: str, **trigger: object) -> StreamingQuery:
    """Appends a stream of changes to the log, numbered by micro-batch; a batch that is tried again replaces its own files."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/batch={number}")

    return changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def read_merged(spark: SparkSession, base: DataFrame | None, log: str, keys: list[str], precombine: str, deleted: Column | None = None) -> DataFrame:
    """The table that base rows and all logged changes give; later micro-batches win among equal precombine values."""
    changes = spark.read.parquet(log).withColumnRenamed("batch", "_batch")
    older = None if base is None else base.withColumn("_batch", F.lit(-1))
    return merge_on_read(older, changes, keys, precombine, ["_batch"], deleted).drop("_batch")


def compact(spark: SparkSession, log: str, target: str, keys: list[str], precombine: str) -> None:
    """Rewrites a log as one row for each key, tombstones included, so that it can be merged with a base like the log."""
    changes = spark.read.parquet(log)
    latest_by_key(changes, keys, [precombine, "batch"]).drop("batch").write.mode("overwrite").parquet(f"{target}/batch=0")
