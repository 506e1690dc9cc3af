"""Merge-on-read: snapshots of file slices, and base rows merged with later changes by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def snapshot_instant(commits: DataFrame) -> DataFrame:
    """(instant): the latest completed one of commits (instant, state); null if there is none."""
    return commits.where(F.col("state") == "completed").agg(F.max("instant").alias("instant"))


def file_slices(files: DataFrame, instant: str) -> DataFrame:
    """(partition, file_group, base_file, base_instant, logs): the latest slice up to the instant of every file group.

    files: (partition, file_group, instant, kind 'base' or 'log', sequence, path). A slice is the newest base file with
    the logs written at or after it, by instant and sequence; without a base file it is the logs alone.
    """
    seen = files.where(F.col("instant") <= instant)
    base = F.col("kind") == "base"
    newest = seen.where(base).groupBy("partition", "file_group").agg(
        F.max_by("path", F.struct("instant", "sequence")).alias("base_file"), F.max("instant").alias("base_instant")
    )
    with_base = seen.join(newest, ["partition", "file_group"], "left")
    log = ~base & (F.col("base_instant").isNull() | (F.col("instant") >= F.col("base_instant")))
    return with_base.groupBy("partition", "file_group").agg(
        F.first("base_file").alias("base_file"), F.first("base_instant").alias("base_instant"),
        F.transform(F.sort_array(F.collect_list(F.when(log, F.struct("instant", "sequence", "path")))), lambda x: x["path"]).alias("logs"),
    )


def latest_by_key(rows: DataFrame, keys: list[str], order: list[str | Column], deleted: Column | None = None) -> DataFrame:
    """For every key its last row by `order`, dropped if `deleted` holds for it.

    The last row is an aggregate, merged before and after one exchange on the keys, so a key with very many versions
    doesn't gather them in one task. `order` should be total over the versions of a key; nulls come first.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    whole = F.struct(*(F.col(f"`{c}`") for c in rows.columns))
    last = rows.groupBy(*keys).agg(F.max_by(whole, F.struct(*order)).alias("_last")).select("_last.*")
    return last if deleted is None else last.where(~F.coalesce(deleted, F.lit(False)))


def merge_on_read(
    base: DataFrame | None, deltas: DataFrame, keys: list[str], precombine: str, sequence: list[str], deleted: Column | None = None
) -> DataFrame:
    """Base rows merged with changes: for every key the row with the greatest precombine value, then sequence, wins.

    A change wins over a base row of the same precombine value and sequence. Keys whose winner is deleted are dropped.
    Without a base the slice is its logs alone. Columns are those of the changes, by name.
    """
    changes = deltas.withColumn("_log", F.lit(1))
    rows = changes if base is None else changes.unionByName(base.withColumn("_log", F.lit(0)))
    return latest_by_key(rows, keys, [precombine, *sequence, "_log"], deleted).drop("_log")
