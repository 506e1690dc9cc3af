"""Tables of file slices on a file system: a timeline of commits, base files, and logs of later changes.

Layout:
  <table>/.hoodie/<instant>.<action>[.requested|.inflight]       the timeline; an instant without a suffix is completed
  <table>/<partition>/<file group>_<token>_<instant>.parquet      a base file, written by that instant
  <table>/<partition>/<file group>_<instant>.log.<n>_<token>      the n-th log (Parquet) after the base file of that instant
Rows of logs say in `_hoodie_commit_time` which instant wrote them; a base file's rows are its instant's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import file_slices, latest_by_key, snapshot_instant

#: The folder of the timeline, and the column of a row's instant.
TIMELINE = ".hoodie"
COMMIT_TIME = "_hoodie_commit_time"
BASE = r"([^/_]+)_[^/_]+_(\d+)\.parquet$"
LOG = r"([^/_]+)_(\d+)\.log\.(\d+)_[^/]+$"
ACTIONS = ("commit", "deltacommit", "replacecommit", "compaction")


def timeline(spark: SparkSession, table: str) -> DataFrame:
    """(instant, action, state): 'completed', 'inflight' or 'requested', one row for each file of the timeline.

    Spark's readers pass over hidden folders, so it is listed by the file system: a few files for each commit of a table.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/{TIMELINE}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    names = [s.getPath().getName().split(".") for s in found if s.isFile()]
    rows = [(n[0], n[1], n[2] if len(n) > 2 else "completed") for n in names if len(n) in (2, 3) and n[1] in ACTIONS]
    return spark.createDataFrame(rows, "instant string, action string, state string")


def table_files(spark: SparkSession, table: str, partitions: list[str] | None = None) -> DataFrame:
    """(partition, file_group, instant, kind, sequence, path, length) of the base files and logs; other files are left out.

    partitions: paths relative to the table, '' for its root; None for all of them.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(table)
    root = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()
    base, log = F.regexp_extract("path", BASE, 0) != "", F.regexp_extract("path", LOG, 0) != ""
    part = lambda k: F.when(base, F.regexp_extract("path", BASE, k)).otherwise(F.regexp_extract("path", LOG, k))
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(table)  # opens no file for these columns
    found = listed.where(base | log).select(
        F.regexp_replace(F.substring("path", len(root) + 2, 1 << 30), "/?[^/]*$", "").alias("partition"), part(1).alias("file_group"), part(2).alias("instant"),
        F.when(base, "base").otherwise("log").alias("kind"), F.when(log, F.regexp_extract("path", LOG, 3).cast("int")).otherwise(0).alias("sequence"), "path", "length",
    )
    return found if partitions is None else found.where(F.col("partition").isin(*partitions))


def completed(spark: SparkSession, table: str, instant: str | None = None) -> DataFrame:
    """(instant) of the completed instants up to the given one, or all."""
    done = timeline(spark, table).where(F.col("state") == "completed").select("instant").distinct()
    return done if instant is None else done.where(F.col("instant") <= instant)


def snapshot(spark: SparkSession, table: str, partitions: list[str] | None = None, instant: str | None = None) -> DataFrame:
    """(partition, file_group, base_file, base_instant, logs) that a read at an instant, by default the latest completed one, takes.

    Base files of instants that are not completed are not seen. No completed instant gives no slices.
    """
    done = completed(spark, table, instant)
    at = snapshot_instant(done.withColumn("state", F.lit("completed"))).first()["instant"]
    files = table_files(spark, table, partitions).join(F.broadcast(done.withColumn("_done", F.lit(True))), "instant", "left")
    return file_slices(files.where((F.col("kind") == "log") | F.col("_done")), at or "")


def read_snapshot(
    spark: SparkSession, table: str, keys: list[str], precombine: str, deleted: Column | None = None, partitions: list[str] | None = None,
    instant: str | None = None, optimized: bool = False,
) -> DataFrame:
    """The rows of a table at an instant: each slice's base rows merged with its logs by key; no slices give an error.

    The last row by (precombine, instant, log number, place in the file) wins, a log's over a base file's of the same
    precombine value, and keys whose last row is `deleted` are dropped. Log rows of instants that are not completed, or
    are later, don't count. A slice without a base file is its logs alone. optimized: base files only, as they are. The
    paths of the chosen files are a scan's plan, so they come to the driver like any file index; rows never do.
    """
    chosen = snapshot(spark, table, partitions, instant).select("base_file", "logs").collect()
    bases, logs = [r["base_file"] for r in chosen if r["base_file"]], [x for r in chosen for x in r["logs"]]
    if not bases and (optimized or not logs):
        raise ValueError(f"no completed files in {table}")
    place = {"_place": F.monotonically_increasing_id()}
    rows = None
    if bases:
        rows = spark.read.parquet(*bases)
        if optimized:
            return rows
        rows = rows.withColumns(place | {"_log": F.lit(0)})
    if logs:
        done = F.broadcast(completed(spark, table, instant).withColumnRenamed("instant", COMMIT_TIME))
        changes = spark.read.parquet(*logs).withColumns(place | {"_log": F.regexp_extract("_metadata.file_path", LOG, 3).cast("int")})
        changes = changes.join(done, COMMIT_TIME, "left_semi")
        rows = changes if rows is None else rows.unionByName(changes)
    order = [F.col(precombine), (F.col("_log") > 0), F.col(COMMIT_TIME), F.col("_log"), F.col("_place")]
    return latest_by_key(rows, keys, order, deleted).drop("_place", "_log")


def write_file(rows: DataFrame, path: str) -> None:
    """Writes rows as one Parquet file of that very name, as the writer of a file slice does."""
    spark = rows.sparkSession
    parts = f"{path}.writing"
    rows.coalesce(1).write.mode("overwrite").parquet(parts)
    jvm = spark._jvm.org.apache.hadoop.fs
    system = jvm.Path(parts).getFileSystem(spark._jsc.hadoopConfiguration())
    part = next(s.getPath() for s in system.listStatus(jvm.Path(parts)) if s.getPath().getName().startswith("part-"))
    system.mkdirs(jvm.Path(path).getParent())
    system.rename(part, jvm.Path(path))
    system.delete(jvm.Path(parts), True)


def write_instant(spark: SparkSession, table: str, instant: str, action: str = "commit", state: str = "completed") -> None:
    """Enters an instant into the timeline."""
    jvm = spark._jvm.org.apache.hadoop.fs
    path = jvm.Path(f"{table}/{TIMELINE}/{instant}.{action}" + ("" if state == "completed" else f".{state}"))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path).close()
