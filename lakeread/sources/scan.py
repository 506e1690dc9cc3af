"""Scans: projection, nested fields and a pushed filter over files, and what the scan would read."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.predicate import Filter, parse
from ..operators.select import select

#: Stores and formats that files can be read from without merging rows.
NATIVE_PROTOCOLS = ["HDFS", "S3", "S3A", "COSN", "COS", "OBS", "OSS", "TOS"]
NATIVE_FORMATS = ["orc", "parquet"]


@dataclass(frozen=True)
class Scan:
    """A read of a table: which columns, which of their nested fields, and which rows.

    With complete=True a filter of which conjuncts had to be dropped is an error; otherwise the scan keeps a superset.
    """

    table: DataFrame
    fields: list[str] | None = None
    nested: str = ""
    filter: str = ""
    complete: bool = False

    def parsed(self) -> Filter:
        return parse(self.filter, self.table.schema, strict=self.complete) if self.filter else Filter(None)

    def df(self) -> DataFrame:
        """The rows; Catalyst pushes filter and projection to the files, and applies the filter exactly."""
        condition = self.parsed().condition
        rows = self.table if condition is None else self.table.where(condition)
        return select(rows, self.fields or self.table.columns, self.nested)

    def files(self, matching: bool = False, keys: Iterable[str] = ()) -> DataFrame:
        """(*keys, path, size, offset, length, modified, rows) of the file parts that the table has rows in.

        That takes the files' footers only. With matching=True the filter is applied, so its columns are read: the parts
        that hold rows of the scan, and how many. keys: partition keys, whose values are told from the paths.
        """
        condition = self.parsed().condition
        rows = self.table if condition is None or not matching else self.table.where(condition)
        m = F.col("_metadata")
        return rows.groupBy(
            *(F.col(f"`{k}`") for k in keys), m["file_path"].alias("path"), m["file_size"].alias("size"), m["file_block_start"].alias("offset"),
            m["file_block_length"].alias("length"), m["file_modification_time"].alias("modified"),
        ).agg(F.count("*").alias("rows"))

    def raw_files(self, matching: bool = False) -> DataFrame:
        """(descriptor): the file parts as JSON."""
        name = F.element_at(F.split("path", r"\."), -1)
        return self.files(matching).withColumn("format", name).select(F.to_json(F.struct("path", "size", "offset", "length", "format", "rows", "modified")).alias("descriptor"))


def read(spark: SparkSession, path: str, file_format: str = "parquet", **options: str) -> DataFrame:
    """A table of parquet, orc, csv, json or text files; avro needs Spark's external module."""
    if file_format == "avro":
        raise NotImplementedError("avro needs the spark-avro module, which is not part of this installation")
    return spark.read.format(file_format).options(**options).load(path)


def native(splits: DataFrame, force_row: bool = False) -> Column:
    """Whether a split's files can be read as they are: splits (is_data, raw_convertible, deletion_files, files).

    files: array of (path, format). All must be of a native format in a native store; a path without :// is not.
    """
    if force_row:
        return F.lit(False)

    def readable(f: Column) -> Column:
        parts = F.split(f["path"], "://")
        return (F.size(parts) == 2) & F.upper(parts[0]).isin(NATIVE_PROTOCOLS) & f["format"].isin(NATIVE_FORMATS)

    clean = splits["is_data"] & splits["raw_convertible"] & (F.coalesce(splits["deletion_files"], F.lit(0)) == 0)
    return F.coalesce(clean & F.forall(splits["files"], readable), F.lit(False))
