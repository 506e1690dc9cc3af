"""The synthetic source as a Spark data source: spark.read.format("lakeread_synthetic").option("batches", 4)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


class BatchPartition(InputPartition):
    def __init__(self, batch: int) -> None:
        super().__init__(batch)
        self.batch = batch


class SyntheticReader(DataSourceReader):
    def __init__(self, batches: int, rows: int) -> None:
        self.batches, self.rows = batches, rows

    def partitions(self) -> list[BatchPartition]:
        return [BatchPartition(i) for i in range(self.batches)]

    def read(self, partition: BatchPartition) -> Iterator[pa.RecordBatch]:
        ids = range(partition.batch * self.rows, (partition.batch + 1) * self.rows)
        yield pa.RecordBatch.from_pydict({
            "batch": pa.array([partition.batch] * self.rows, pa.int64()),
            "ints": pa.array(ids, pa.int32()),
            "strs": pa.array([f"row-{i}" for i in ids], pa.string()),
        })


class SyntheticSource(DataSource):
    """Options: batches (1), each a partition, and rows (4096) of each. A pattern for sources that Spark doesn't have."""

    @classmethod
    def name(cls) -> str:
        return "lakeread_synthetic"

    def schema(self) -> str:
        return "batch long, ints int, strs string"

    def reader(self, schema: StructType) -> SyntheticReader:
        return SyntheticReader(int(self.options.get("batches", 1)), int(self.options.get("rows", 4096)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SyntheticSource)
