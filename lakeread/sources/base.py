"""What a source of tables may offer, and a record of the calls that it gets."""

from __future__ import annotations

import functools
import logging
import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger("lakeread")


class TableSource:
    """Base of catalogs: everything is unsupported until a subclass says how."""

    def list_databases(self) -> list[str]:
        raise NotImplementedError("listing databases is not supported")

    def list_tables(self, database: str) -> list[str]:
        raise NotImplementedError("listing tables is not supported")

    def table_exists(self, database: str, table: str) -> bool:
        raise NotImplementedError("looking up tables is not supported")

    def schema(self, database: str, table: str) -> Any:
        raise NotImplementedError("table schemas are not supported")

    def read(self, database: str, table: str) -> DataFrame:
        raise NotImplementedError("reading tables is not supported")

    def partitions(self, database: str, table: str) -> DataFrame:
        raise NotImplementedError("listing partitions is not supported")

    def partitions_by_filter(self, database: str, table: str, predicate: str, max_parts: int = -1) -> DataFrame:
        raise NotImplementedError("filtering partitions is not supported")


def traced(spark: SparkSession, call: Callable[..., Any]) -> Callable[..., Any]:
    """The call, with its name as the description of the Spark jobs it starts and its time and arguments in the log."""

    @functools.wraps(call)
    def run(*args: Any, **kwargs: Any) -> Any:
        began = time.perf_counter()
        spark.sparkContext.setJobDescription(call.__name__)
        try:
            return call(*args, **kwargs)
        finally:
            spark.sparkContext.setJobDescription(None)
            log.info("%s%r took %.0f ms", call.__name__, args, 1000 * (time.perf_counter() - began))

    return run
