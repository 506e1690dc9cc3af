"""Where intermediate tables go: the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def work_dir(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; where that is unset, a temporary one in local mode, else an error."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that the driver and all executors of {master} share")
        shared = tempfile.mkdtemp(prefix="lakeread-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
