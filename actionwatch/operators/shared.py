"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="spark-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share (``spark.checkpoint.dir``).

    A temporary one is used only where that is unset and Spark runs in this process alone; on a cluster it is an error,
    as executors would write to disks of their own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = _own_folder()
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write and read back: cuts lineage, survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
