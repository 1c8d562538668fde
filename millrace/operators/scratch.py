"""Intermediate tables in the folder that all machines share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; in local mode, where it may be unset, a temporary folder. Unset on a cluster it is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or _local.get(spark.sparkContext.applicationId)
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = _local[spark.sparkContext.applicationId] = "file://" + tempfile.mkdtemp(prefix="millrace-")
    return found.rstrip("/")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared folder."""
    return f"{shared_dir(spark)}/millrace/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written as a table in the shared folder and read again: it is made once, and a lost executor costs its own tasks only."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
