"""Shared-folder tables, size-checked broadcasts and input sizing used by every operator of this subpackage."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most keys that are broadcast; beyond it the same join is left to a shuffle.
BROADCAST_KEYS = 2_000_000
#: Most bytes of a table of longer rows that are broadcast.
BROADCAST_BYTES = 32 << 20


_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode, where it may be unset, a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or _local.get(spark.sparkContext.applicationId)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = _local[spark.sparkContext.applicationId] = "file://" + tempfile.mkdtemp(prefix="millrace-")
    return found.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/millrace/{name}-{uuid.uuid4().hex}"


#: Bytes of one Arrow batch between the JVM and Python; the default, 64 MB or 10,000 rows, is many times what a task works on at once.
BATCH_BYTES = 4 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.scratch)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0


def pieces(total: int, each: int, least: int = 1) -> int:
    """How many partitions of about `each` units hold `total` units."""
    return max(least, math.ceil(total / each))


def keys_join(df: DataFrame, keys: DataFrame, on: list[str] | str, how: str, bound: int = BROADCAST_KEYS) -> DataFrame:
    """Join with a stored key table: broadcast while it has at most `bound` rows, a shuffled join beyond."""
    small = keys.limit(bound + 1).count() <= bound
    return df.join(F.broadcast(keys) if small else keys, on, how)


def sized_join(df: DataFrame, table: DataFrame, on: list[str] | str, how: str, blob: str, bound: int = BROADCAST_BYTES) -> DataFrame:
    """Join with a stored table whose rows are as long as its binary column `blob`: broadcast up to `bound` bytes, a shuffled join beyond."""
    size = table.agg(F.sum(F.octet_length(blob) + 40).alias("b")).first()["b"] or 0
    return df.join(F.broadcast(table) if size <= bound else table, on, how)
