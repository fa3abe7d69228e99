"""Shared storage for written intermediates."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``, or the session's warehouse.

    There is no machine-local choice; a folder of one machine is lost with it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (root or f"{spark.conf.get('spark.sql.warehouse.dir')}/intermediates").rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write once, read back: later branches scan only the columns they need and
    nothing upstream is computed twice.  Survives executor loss, unlike a cache.
    Runs a job at once, so it is for inputs that two or more branches read.  The files
    stay until the folder is cleared: a lazy result may still read them."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
