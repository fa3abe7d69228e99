"""Intake of dropped files as a stream, each file in the log once.

The stream's checkpoint knows which files a batch took; the sink keys what it appends by the
batch.  A run that is cut after a batch was written but before it was committed takes the
same files as the same batch again and replaces its folder: a replay changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.operators import intake

BATCH = "batch_id"


def listed_files(spark: SparkSession, folder: str, per_batch: int = 1000) -> DataFrame:
    """Stream of the file lists (path, name, file_date) that arrive in a folder."""
    reader = spark.readStream.schema("path string, name string, file_date date")
    return reader.option("maxFilesPerTrigger", per_batch).parquet(folder)


def append_once(step: Callable[[DataFrame], DataFrame], log: str) -> Callable[[DataFrame, int], None]:
    """A batch sink: the batch's rows through ``step``, in a folder of the batch."""

    def sink(rows: DataFrame, batch: int) -> None:
        step(rows).write.mode("overwrite").parquet(f"{log}/{BATCH}={batch}")

    return sink


def run_intake(files: DataFrame, log: str, checkpoint: str, step: Callable[[DataFrame], DataFrame] = intake.file_classify) -> None:
    """Take in all files that are there, in batches, and end."""
    writer = files.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer.foreachBatch(append_once(step, log)).start().awaitTermination()


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """The log of all batches, with the batch of each row."""
    return spark.read.parquet(log).withColumn(BATCH, F.col(BATCH).cast("long"))
