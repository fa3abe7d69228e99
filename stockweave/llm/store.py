"""Written intermediates of operators that take several jobs."""

from __future__ import annotations

import gc
import time

from pyspark.sql import DataFrame

from stockweave.sources.shared import fresh_path


#: Rows and bytes of an Arrow batch while a job writes: a worker holds a few batches of whole
#: texts at a time, which the session's 10,000 rows would leave unbounded.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "16777216"}


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back.  The plan that was written is given up at
    once and the JVM asked to collect it, so that Spark's cleaner removes its shuffle files
    now and not at the end of the application: disk holds the shuffles of one job only."""
    spark, path, schema = df.sparkSession, fresh_path(df.sparkSession, name), df.schema
    # runs of one text overlap, which this codec makes use of
    before = {key: spark.conf.get(key, None) for key in BATCHES}
    try:
        for key, value in BATCHES.items():
            spark.conf.set(key, value)
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    jvm = spark.sparkContext._jvm
    del df
    # the first round frees the plan, the second the shuffles that only it held
    for _ in range(2):
        gc.collect()
        jvm.System.gc()
        time.sleep(0.3)
    return spark.read.schema(schema).parquet(path)
