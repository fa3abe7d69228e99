"""Tables bucketed by (SKU, LOCATION): the pair windows of all operators run without exchange."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from stockweave import columns as c
from stockweave.sources.shared import fresh_path


def save_by_pair(panel: DataFrame, buckets: int, name: str | None = None) -> str:
    """Write a panel as a table of ``buckets`` buckets by pair, each sorted by pair and date;
    returns its name.

    The rows are dealt once, by the hash that the buckets use, so a bucket is one file.  Every
    later plan that groups or orders the rows of a pair reads a bucket a task and deals
    nothing; ``buckets`` sets how many tasks that are.  A pair has at most one row a day, so a
    bucket is never much larger than the others.
    """
    spark = panel.sparkSession
    name = name or f"panel_{uuid.uuid4().hex}"
    dealt = panel.repartition(buckets, *c.PAIR)
    writer = dealt.write.option("path", fresh_path(spark, name)).bucketBy(buckets, *c.PAIR).sortBy(*c.KEY)
    writer.format("parquet").saveAsTable(name)
    return name


def read_by_pair(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
