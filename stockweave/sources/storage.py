"""Scans and sinks of the pipeline's folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave import columns as c


def scan_csv(spark: SparkSession, paths, schema: str | None = None, **options) -> DataFrame:
    """CSV with a header.  A schema saves the extra pass that inference costs."""
    reader = spark.read.option("header", True).options(**options)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(paths)


def scan_partition(spark: SparkSession, root: str, group: int) -> DataFrame:
    """Rows of one location group; the filter prunes the other folders."""
    return spark.read.parquet(root).where(F.col(c.LOCATION_GROUP) == group)


def sink_group_folders(df: DataFrame, root: str, groups: list[int]) -> None:
    """One plain folder a location group, ``LOCATION_GROUP_<g>``; the groups are listed."""
    for group in groups:
        df.where(F.col(c.LOCATION_GROUP) == group).drop(c.LOCATION_GROUP).write.mode("overwrite").parquet(f"{root}/{c.LOCATION_GROUP}_{group}")


def scan_group_folders(spark: SparkSession, root: str) -> DataFrame:
    """All ``LOCATION_GROUP_<g>`` folders with the group as a column, made from the files'
    paths: a filter on it prunes the list of files, as with partition folders."""
    group = F.regexp_extract(F.col("_metadata.file_path"), f"/{c.LOCATION_GROUP}_([0-9]+)/[^/]*$", 1).cast("int")
    rows = spark.read.parquet(f"{root}/{c.LOCATION_GROUP}_*")
    return rows.select("*", group.alias(c.LOCATION_GROUP))


def scan_csv_kept(spark: SparkSession, paths, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of CSV files, a record a line: no line is lost.

    Lines that repeat the names of the schema are headers.  A line that does not fit the schema
    is a reject (file, line, reason, fields): ``columns`` if it has more or fewer fields than
    the schema, else ``value`` with the names of the fields whose text is no value of their
    type.  ``drift`` sums them up.
    """
    bad = "_corrupt_record"
    kinds = spark.createDataFrame([], schema).schema
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("__file"))
    lines = lines.where(F.col("value") != ",".join(f.name for f in kinds.fields))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    read = lines.withColumn("__row", F.from_csv("value", f"{schema}, {bad} string", options)).select("__file", "value", "__row.*")
    # an empty line has no field at all
    misses = F.col(bad).isNotNull() | (F.col("value") == "")
    rows = read.where(~misses).drop(bad, "__file", "value")
    texts = ", ".join(f"`{f.name}` string" for f in kinds.fields)
    # commas outside of quotes part the fields
    parts = F.size(F.split(F.regexp_replace("value", '"[^"]*"', ""), ",", -1))
    fields = F.from_csv("value", texts)
    wrong = F.array_compact(
        F.array(
            *(
                F.when(fields[f.name].isNotNull() & (fields[f.name] != "") & fields[f.name].try_cast(f.dataType).isNull(), F.lit(f.name))
                for f in kinds.fields
            )
        )
    )
    misfit = parts != len(kinds.fields)
    rejects = read.where(misses).select(
        F.element_at(F.split("__file", "/"), -1).alias("file"),
        F.col("value").alias("line"),
        F.when(misfit, "columns").otherwise("value").alias("reason"),
        F.when(misfit, F.array().cast("array<string>")).otherwise(wrong).alias("fields"),
    )
    return rows, rejects


def drift(rejects: DataFrame) -> DataFrame:
    """(reason, field, n_lines): how many lines of what kind, and which fields they miss."""
    field = F.explode_outer(F.when(F.size("fields") > 0, F.col("fields")))
    return rejects.select("reason", field.alias("field")).groupBy("reason", "field").agg(F.count(F.lit(1)).alias("n_lines"))


def scan_layer(spark: SparkSession, root: str, layer: str) -> DataFrame:
    """One prediction layer over all location groups."""
    return spark.read.parquet(root).where(F.col("layer") == layer).drop("layer")


def file_catalog(spark: SparkSession, root: str) -> DataFrame:
    """Dropped files with bucket, path, name and length; file contents are not read.  The bucket
    is the authority of the path, or its first folder where it has none."""
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    )
    authority = F.regexp_extract("path", "^[a-z0-9]+://([^/]+)/", 1)
    first = F.regexp_extract("path", "^(?:[a-z0-9]+:)?/*([^/]+)/", 1)
    return found.withColumns(
        {"bucket": F.when(authority != "", authority).otherwise(first), "name": F.element_at(F.split("path", "/"), -1)}
    )


def sink_parquet(df: DataFrame, path: str, partition_by: list[str] = (), append: bool = False) -> None:
    """Compressed parquet.  Partition folders are filled through a rebalance, which
    splits a large folder over several tasks and gathers small ones."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("append" if append else "overwrite").option("compression", "gzip")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def sink_csv(df: DataFrame, path: str, append: bool = False) -> None:
    """CSV with a header."""
    df.write.mode("append" if append else "overwrite").option("header", True).csv(path)


def sink_json(df: DataFrame, path: str) -> None:
    """A metric document: one row, one file."""
    df.write.mode("overwrite").json(path)


def merge_consolidated(day: DataFrame, history: str, load_date: str) -> None:
    """Put a day's output under LOCATION_GROUP / LOAD_DATE of the history.

    Only the folders the day writes are replaced, so a rerun is idempotent.
    """
    stamped = day.withColumn(c.LOAD_DATE, F.to_date(F.lit(load_date)))
    (
        stamped.hint("rebalance", c.LOCATION_GROUP)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .partitionBy(c.LOCATION_GROUP, c.LOAD_DATE)
        .parquet(history)
    )
