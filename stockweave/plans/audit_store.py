"""The audited panel kept up to date day by day.

An audit changes rows back to the one before it: until it came in, those rows had no audit
ahead.  A day's run finds that range for each pair, reads only the raw rows in it, and
rewrites only the month folders that hold them.  Three tables under one path:

- ``raw``: the panel as loaded, one row a key, by month of DATE;
- ``audited``: the panel after ``apply_audit``, by month of DATE;
- ``marks``: per pair the last day, the last audit, and the last cycle count at either, by
  LOAD_DATE: all a new row needs of the rows before it.

A day that is run again, as after a lost driver, gives the same tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave import columns as c
from stockweave.operators.audit import CC_SEED, apply_audit, dedup_latest
from stockweave.sources.shared import written

MONTH = "PANEL_MONTH"
CLOSING = "__closing"
MARKS = ["last_day", "last_cc", "last_audit", "audit_cc"]


def _closes() -> Column:
    """An audit row that all backward fills stop at."""
    return (F.col(c.AUDIT_FLAG) == 1) & F.col(c.AUDIT_DATE).isNotNull() & F.col(c.AUDIT_UNITS).isNotNull()


def _reaches_back() -> Column:
    return (F.col(c.AUDIT_FLAG) == 1) | F.col(c.AUDIT_DATE).isNotNull() | F.col(c.AUDIT_UNITS).isNotNull()


def _by_month(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH, F.date_format(c.DATE, "'m'yyyy-MM"))


def _save(df: DataFrame, path: str, by: str) -> None:
    """Replace the folders of ``by`` that ``df`` has rows of; a large one is split over tasks."""
    writer = df.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(by).parquet(path)


def _read(spark: SparkSession, path: str, months: list[str]) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path).where(F.col(MONTH).isin(months))


def _marks(done: DataFrame) -> DataFrame:
    """(PAIR, MARKS) of audited rows that carry CLOSING."""
    at_audit = F.when(F.col(CLOSING), F.col(c.DATE))
    return done.groupBy(*c.PAIR).agg(
        F.max(c.DATE).alias("last_day"),
        F.max_by(c.LAST_CC_DATE, c.DATE).alias("last_cc"),
        F.max(at_audit).alias("last_audit"),
        F.max_by(c.LAST_CC_DATE, at_audit).alias("audit_cc"),
    )


def start(panel: DataFrame, path: str, day: str) -> None:
    """All three tables from a panel that ends on ``day``; the only step that reads it all."""
    raw = written(dedup_latest(panel), "raw")
    _save(_by_month(raw), f"{path}/raw", MONTH)
    done = written(apply_audit(raw.withColumn(CLOSING, _closes())), "audited")
    _save(_by_month(done.drop(CLOSING)), f"{path}/audited", MONTH)
    _save(_marks(done).withColumn(c.LOAD_DATE, F.to_date(F.lit(day))), f"{path}/marks", c.LOAD_DATE)


def affected(incoming: DataFrame, marks: DataFrame) -> DataFrame:
    """(PAIR, start, seed, back, whole): the rows of the pair after ``start`` change (null:
    all), ``seed`` is the cycle count before them.

    - A new row without an audit changes no other row.
    - A new row with an audit changes those after the pair's last audit (``back``).
    - A row on or before the pair's last day corrects history; the pair is done anew.
    """
    pairs = incoming.groupBy(*c.PAIR).agg(F.min(c.DATE).alias("first"), F.max(_reaches_back()).alias("audits"))
    late = F.coalesce(F.col("first") <= F.col("last_day"), F.lit(False))
    joined = pairs.join(marks, c.PAIR, "left")
    begin = F.when(late, None).when(F.col("audits"), F.col("last_audit")).otherwise(F.date_sub("first", 1))
    seed = F.when(late, None).when(F.col("audits"), F.col("audit_cc")).otherwise(F.col("last_cc"))
    back = F.col("audits") | late
    return joined.select(*c.PAIR, begin.alias("start"), seed.alias("seed"), back.alias("back"), (back & begin.isNull()).alias("whole"))


def refresh(rows: DataFrame, path: str, before: str, day: str) -> list[str]:
    """Take in the rows loaded on ``day``; ``before`` is the day of the marks to go on from.
    Returns the months of the audited table that were rewritten."""
    spark = rows.sparkSession
    on = lambda x: F.col(c.LOAD_DATE) == F.to_date(F.lit(x))
    incoming = written(_by_month(dedup_latest(rows.where(on(day)))), "incoming")
    marks = spark.read.parquet(f"{path}/marks").where(on(before)).drop(c.LOAD_DATE)
    scope = written(affected(incoming, marks), "scope")

    # raw: the day's rows replace their keys
    months = [r[0] for r in incoming.select(MONTH).distinct().collect()]  # as many as the calendar has
    kept = _read(spark, f"{path}/raw", months).join(incoming.select(*c.KEY), c.KEY, "left_anti")
    _save(written(kept.unionByName(incoming), "raw"), f"{path}/raw", MONTH)

    # the changed ranges, from the raw table pruned to the earliest of them
    ranges = scope.where("back")
    low = ranges.agg(F.min(F.coalesce("start", F.to_date(F.lit("0001-01-01"))))).first()[0]
    changed = incoming
    if low is not None:
        raw = spark.read.parquet(f"{path}/raw").where(F.col(MONTH) >= f"m{low.isoformat()[:7]}")
        earlier = raw.join(ranges.select(*c.PAIR, "start"), c.PAIR).where(F.col("start").isNull() | (F.col(c.DATE) > F.col("start")))
        earlier = earlier.drop("start").join(incoming.select(*c.KEY), c.KEY, "left_anti")
        changed = incoming.unionByName(earlier)
    seeded = changed.join(scope.select(*c.PAIR, F.col("seed").alias(CC_SEED)), c.PAIR).withColumn(CLOSING, _closes())
    done = written(apply_audit(seeded).drop(CC_SEED), "changed")

    months = sorted(r[0] for r in done.select(MONTH).distinct().collect())
    fresh = done.drop(CLOSING)
    kept = _read(spark, f"{path}/audited", months).join(done.select(*c.KEY), c.KEY, "left_anti")
    _save(written(kept.unionByName(fresh), "audited"), f"{path}/audited", MONTH)

    # marks: of a pair that was not done as a whole the last audit may lie before its range
    new = _marks(done).select(*c.PAIR, *(F.col(n).alias(f"__{n}") for n in MARKS)).join(scope.select(*c.PAIR, "whole"), c.PAIR)
    joined = new.join(marks, c.PAIR, "left")
    held = F.col("whole") | F.col("__last_audit").isNotNull()
    made = joined.select(
        *c.PAIR,
        F.col("__last_day").alias("last_day"),
        F.col("__last_cc").alias("last_cc"),
        *(F.when(held, F.col(f"__{n}")).otherwise(F.col(n)).alias(n) for n in ("last_audit", "audit_cc")),
    )
    idle = marks.join(new.select(*c.PAIR), c.PAIR, "left_anti")
    state = made.unionByName(idle.select(*made.columns)).withColumn(c.LOAD_DATE, F.to_date(F.lit(day)))
    _save(state, f"{path}/marks", c.LOAD_DATE)
    return months
