"""Inputs of the later stages, derived from the base tables by plain arithmetic.

Spread formulas use whole numbers below 2**53, divided once, so any engine gives
the same doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave import columns as c
from stockweave.operators.prepare import Feeds
from stockweave.operators.intake import FEEDS
from stockweave.sources.tables import table


def dropped_files(spark: SparkSession, root: str) -> DataFrame:
    """One dropped file per order: mostly well named, some malformed."""
    orders = table(spark, root, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("file_date"))
    k = F.col("o_orderkey")
    feed = F.get(F.array(*(F.lit(f) for f in FEEDS), F.lit("UNKNOWN")), (k % 11).cast("int"))
    date = F.when(k % 7 == 0, F.date_format("file_date", "yyyyMMdd")).otherwise(F.date_format("file_date", "ddMMyyyy"))
    number = k.cast("string")
    base = (
        F.when(k % 19 == 0, F.concat(feed, F.lit("-"), date, F.lit("_"), number, F.lit("-23")))
        .when(k % 23 == 0, F.concat(feed, F.lit("_ERROR-"), date, F.lit("12-"), number))
        .otherwise(F.concat(feed, F.lit("-"), date, F.lit("-"), number))
    )
    ext = F.when(k % 13 == 0, "txt").when(k % 17 == 0, "CSV").when(k % 5 == 0, "csv.gz").otherwise("csv")
    named = orders.withColumn("name", F.concat(base, F.lit("."), ext))
    return named.select(F.concat(F.lit("drop/"), "name").alias("path"), "name", "file_date")


def _spread(value: Column, n: int) -> Column:
    return F.pmod(value, F.lit(n)).cast("double") / F.lit(1000.0)


def scored_panel(panel: DataFrame, model: str = "new", keep: tuple = ()) -> DataFrame:
    """Panel rows with four stage scores and the truth columns, and the columns of ``keep``."""
    shift = {"new": 0, "prod": 137}[model]
    soh, sales, loc, cnt = (F.col(n) for n in (c.END_SOH, c.SALES_UNITS, c.LOCATION, c.SALES_COUNT))
    day = F.datediff(c.DATE, F.to_date(F.lit("1990-01-01")))
    stock = soh + 2 * F.coalesce(F.col(c.AUDIT_UNITS), F.lit(0)) + (cnt + day) % 7 - 3
    return panel.select(
        *c.KEY,
        c.LOCATION_GROUP, c.EOP_SOH, c.BOOK, c.TOTAL_RETAIL,
        _spread(soh * 37 + sales * 11 + day * 13 + loc + shift, 1000).alias("binary_pred"),
        _spread(soh * 53 + sales * 29 + day * 7 + shift, 1000).alias("hl_score"),
        _spread(soh * 71 + sales * 3 + day * 31 + shift, 1500).alias("low_pred"),
        (F.lit(1.0) + _spread(soh * 17 + sales * 41 + day * 5 + shift, 900)).alias("high_pred"),
        stock.cast("bigint").alias("rev_ip_qty_eop_soh"),
        F.when(stock <= 0, 1).otherwise(0).alias("BINARY_TARGET_CLASSIFICATION"),
        F.when(stock <= soh, 1).otherwise(0).alias("BINARY_HL_TARGET_CLASSIFICATION"),
        _spread(stock * 29 + soh, 1200).alias("TARGET_REGRESSION"),
        *keep,
    )


def actuals(panel: DataFrame) -> DataFrame:
    """Audited truth: panel rows of audit days with whether stock was gone."""
    return panel.where(F.col(c.AUDIT_FLAG) == 1).select(
        *c.KEY, F.when(F.col(c.END_SOH) + F.col(c.AUDIT_UNITS) <= 0, 1).otherwise(0).alias("ACTUAL_OOS_FLAG")
    )


def fact_tables(lines: DataFrame) -> tuple[DataFrame, dict[str, DataFrame], DataFrame]:
    """Snapshot spine, line-level facts and the item master, before denormalising."""
    units, returned, line_no = F.col("units"), F.col("return_flag") == "R", F.col("line_no")

    def fact(name: str, amount: Column, when: Column) -> DataFrame:
        return lines.where(when).select(*c.KEY, amount.alias(name))

    facts = {
        c.GROSS_SALES: fact(c.GROSS_SALES, units, ~returned),
        c.RETURN_UNITS: fact(c.RETURN_UNITS, -units, returned),
        c.IN_TRANSIT: fact(c.IN_TRANSIT, units, (F.col("line_status") == "O") & (line_no <= 2)),
        c.POS_ADJ: fact(c.POS_ADJ, units, line_no == 6),
        c.NEG_ADJ: fact(c.NEG_ADJ, -units, line_no == 7),
    }
    snapshot = lines.select(*c.KEY).distinct()
    number = F.col("brand_no")
    master = lines.select(
        c.SKU, F.concat(F.lit("C"), (number % 5).cast("string")).alias(c.CAT),
        F.concat(F.lit("D"), (number % 3).cast("string")).alias(c.DEPT),
    ).distinct()
    return snapshot, facts, master


def panel_feeds(lines: DataFrame, panel: DataFrame) -> Feeds:
    """The feeds of a panel: line-level facts, the stock snapshot, item master, audits, and a
    count period of 25 days in every third month of a store (another third for each)."""
    units, line_no, returned = F.col("units"), F.col("line_no"), F.col("return_flag") == "R"
    group = [c.LOCATION_GROUP] if c.LOCATION_GROUP in lines.columns else []

    def fact(name: str, amount: Column, when: Column) -> DataFrame:
        return lines.where(when).select(*c.KEY, *group, amount.cast("bigint").alias(name))

    facts = {
        c.SALES_COUNT: lines.select(*c.KEY, *group, "order_key").distinct().select(*c.KEY, *group, F.lit(1).cast("bigint").alias(c.SALES_COUNT)),
        c.GROSS_SALES: fact(c.GROSS_SALES, units, ~returned),
        c.RETURN_UNITS: fact(c.RETURN_UNITS, -units, returned),
        c.IN_TRANSIT: fact(c.IN_TRANSIT, units, (F.col("line_status") == "O") & (line_no <= 2)),
        c.POS_ADJ: fact(c.POS_ADJ, units, line_no == 6),
        c.NEG_ADJ: fact(c.NEG_ADJ, -units, line_no == 7),
        c.DSD_UNITS: fact(c.DSD_UNITS, F.when(F.col("return_flag") == "A", -units).otherwise(units), line_no == 5),
        c.TOTAL_RETAIL: fact(c.TOTAL_RETAIL, F.col("cents"), ~returned),
    }
    stock = [c.BEGIN_SOH, c.END_SOH, c.START_INTRANS, c.END_INTRANS, c.EOP_SOH, c.BOOK]
    held = [c.LOCATION_GROUP] if c.LOCATION_GROUP in panel.columns else []
    audits = panel.where(F.col(c.AUDIT_FLAG) == 1).select(*c.PAIR, *held, c.AUDIT_DATE, c.AUDIT_UNITS)
    first = F.trunc(c.DATE, "month").alias("FIRST_DAY")
    months = panel.select(c.LOCATION, first).distinct().where((F.month("FIRST_DAY") + F.col(c.LOCATION) / 10) % 3 == 0)
    return Feeds(
        panel.select(*c.KEY, *held, c.LOAD_DATE, *stock),
        facts,
        panel.select(c.SKU, c.CAT, c.DEPT, c.LOB).distinct(),
        audits,
        months.withColumn("LAST_DAY", F.date_add("FIRST_DAY", 24)),
    )
