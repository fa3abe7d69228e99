"""Base tables and the inputs derived from them.

The star-schema tables stand in for the retailer's feeds: brand = SKU, the
supplier's nation = store, ship date = business day.  Everything here scales
with the tables; nothing is a literal sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockweave import columns as c
from stockweave.functions.exprs import half_up


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def brand_number(brand: Column) -> Column:
    return F.substring(brand, 7, 10).cast("int")


def store_lines(spark: SparkSession, root: str) -> DataFrame:
    """One row per order line with its SKU, LOCATION and DATE.

    part and supplier join by size: Catalyst broadcasts a side below its
    threshold and sort-merges beyond it, where AQE splits hot keys.
    """
    line = table(spark, root, "lineitem").select(
        "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    part = table(spark, root, "part").select("p_partkey", "p_brand")
    supplier = table(spark, root, "supplier").select("s_suppkey", "s_nationkey")
    return (
        line.join(part, line.l_partkey == part.p_partkey)
        .join(supplier, line.l_suppkey == supplier.s_suppkey)
        .select(
            F.col("p_brand").alias(c.SKU),
            (F.col("s_nationkey") * 10).cast("int").alias(c.LOCATION),
            F.col("l_shipdate").cast("date").alias(c.DATE),
            brand_number(F.col("p_brand")).alias("brand_no"),
            F.col("l_quantity").cast("bigint").alias("units"),
            half_up(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
            F.col("l_returnflag").alias("return_flag"),
            F.col("l_linestatus").alias("line_status"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_orderkey").alias("order_key"),
        )
    )


def panel(spark: SparkSession, root: str) -> DataFrame:
    """Daily inventory panel, one row per (SKU, LOCATION, DATE).

    The distinct orders make the lines be grouped by key and order first, where hardly any
    two fall together.  So the lines are dealt out before that, as they are: grouped where
    they are read, a task holds a row of sums for each line of its file split and spills.
    The number of the brand is cut from the SKU afterwards, once a panel row.
    """
    returned = F.col("return_flag") == "R"
    units, line_no = F.col("units"), F.col("line_no")

    def total(amount, when=None):
        value = amount if when is None else F.when(when, amount).otherwise(F.lit(0))
        return F.sum(value).cast("bigint")

    lines = store_lines(spark, root).repartition(*c.KEY, "order_key")
    day = lines.groupBy(*c.KEY).agg(
        F.count_distinct("order_key").alias(c.SALES_COUNT),
        total(units, ~returned).alias(c.GROSS_SALES),
        total(-units, returned).alias(c.RETURN_UNITS),
        total(F.when(returned, -units).otherwise(units)).alias(c.SALES_UNITS),
        total(units, F.col("line_status") == "F").alias("receipts"),
        total(units, (F.col("line_status") == "O") & (line_no <= 2)).alias(c.IN_TRANSIT),
        total(units, line_no == 6).alias(c.POS_ADJ),
        total(-units, line_no == 7).alias(c.NEG_ADJ),
        total(F.when(F.col("return_flag") == "A", -units).otherwise(units), line_no == 5).alias(
            c.DSD_UNITS
        ),
        total(F.col("cents"), ~returned).alias(c.TOTAL_RETAIL),
        total(units).alias("handled"),
    )
    order = Window.partitionBy(*c.PAIR).orderBy(c.DATE)
    history = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    net_in = F.col("receipts") - F.col(c.SALES_UNITS)
    stock = day.select(
        "*",
        (F.lit(20) + F.sum(net_in).over(history)).cast("bigint").alias(c.END_SOH),
        F.coalesce(F.lag(c.IN_TRANSIT, 1).over(order), F.lit(0)).cast("bigint").alias(c.START_INTRANS),
    )
    begin = F.col(c.END_SOH) - net_in
    audited = F.col("handled") % 10 == 0
    code = brand_number(F.col(c.SKU))
    return stock.select(
        *c.KEY,
        location_group(F.col(c.LOCATION)).alias(c.LOCATION_GROUP),
        F.col(c.DATE).alias(c.LOAD_DATE),
        F.concat(F.lit("C"), (code % 5).cast("string")).alias(c.CAT),
        F.concat(F.lit("D"), (code % 3).cast("string")).alias(c.DEPT),
        F.concat(F.lit("L"), (code % 2).cast("string")).alias(c.LOB),
        c.SALES_COUNT, c.SALES_UNITS, c.GROSS_SALES, c.RETURN_UNITS, c.IN_TRANSIT,
        c.POS_ADJ, c.NEG_ADJ,
        (F.col(c.POS_ADJ) + F.col(c.NEG_ADJ)).alias(c.ADJ_UNITS),
        c.DSD_UNITS,
        F.coalesce(
            F.floor(F.try_divide(c.TOTAL_RETAIL, F.when(F.col(c.GROSS_SALES) > 0, F.col(c.GROSS_SALES)))),
            F.lit(0),
        ).cast("bigint").alias(c.UNIT_RETAIL),
        c.TOTAL_RETAIL,
        begin.alias(c.BEGIN_SOH),
        c.END_SOH,
        c.START_INTRANS,
        F.col(c.IN_TRANSIT).alias(c.END_INTRANS),
        (begin + F.col(c.START_INTRANS)).alias(c.START_TOTAL),
        (F.col(c.END_SOH) + F.col(c.IN_TRANSIT)).alias(c.END_TOTAL),
        F.col(c.END_SOH).alias(c.EOP_SOH),
        F.col(c.END_SOH).alias(c.BOOK),
        F.when(audited, 1).otherwise(0).alias(c.AUDIT_FLAG),
        F.when(audited, F.col(c.DATE)).alias(c.AUDIT_DATE),
        F.when(audited, (F.col(c.SALES_COUNT) % 5 - 2).cast("bigint")).alias(c.AUDIT_UNITS),
    )


def location_group(location):
    """Stores are bucketed fifty to a group, halves rounding up."""
    return F.round(location / F.lit(50.0)).cast("int")
