"""Trailing features over the rows of each (SKU, LOCATION).

Frames count rows, not calendar days: a missing day stretches the frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave import columns as c
from stockweave.functions.exprs import flag, min_max, ratio_neg, shrinkage
from stockweave.functions.windows import Trailing, optional, pair_history, pair_order, trailing

HISTORY_DAYS = 100

SALES_SUMS = {f"itr_cogs_{n}": Trailing("sales", n) for n in (7, 14, 28)}
IN_OUT = {f"in_{n}": Trailing("onhand", n) for n in (28, 56, 84)} | {
    f"out_{n}": Trailing("sales", n) for n in (28, 56, 84)
}
SHORT_LONG = ((7, 28), (28, 84))


def _short_long(measure: str, label: str) -> dict[str, Trailing]:
    pairs = {}
    for short, long in SHORT_LONG:
        pairs[f"cur_{label}_{short}_{long}"] = Trailing(measure, short)
        pairs[f"hist_{label}_{short}_{long}"] = Trailing(measure, long)
    return pairs


SALES_WINDOWS = _short_long("sales", "sales")
STOCK_WINDOWS = _short_long("stock", "stock")
OOS_COUNTS = {f"oos_count_{n}": Trailing("out_of_stock", n) for n in (28, 84)}
SALE_DAY_COUNTS = {f"hist_sale_day_count_{n}": Trailing("sale_day", n, "count") for n in (28, 84)}
SALE_28 = {"avg_sale_28": Trailing("sales", 28)}  # a sum, whatever the name says
PRICE_7 = {"avg_price_7": Trailing("price", 7, "mean")}
EOP_MEANS = {f"AVG_IP_QTY_EOP_SOH_{n}": Trailing("eop", n, "mean") for n in (7, 14, 28)}

ALL_TRAILING = (
    SALES_SUMS | IN_OUT | SALES_WINDOWS | STOCK_WINDOWS | OOS_COUNTS
    | SALE_DAY_COUNTS | SALE_28 | PRICE_7 | EOP_MEANS
)


def measures() -> dict[str, Column]:
    return {
        "sales": F.col(c.SALES_UNITS),
        "stock": F.col(c.END_SOH),
        "onhand": F.col(c.ONHAND_RECORDED),
        "eop": F.col(c.EOP_SOH),
        "out_of_stock": flag(F.col(c.END_SOH) <= 0),
        "sale_day": F.when(F.col(c.GROSS_SALES) > 0, F.lit(1)),
        "price": F.when(F.col(c.UNIT_RETAIL) != 0, F.col(c.UNIT_RETAIL)),
    }


def rolling_filter(panel: DataFrame, as_of: str, days: int = HISTORY_DAYS) -> DataFrame:
    """Rows the trailing features of ``as_of`` may look at; pushed to the scan."""
    return panel.where(F.col(c.DATE) >= F.date_sub(F.to_date(F.lit(as_of)), days))


def daily_filter(panel: DataFrame, as_of: str) -> DataFrame:
    """Rows loaded on ``as_of``."""
    return panel.where(F.col(c.LOAD_DATE) == F.to_date(F.lit(as_of)))


def trailing_features(panel: DataFrame, wanted: dict[str, Trailing] | None = None) -> DataFrame:
    return trailing(panel, measures(), ALL_TRAILING if wanted is None else wanted)


def opening_stock(panel: DataFrame) -> DataFrame:
    """Closing stock 7, 14 and 28 rows earlier."""
    order = pair_order()
    return panel.withColumns(
        {f"itr_avg_start_{n}": F.lag(c.END_SOH, n).over(order) for n in (7, 14, 28)}
    )


def last_sale_day(panel: DataFrame) -> DataFrame:
    """Latest day with gross sales up to the row, else the first day of the pair."""
    history = pair_history()
    sold_on = F.when(F.col(c.GROSS_SALES) > 0, F.col(c.DATE))
    return panel.withColumn(
        "last_sale_day",
        F.coalesce(F.last(sold_on, ignorenulls=True).over(history), F.first(c.DATE).over(history)),
    )


def shrinkage_qty(panel: DataFrame) -> DataFrame:
    return panel.withColumn("shrinkage_qty", shrinkage(F.col(c.AUDIT_ADJ_UNITS)))


def ledger_balance(panel: DataFrame) -> DataFrame:
    """Running receipts minus outflow, and its trailing mean against the stock's.

    Both means have the same row count, so their ratio is the ratio of the sums:
    integers, hence exact.  A carried balance lifts the whole run of the slice.
    """
    history = pair_history()
    net = F.col(c.ONHAND_RECORDED) - (F.col(c.SALES_UNITS) - F.col(c.AUDIT_ADJ_UNITS))
    seed = F.coalesce(F.first(optional(panel, c.LEDGER_STATE)).over(history), F.lit(0))
    run = panel.withColumn("cumulative_daily_ledger_diff", F.sum(net).over(history) + seed)
    sums = {}
    for n in (7, 14, 28):
        sums[f"__ledger_{n}"] = Trailing("ledger", n)
        sums[f"__eop_{n}"] = Trailing("eop", n)
    sources = {"ledger": F.col("cumulative_daily_ledger_diff"), "eop": F.col(c.EOP_SOH)}
    summed = trailing(run, sources, sums)
    return summed.withColumns(
        {
            f"LEDGER_BAL_RATIO_{n}": ratio_neg(F.col(f"__ledger_{n}"), F.col(f"__eop_{n}"))
            for n in (7, 14, 28)
        }
    ).drop(*sums)


def categorical_shrinkage(panel: DataFrame) -> DataFrame:
    """Seven-row shrinkage of a category, scaled over the categories of the store's day.

    Summed to (LOCATION, DATE, CAT) before any window, so the windows see one
    row per category and day whatever the number of SKUs.
    """
    day = panel.groupBy(c.LOCATION, c.DATE, c.CAT).agg(
        F.sum(shrinkage(F.col(c.AUDIT_ADJ_UNITS))).alias("shrinkage_qty_day_sum")
    )
    scaled = category_scale(day)
    return panel.join(scaled, [c.LOCATION, c.DATE, c.CAT], "left").withColumn(
        "categorical_shrinkage_scale_7",
        F.coalesce(F.col("categorical_shrinkage_scale_7"), F.lit(0.0)),
    )


def category_scale(day: DataFrame) -> DataFrame:
    week = Window.partitionBy(c.LOCATION, c.CAT).orderBy(c.DATE).rowsBetween(-6, 0)
    peers = Window.partitionBy(c.LOCATION, c.DATE)
    qty = F.col("categorical_shrinkage_qty_7")
    return day.withColumn(
        "categorical_shrinkage_qty_7", F.sum("shrinkage_qty_day_sum").over(week)
    ).withColumn(
        "categorical_shrinkage_scale_7",
        min_max(qty, F.min(qty).over(peers), F.max(qty).over(peers)),
    )


def trailing_block(panel: DataFrame) -> DataFrame:
    """Trailing aggregates, opening stock and last sale day of each row."""
    return trailing_features(opening_stock(last_sale_day(panel)))

