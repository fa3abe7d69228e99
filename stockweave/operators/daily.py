"""Per-row features built from the trailing block, and the carried-state recurrences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockweave import columns as c
from stockweave.functions.exprs import (
    divide,
    fixed_ratio,
    flag,
    floor_zero,
    footfall_bin,
    min_max,
    ratio,
    shrinkage,
)
from stockweave.functions.windows import Trailing, optional, pair_history, trailing
from stockweave.operators.rolling import SHORT_LONG, category_scale


def day_of_week(panel: DataFrame) -> DataFrame:
    """Monday = 0."""
    return panel.withColumn("day_of_week", F.weekday(c.DATE))


def clamp_eop_soh(panel: DataFrame) -> DataFrame:
    return panel.withColumn(c.AUDIT_ADJ_EOP_SOH, floor_zero(F.col(c.END_SOH)).cast("bigint"))


def inventory_turnover(df: DataFrame) -> DataFrame:
    """Turnover, its inverse, and shrinkage over the mean of opening and closing stock.

    The mean is kept as a sum of two integers, doubling the other operand.
    """
    out = {}
    lost = shrinkage(F.col(c.AUDIT_ADJ_UNITS))
    end = floor_zero(F.col(c.END_SOH))
    for n in (7, 14, 28):
        cogs = floor_zero(F.col(f"itr_cogs_{n}"))
        two_means = floor_zero(F.col(f"itr_avg_start_{n}")) + end
        out[f"itr_ratio_{n}"] = ratio(2 * cogs, two_means)
        out[f"inv_sales_ratio_{n}"] = ratio(two_means, 2 * cogs)
        out[f"inv_shrinkage_ratio_{n}"] = ratio(2 * lost, two_means)
    return df.withColumns(out)


def sell_through(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            f"sell_through_rate_{n}": ratio(floor_zero(F.col(f"out_{n}")), F.col(f"in_{n}"))
            for n in (28, 56, 84)
        }
    )


def _short_over_long(df: DataFrame, label: str) -> DataFrame:
    return df.withColumns(
        {
            f"{label}_ratio_{s}_{l}": divide(
                floor_zero(F.col(f"hist_{label}_{s}_{l}")),
                floor_zero(F.col(f"cur_{label}_{s}_{l}")),
                l // s,
            )
            for s, l in SHORT_LONG
        }
    )


def sales_ratio(df: DataFrame) -> DataFrame:
    return _short_over_long(df, "sales")


def stock_ratio(df: DataFrame) -> DataFrame:
    return _short_over_long(df, "stock")


def sale_day_ratio(df: DataFrame) -> DataFrame:
    """Days since the last sale over the usual gap between sale days."""
    idle = F.datediff(c.DATE, "last_sale_day")
    out = {}
    for n in (28, 84):
        usual_gap = ratio(F.lit(n), F.col(f"hist_sale_day_count_{n}"))
        # the gap has two decimals: divide by its whole hundredths
        out[f"sale_day_ratio_{n}"] = fixed_ratio(100 * idle, F.round(usual_gap * 100))
    return df.withColumns(out)


def oos_ratio(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {f"oos_ratio_{n}": fixed_ratio(F.col(f"oos_count_{n}"), F.lit(n)) for n in (28, 84)}
    )


def event_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "transfer_flag": flag(F.col(c.IN_TRANSIT) > 0),
            "sales_flag": flag(F.col(c.GROSS_SALES) > 0),
            "returns_flag": flag(F.col(c.RETURN_UNITS) != 0),
            "neg_cc_flag": flag(F.col(c.NEG_ADJ) != 0),
            "pos_cc_flag": flag(F.col(c.POS_ADJ) != 0),
            "audit_day_flag": flag(F.col(c.AUDIT_FLAG) == 1),
        }
    )


PEER_SCALES = {"price_scale_7": "avg_price_7", "sale_scale_28": "avg_sale_28"}


def index_scale(df: DataFrame) -> DataFrame:
    """Price and sales level among the SKUs of the store's day, 0 to 1.

    The extremes come from an aggregate that combines on the map side and are
    joined back: a store's day is never gathered in one task.  AQE broadcasts
    the extremes when their measured size allows and splits hot keys otherwise.
    """
    level = {s: F.coalesce(F.col(a), F.lit(0)) for s, a in PEER_SCALES.items()}
    extremes = df.groupBy(c.LOCATION, c.DATE).agg(
        *(F.min(x).alias(f"__low_{s}") for s, x in level.items()),
        *(F.max(x).alias(f"__high_{s}") for s, x in level.items()),
    )
    joined = df.join(extremes, [c.LOCATION, c.DATE], "left")
    return joined.withColumns(
        {s: min_max(x, F.col(f"__low_{s}"), F.col(f"__high_{s}")) for s, x in level.items()}
    ).drop(*extremes.columns[2:])


def footfall_by_day(day: DataFrame) -> DataFrame:
    """Running extremes of a store's daily transactions, the scale and its ten bins.

    ``day`` has ``daily_trans`` equal on all rows of a (LOCATION, DATE); the frame
    runs over whole days, so several rows per day are fine.
    """
    so_far = Window.partitionBy(c.LOCATION).orderBy(c.DATE)
    trans = F.col("daily_trans")
    low, high = (F.first(optional(day, n)).over(so_far) for n in c.FOOTFALL_STATE)
    # least / greatest skip a missing carried value
    bounds = day.withColumns(
        {
            "footfall_min": F.least(F.min(trans).over(so_far), low),
            "footfall_max": F.greatest(F.max(trans).over(so_far), high),
        }
    )
    scaled = bounds.withColumn(
        "footfall_scale", min_max(trans, F.col("footfall_min"), F.col("footfall_max"))
    )
    return scaled.withColumn("footfall_index", footfall_bin(F.col("footfall_scale")))


def footfall(panel: DataFrame) -> DataFrame:
    """Store traffic per day, attached to each row of the day."""
    carried = [n for n in c.FOOTFALL_STATE if n in panel.columns]
    day = panel.groupBy(c.LOCATION, c.DATE).agg(
        F.sum(c.SALES_COUNT).alias("daily_trans"), *(F.max(n).alias(n) for n in carried)
    )
    out = footfall_by_day(day).drop(*carried)
    return panel.join(out, [c.LOCATION, c.DATE], "left")


def store_context(df: DataFrame, scale: Callable[[DataFrame], DataFrame] = category_scale) -> DataFrame:
    """Everything a row needs from the rest of its store, per (LOCATION, DATE, CAT).

    One aggregate over the panel feeds category shrinkage, price and sales
    extremes and footfall; the windows after it see one row per category and day.
    ``scale`` adds the category's seven-row shrinkage and its scale.
    """
    level = {s: F.coalesce(F.col(a), F.lit(0)) for s, a in PEER_SCALES.items()}
    carried = [n for n in c.FOOTFALL_STATE if n in df.columns]
    cell = df.groupBy(c.LOCATION, c.DATE, c.CAT).agg(
        F.sum(shrinkage(F.col(c.AUDIT_ADJ_UNITS))).alias("shrinkage_qty_day_sum"),
        F.sum(c.SALES_COUNT).alias("__trans"),
        *(F.min(x).alias(f"__low_{s}") for s, x in level.items()),
        *(F.max(x).alias(f"__high_{s}") for s, x in level.items()),
        *(F.max(n).alias(n) for n in carried),
    )
    peers = Window.partitionBy(c.LOCATION, c.DATE)
    day = scale(cell).withColumns(
        {"daily_trans": F.sum("__trans").over(peers)}
        | {f"__low_{s}": F.min(f"__low_{s}").over(peers) for s in PEER_SCALES}
        | {f"__high_{s}": F.max(f"__high_{s}").over(peers) for s in PEER_SCALES}
        | {n: F.max(n).over(peers) for n in carried}
    )
    return footfall_by_day(day).drop("__trans", *carried)


def attach_store_context(df: DataFrame, context: DataFrame) -> DataFrame:
    """Join the store context and derive the scales that depend on it."""
    renamed = context.select(
        *(F.col(n).alias(f"__{n}") for n in (c.LOCATION, c.DATE, c.CAT)),
        "footfall_min", "footfall_max", "daily_trans", "footfall_scale", "footfall_index",
        "categorical_shrinkage_scale_7",
        *(f"__{side}_{s}" for side in ("low", "high") for s in PEER_SCALES),
    )
    joined = df.join(
        renamed,
        (df[c.LOCATION] == renamed[f"__{c.LOCATION}"])
        & (df[c.DATE] == renamed[f"__{c.DATE}"])
        & df[c.CAT].eqNullSafe(renamed[f"__{c.CAT}"]),
        "left",
    )
    scales = {
        s: min_max(F.coalesce(F.col(a), F.lit(0)), F.col(f"__low_{s}"), F.col(f"__high_{s}"))
        for s, a in PEER_SCALES.items()
    }
    # rows without a category take part in no category scale
    scale_7 = F.when(F.col(c.CAT).isNotNull(), F.col("categorical_shrinkage_scale_7"))
    scales["categorical_shrinkage_scale_7"] = F.coalesce(scale_7, F.lit(0.0))
    return joined.withColumns(scales).drop(*(n for n in renamed.columns if n.startswith("__")))


def shelf_life(panel: DataFrame) -> DataFrame:
    """Stock age scale from cumulative stock, outflow and received batches.

    Carried values enter at the first row of the slice; without state they are
    neutral.  Every recurrence is a running aggregate, so the state columns of a
    row are all that the next slice needs.
    """
    history = pair_history()
    carried = {n: F.first(optional(panel, n)).over(history) for n in c.SHELF_STATE}
    zero = F.lit(0).cast("bigint")

    def seeded(running, state):
        return F.coalesce(running, zero) + F.coalesce(carried[state], zero)

    fell = F.col(c.END_INTRANS) < F.col(c.START_INTRANS)
    batch = F.when(fell, F.col(c.START_INTRANS) - F.col(c.END_INTRANS))
    out_today = F.col(c.SALES_UNITS) + F.col(c.RETURN_UNITS) - F.col(c.AUDIT_ADJ_UNITS)
    step = panel.withColumns(
        {
            "CUMULATIVE_SOH": seeded(F.sum(c.BEGIN_SOH).over(history), c.SHELF_STATE[0]),
            "CUMULATIVE_DAILY_OUT": seeded(F.sum(out_today).over(history), c.SHELF_STATE[1]),
            "CUMULATIVE_BATCH_QTY": seeded(F.sum(batch).over(history), c.SHELF_STATE[3]),
            "__carry_seed": F.coalesce(carried[c.SHELF_STATE[2]], zero),
            "__low_seed": carried[c.SHELF_STATE[4]],
            "__high_seed": carried[c.SHELF_STATE[5]],
        }
    )
    at_batch = F.when(fell, F.col("CUMULATIVE_SOH"))
    step = step.withColumn(
        "CARRY_FORWARD_CUMULATIVE_SOH",
        F.coalesce(F.last(at_batch, ignorenulls=True).over(history), F.col("__carry_seed")),
    )
    sold_out = F.col("CUMULATIVE_DAILY_OUT") >= F.col("CUMULATIVE_BATCH_QTY")
    carry = F.when(sold_out, zero).otherwise(F.col("CARRY_FORWARD_CUMULATIVE_SOH"))
    step = step.withColumn("REV_CUMULATIVE_SOH", F.col("CUMULATIVE_SOH") - carry)
    rev = F.col("REV_CUMULATIVE_SOH")
    step = step.withColumns(
        {
            "REV_CUMULATIVE_SOH_MIN": F.least(F.min(rev).over(history), F.col("__low_seed")),
            "REV_CUMULATIVE_SOH_MAX": F.greatest(F.max(rev).over(history), F.col("__high_seed")),
        }
    )
    scale = min_max(rev, F.col("REV_CUMULATIVE_SOH_MIN"), F.col("REV_CUMULATIVE_SOH_MAX"))
    return step.withColumn("REV_CUMULATIVE_SOH_SCALE", scale).drop(
        "REV_CUMULATIVE_SOH", "__carry_seed", "__low_seed", "__high_seed"
    )


DECAYS = ("sale", "transfer")
DECAY_ROWS = 84


def decay(state: DataFrame, rows: int = DECAY_ROWS) -> DataFrame:
    """Mean over ``rows`` rows of the previous decay value seen at the same day count.

    0 until the frame holds that many values.  Decay values carry two decimals and are
    summed as whole hundredths.
    """
    previous = state.withColumns(
        {
            f"__{d}_prev": F.lag(F.round(F.col(f"meta_{d}_decay_decimal") * 100).cast("bigint"), 1).over(
                Window.partitionBy(*c.PAIR, f"meta_{d}_cur_day_count").orderBy(c.DATE)
            )
            for d in DECAYS
        }
    )
    wanted = {}
    for d in DECAYS:
        wanted[f"__{d}_sum"] = Trailing(d, rows)
        wanted[f"__{d}_n"] = Trailing(d, rows, "count")
    summed = trailing(previous, {d: F.col(f"__{d}_prev") for d in DECAYS}, wanted)
    return summed.withColumns(
        {
            f"{d}_decay_decimal": F.when(F.col(f"__{d}_n") < rows, F.lit(0.0)).otherwise(
                fixed_ratio(F.col(f"__{d}_sum"), F.lit(100 * rows))
            )
            for d in DECAYS
        }
    ).drop(*wanted, *(f"__{d}_prev" for d in DECAYS))


def level_ratios(df: DataFrame) -> DataFrame:
    """Ratios between trailing levels; nothing later needs the levels themselves."""
    return stock_ratio(sales_ratio(sell_through(inventory_turnover(df))))


def day_features(df: DataFrame) -> DataFrame:
    """The remaining row-wise features.

    Kept apart from ``level_ratios``: one projection of all of them compiles to a
    method above 8000 bytes of bytecode, which the JVM then only interprets.
    """
    return event_flags(oos_ratio(sale_day_ratio(clamp_eop_soh(day_of_week(df)))))
