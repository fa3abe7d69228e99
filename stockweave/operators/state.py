"""Carried state: what one day's run leaves for the next.

The table that held it has no surviving producer, so the producer is ours: the
value of each recurrence after the row, one row per panel key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave import columns as c
from stockweave.functions.windows import pair_history, pair_order
from stockweave.operators.daily import DECAYS, footfall_by_day, shelf_life
from stockweave.operators.rolling import ledger_balance


def decay_state(panel: DataFrame) -> DataFrame:
    """Days since the last sale (or transfer) and that day's units spread over them,
    in two decimals (our definition)."""
    history = pair_history()
    source = {"sale": c.GROSS_SALES, "transfer": c.IN_TRANSIT}
    out = {}
    for d in DECAYS:
        happened = F.col(source[d]) > 0
        since = F.coalesce(
            F.last(F.when(happened, F.col(c.DATE)), ignorenulls=True).over(history),
            F.first(c.DATE).over(history),
        )
        units = F.coalesce(
            F.last(F.when(happened, F.col(source[d])), ignorenulls=True).over(history), F.lit(0)
        )
        days = F.datediff(c.DATE, since)
        out[f"meta_{d}_cur_day_count"] = days
        out[f"meta_{d}_last_units"] = units
        out[f"meta_{d}_decay_decimal"] = F.floor(F.lit(100.0) * units / (days + 1)) / F.lit(100.0)
    return panel.withColumns(out)


def pair_state(panel: DataFrame) -> DataFrame:
    """State columns that depend on the pair's own rows only."""
    full = decay_state(ledger_balance(shelf_life(panel)))
    return full.withColumns(
        {n: F.col(n.removeprefix("meta_")).cast("double") for n in c.SHELF_STATE}
        | {c.LEDGER_STATE: F.col("cumulative_daily_ledger_diff").cast("double")}
    )


STATE_COLUMNS = (
    c.DAILY_STATE
    + [c.LEDGER_STATE]
    + [f"meta_{d}_{part}" for d in DECAYS for part in ("cur_day_count", "decay_decimal")]
)


#: What a step by one day needs besides the state columns.
UNITS = [f"meta_{d}_last_units" for d in DECAYS]


def carry_state(panel: DataFrame, store_day: DataFrame, extra: list[str] = ()) -> DataFrame:
    """State table of a panel slice; ``store_day`` is the footfall per (LOCATION, DATE).
    With ``extra=UNITS`` it can be advanced day by day."""
    bounds = store_day.select(
        c.LOCATION, c.DATE,
        F.col("footfall_min").cast("double").alias(c.FOOTFALL_STATE[0]),
        F.col("footfall_max").cast("double").alias(c.FOOTFALL_STATE[1]),
    )
    return pair_state(panel).join(bounds, [c.LOCATION, c.DATE], "left").select(
        *c.KEY, *STATE_COLUMNS, *extra
    )


def advance_state(before: DataFrame, day: DataFrame) -> DataFrame:
    """State after a day, from the state before it (one row per pair, with UNITS) and the
    day's audited rows; no history is read.

    Every pair has a row: those without one that day keep theirs.  So the state of a day,
    stored as one partition, is all that the next day reads.
    """
    kept = before.select(*c.KEY, *STATE_COLUMNS, *UNITS)
    old = {f"meta_{d}_{part}": f"__{d}_{part}" for d in DECAYS for part in ("cur_day_count", "last_units")}
    pairs = kept.select(
        *c.PAIR, F.col(c.DATE).alias("__before"), *c.SHELF_STATE, c.LEDGER_STATE, *(F.col(n).alias(a) for n, a in old.items())
    )
    # a store's bounds are those of its latest day
    latest = F.max(F.struct(c.DATE, *c.FOOTFALL_STATE)).alias("latest")
    stores = kept.groupBy(c.LOCATION).agg(latest).select(c.LOCATION, *(F.col(f"latest.{n}").alias(n) for n in c.FOOTFALL_STATE))
    traffic = day.groupBy(c.LOCATION, c.DATE).agg(F.sum(c.SALES_COUNT).alias("daily_trans")).join(stores, c.LOCATION, "left")
    bounds = footfall_by_day(traffic).select(
        c.LOCATION, c.DATE,
        F.col("footfall_min").cast("double").alias(c.FOOTFALL_STATE[0]),
        F.col("footfall_max").cast("double").alias(c.FOOTFALL_STATE[1]),
    )
    rows = ledger_balance(shelf_life(day.join(pairs, c.PAIR, "left"))).drop(*c.SHELF_STATE, c.LEDGER_STATE)
    made = {n: F.col(n.removeprefix("meta_")).cast("double") for n in c.SHELF_STATE}
    made[c.LEDGER_STATE] = F.col("cumulative_daily_ledger_diff").cast("double")
    source = {"sale": c.GROSS_SALES, "transfer": c.IN_TRANSIT}
    for d in DECAYS:
        happened = F.col(source[d]) > 0
        passed = F.col(f"__{d}_cur_day_count") + F.datediff(c.DATE, "__before")
        days = F.when(happened, 0).otherwise(F.coalesce(passed, F.lit(0)))
        units = F.when(happened, F.col(source[d])).otherwise(F.coalesce(f"__{d}_last_units", F.lit(0)))
        made[f"meta_{d}_cur_day_count"] = days
        made[f"meta_{d}_last_units"] = units
        made[f"meta_{d}_decay_decimal"] = F.floor(F.lit(100.0) * units / (days + 1)) / F.lit(100.0)
    fresh = rows.withColumns(made).join(bounds, [c.LOCATION, c.DATE], "left")
    idle = kept.join(day.select(*c.PAIR), c.PAIR, "left_anti")
    return fresh.select(*kept.columns).unionByName(idle)


def state_lag(state: DataFrame) -> DataFrame:
    """Each row with the daily state and ledger balance of the pair's previous row."""
    order = pair_order()
    return state.select(
        *c.KEY, *(F.lag(n, 1).over(order).alias(n) for n in c.DAILY_STATE + [c.LEDGER_STATE])
    )


def state_before(state: DataFrame, columns: list[str], day, keys: list[str] = c.PAIR) -> DataFrame:
    """Latest state of each pair (or store) strictly before ``day``.

    Equal to the lagged row at the first row of a slice starting at ``day``, but
    one row per pair, found by an aggregate that combines on the map side.
    """
    latest = F.max(F.struct(c.DATE, *columns)).alias("latest")
    return (
        state.where(F.col(c.DATE) < day)
        .groupBy(*keys)
        .agg(latest)
        .select(*keys, *(F.col(f"latest.{n}").alias(n) for n in columns))
    )
