"""Feature store plans: the whole history in one pass, or one day on carried state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave import columns as c
from stockweave.operators.daily import (
    DECAY_ROWS,
    DECAYS,
    PEER_SCALES,
    attach_store_context,
    day_features,
    decay,
    footfall_by_day,
    level_ratios,
    shelf_life,
    store_context,
)
from stockweave.operators.rolling import (
    EOP_MEANS,
    IN_OUT,
    SALES_SUMS,
    SALES_WINDOWS,
    STOCK_WINDOWS,
    daily_filter,
    ledger_balance,
    rolling_filter,
    trailing_block,
)
from stockweave.operators.rings import DayState, day_context, state_after, state_of, step
from stockweave.operators.state import decay_state, state_before
from stockweave.sources.shared import written

OUTPUT = c.KEY + c.FEATURES
FROM_STORE = ["price_scale_7", "sale_scale_28", "categorical_shrinkage_scale_7",
              "footfall_scale", "footfall_index"]
KEPT = [n for n in c.FEATURES if n not in FROM_STORE]
# trailing columns only the level ratios read
USED_UP = [*SALES_SUMS, *IN_OUT, *SALES_WINDOWS, *STOCK_WINDOWS, *EOP_MEANS] + [
    f"itr_avg_start_{n}" for n in (7, 14, 28)
]
# columns of the audited panel the features read
INPUT = c.KEY + [
    c.LOAD_DATE, c.CAT, c.DEPT, c.LOB, c.SALES_COUNT, c.SALES_UNITS, c.GROSS_SALES,
    c.RETURN_UNITS, c.IN_TRANSIT, c.POS_ADJ, c.NEG_ADJ, c.UNIT_RETAIL, c.BEGIN_SOH, c.END_SOH,
    c.START_INTRANS, c.END_INTRANS, c.EOP_SOH, c.BOOK, c.AUDIT_FLAG, c.AUDIT_ADJ_UNITS,
    c.ONHAND_RECORDED,
]


def historical_features(audited: DataFrame) -> DataFrame:
    """Features of every row, the panel taken as one slice without prior state.

    Everything per (SKU, LOCATION) hangs off a single exchange; the only other
    wide step is the join of the store context, whose aggregate reads five
    columns of the panel.
    """
    decayed = with_decay(audited.select(*INPUT))
    rolled = trailing_block(decayed)
    context = store_context(rolled)
    # Ratios right after the trailing sums, so that the sums do not travel on.
    ratios = level_ratios(rolled).drop(*USED_UP)
    features = day_features(ledger_balance(shelf_life(ratios)))
    features = features.select(*c.KEY, *KEPT, *PEER_SCALES.values())
    return attach_store_context(features, context).select(*OUTPUT)


def with_decay(panel: DataFrame) -> DataFrame:
    """Decay features of a panel that starts without state.

    They need two more orders of the pair's rows, so they come first, while the
    rows are still narrow; their working columns do not travel on.
    """
    helpers = [f"meta_{d}_{part}" for d in DECAYS for part in ("cur_day_count", "decay_decimal")]
    return decay(decay_state(panel)).drop(*helpers)


def incremental_features(audited: DataFrame, state: DataFrame, as_of: str) -> DataFrame:
    """Features of the rows loaded on ``as_of``.

    ``state`` is the state table up to and including ``as_of``.  The rolling slice
    is seeded with the ledger balance as of its start, the daily slice with the
    recurrences as of the day before.
    """
    start = F.date_sub(F.to_date(F.lit(as_of)), 100)
    today = F.to_date(F.lit(as_of))

    ledger = state_before(state, [c.LEDGER_STATE], start)
    recent = rolling_filter(audited, as_of).join(ledger, c.PAIR, "left")
    rolled = ledger_balance(trailing_block(recent)).drop(c.LEDGER_STATE)

    rows = daily_filter(rolled, as_of)
    store = state_before(state, c.FOOTFALL_STATE, today, [c.LOCATION])
    recurrences = state_before(state, c.SHELF_STATE, today)
    seeded = rows.join(recurrences, c.PAIR, "left").join(store, [c.LOCATION], "left")

    # category shrinkage looks back seven rows, so its cells come from the slice
    context = store_context(rolled).where(F.col(c.DATE) == today)
    traffic = context.select(c.LOCATION, c.DATE, c.CAT, "daily_trans").join(
        store, [c.LOCATION], "left"
    )
    context = context.drop(
        "daily_trans", "footfall_min", "footfall_max", "footfall_scale", "footfall_index"
    ).join(
        footfall_by_day(traffic).drop(*c.FOOTFALL_STATE), [c.LOCATION, c.DATE, c.CAT]
    )
    decayed = decay(
        state.select(
            *c.KEY,
            *(f"meta_{d}_{part}" for d in DECAYS for part in ("cur_day_count", "decay_decimal")),
        )
    ).where(F.col(c.DATE) == today).select(*c.KEY, "sale_decay_decimal", "transfer_decay_decimal")

    features = day_features(level_ratios(shelf_life(seeded))).drop(*c.DAILY_STATE)
    joined = features.join(decayed, c.KEY, "left")
    return attach_store_context(joined, context).select(*OUTPUT)


# ---- one day at a time, on a state table partitioned by day -----------------

STATE_TABLES = ("pairs", "stores", "categories")


def save_state(state: DayState, path: str, day: str) -> None:
    """Write the state as the partition LOAD_DATE=day of its three tables.  A day that is run
    again replaces its own partition; no other partition is touched."""
    for name in STATE_TABLES:
        rows = getattr(state, name).withColumn(c.LOAD_DATE, F.to_date(F.lit(day)))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(c.LOAD_DATE).parquet(f"{path}/{name}")


def load_state(spark: SparkSession, path: str, day: str) -> DayState:
    """The state of one day: one partition of each table."""
    on_day = F.col(c.LOAD_DATE) == F.to_date(F.lit(day))
    return DayState(*(spark.read.parquet(f"{path}/{name}").where(on_day).drop(c.LOAD_DATE) for name in STATE_TABLES))


def start_state(history: DataFrame, path: str, day: str, decay_rows: int = DECAY_ROWS) -> None:
    """State after a panel slice that ends on ``day``: the only step that reads history."""
    save_state(state_of(history, decay_rows), path, day)


def features_of_day(rows: DataFrame, path: str, before: str, day: str, decay_rows: int = DECAY_ROWS) -> DataFrame:
    """Features of the audited rows of ``day``; reads them and the state partition of
    ``before``, and writes that of ``day``.  Equal to ``historical_features`` over all rows
    up to the day."""
    state = load_state(rows.sparkSession, path, before)
    today = rows.where(F.col(c.LOAD_DATE) == F.to_date(F.lit(day))).select(*INPUT)
    stepped = written(step(state.pairs, today, decay_rows), "stepped")
    context = written(day_context(stepped, state), "context")
    save_state(state_after(state, stepped, context), path, day)
    held = [n for n in stepped.columns if n.startswith("__")]
    features = day_features(level_ratios(stepped.drop(*held)).drop(*USED_UP))
    features = features.select(*c.KEY, *KEPT, *PEER_SCALES.values())
    return attach_store_context(features, context).select(*OUTPUT)
