"""State of a day from which the next day's features follow without reading history.

A pair (SKU, LOCATION) keeps a ring of its last 84 rows' measures and, for each trailing
frame, the sum and the number of values in it.  A new row adds itself to a total and takes
away the one that leaves the frame, found in the ring: a frame costs the same whatever its
length.  Stores keep their traffic bounds, categories their last six daily sums.

A ring has at most 84 entries; the decay values met so far are kept by day count, of which a
pair has no more than days.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave import columns as c
from stockweave.functions.exprs import fixed_ratio, min_max, ratio_neg, shrinkage
from stockweave.functions.windows import Trailing
from stockweave.operators.daily import DECAY_ROWS, DECAYS, shelf_life, store_context
from stockweave.operators.rolling import ALL_TRAILING, ledger_balance, measures
from stockweave.operators.state import decay_state

RING_ROWS = 84
WEEK_BEFORE = 6
LEDGER_FRAMES = (7, 14, 28)
SOURCE = {"sale": c.GROSS_SALES, "transfer": c.IN_TRANSIT}
IN_RING = [
    "sales", "stock", "onhand", "eop", "out_of_stock", "sale_day", "price", "ledger", *(f"{d}_decay" for d in DECAYS)
]
PAIR_STATE = (
    ["first_day", "last_day", "last_sale", "ledger", "ring", "totals"]
    + c.SHELF_STATE
    + [f"{d}_{part}" for d in DECAYS for part in ("days", "units", "seen")]
)


@dataclass(frozen=True)
class DayState:
    """``pairs`` has PAIR and PAIR_STATE, ``stores`` LOCATION and the traffic bounds,
    ``categories`` LOCATION, CAT and the ring ``week`` of daily shrinkage."""

    pairs: DataFrame
    stores: DataFrame
    categories: DataFrame


def frames(decay_rows: int) -> list[tuple[str, int]]:
    wanted = {(t.measure, t.rows) for t in ALL_TRAILING.values()}
    wanted |= {(m, n) for m in ("ledger", "eop") for n in LEDGER_FRAMES}
    return sorted(wanted | {(f"{d}_decay", decay_rows) for d in DECAYS})


def _newest(ring: Column, n: int) -> Column:
    return F.when(F.size(ring) <= n, ring).otherwise(F.slice(ring, -n, n))


def _entry(extra: dict[str, Column]) -> Column:
    values = measures() | extra
    return F.struct(*(values[n].cast("bigint").alias(n) for n in IN_RING))


def _hundredths(d: str) -> Column:
    return F.round(F.col(f"meta_{d}_decay_decimal") * 100).cast("bigint")


# ---- from history ----------------------------------------------------------


def state_of(history: DataFrame, decay_rows: int = DECAY_ROWS) -> DayState:
    """State after the last row of a panel slice that starts without state."""
    rows = decay_state(ledger_balance(shelf_life(history)))
    same_count = lambda d: Window.partitionBy(*c.PAIR, f"meta_{d}_cur_day_count").orderBy(c.DATE)
    rows = rows.withColumns({f"__{d}_prev": F.lag(_hundredths(d), 1).over(same_count(d)) for d in DECAYS})
    newest = Window.partitionBy(*c.PAIR).orderBy(F.col(c.DATE).desc())
    entry = _entry({"ledger": F.col("cumulative_daily_ledger_diff")} | {f"{d}_decay": F.col(f"__{d}_prev") for d in DECAYS})
    ranked = rows.withColumn("__age", F.row_number().over(newest)).withColumn("__entry", entry)
    last = {n: F.col(n.removeprefix("meta_")) for n in c.SHELF_STATE} | {"ledger": F.col("cumulative_daily_ledger_diff")}
    last |= {f"{d}_days": F.col(f"meta_{d}_cur_day_count") for d in DECAYS}
    last |= {f"{d}_units": F.col(f"meta_{d}_last_units") for d in DECAYS}
    pairs = ranked.groupBy(*c.PAIR).agg(
        F.min(c.DATE).alias("first_day"),
        F.max(c.DATE).alias("last_day"),
        F.max(F.when(F.col(c.GROSS_SALES) > 0, F.col(c.DATE))).alias("last_sale"),
        F.max_by(F.struct(*(x.alias(n) for n, x in last.items())), c.DATE).alias("__last"),
        # 84 entries a pair at most
        F.array_sort(F.collect_list(F.when(F.col("__age") <= RING_ROWS, F.struct(c.DATE, "__entry")))).alias("__ring"),
    )
    pairs = pairs.withColumn("ring", F.transform("__ring", lambda x: x["__entry"]))
    totals = []
    for m, n in frames(decay_rows):
        part = _newest(F.col("ring"), n)
        values = F.filter(F.transform(part, lambda x: x[m]), lambda x: x.isNotNull())  # noqa: B023
        totals += [
            F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x).alias(f"s_{m}_{n}"),
            F.size(values).cast("bigint").alias(f"n_{m}_{n}"),
        ]
    pairs = pairs.select(*c.PAIR, "first_day", "last_day", "last_sale", "__last.*", "ring", F.struct(*totals).alias("totals"))
    for d in DECAYS:
        latest = rows.groupBy(*c.PAIR, F.col(f"meta_{d}_cur_day_count").alias("__days")).agg(
            F.max_by(_hundredths(d), c.DATE).alias("__value")
        )
        seen = F.map_from_entries(F.collect_list(F.struct(F.col("__days").cast("int"), "__value"))).alias(f"{d}_seen")
        pairs = pairs.join(latest.groupBy(*c.PAIR).agg(seen), c.PAIR)

    day = history.groupBy(c.LOCATION, c.DATE).agg(F.sum(c.SALES_COUNT).alias("__trans"))
    stores = day.groupBy(c.LOCATION).agg(
        F.min("__trans").alias(c.FOOTFALL_STATE[0]), F.max("__trans").alias(c.FOOTFALL_STATE[1])
    )
    cells = history.groupBy(c.LOCATION, c.CAT, c.DATE).agg(F.sum(shrinkage(F.col(c.AUDIT_ADJ_UNITS))).alias("__qty"))
    age = F.row_number().over(Window.partitionBy(c.LOCATION, c.CAT).orderBy(F.col(c.DATE).desc()))
    recent = cells.withColumn("__age", age).where(F.col("__age") <= WEEK_BEFORE)
    week = F.transform(F.array_sort(F.collect_list(F.struct(c.DATE, "__qty"))), lambda x: x["__qty"])
    categories = recent.groupBy(c.LOCATION, c.CAT).agg(week.alias("week"))
    return DayState(pairs.select(*c.PAIR, *PAIR_STATE), stores, categories)


# ---- one day on ------------------------------------------------------------


def step(before: DataFrame, day: DataFrame, decay_rows: int = DECAY_ROWS) -> DataFrame:
    """The day's rows with all trailing features and recurrences, and the pair's new state
    under ``__<name>``.  ``day`` has one row a pair; ``before`` may lack it."""
    old = {n: n if n in c.SHELF_STATE else f"__old_{n}" for n in PAIR_STATE}
    held = before.select(*c.PAIR, *(F.col(n).alias(a) for n, a in old.items()))
    # shelf life reads its carried values by their names
    rows = shelf_life(day.join(held, c.PAIR, "left")).drop(*c.SHELF_STATE)
    ring = F.col("__old_ring")
    sold = F.col(c.GROSS_SALES) > 0
    net = F.col(c.ONHAND_RECORDED) - (F.col(c.SALES_UNITS) - F.col(c.AUDIT_ADJ_UNITS))
    made: dict[str, Column] = {
        "__first_day": F.coalesce("__old_first_day", F.col(c.DATE)),
        "__last_day": F.col(c.DATE),
        "__last_sale": F.when(sold, F.col(c.DATE)).otherwise(F.col("__old_last_sale")),
        "__ledger": F.coalesce("__old_ledger", F.lit(0)) + F.coalesce(net, F.lit(0)),
    }
    for d in DECAYS:
        happened = F.col(SOURCE[d]) > 0
        passed = F.col(f"__old_{d}_days") + F.datediff(c.DATE, "__old_last_day")
        made[f"__{d}_days"] = F.when(happened, 0).otherwise(F.coalesce(passed, F.lit(0)))
        made[f"__{d}_units"] = F.when(happened, F.col(SOURCE[d])).otherwise(F.coalesce(f"__old_{d}_units", F.lit(0)))
    rows = rows.withColumns(made)
    made = {}
    for d in DECAYS:
        days, units = F.col(f"__{d}_days"), F.col(f"__{d}_units")
        value = F.round(F.floor(F.lit(100.0) * units / (days + 1)) / F.lit(100.0) * 100).cast("bigint")
        seen = F.coalesce(F.col(f"__old_{d}_seen"), F.expr("cast(map() as map<int, bigint>)"))
        made[f"__{d}_prev"] = F.try_element_at(seen, days)
        others = F.map_filter(seen, lambda k, _: k != days)  # noqa: B023
        made[f"__{d}_seen"] = F.map_concat(others, F.create_map(days, value))
    made["last_sale_day"] = F.coalesce("__last_sale", "__first_day")
    made |= {f"itr_avg_start_{n}": F.try_element_at(ring, F.lit(-n))["stock"] for n in (7, 14, 28)}
    rows = rows.withColumns(made)
    entry = _entry({"ledger": F.col("__ledger")} | {f"{d}_decay": F.col(f"__{d}_prev") for d in DECAYS})
    rows = rows.withColumn("__entry", entry)
    zero, totals = F.lit(0).cast("bigint"), []
    for m, n in frames(decay_rows):
        comes, goes = F.col("__entry")[m], F.try_element_at(ring, F.lit(-n))[m]
        one = lambda x: F.when(x.isNotNull(), 1).otherwise(0)
        was = lambda kind: F.coalesce(F.col("__old_totals")[f"{kind}_{m}_{n}"], zero)  # noqa: B023, E731
        totals.append((was("s") + F.coalesce(comes, zero) - F.coalesce(goes, zero)).alias(f"s_{m}_{n}"))
        totals.append((was("n") + one(comes) - one(goes)).alias(f"n_{m}_{n}"))
    grown = F.when(ring.isNull(), F.array("__entry")).otherwise(F.concat(ring, F.array("__entry")))
    rows = rows.withColumns({"__totals": F.struct(*totals), "__ring": _newest(grown, RING_ROWS)})
    rows = rows.withColumns({f"__{n}": F.col(n.removeprefix("meta_")) for n in c.SHELF_STATE})
    out = {name: _total(t) for name, t in ALL_TRAILING.items()}
    for n in LEDGER_FRAMES:
        out[f"LEDGER_BAL_RATIO_{n}"] = ratio_neg(_total(Trailing("ledger", n)), _total(Trailing("eop", n)))
    for d in DECAYS:
        met, all_met = F.col("__totals")[f"n_{d}_decay_{decay_rows}"], F.col("__totals")[f"s_{d}_decay_{decay_rows}"]
        mean = fixed_ratio(all_met, F.lit(100 * decay_rows))
        out[f"{d}_decay_decimal"] = F.when(met < decay_rows, F.lit(0.0)).otherwise(mean)
    return rows.withColumns(out).drop("__entry", *(f"__{d}_prev" for d in DECAYS), *old.values())


def _total(t: Trailing) -> Column:
    total, values = F.col("__totals")[f"s_{t.measure}_{t.rows}"], F.col("__totals")[f"n_{t.measure}_{t.rows}"]
    if t.kind == "mean":
        return F.try_divide(total.cast("double"), values.cast("double"))
    return values if t.kind == "count" else F.when(values > 0, total)


def day_context(stepped: DataFrame, before: DayState) -> DataFrame:
    """Store context of the day's rows, the weeks and bounds continued from the state."""
    weeks = before.categories.select(F.col(c.LOCATION).alias("__loc"), F.col(c.CAT).alias("__cat"), "week")

    def continued(cell: DataFrame) -> DataFrame:
        joined = cell.join(weeks, (cell[c.LOCATION] == weeks["__loc"]) & cell[c.CAT].eqNullSafe(weeks["__cat"]), "left")
        past = F.filter(F.coalesce("week", F.expr("cast(array() as array<bigint>)")), lambda x: x.isNotNull())
        qty = F.col("categorical_shrinkage_qty_7")
        peers = Window.partitionBy(c.LOCATION, c.DATE)
        summed = joined.withColumn(
            "categorical_shrinkage_qty_7",
            F.aggregate(past, F.lit(0).cast("bigint"), lambda a, x: a + x) + F.coalesce("shrinkage_qty_day_sum", F.lit(0)),
        )
        return summed.drop("__loc", "__cat").withColumn(
            "categorical_shrinkage_scale_7", min_max(qty, F.min(qty).over(peers), F.max(qty).over(peers))
        )

    return store_context(stepped.join(before.stores, c.LOCATION, "left"), continued)


def state_after(before: DayState, stepped: DataFrame, context: DataFrame) -> DayState:
    """The new state: stepped pairs, stores and categories, the idle ones as they were."""
    fresh = stepped.select(*c.PAIR, *(F.col(f"__{n}").alias(n) for n in PAIR_STATE))
    pairs = fresh.unionByName(before.pairs.join(stepped.select(*c.PAIR), c.PAIR, "left_anti"))
    bounds = context.groupBy(c.LOCATION).agg(
        F.min("footfall_min").alias(c.FOOTFALL_STATE[0]), F.max("footfall_max").alias(c.FOOTFALL_STATE[1])
    )
    stores = bounds.unionByName(before.stores.join(bounds.select(c.LOCATION), c.LOCATION, "left_anti"))
    today = F.array(F.col("shrinkage_qty_day_sum"))
    week = _newest(F.when(F.col("week").isNull(), today).otherwise(F.concat("week", today)), WEEK_BEFORE)
    met = context.select(c.LOCATION, c.CAT, week.alias("week"))
    other = met.select(F.col(c.LOCATION).alias("__loc"), F.col(c.CAT).alias("__cat"))
    old = before.categories
    idle = old.join(other, (old[c.LOCATION] == other["__loc"]) & old[c.CAT].eqNullSafe(other["__cat"]), "left_anti")
    return DayState(pairs, stores, met.unionByName(idle))
