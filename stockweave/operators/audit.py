"""Adjust the panel for physical audits and cycle counts.

Each operator takes and returns a panel; ``apply_audit`` chains them.  The
backward fills run in descending date order over the same (SKU, LOCATION)
partitioning as everything else, so the whole chain needs a single exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave import columns as c
from stockweave.functions.exprs import floor_zero
from stockweave.functions.windows import optional, pair_future, pair_history

#: Cycle count before the first row of a slice, if the frame carries it.
CC_SEED = "meta_last_cc_date"


def audit_scope(panel: DataFrame, as_of: str) -> DataFrame:
    """All rows of the pairs that have an audit recorded on ``as_of``."""
    audited = panel.where(
        (F.col(c.DATE) == F.to_date(F.lit(as_of))) & F.col(c.AUDIT_DATE).isNotNull()
    ).select(*c.PAIR)
    return panel.join(audited, c.PAIR, "left_semi")


def dedup_latest(panel: DataFrame) -> DataFrame:
    """One row per key, the one loaded last (our reading of a missing routine).

    A max over structs combines on the map side, so a key repeated millions of
    times still sends one row per task; ranking would gather all its copies.
    Ties on the load date fall to the largest remaining values, so reruns agree.
    """
    rest = [n for n in panel.columns if n not in c.KEY and n != c.LOAD_DATE]
    best = F.max(F.struct(c.LOAD_DATE, *rest)).alias("best")
    return panel.groupBy(*c.KEY).agg(best).select(
        *(F.col(n) if n in c.KEY else F.col(f"best.{n}").alias(n) for n in panel.columns)
    )


def audit_day_units(panel: DataFrame) -> DataFrame:
    """Counted difference on the audit day itself, 0 elsewhere."""
    on_day = F.col(c.DATE) == F.col(c.AUDIT_DATE)
    return panel.withColumn(
        c.AUDIT_DAY_UNITS, F.when(on_day, F.col(c.AUDIT_UNITS)).otherwise(F.lit(0)).cast("bigint")
    )


def audit_backfill(panel: DataFrame) -> DataFrame:
    """Next audit date and units at or after each row."""
    return panel.withColumns(
        {n: F.last(n, ignorenulls=True).over(pair_future()) for n in (c.AUDIT_DATE, c.AUDIT_UNITS)}
    )


def audit_balance_check(panel: DataFrame) -> DataFrame:
    """Keep audit units only where the day's ledger closes with them."""
    expected = (
        F.col(c.START_TOTAL) + F.col(c.IN_TRANSIT) + F.col(c.DSD_UNITS)
        + F.col(c.AUDIT_UNITS) + F.col(c.ADJ_UNITS) - F.col(c.SALES_UNITS)
    )
    closes = expected == F.col(c.END_TOTAL)
    return panel.withColumn(
        c.AUDIT_UNITS, F.when(closes, F.col(c.AUDIT_UNITS)).otherwise(F.lit(0)).cast("bigint")
    )


def audit_adj_units(panel: DataFrame) -> DataFrame:
    return panel.withColumn(c.AUDIT_ADJ_UNITS, F.col(c.AUDIT_UNITS) + F.col(c.ADJ_UNITS))


def onhand_recorded(panel: DataFrame) -> DataFrame:
    """Units that must have come in: closing stock + sales - adjustments - opening stock."""
    before_receipts = F.col(c.END_SOH) + F.col(c.SALES_UNITS) - F.col(c.AUDIT_ADJ_UNITS)
    opening = F.col(c.BEGIN_SOH)
    return panel.withColumn(
        c.ONHAND_RECORDED,
        F.when(before_receipts > opening, before_receipts - opening).otherwise(F.lit(0)).cast("bigint"),
    )


def dsd_correction(panel: DataFrame) -> DataFrame:
    """Direct deliveries sent back reduce the recorded receipts."""
    dsd, recorded = F.col(c.DSD_UNITS), F.col(c.ONHAND_RECORDED)
    return panel.withColumn(c.ONHAND_RECORDED, F.when(dsd < 0, recorded + dsd).otherwise(recorded))


def last_cycle_count(panel: DataFrame) -> DataFrame:
    """Latest day up to the row with a non-zero adjustment; a slice starts from its seed."""
    counted = F.last(F.when(F.col(c.ADJ_UNITS) != 0, F.col(c.DATE)), ignorenulls=True).over(pair_history())
    return panel.withColumn(c.LAST_CC_DATE, F.coalesce(counted, optional(panel, CC_SEED, "date")))


def _from_next_flag_row(value: Column) -> Column:
    """Value of the row if set, else of the next row that has one."""
    return F.last(value, ignorenulls=True).over(pair_future())


def audit_prev_cc(panel: DataFrame) -> DataFrame:
    """Cycle count preceding the coming audit: the last one on the audit row, or the
    first day of the audit period when there was none; spread to the earlier rows."""
    period = Window.partitionBy(*c.PAIR, c.AUDIT_DATE)
    is_audit = F.col(c.AUDIT_FLAG) == 1
    # In date order the running minimum of DATE is the first date of the group.
    own = F.when(is_audit, F.coalesce(F.col(c.LAST_CC_DATE), F.min(c.DATE).over(period)))
    return panel.withColumn("__own_cc", own).withColumn(
        c.AUDIT_PREV_CC_DATE, _from_next_flag_row(F.col("__own_cc"))
    ).drop("__own_cc")


def audit_adj_flag(panel: DataFrame) -> DataFrame:
    """'Y' before an audit that changed stock, 'N' before one that did not."""
    units = F.col(c.AUDIT_DAY_UNITS)
    own = F.when(
        F.col(c.AUDIT_FLAG) == 1, F.when(units == 0, F.lit("N")).when(units != 0, F.lit("Y"))
    )
    return panel.withColumn(c.AUDIT_ADJ_FLAG, _from_next_flag_row(own))


def pre_audit_cc_flag(panel: DataFrame) -> DataFrame:
    """1 from the last cycle count up to an audit that confirmed the stock, audit days apart."""
    day = F.col(c.DATE)
    inside = (
        (day >= F.col(c.AUDIT_PREV_CC_DATE))
        & (day <= F.col(c.AUDIT_DATE))
        & (F.col(c.AUDIT_ADJ_FLAG) == "N")
        & (F.col(c.AUDIT_FLAG) == 0)
    )
    return panel.withColumn(c.PRE_AUDIT_CC_DAY_FLAG, F.when(inside, 1).otherwise(0))


def audit_eop_soh(panel: DataFrame) -> DataFrame:
    """Closing stock without the audit correction, not below 0."""
    corrected = (F.col(c.AUDIT_UNITS) != 0) & (F.col(c.AUDIT_DAY_UNITS) != 0)
    closing = F.when(corrected, F.col(c.END_SOH) - F.col(c.AUDIT_UNITS)).otherwise(F.col(c.END_SOH))
    return panel.withColumn(c.AUDIT_ADJ_EOP_SOH, floor_zero(closing).cast("bigint"))


STEPS = [
    last_cycle_count,
    audit_day_units,
    audit_backfill,
    audit_balance_check,
    audit_adj_units,
    onhand_recorded,
    dsd_correction,
    audit_prev_cc,
    audit_adj_flag,
    pre_audit_cc_flag,
    audit_eop_soh,
]


def apply_audit(panel: DataFrame, as_of: str | None = None) -> DataFrame:
    """The full chain.  The forward fill comes first, then the backward ones.

    With ``as_of`` only the pairs that have an audit on that day are adjusted, each key
    once, as loaded last: the daily mode.
    """
    if as_of is not None:
        panel = dedup_latest(audit_scope(panel, as_of))
    for step in STEPS:
        panel = step(panel)
    return panel
