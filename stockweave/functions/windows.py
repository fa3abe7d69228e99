"""Window orders and the trailing-aggregate builder.

Spark evaluates a sliding ``ROWS n PRECEDING`` frame by re-aggregating the
buffer for each row, so an 84-row sum costs 84 updates per row and per
measure.  A running total costs one: the trailing sum over n rows is the
running total minus the running total n rows earlier.  With integer measures
the difference is exact.  ``trailing`` builds all requested aggregates from one
pass of running totals and one pass of lags over the same partitioning and
order, hence one exchange and one sort however many features are asked for.

Groups of the (SKU, LOCATION) order are bounded by the calendar: the panel key
is unique, so a pair never has more rows than there are days.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave import columns as c

def pair_order():
    return Window.partitionBy(*c.PAIR).orderBy(c.DATE)


def pair_history():
    """First row of the pair up to the current one."""
    return pair_order().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def pair_future():
    """Current row up to the last one of the pair.

    Written as a look back in descending order: Spark re-aggregates a frame
    "current row to end" for each row, which is quadratic in the group.
    """
    newest_first = Window.partitionBy(*c.PAIR).orderBy(F.col(c.DATE).desc())
    return newest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)


@dataclass(frozen=True)
class Trailing:
    """One aggregate over the last ``rows`` rows of ``measure``."""

    measure: str
    rows: int
    kind: str = "sum"  # sum | count | mean


#: A running total carries the number of its values in the low bits.
COUNT_BITS = 20


def trailing(df: DataFrame, measures: dict[str, Column], wanted: dict[str, Trailing]) -> DataFrame:
    """Add the aggregates in ``wanted`` (output name -> spec) over (SKU, LOCATION) by DATE.

    Nulls are skipped; a sum or mean over a frame without any value is null.  Sum and number
    of a measure's values travel in one whole number, x * 2**20 + 1 for each value, so that
    both cost one running total and one lag a frame: a pair has fewer than 2**20 days, and
    sums stay under 2**43 (beyond, the session's arithmetic raises an error).  Helper columns
    are dropped at once, since the width of the rows is what the windows above pay for.
    """
    order, history = pair_order(), pair_history()
    frames = sorted({(t.measure, t.rows) for t in wanted.values()})
    one = F.lit(1 << COUNT_BITS).cast("bigint")

    running = {f"__r_{m}": F.sum(measures[m].cast("bigint") * one + F.lit(1)).over(history) for m in sorted({m for m, _ in frames})}
    zero = F.lit(0).cast("bigint")
    recent = {}
    for m, n in frames:
        now, before = F.col(f"__r_{m}"), F.lag(f"__r_{m}", n).over(order)
        recent[f"__r_{m}_{n}"] = F.coalesce(now, zero) - F.coalesce(before, zero)

    def output(t: Trailing) -> Column:
        both = F.col(f"__r_{t.measure}_{t.rows}")
        values = F.pmod(both, one)
        total = F.shiftright(both - values, COUNT_BITS)
        if t.kind == "mean":
            return F.try_divide(total.cast("double"), values.cast("double"))
        return values if t.kind == "count" else F.when(values > 0, total)

    out = df.withColumns(running).withColumns(recent)
    out = out.withColumns({name: output(t) for name, t in wanted.items()})
    return out.drop(*running, *recent)


def optional(df: DataFrame, name: str, dtype: str = "bigint") -> Column:
    """A state column if the frame carries it, else null (no state)."""
    return F.col(name).cast(dtype) if name in df.columns else F.lit(None).cast(dtype)
