"""Attaching audits to the count periods of their store."""

import datetime
import random

from stockweave import columns as c
from stockweave.operators.prepare import Feeds, attach_schedule, denormalize_panel


def day(n):
    return datetime.date(2000, 1, 1) + datetime.timedelta(days=n)


def test_audits_in_any_open_period_are_attached(spark):
    rng = random.Random(1)
    periods = [(rng.randrange(4), n := rng.randrange(300), n + rng.randrange(40)) for _ in range(40)]
    periods += [(0, 10, 200), (0, 50, 52)]  # a short one inside a long one
    audits = [(f"S{rng.randrange(9)}", rng.randrange(6), rng.randrange(340), rng.choice([None, -2, 0, 3])) for _ in range(800)]
    schedule = spark.createDataFrame([(s, day(a), day(b)) for s, a, b in periods], "LOCATION int, FIRST_DAY date, LAST_DAY date")
    rows = spark.createDataFrame([(i, s, day(n), u) for i, s, n, u in audits], "SKU string, LOCATION int, AUDIT_DATE date, AUDIT_UNITS long")
    found = sorted(map(str, attach_schedule(rows, schedule).select("SKU", "LOCATION", "AUDIT_DATE", "AUDIT_UNITS").collect()))
    expected = [a for a in audits if any(s == a[1] and x <= a[2] <= y for s, x, y in periods)]
    assert found == sorted(map(str, rows.sparkSession.createDataFrame([(i, s, day(n), u) for i, s, n, u in expected], rows.schema).collect()))
    plan = attach_schedule(rows, schedule)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert attach_schedule(rows, schedule.where("false")).isEmpty() and attach_schedule(rows.where("false"), schedule).isEmpty()


def feeds(spark):
    key = "SKU string, LOCATION int, DATE date"
    stock = ", ".join(f"{n} long" for n in (c.BEGIN_SOH, c.END_SOH, c.START_INTRANS, c.END_INTRANS))
    snapshot = [(s, loc, day(n), 5, 6, 1, 2) for s in "AB" for loc in (10, 60, 120) for n in range(3)]
    facts = {
        n: spark.createDataFrame([("A", 10, day(1), 3), ("A", 10, day(1), 4), ("B", 60, day(2), k)], f"{key}, {n} long")
        for k, n in enumerate([c.SALES_COUNT, c.GROSS_SALES, c.RETURN_UNITS, c.POS_ADJ, c.NEG_ADJ, c.TOTAL_RETAIL, c.IN_TRANSIT, c.DSD_UNITS])
    }
    audits = [("A", 10, day(1), 2), ("A", 10, day(1), 1), ("B", 60, day(0), 9), ("B", 120, day(2), None)]
    return Feeds(
        spark.createDataFrame(snapshot, f"{key}, {stock}"),
        facts,
        spark.createDataFrame([("A", "c1")], "SKU string, CAT string"),
        spark.createDataFrame(audits, "SKU string, LOCATION int, AUDIT_DATE date, AUDIT_UNITS long"),
        spark.createDataFrame([(10, day(0), day(1)), (120, day(2), day(9))], "LOCATION int, FIRST_DAY date, LAST_DAY date"),
    )


def test_panel_of_all_facts(spark):
    rows = {(r.SKU, r.LOCATION, r.DATE): r for r in denormalize_panel(feeds(spark)).collect()}
    assert len(rows) == 18
    full = rows["A", 10, day(1)]
    assert (full[c.SALES_COUNT], full[c.SALES_UNITS], full[c.UNIT_RETAIL]) == (7, 14, 1)
    assert (full[c.AUDIT_FLAG], full[c.AUDIT_DATE], full[c.AUDIT_UNITS], full[c.START_TOTAL], full[c.END_TOTAL]) == (1, day(1), 3, 6, 8)
    other = rows["B", 60, day(0)]  # its audit lies in no period
    assert (other[c.AUDIT_FLAG], other[c.AUDIT_DATE], other[c.AUDIT_UNITS], other.CAT, other[c.GROSS_SALES]) == (0, None, None, None, 0)
    assert rows["B", 120, day(2)][c.AUDIT_FLAG] == 1


def test_groups_and_day_reach_the_feeds(spark):
    rows = denormalize_panel(feeds(spark), groups=[0], as_of="2000-01-02").collect()
    assert sorted((r.SKU, r.LOCATION) for r in rows) == [("A", 10), ("B", 10)]
    assert {r[c.LOCATION_GROUP] for r in rows} == {0} and {r.DATE for r in rows} == {day(1)}
    assert denormalize_panel(feeds(spark), groups=[]).isEmpty()
