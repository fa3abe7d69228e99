"""Days taken into the audited panel one by one."""

import os

import pytest
from pyspark.sql import functions as F

from stockweave import columns as c
from stockweave.operators.audit import apply_audit, dedup_latest
from stockweave.plans import audit_store
from stockweave.sources.shared import written
from stockweave.sources.tables import panel

FIRST, DAYS = "2000-04-29", ["2000-04-30", *(f"2000-05-0{d}" for d in range(1, 7))]


@pytest.fixture(scope="module")
def busy(spark, small):
    """Few pairs with rows on most days of four months; some late corrections of older rows."""
    day = F.date_add(F.to_date(F.lit("2000-01-01")), F.pmod(F.xxhash64(c.SKU, c.LOCATION, c.DATE), F.lit(130)).cast("int"))
    rows = panel(spark, small).withColumn(c.SKU, F.concat(F.lit("S"), F.pmod(F.xxhash64(c.SKU), F.lit(4)).cast("string")))
    rows = rows.withColumn(c.LOCATION, F.col(c.LOCATION) % 60).withColumn(c.DATE, day).dropDuplicates(c.KEY)
    rows = rows.withColumn(c.LOAD_DATE, F.col(c.DATE)).withColumn(c.AUDIT_DATE, F.when(F.col(c.AUDIT_FLAG) == 1, F.col(c.DATE)))
    late = rows.where(F.col(c.DATE).between(F.lit("2000-03-01"), F.lit("2000-04-15")) & (F.hash(*c.KEY) % 40 == 0))
    late = late.withColumn(c.ADJ_UNITS, F.col(c.ADJ_UNITS) + 3).withColumn(c.LOAD_DATE, F.to_date(F.lit("2000-05-03")))
    return written(rows.unionByName(late), "busy")


def files(path):
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def rows_of(df, columns):
    return sorted(map(str, df.select(*columns).collect()))


def test_days_equal_a_full_rerun_and_other_folders_stay(spark, busy, tmp_path):
    path = str(tmp_path)
    known = lambda day: busy.where(F.col(c.LOAD_DATE) <= F.lit(day))
    audit_store.start(known(FIRST), path, FIRST)
    reached, before = [], FIRST
    for day in DAYS:
        old = files(f"{path}/audited")
        months = audit_store.refresh(busy, path, before, day)
        new = files(f"{path}/audited")
        for name, time in old.items():
            if not any(f"PANEL_MONTH={m}/" in name for m in months):
                assert new[name] == time
        reached.append(months)
        before = day
        if day in ("2000-05-02", "2000-05-03", DAYS[-1]):
            expected = apply_audit(dedup_latest(known(day)))
            assert rows_of(spark.read.parquet(f"{path}/audited"), expected.columns) == rows_of(expected, expected.columns)
    # audits reach back further than their own month on some days, and not on all
    assert {len(m) for m in reached} >= {1, 2} and any("m2000-03" not in m for m in reached)


def test_a_day_run_again_and_a_day_without_rows(spark, busy, tmp_path):
    path = str(tmp_path)
    known = busy.where(F.col(c.LOAD_DATE) <= F.lit(DAYS[0]))
    audit_store.start(busy.where(F.col(c.LOAD_DATE) <= F.lit(FIRST)), path, FIRST)
    audit_store.refresh(busy, path, FIRST, DAYS[0])
    audit_store.refresh(busy, path, FIRST, DAYS[0])
    assert audit_store.refresh(busy, path, DAYS[0], "2030-01-01") == []
    expected = apply_audit(dedup_latest(known))
    assert rows_of(spark.read.parquet(f"{path}/audited"), expected.columns) == rows_of(expected, expected.columns)
    marks = spark.read.parquet(f"{path}/marks").where("LOAD_DATE = date'2030-01-01'")
    assert marks.count() == known.select(*c.PAIR).distinct().count()
