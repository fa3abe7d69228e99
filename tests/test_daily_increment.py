"""The daily increment on the state table."""

import os

import pytest
from pyspark.sql import functions as F

from stockweave import columns as c
from stockweave.operators.audit import apply_audit
from stockweave.operators.daily import decay
from stockweave.operators.state import decay_state
from stockweave.plans.feature_store import INPUT, OUTPUT, features_of_day, historical_features, load_state, start_state
from stockweave.sources.shared import written
from stockweave.sources.tables import panel

DECAY = 5


@pytest.fixture(scope="module")
def busy(spark, small):
    """Few pairs with a row on most of the last 130 days, some without a category."""
    rows = apply_audit(panel(spark, small)).select(*INPUT)
    sku = F.concat(F.lit("S"), F.pmod(F.xxhash64(c.SKU), F.lit(3)).cast("string"))
    day = F.date_add(F.to_date(F.lit("2000-01-01")), F.pmod(F.xxhash64(c.SKU, c.LOCATION, c.DATE), F.lit(130)).cast("int"))
    shifted = rows.withColumns({c.SKU: sku, c.LOCATION: F.col(c.LOCATION) % 40, c.DATE: day, c.LOAD_DATE: day})
    shifted = shifted.withColumn(c.CAT, F.when(F.hash(c.SKU, c.LOCATION) % 4 != 0, F.col(c.CAT)))
    return written(shifted.dropDuplicates(c.KEY), "busy")


def expected(rows):
    """The historical run, with the shorter decay frame."""
    short = decay(decay_state(rows), DECAY).select(*c.KEY, "sale_decay_decimal", "transfer_decay_decimal")
    names = ["sale_decay_decimal", "transfer_decay_decimal"]
    return historical_features(rows).drop(*names).join(short, c.KEY).select(*OUTPUT)


def test_thirty_days_equal_the_historical_run(spark, busy, tmp_path):
    path, table = str(tmp_path / "state"), str(tmp_path / "rows")
    busy.write.partitionBy(c.LOAD_DATE).parquet(table)
    rows = spark.read.parquet(table)
    days = [str(r[0]) for r in busy.select(c.DATE).distinct().orderBy(c.DATE).collect()]
    before, last = days[-31], days[-30:]
    start_state(busy.where(F.col(c.DATE) <= F.lit(before)), path, before, DECAY)
    made = []
    for day in last:
        made += [tuple(r) for r in features_of_day(rows, path, before, day, DECAY).collect()]
        before = day
    wanted = [tuple(r) for r in expected(busy).where(F.col(c.DATE) >= F.lit(last[0])).collect()]
    assert len(made) > 250 and sorted(map(str, made)) == sorted(map(str, wanted))
    at = OUTPUT.index("sale_decay_decimal")
    assert sum(r[at] > 0 for r in made) > 20


def test_a_start_from_nothing_and_a_day_run_twice(spark, busy, tmp_path):
    path = str(tmp_path / "state")
    days = [str(r[0]) for r in busy.select(c.DATE).distinct().orderBy(c.DATE).collect()][:6]
    start_state(busy.where("false"), path, "1999-12-31", DECAY)
    early = busy.where(F.col(c.DATE) == F.lit(days[0]))
    start_state(early, path, days[0], DECAY)
    made = []
    for before, day in zip(days, days[1:]):
        again = features_of_day(busy, path, before, day, DECAY).count()
        rows = [tuple(r) for r in features_of_day(busy, path, before, day, DECAY).collect()]
        assert again == len(rows)
        made += rows
    known = busy.where(F.col(c.DATE).between(F.lit(days[0]), F.lit(days[-1])))
    wanted = [tuple(r) for r in expected(known).where(F.col(c.DATE) > F.lit(days[0])).collect()]
    assert sorted(map(str, made)) == sorted(map(str, wanted))
    assert load_state(spark, path, days[-1]).pairs.groupBy(*c.PAIR).count().where("count > 1").isEmpty()


def test_only_one_partition_is_read(spark, busy, tmp_path):
    path, table = str(tmp_path / "state"), str(tmp_path / "rows")
    busy.write.partitionBy(c.LOAD_DATE).parquet(table)
    start_state(busy.where(F.col(c.DATE) <= F.lit("2000-03-01")), path, "2000-03-01")
    features_of_day(spark.read.parquet(table), path, "2000-03-01", "2000-03-02")
    assert sorted(f for f in os.listdir(f"{path}/pairs") if f.startswith(c.LOAD_DATE)) == [
        "LOAD_DATE=2000-03-01",
        "LOAD_DATE=2000-03-02",
    ]
    for frame in (load_state(spark, path, "2000-03-01").pairs, spark.read.parquet(table).where("LOAD_DATE = date'2000-03-02'")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(LOAD_DATE" in plan and "DataFilters: []" in plan
