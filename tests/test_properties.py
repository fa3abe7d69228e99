"""Properties that hold whatever the data: partitioning, skew, state, brute force."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from stockweave import columns as c
from stockweave.functions.exprs import half_up
from stockweave.functions.windows import Trailing, trailing
from stockweave.operators import audit, cascade, daily, intake, metrics, prepare, split, state
from stockweave.plans.feature_store import historical_features, incremental_features
from stockweave.sources import derived, storage
from stockweave.sources.shared import fresh_path
from stockweave.sources.tables import panel

AS_OF = "2023-05-10"


@pytest.fixture(scope="module")
def dense(spark):
    """Two stores, four items, 130 days without gaps."""
    rng = random.Random(7)
    rows = []
    for item in range(4):
        for store in (10, 60):
            soh, transit = 40, 0
            for i in range(130):
                day = datetime.date(2023, 1, 1) + datetime.timedelta(days=i)
                gross, back = rng.choice([0, 0, 1, 2, 5]), rng.choice([0, 0, 0, 1])
                pos, neg = rng.choice([0, 0, 3]), -rng.choice([0, 0, 0, 2])
                arrived, sent = transit, rng.choice([0, 0, 6])
                begin, start_it = soh, transit
                soh += arrived - gross + back + pos + neg
                transit = sent
                flag = int(rng.random() < 0.1)
                rows.append(
                    (f"S{item}", store, day, store // 50, day, f"C{item % 2}", "D0", "L0", gross + 1, gross - back, gross,
                     -back, sent, pos, neg, pos + neg, 0, rng.choice([0, 199, 250]), gross * 199, begin, soh, start_it,
                     transit, begin + start_it, soh + transit, soh, soh, flag, day if flag else None,
                     rng.choice([-1, 0, 2]) if flag else None)
                )
    names = panel_columns(spark)
    return spark.createDataFrame(rows, names)


def panel_columns(spark):
    schema = panel(spark, "/root/testdata/sf0.001").schema
    return schema


def _state(rows):
    traffic = rows.groupBy(c.LOCATION, c.DATE).agg(F.sum(c.SALES_COUNT).alias("daily_trans"))
    return state.carry_state(rows, daily.footfall_by_day(traffic))


def test_incremental_equals_historical(spark, dense):
    rows = audit.apply_audit(dense)
    full = {tuple(r)[:3]: r.asDict() for r in historical_features(rows).where(F.col(c.DATE) == AS_OF).collect()}
    day = {tuple(r)[:3]: r.asDict() for r in incremental_features(rows, _state(rows), AS_OF).collect()}
    assert len(day) == 8 and day == full


def test_partitioning_and_order_do_not_matter(spark, dense):
    def result(df):
        return sorted(map(str, historical_features(audit.apply_audit(df)).collect()))

    base = result(dense)
    assert result(dense.repartition(1)) == base
    assert result(dense.orderBy(F.rand(3)).repartition(7)) == base


def test_scales_stay_within_bounds(spark, dense):
    df = historical_features(audit.apply_audit(dense))
    scales = [n for n in df.columns if "scale" in n.lower()]
    assert len(scales) == 5
    for n in scales:
        assert df.where(~F.col(n).between(0, 1)).count() == 0, n
    assert df.where(~F.col("footfall_index").between(1, 10)).count() == 0


def test_empty_panel(spark, dense):
    none = dense.where("false")
    assert historical_features(audit.apply_audit(none)).count() == 0
    scored = cascade.cascade_predict(derived.scored_panel(none))
    row = metrics.overall_metrics(scored).first()
    assert row.tp_perc == 0.0 and row.under_accurate_perc is None and row.loss == 0


def test_daily_steps_equal_the_whole_history(spark, dense):
    path = fresh_path(spark, "audited")
    storage.sink_parquet(audit.apply_audit(dense), path)
    rows = spark.read.parquet(path)
    traffic = rows.groupBy(c.LOCATION, c.DATE).agg(F.sum(c.SALES_COUNT).alias("daily_trans"))
    whole = state.carry_state(rows, daily.footfall_by_day(traffic), state.UNITS)
    first = datetime.date(2023, 4, 20)
    current = whole.where(F.col(c.DATE) == first)
    for step in range(1, 13):
        day = rows.where(F.col(c.DATE) == first + datetime.timedelta(days=step))
        if step == 5:  # a pair without a row keeps its state
            day = day.where("SKU <> 'S0'")
        stored = fresh_path(spark, "state")
        storage.sink_parquet(state.advance_state(current, day), stored)
        current = spark.read.parquet(stored)
        if step == 4:
            assert current.exceptAll(whole.where(F.col(c.DATE) == first + datetime.timedelta(days=4))).isEmpty()
    expected = whole.where(F.col(c.DATE) == first + datetime.timedelta(days=12)).where("SKU <> 'S0'")
    got = current.where("SKU <> 'S0'")
    assert got.count() == 6 and got.exceptAll(expected.select(got.columns)).isEmpty()
    assert got.where("meta_sale_decay_decimal > 0").count() > 0


def test_trailing_against_brute_force(spark):
    rng = random.Random(1)
    rows = [
        ("a", s, datetime.date(2020, 1, 1) + datetime.timedelta(days=3 * i), rng.choice([None, 1, 5, -3]))
        for s in range(3)
        for i in range(60)
    ]
    df = spark.createDataFrame(rows, "SKU string, LOCATION int, DATE date, v bigint")
    wanted = {"s": Trailing("v", 7), "n": Trailing("v", 7, "count"), "m": Trailing("v", 28, "mean")}
    got = {(r.LOCATION, r.DATE): r for r in trailing(df, {"v": F.col("v")}, wanted).collect()}
    for s in range(3):
        values = [r for r in rows if r[1] == s]
        for i, r in enumerate(values):
            near = [x[3] for x in values[max(0, i - 6) : i + 1] if x[3] is not None]
            far = [x[3] for x in values[max(0, i - 27) : i + 1] if x[3] is not None]
            out = got[(s, r[2])]
            assert (out.s, out.n) == (sum(near) if near else None, len(near))
            assert out.m == (sum(far) / len(far) if far else None)


def test_one_key_with_a_third_of_all_copies(spark):
    hot = spark.range(4000).select(
        F.lit("x").alias(c.SKU), F.lit(1).alias(c.LOCATION), F.lit(datetime.date(2020, 1, 1)).alias(c.DATE),
        F.date_add(F.lit(datetime.date(2020, 1, 1)), (F.col("id") % 50).cast("int")).alias(c.LOAD_DATE), F.col("id").alias("v"),
    )
    cold = hot.withColumn(c.SKU, F.col("v").cast("string"))
    best = {r[c.SKU]: r.v for r in audit.dedup_latest(hot.union(cold).union(cold)).collect()}
    assert len(best) == 4001 and best["x"] == 3999 and best["17"] == 17


def test_days_without_files_are_logged_and_routed(spark):
    day = datetime.date
    files = spark.createDataFrame(
        [(day(2020, 1, 1), "d/A-1.csv", "A-1.csv", "A", True), (day(2020, 1, 1), "d/B-1.csv", "B-1.csv", "B", True), (day(2020, 1, 3), "d/A-3.csv", "A-3.csv", "A", True)],
        "file_date date, path string, name string, feed string, permitted boolean",
    )
    dates = spark.createDataFrame([(day(2020, 1, d),) for d in (1, 2, 3)], "file_date date")
    log = intake.intake_log(files, dates, "20200104", required=["A", "B"]).collect()
    assert sorted((r.file_date, r.error_code, r.missed_files, r.processed_files) for r in log) == [
        ("20200101", "", "", "A:1,B:1"),
        ("20200102", "DATA_ING_ERR_001", "A,B", ""),
        ("20200103", "", "", "A:1"),
        ("20200103", "DATA_ING_ERR_002", "B", ""),
    ]
    routes = intake.day_route(files, dates, ["A", "B"]).collect()
    assert sorted((r.file_date.day, r.n_missing, r.route) for r in routes) == [(1, 0, "success"), (2, 2, "error"), (3, 1, "error")]


def test_daily_audit_equals_the_whole_one_on_its_pairs(spark):
    rows = panel(spark, "/root/testdata/sf0.001")
    whole, scoped = audit.apply_audit(rows), audit.audit_scope(rows, audit_day(rows))
    daily_run = audit.apply_audit(rows, audit_day(rows))
    expected = whole.join(scoped.select(*c.PAIR).distinct(), c.PAIR, "left_semi").select(daily_run.columns)
    assert daily_run.count() > 0
    assert daily_run.exceptAll(expected).isEmpty() and expected.exceptAll(daily_run).isEmpty()


def audit_day(rows):
    return str(rows.where(F.col(c.AUDIT_DATE).isNotNull()).agg(F.min(c.DATE)).first()[0])


def test_auc_against_all_pairs(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 1), rng.choice([0.1, 0.2, 0.2, rng.random()])) for _ in range(400)]
    won = sum(
        (a > b) + (a == b) / 2 for y, a in rows if y == 1 for z, b in rows if z == 0
    )
    pos = sum(y for y, _ in rows)
    df = spark.createDataFrame(rows, "y int, s double")
    assert metrics.roc_auc(df, "y", "s").first()[0] == pytest.approx(won / (pos * (len(rows) - pos)), abs=5e-4)
    assert metrics.roc_auc(df.where("y = 1"), "y", "s").first()[0] == 0.0


def test_confusion_counts_add_up(spark, dense):
    scored = cascade.cascade_predict(derived.scored_panel(dense))
    row = metrics.stock_confusion(scored).first()
    assert row.tp + row.fn + row.tn + row.fp == dense.count()


def test_split_is_ordered_in_time(spark, dense):
    parts = split.split_incremental(dense).groupBy("SKU", "LOCATION", "data_split").agg(
        F.min("DATE").alias("lo"), F.max("DATE").alias("hi"), F.count("*").alias("n")
    )
    by = {}
    for r in parts.collect():
        by.setdefault((r.SKU, r.LOCATION), {})[r.data_split] = r
    for p in by.values():
        assert (p["train"].n, p["validation"].n, p["test"].n) == (105, 12, 13)
        assert p["train"].hi < p["validation"].lo and p["validation"].hi < p["test"].lo
    assert {r[0] for r in split.split_historical(dense).select("data_split").distinct().collect()} == {"train"}


def test_promotion(spark):
    scores = lambda a, b: spark.createDataFrame([("new", a), ("prod", b)], "model string, score double")
    assert metrics.promotion_decision(scores(2.0, 1.0)).first().decision == "promote"
    assert metrics.promotion_decision(scores(1.0, 1.0)).first().decision == "keep"
    assert metrics.promotion_decision(scores(0.0, 1.0), compare=False).first().decision == "promote"


def test_merge_replaces_only_its_own_day(spark, dense):
    history = fresh_path(spark, "history")
    day = dense.select(*c.KEY, c.LOCATION_GROUP, c.SALES_UNITS)
    for load_date in ("2023-05-09", "2023-05-10", "2023-05-10"):
        storage.merge_consolidated(day, history, load_date)
    assert spark.read.parquet(history).count() == 2 * dense.count()


def test_panel_check_reasons(spark, dense):
    twice = dense.union(dense.limit(1))
    found = prepare.panel_reconcile(twice)
    assert found.where("reason = 'duplicate_key'").count() == 1
    lost = dense.limit(1).withColumn("SKU", F.lit(None).cast("string"))
    assert prepare.panel_reconcile(lost).first().reason == "null_key"


def test_model_scores_feed_the_cascade(spark, dense):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    truth = derived.scored_panel(dense).select(*c.KEY, "BINARY_TARGET_CLASSIFICATION", "TARGET_REGRESSION")
    rows = dense.join(truth, c.KEY)
    features = [c.END_SOH, c.SALES_UNITS, c.BEGIN_SOH]
    train = VectorAssembler(inputCols=features, outputCol="__x").transform(rows)
    clf = GBTClassifier(featuresCol="__x", labelCol="BINARY_TARGET_CLASSIFICATION", maxIter=2, maxDepth=2).fit(train)
    reg = GBTRegressor(featuresCol="__x", labelCol="TARGET_REGRESSION", maxIter=2, maxDepth=2).fit(train)
    scored = cascade.score_with_models(rows, {"binary": clf, "hl": clf, "low": reg, "high": reg}, features)
    out = cascade.cascade_predict(scored)
    assert out.where("binary_pred < 0 or binary_pred > 1 or orig_pred_low > orig_pred_high").count() == 0
    assert out.count() == dense.count() and "__x" not in out.columns


def test_ship_date_cells_parse(spark):
    """Sample delivery files write dates as 04-Jul-23 and leave cells empty."""
    path = fresh_path(spark, "stops")
    text = spark.createDataFrame([("1", "04-Jul-23"), ("2", None)], "SHIPMENT_XID string, ACTUAL_ARRIVAL string")
    storage.sink_csv(text, path)
    back = storage.scan_csv(spark, path, "SHIPMENT_XID bigint, ACTUAL_ARRIVAL date", dateFormat="dd-MMM-yy")
    assert sorted(map(tuple, back.collect())) == [(1, datetime.date(2023, 7, 4)), (2, None)]


def test_half_up_is_round(spark):
    """Halves, values next to them and whole ones beyond 2**52, both signs."""
    values = [0.0, 0.5, 1.5, 2.5, 0.49999999999999994, 0.5000000000000001, 1234567.5, 4503599627370495.5, 2.0**52 + 1, 1e18]
    values += [n / 8 for n in range(200)] + [n / 100 * 100 for n in range(9000, 9200)]
    cells = spark.createDataFrame([(s * v,) for v in values for s in (1.0, -1.0)] + [(None,)], "x double")
    whole = cells.select("x", F.round("x").cast("bigint").alias("a"), half_up(F.col("x")).cast("bigint").alias("b"))
    assert whole.where(~F.col("a").eqNullSafe(F.col("b"))).collect() == []


def _star(spark, lines):
    root = fresh_path(spark, "star")
    spark.createDataFrame([(1, "Brand#12"), (2, "Brand#34"), (3, None)], "p_partkey long, p_brand string").write.parquet(f"{root}/part.parquet")
    spark.createDataFrame([(1, 3), (2, 4)], "s_suppkey long, s_nationkey int").write.parquet(f"{root}/supplier.parquet")
    schema = (
        "l_partkey long, l_suppkey long, l_orderkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    )
    spark.createDataFrame(lines, schema).write.parquet(f"{root}/lineitem.parquet")
    return root


def test_panel_counts_repeated_and_missing_orders(spark):
    rng = random.Random(11)
    days = [datetime.datetime(2023, 1, d) for d in (1, 2)] + [None]
    lines = [
        (rng.choice([1, 2, 3, 4, None]), rng.choice([1, 2]), rng.choice([5, 6, 7, None]), rng.randint(1, 7), float(rng.randint(1, 9)),
         rng.choice([1.25, 10.005, 99.99]), rng.choice(["R", "A", "N"]), rng.choice(["F", "O"]), rng.choice(days))
        for _ in range(400)
    ]
    brands, stores = {1: "Brand#12", 2: "Brand#34", 3: None}, {1: 30, 2: 40}
    orders, units = {}, {}
    for part, supplier, order, _, quantity, _, flag, _, when in lines:
        if part in brands:
            key = brands[part], stores[supplier], when and when.date()
            orders.setdefault(key, set()).update({order} - {None})
            units[key] = units.get(key, 0) + int(-quantity if flag == "R" else quantity)
    rows = panel(spark, _star(spark, lines)).collect()
    assert {(r.SKU, r.LOCATION, r.DATE): r[c.SALES_COUNT] for r in rows} == {k: len(v) for k, v in orders.items()}
    assert {(r.SKU, r.LOCATION, r.DATE): r[c.SALES_UNITS] for r in rows} == units
    assert len(rows) == len(orders)
    assert {(r.SKU, r[c.CAT], r[c.DEPT], r[c.LOB]) for r in rows} == {
        ("Brand#12", "C2", "D0", "L0"), ("Brand#34", "C4", "D1", "L0"), (None, None, None, None)
    }


def test_lines_are_dealt_out_before_they_are_grouped(spark, small):
    """Else a task that reads a large split holds sums for each of its lines."""
    plan = panel(spark, small)._jdf.queryExecution().executedPlan().toString().splitlines()
    dealt = next(i for i, step in enumerate(plan) if "REPARTITION_BY_COL" in step)
    assert not [step for step in plan[dealt:] if "Aggregate" in step]
    assert any("Aggregate" in step for step in plan[:dealt])
