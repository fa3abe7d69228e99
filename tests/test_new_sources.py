"""Bucketed tables, digests of panels, one-pass validation, and compiled trees."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stockweave import columns as c
from stockweave.operators import audit, digests, prepare, trees
from stockweave.operators.cascade import score_with_models
from stockweave.plans.catalog import RULES
from stockweave.plans.feature_store import historical_features
from stockweave.sources import bucketed
from stockweave.sources.shared import fresh_path, written
from stockweave.sources.tables import panel, table


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_no_exchange_by_pair_over_a_bucketed_table(spark, small):
    rows = panel(spark, small)
    # one pair holds a third of the rows
    hot = rows.withColumn("hot", F.row_number().over(Window.orderBy(*c.KEY)) % 3 == 0)
    day = F.date_add(F.to_date(F.lit("1990-01-01")), F.row_number().over(Window.orderBy(*c.KEY)))
    hot = hot.withColumns({c.DATE: F.when(F.col("hot"), day).otherwise(F.col(c.DATE)), c.SKU: F.when(F.col("hot"), "S").otherwise(F.col(c.SKU))})
    hot = written(hot.withColumn(c.LOCATION, F.when(F.col("hot"), 10).otherwise(F.col(c.LOCATION))).drop("hot"), "hot")
    name = bucketed.save_by_pair(hot, 6)
    features = historical_features(audit.apply_audit(bucketed.read_by_pair(spark, name)))
    plan = plan_of(features)
    exchanges = [x for x in plan.splitlines() if "Exchange" in x and "SKU" in x.split("hashpartitioning", 1)[-1].split(")")[0]]
    assert "Window" in plan and "Bucketed: true" in plan and not exchanges
    assert rows_of(features) == rows_of(historical_features(audit.apply_audit(hot)))
    spark.sql(f"DROP TABLE {name}")


def test_only_differing_groups_are_read_again(spark, small):
    rows = written(panel(spark, small).select(*c.KEY, c.LOCATION_GROUP, c.CAT, c.END_SOH), "panel")
    paths = [fresh_path(spark, "copy") for _ in range(2)]
    chosen = (F.col(c.LOCATION_GROUP) == 3) & (F.dayofmonth(c.DATE) == 7)
    for path, df in zip(paths, (rows, rows.withColumn(c.END_SOH, F.when(chosen, F.col(c.END_SOH) + 1).otherwise(F.col(c.END_SOH))))):
        df.repartition(3).write.partitionBy(c.LOCATION_GROUP).parquet(path)
    left, right = (spark.read.parquet(p) for p in paths)
    found = digests.panel_differences(left, right)
    assert {(r.kind, r.fields, r[c.LOCATION_GROUP], r.DATE.day) for r in found.collect()} == {("changed", c.END_SOH, 3, 7)}
    assert found.count() == rows.where(chosen).count() > 0
    filters = [x for x in plan_of(found).splitlines() if "PartitionFilters" in x and "LOCATION_GROUP" in x]
    assert filters and all("= 3)" in x or "IN (3)" in x for x in filters)
    assert digests.panel_differences(left, left).isEmpty()
    # nulls and rows of another order make no difference, a null for a zero does
    odd = rows.withColumn(c.CAT, F.when(F.col(c.END_SOH) % 2 == 0, F.col(c.CAT)))
    assert digests.panel_differences(odd, odd.repartition(7)).isEmpty()
    zero = rows.withColumn(c.END_SOH, F.lit(0).cast("long"))
    null = zero.withColumn(c.END_SOH, F.when(F.col(c.LOCATION_GROUP) != 1, 0).cast("long"))
    assert digests.panel_differences(zero, null).count() == rows.where(F.col(c.LOCATION_GROUP) == 1).count()
    assert {r.kind for r in digests.panel_differences(rows, rows.where("false")).collect()} == {"left_only"}


def test_three_results_of_one_scan(spark, small):
    lines = table(spark, small, "lineitem")
    report, good, bad = prepare.validate_once(lines, RULES, fresh_path(spark, "checked"))
    assert rows_of(report) == rows_of(prepare.rule_report(lines, RULES))
    checked = prepare.failed_rules(lines, RULES)
    assert rows_of(good) == rows_of(prepare.valid_rows(checked).select(good.columns))
    named = bad.withColumn("failed_rules", F.array_join("failed_rules", ","))
    assert rows_of(named) == rows_of(prepare.error_rows(checked).select(bad.columns))
    none = prepare.validate_once(lines.where("false"), RULES, fresh_path(spark, "checked"))
    assert none[1].isEmpty() and none[2].isEmpty() and {(r.n_rows, r.n_failed) for r in none[0].collect()} == {(0, 0)}


def test_compiled_trees_equal_the_fitted_models(spark, small):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    names = [c.BEGIN_SOH, c.END_SOH, c.SALES_UNITS, c.RETURN_UNITS]
    rows = written(panel(spark, small).withColumns({"y": (F.col(c.END_SOH) % 7 < 3).cast("int"), "z": F.col(c.END_SOH) / 3}), "rows")
    train = VectorAssembler(inputCols=names, outputCol="__x").transform(rows)
    small_fit = {"featuresCol": "__x", "maxIter": 4, "maxDepth": 4, "seed": 3}
    fitted = {k: GBTClassifier(labelCol="y", **small_fit).fit(train) for k in ("binary", "hl")}
    fitted |= {k: GBTRegressor(labelCol="z", **small_fit).fit(train) for k in ("low", "high")}
    compiled = {k: trees.from_fitted(m, names) for k, m in fitted.items()}
    assert all(e.features() <= set(names) and len(e.trees) == 4 for e in compiled.values())
    scores = ["binary_pred", "hl_score", "low_pred", "high_pred"]
    rounded = lambda df: rows_of(df.select(*c.KEY, *(F.round(n, 9) for n in scores)))
    with_gaps = rows.withColumn(c.BEGIN_SOH, F.when(F.col(c.END_SOH) % 5 != 0, F.col(c.BEGIN_SOH)))
    for df in (rows, with_gaps):
        assert rounded(trees.score_with_trees(df, compiled)) == rounded(score_with_models(df, fitted, names))


@pytest.mark.parametrize("value, expected", [(None, 1.0), (float("nan"), 1.0), (1.9, 2.0), (2.0, 4.0), (5.0, 4.0)])
def test_dumped_splits_are_open_and_know_missing_values(spark, value, expected):
    dump = '{"nodeid":0,"split":"x","split_condition":2,"yes":1,"no":2,"missing":2,"children":[{"nodeid":1,"leaf":2},{"nodeid":2,"leaf":1}]}'
    other = {"nodeid": 0, "split": "x", "split_condition": 2, "yes": 1, "no": 2, "missing": 1, "children": [{"nodeid": 1, "leaf": 0}, {"nodeid": 2, "leaf": 3}]}
    df = spark.createDataFrame([(value,)], "x double")
    score = trees.compiled(trees.from_dump([dump, other]))
    assert df.select(score).first()[0] == expected
