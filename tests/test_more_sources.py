"""Plain group folders, CSV without loss, feeds by a table, and the intake stream."""

import pytest
from pyspark.sql import functions as F

from stockweave import columns as c
from stockweave.operators import intake
from stockweave.sources import storage
from stockweave.streaming import intake as streamed


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_a_group_filter_prunes_the_files(spark, tmp_path):
    df = spark.range(300).select(F.col("id").alias(c.SKU), (F.col("id") % 3).cast("int").alias(c.LOCATION_GROUP))
    storage.sink_group_folders(df.repartition(2), str(tmp_path), [0, 1, 2])
    every = storage.scan_group_folders(spark, str(tmp_path))
    assert rows_of(every) == rows_of(df)
    one = every.where(F.col(c.LOCATION_GROUP) == 1)
    assert rows_of(one) == rows_of(df.where(F.col(c.LOCATION_GROUP) == 1))

    # the files of the other groups can no longer be read, and are not
    for other in ("0", "2"):
        for part in (tmp_path / f"{c.LOCATION_GROUP}_{other}").glob("part-*"):
            part.write_bytes(b"no parquet")
    again = every.where(F.col(c.LOCATION_GROUP) == 1)
    assert rows_of(again) == rows_of(df.where(F.col(c.LOCATION_GROUP) == 1))
    with pytest.raises(Exception):
        every.collect()


def test_no_csv_line_is_lost(spark, tmp_path):
    lines = ["id,price,note", "1,2.5,ok", '2,3,"a, b"', "3,x,bad price", "4,1", "5,1,a,b", "", "y,z,two", "id,price,note", '6,,""', "7,1e3,"]
    (tmp_path / "a.csv").write_text("\n".join(lines[:6]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join(lines[6:]))
    rows, rejects = storage.scan_csv_kept(spark, str(tmp_path), "id int, price double, note string")
    assert sorted(((r.id, r.price) for r in rows.collect()), key=str) == [(1, 2.5), (2, 3.0), (6, None), (7, 1000.0)]
    found = sorted((r.file, r.line, r.reason, tuple(r.fields)) for r in rejects.collect())
    assert found == [
        ("a.csv", "3,x,bad price", "value", ("price",)),
        ("a.csv", "4,1", "columns", ()),
        ("a.csv", "5,1,a,b", "columns", ()),
        ("b.csv", "", "columns", ()),
        ("b.csv", "y,z,two", "value", ("id", "price")),
    ]
    assert rows.count() + rejects.count() == len(lines) - 2
    summed = {(r.reason, r.field): r.n_lines for r in storage.drift(rejects).collect()}
    assert summed[("value", "price")] == 2 and summed[("value", "id")] == 1 and summed[("columns", None)] == 3


def test_feeds_by_table_equal_the_comparison_of_all_pairs(spark):
    names = spark.range(3000).select(F.concat(F.lit("drop/FD_"), F.hex(F.col("id") * 7919 % 4096), F.lit("-"), F.col("id") % 50).alias("path"))
    names = names.unionByName(spark.createDataFrame([("FD_",), ("",), (None,), ("x",)], "path string")).unionByName(names.limit(5))
    feeds = spark.range(400).select(F.concat(F.lit("FD_"), F.hex(F.col("id") * 13 % 500)).alias("feed"))
    feeds = feeds.unionByName(spark.createDataFrame([("",), (None,), ("D_F",), ("x",), ("not there at all",)], "feed string"))
    found = intake.matched_by_table(names, feeds)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    wanted = feeds.where("length(feed) > 0").distinct()
    assert rows_of(found) == rows_of(names.join(wanted, F.contains("path", F.col("feed")), "left"))
    assert rows_of(intake.matched_by_table(names, feeds.where("false"))) == rows_of(names.withColumn("feed", F.lit(None).cast("string")))


def test_many_names_against_many_feeds(spark):
    names = spark.range(100_000).select(F.concat(F.lit("in/"), F.sha1(F.col("id").cast("string")), F.lit(".csv")).alias("path"))
    feeds = spark.range(10_000).select(F.substring(F.sha1((F.col("id") * 10).cast("string")), 5, 12).alias("feed"))
    found = intake.matched_by_table(names, feeds).where("feed is not null")
    assert found.count() >= 10_000 and found.where(~F.contains("path", F.col("feed"))).isEmpty()


@pytest.mark.parametrize("chars", [500_000, 0])
def test_the_grams_of_the_paths_are_never_broadcast(spark, tmp_path, monkeypatch, chars):
    spark.range(2000).select(F.concat(F.lit("in/FD_"), F.hex("id"), F.lit("-"), F.col("id") % 50).alias("path")).write.parquet(str(tmp_path / "names"))
    names = spark.read.parquet(str(tmp_path / "names"))
    feeds = spark.createDataFrame([(f"FD_{k:X}",) for k in range(0, 3000, 7)] + [("FD",), ("-4",)], "feed string")
    plans, write = [], getattr(intake, "written", None)
    monkeypatch.setattr(intake, "written", lambda df, name: plans.append(df) or write(df, name), raising=False)
    found = intake.matched_by_table(names, feeds, **({} if chars else {"broadcast_chars": 0}))
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in [*plans, found]]
    assert not any("BuildLeft" in plan for plan in plans)
    assert chars or not any("BroadcastHashJoin" in plan for plan in plans[:-1])
    assert rows_of(found) == rows_of(names.join(feeds, F.contains("path", F.col("feed")), "left"))


def test_a_cut_run_started_again_logs_each_file_once(spark, tmp_path):
    folder, log, checkpoint = (str(tmp_path / n) for n in ("drop", "log", "checkpoint"))
    made = [(f"drop/FD_SALES-0101200{k}-{k}.csv", f"FD_SALES-0101200{k}-{k}.csv") for k in range(6)]
    rows = spark.createDataFrame(made, "path string, name string").withColumn("file_date", F.to_date(F.lit("2000-01-01")))
    for k in range(3):
        rows.where(F.col("name").rlike(f"-[{2 * k}{2 * k + 1}][.]")).coalesce(1).write.mode("append").parquet(folder)

    class Cut(Exception):
        pass

    def cut_after_writing(frame, batch):
        streamed.append_once(intake.file_classify, log)(frame, batch)
        if batch == 1:
            raise Cut("the driver is lost before the batch is committed")

    files = streamed.listed_files(spark, folder, 1)
    query = files.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(cut_after_writing).start()
    with pytest.raises(Exception):
        query.awaitTermination()
    assert streamed.read_log(spark, log).count() == 4
    for _ in range(2):  # the second start finds nothing new
        streamed.run_intake(files, log, checkpoint)
        found = streamed.read_log(spark, log)
        assert rows_of(found.drop(streamed.BATCH)) == rows_of(intake.file_classify(rows))
    assert found.select(streamed.BATCH).distinct().count() == 3
    rows.withColumn("name", F.concat(F.lit("late"), "name")).coalesce(1).write.mode("append").parquet(folder)
    streamed.run_intake(files, log, checkpoint)
    assert streamed.read_log(spark, log).count() == 12
