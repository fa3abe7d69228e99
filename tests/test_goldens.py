"""Values worked out by hand."""

import datetime

import pytest
from pyspark.sql import functions as F

from stockweave.functions.exprs import divide, fixed_ratio, footfall_bin, min_max, ratio, ratio_neg
from stockweave.operators import cascade, intake

D = datetime.date


def one(spark, schema, row, expr):
    return spark.createDataFrame([row], schema).select(expr).first()[0]


@pytest.mark.parametrize("up,down,want", [(5, 2, 2.5), (5, 0, 100.0), (None, 2, 100.0), (5, None, 100.0)])
def test_ratio(spark, up, down, want):
    assert one(spark, "a int, b int", (up, down), ratio(F.col("a"), F.col("b"))) == want


@pytest.mark.parametrize("hist,cur,want", [(8, 3, 1.5), (0, 3, 100.0), (None, 3, 100.0), (8, None, 100.0)])
def test_divide(spark, hist, cur, want):
    assert one(spark, "h int, c int", (hist, cur), divide(F.col("h"), F.col("c"), 4)) == want


@pytest.mark.parametrize(
    "up,down,want", [(5, 2, 2.5), (5, 0, 100.0), (-5, 0, -100.0), (None, 2, -100.0), (5, None, -100.0), (None, 0, -100.0)]
)
def test_ratio_neg(spark, up, down, want):
    assert one(spark, "a int, b int", (up, down), ratio_neg(F.col("a"), F.col("b"))) == want


def test_zero_range_is_null(spark):
    assert one(spark, "x int", (5,), min_max(F.col("x"), F.lit(5), F.lit(5))) is None
    assert one(spark, "x int", (5,), fixed_ratio(F.col("x"), F.lit(0))) is None


@pytest.mark.parametrize("scale,want", [(0.0, 1), (0.1, 1), (0.11, 2), (0.5, 5), (1.0, 10), (None, 1)])
def test_footfall_bins(spark, scale, want):
    assert one(spark, "s double", (scale,), footfall_bin(F.col("s"))) == want


@pytest.mark.parametrize(
    "pred,book,want",
    [
        (1.0, 100, (100, 85, 115)),
        (1.0, 0, (0, 0, 1)),
        (1.0, 2, (2, 0, 2)),
        (0.5, 4, (2, 0, 2)),
        (1.0, 3, (3, 1, 3)),
        (0.125, 100, (12, 10, 14)),  # halves round to even
        (1.0, 7, (7, 6, 8)),
        (1.0, -2, (-2, 0, -1)),
    ],
)
def test_range(spark, pred, book, want):
    df = spark.createDataFrame([(pred, book)], "orig_pred double, CURDAY_IP_QTY_EOP_SOH bigint")
    row = cascade.range_postprocess(df).first()
    assert (row.orig_pred_temp, row.orig_pred_low, row.orig_pred_high) == want


FILES = {
    "FD_RETURNS-01072023-1231123.csv": ("all_valid", "FD_RETURNS"),
    "FD_RETURNS-02072023-1231124.csv": ("all_valid", "FD_RETURNS"),
    "FD_RETURNS-03072023-1231126.csv": ("all_valid", "FD_RETURNS"),
    "FD_STORE_INV-01072023-1231127.csv": ("all_valid", "FD_STORE_INV"),
    "FD_STORE_INV-03072023-1231129.csv": ("all_valid", "FD_STORE_INV"),
    "FD_STORE_INV-03072023-1231131-23.csv": ("file_name_error", ""),
    "FD_STORE_INV-03072023_1231131-23.csv": ("file_name_error", ""),
    "FD_INV_ADJ_ERROR-0107202312-1231122.csv": ("file_name_error", ""),
    "FD_SALES-01072023-1.txt": ("valid_name", "FD_SALES"),
    "FD_SALES-01072023-1.csv.gz": ("all_valid", "FD_SALES"),
    "UNKNOWN-01072023-1.csv": ("file_name_error", ""),
}


def test_file_classes_and_targets(spark):
    rows = spark.createDataFrame([(f"drop/{n}", n) for n in FILES], "path string, name string")
    routed = intake.file_route(intake.file_classify(rows), "ok/", "bad/")
    got = {r["name"]: r for r in routed.collect()}
    assert {n: (r.status, r.feed) for n, r in got.items()} == FILES
    assert got["FD_SALES-01072023-1.txt"].target == "bad/extension_error/FD_SALES/FD_SALES-01072023-1.txt"
    assert got["UNKNOWN-01072023-1.csv"].target == "bad/file_name_error/UNKNOWN-01072023-1.csv"
    assert got["FD_SALES-01072023-1.csv.gz"].target == "ok/FD_SALES/FD_SALES-01072023-1.csv.gz"


def test_missing_required_by_date_token(spark):
    eight = list(FILES)[:8]
    rows = spark.createDataFrame([(n, n) for n in eight], "path string, name string")
    got = dict(intake.missing_mandatory(intake.file_parse(rows)).collect())
    assert got == {
        "01072023": "None",
        "02072023": "FD_STORE_INV",
        "03072023": "None",
        "03072023_1231131": "None",
        "0107202312": "FD_STORE_INV",
    }


def test_gap_fill_and_holidays(spark):
    one_day = lambda d: spark.createDataFrame([(d,)], "file_date date")
    filled = intake.date_gap_fill(one_day(D(2023, 7, 1)), one_day(D(2023, 7, 5)))
    assert sorted(r[0].day for r in filled.collect()) == [1, 2, 3, 4, 5]
    assert sorted(r[0].day for r in intake.exclude_holidays(filled).collect()) == [1, 3, 5]
    empty = one_day(D(2023, 7, 1)).where("false")
    assert [r[0].day for r in intake.date_gap_fill(one_day(D(2023, 7, 1)), empty).collect()] == [1]


def test_last_critical_run(spark):
    columns = ", ".join(f"{n} string" for n in intake.LOG_COLUMNS)
    fail = ("failed", "critical", "DATA_ING_ERR_001", "All Files missed for the day", "['FD_STORE_INV']", "", "", "")
    head = ("1", "2", "3", "Data Ingestion")
    log = spark.createDataFrame(
        [
            (*head, "20230630", "20230630", *fail),
            (*head, "20230701", "20230630", "success", "", "", "", "", "['FD_STORE_INV','FD_INV_ADJ']", "", ""),
            (*head, "20230701", "20230701", *fail),
        ],
        columns,
    )
    rows = intake.last_run_rows(log)
    assert [(r.run_date, r.file_date) for r in rows.collect()] == [("20230701", "20230701")]
    assert intake.missing_from_log(rows).collect() == [("20230701", "FD_STORE_INV")]


@pytest.mark.parametrize("offset,want", [(3, D(2023, 7, 12)), (1, D(2023, 7, 10)), (0, D(2023, 7, 10)), (-2, D(2023, 7, 8))])
def test_relative_date(spark, offset, want):
    assert one(spark, "d date, o int", (D(2023, 7, 10), offset), intake.relative_date(F.col("d"), F.col("o"))) == want
