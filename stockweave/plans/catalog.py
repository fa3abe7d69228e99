"""One query per operator over the base tables: name -> (spark, root) -> DataFrame."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave import columns as c
from stockweave.operators import audit, cascade, daily, digests, intake, metrics, prepare, rolling, split, state, trees
from stockweave.plans import audit_store
from stockweave.plans.feature_store import INPUT, features_of_day, historical_features, incremental_features, start_state
from stockweave.sources import bucketed, derived, models, storage
from stockweave.sources.shared import fresh_path, written
from stockweave.sources.tables import panel, store_lines, table
from stockweave.streaming import intake as streamed

AS_OF = "2000-06-30"
RUN_DATE = "20000630"
REQUIRED = ["FD_STORE_INV", "FD_SALES", "FD_RETURNS"]
MASTERS = ["FD_SKU_MASTER", "FD_CARRIER_DETAILS"]
HOLIDAYS = ["19970704", "19980704", "19981225", "19990704"]
RULES = [
    prepare.Rule("quantity_positive", "l_quantity > 0"),
    prepare.Rule("quantity_below_46", "l_quantity < 46"),
    prepare.Rule("discount_within_bounds", "l_discount between 0 and 0.09"),
    prepare.Rule("ship_date_present", "l_shipdate is not null"),
    prepare.Rule("return_flag_known", "l_returnflag in ('A', 'N', 'R')"),
]
QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def audited(spark: SparkSession, root: str) -> DataFrame:
    return audit.apply_audit(panel(spark, root))


def stored_audited(spark: SparkSession, root: str, columns: list[str] = INPUT) -> DataFrame:
    """The columns of the audited panel a plan reads, written once: the branches of a plan that
    joins a frame with an aggregate of itself then scan it, not the base tables."""
    return written(audited(spark, root).select(*columns), "audited")


def predicted(spark: SparkSession, root: str, model: str = "new") -> DataFrame:
    return cascade.cascade_predict(derived.scored_panel(panel(spark, root), model))


def files(spark: SparkSession, root: str) -> DataFrame:
    return derived.dropped_files(spark, root)


def order_dates(spark: SparkSession, root: str, status: str | None = None) -> DataFrame:
    orders = table(spark, root, "orders")
    if status:
        orders = orders.where(F.col("o_orderstatus") == status)
    return orders.select(F.col("o_orderdate").cast("date").alias("file_date")).distinct()


def dated_files(spark: SparkSession, root: str) -> DataFrame:
    return intake.day_files(intake.match_date_formats(files(spark, root), order_dates(spark, root)))


def spine(spark: SparkSession, root: str) -> DataFrame:
    """Every day from five days before the first order to five after the last, of either
    status, holidays apart: days without any file occur at all sizes."""
    ends = {"F": F.date_sub(F.min("file_date"), 5), "O": F.date_add(F.max("file_date"), 5)}
    known = order_dates(spark, root, "F").unionByName(order_dates(spark, root, "O"))
    sides = [order_dates(spark, root, s).unionByName(known.agg(x.alias("file_date"))) for s, x in ends.items()]
    return intake.exclude_holidays(intake.date_gap_fill(*sides), HOLIDAYS)


def working_files(spark: SparkSession, root: str) -> DataFrame:
    """Files of all days but holidays."""
    days = intake.exclude_holidays(order_dates(spark, root), HOLIDAYS)
    return intake.day_files(intake.match_date_formats(files(spark, root), days))


def full_log(spark: SparkSession, root: str) -> DataFrame:
    return intake.intake_log(working_files(spark, root), spine(spark, root), RUN_DATE, required=REQUIRED)


def run_log(spark: SparkSession, root: str) -> DataFrame:
    """Intake log over all dates, each date being its own run."""
    log = full_log(spark, root)
    return log.withColumn("run_date", F.col("file_date"))


def over_panel(name: str, step, columns: list[str], source=audited) -> None:
    """Register an operator on the (audited) panel, returning the key and its columns."""

    def run(spark: SparkSession, root: str) -> DataFrame:
        return step(source(spark, root)).select(*c.KEY, *columns)

    QUERIES[name] = run


# ---- scans and sinks -------------------------------------------------------


@query
def scan_csv_infer(spark, root):
    path = fresh_path(spark, "csv")
    storage.sink_csv(panel(spark, root).select(*c.KEY, c.SALES_UNITS, c.CAT), path)
    return storage.scan_csv(spark, path)


@query
def scan_partition(spark, root):
    path = fresh_path(spark, "panel")
    storage.sink_parquet(panel(spark, root).select(*c.KEY, c.LOCATION_GROUP, c.END_SOH), path, [c.LOCATION_GROUP])
    return storage.scan_partition(spark, path, 2)


def _stored_layers(spark, root):
    path = fresh_path(spark, "layers")
    layers = prepare.with_location_group(cascade.prediction_layers(predicted(spark, root)))
    storage.sink_parquet(layers, path, [c.LOCATION_GROUP, "layer"])
    return path


@query
def scan_glob(spark, root):
    layer = storage.scan_layer(spark, _stored_layers(spark, root), "step_3")
    return layer.select(*c.KEY, "orig_pred", "orig_pred_low", "orig_pred_high")


@query
def scan_group_folders(spark, root):
    """One group of plain, non-partition folders."""
    path, rows = fresh_path(spark, "folders"), written(panel(spark, root).select(*c.KEY, c.LOCATION_GROUP, c.END_SOH), "panel")
    storage.sink_group_folders(rows, path, GROUPS)
    return storage.scan_group_folders(spark, path).where(F.col(c.LOCATION_GROUP) == 2)


@query
def scan_csv_kept(spark, root):
    """Order lines as CSV, some cut short, some with text for a number: counts of rows and rejects."""
    path = fresh_path(spark, "lines")
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    price = F.when(k % 11 == 0, "n/a").otherwise(F.col("l_quantity").cast("int").cast("string"))
    line = F.concat_ws(",", k, n, F.when(k % 13 == 0, F.lit(None)).otherwise(price), F.concat(F.lit('"a,'), n, F.lit('"')))
    table(spark, root, "lineitem").select(line.alias("value")).write.text(path)
    rows, rejects = storage.scan_csv_kept(spark, path, "order_key long, line_no int, quantity int, remark string")
    kept = rows.agg(F.count(F.lit(1)).alias("n_lines")).select(F.lit("row").alias("reason"), F.lit(None).cast("string").alias("field"), "n_lines")
    return kept.unionByName(storage.drift(rejects))


@query
def scan_csv_glob(spark, root):
    path = fresh_path(spark, "predictions")
    final = predicted(spark, root).select(*c.KEY, "OOS", c.LOCATION_GROUP)
    final.hint("rebalance", c.LOCATION_GROUP).write.option("header", True).partitionBy(c.LOCATION_GROUP).csv(path)
    return storage.scan_csv(spark, f"{path}/*/part-*.csv", "SKU string, LOCATION int, DATE date, OOS int")


@query
def sink_parquet(spark, root):
    path = fresh_path(spark, "audited")
    storage.sink_parquet(audited(spark, root).select(*c.KEY, c.ONHAND_RECORDED, c.AUDIT_ADJ_UNITS, c.CAT), path)
    return spark.read.parquet(path)


@query
def sink_partitioned(spark, root):
    path = fresh_path(spark, "split")
    storage.sink_parquet(split.split_incremental(panel(spark, root)).select(*c.KEY, "data_split"), path, ["data_split"])
    return spark.read.parquet(path).withColumn("data_split", F.col("data_split").cast("string"))


@query
def sink_csv_projected(spark, root):
    """All rows of the five files, read back."""
    rows = written(predicted(spark, root), "predicted")
    back = []
    for layer in cascade.LAYERS:
        path = fresh_path(spark, layer)
        part = cascade.prediction_layer(rows, layer)
        storage.sink_csv(part, path)
        read = storage.scan_csv(spark, path, part.schema.simpleString()[7:-1].replace(":", " "))
        back.append(read.withColumn("layer", F.lit(layer)))
    return cascade.union_concat(*back)


@query
def sink_report(spark, root):
    path = fresh_path(spark, "report")
    storage.sink_csv(actual_vs_predicted(spark, root), path)
    return storage.scan_csv(spark, path, "SKU string, LOCATION int, DATE date, ACTUAL_OOS_FLAG int, OOS int")


@query
def sink_metrics(spark, root):
    path = fresh_path(spark, "metrics")
    document = metrics.overall_metrics(predicted(spark, root))
    storage.sink_json(document, path)
    return spark.read.schema(document.schema).json(path)


@query
def master_passthrough(spark, root):
    raw, out = fresh_path(spark, "master_csv"), fresh_path(spark, "master")
    part = table(spark, root, "part")
    storage.sink_csv(part, raw)
    storage.sink_parquet(storage.scan_csv(spark, raw, part.schema.simpleString()[7:-1].replace(":", " ")), out)
    return spark.read.parquet(out)


@query
def merge_consolidated(spark, root):
    history = fresh_path(spark, "history")
    day = written(panel(spark, root).select(*c.KEY, c.LOCATION_GROUP, c.SALES_UNITS), "day")
    for load_date in (AS_OF, "2000-07-01", AS_OF):  # the rerun replaces its own day only
        storage.merge_consolidated(day, history, load_date)
    return spark.read.parquet(history).groupBy(c.LOCATION_GROUP, c.LOAD_DATE).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(c.SALES_UNITS).alias("sales_units")
    )


@query
def file_catalog(spark, root):
    """Folders of stored layers, one file each, with the number of their files and whether all
    have content and the bucket of the place they were written to; names and lengths of part
    files are not the same twice."""
    place = fresh_path(spark, "layers")
    layers = prepare.with_location_group(cascade.prediction_layers(predicted(spark, root)))
    layers.repartition(c.LOCATION_GROUP, "layer").write.partitionBy(c.LOCATION_GROUP, "layer").parquet(place)
    bucket = re.match(r"^(?:[a-z0-9]+://(?=[^/]))?(?:[a-z0-9]+:)?/*([^/]+)/", place)[1]
    found = storage.file_catalog(spark, place).where(F.col("name").endswith(".parquet"))
    return found.groupBy(F.regexp_extract("path", f"({c.LOCATION_GROUP}=[^/]+/layer=[^/]+)/[^/]+$", 1).alias("folder")).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.bool_and(F.col("length") > 0).alias("have_content"),
        F.bool_and(F.col("bucket") == bucket).alias("in_bucket"),
    )


# ---- intake ----------------------------------------------------------------


@query
def file_parse(spark, root):
    return intake.file_parse(files(spark, root))


@query
def file_pattern(spark, root):
    return intake.file_pattern(files(spark, root)).select("name", "pattern_feed")


@query
def file_extension(spark, root):
    return intake.file_extension(files(spark, root)).select("name", "extension", "permitted", "permitted_any_case")


@query
def file_classify(spark, root):
    return intake.file_classify(files(spark, root))


@query
def feeds_by_table(spark, root):
    """Files against a reference table of feeds with day and month, and the plain feeds."""
    rows = files(spark, root).select("path", "name")
    dated = rows.select(F.regexp_extract("name", "^[A-Z_]+-[0-9]{4}", 0).alias("feed")).distinct()
    plain = spark.createDataFrame([(f,) for f in intake.FEEDS], "feed string")
    return intake.matched_by_table(rows, dated.unionByName(plain)).select("name", "feed")


@query
def intake_stream(spark, root):
    """The classification of all dropped files, taken in as a stream in several batches."""
    folder, log, checkpoint = (fresh_path(spark, name) for name in ("drop", "log", "stream"))
    files(spark, root).repartition(4).write.parquet(folder)
    streamed.run_intake(streamed.listed_files(spark, folder, 1), log, checkpoint)
    return streamed.read_log(spark, log).drop(streamed.BATCH)


@query
def file_route(spark, root):
    routed = intake.file_route(intake.file_classify(files(spark, root)), "out/success/", "out/error/")
    return routed.select("name", "status", "target")


@query
def file_table_groups(spark, root):
    routed = intake.file_route(intake.file_classify(files(spark, root)), "out/success/", "out/error/")
    return intake.file_table_groups(routed)


@query
def received_by_date(spark, root):
    return intake.received_by_date(intake.file_parse(files(spark, root)))


@query
def missing_mandatory(spark, root):
    return intake.missing_mandatory(intake.file_parse(files(spark, root)), REQUIRED)


@query
def missing_feeds(spark, root):
    return intake.missing_feeds(intake.file_parse(files(spark, root)), REQUIRED)


@query
def match_date_formats(spark, root):
    return intake.match_date_formats(files(spark, root), order_dates(spark, root))


@query
def date_gap_fill(spark, root):
    return intake.date_gap_fill(order_dates(spark, root, "F"), order_dates(spark, root, "O"))


@query
def exclude_holidays(spark, root):
    return intake.exclude_holidays(order_dates(spark, root), HOLIDAYS)


@query
def last_run_rows(spark, root):
    return intake.last_run_rows(run_log(spark, root)).select("component", "run_date", "file_date", "priority", "missed_files")


@query
def missing_from_log(spark, root):
    return intake.missing_from_log(run_log(spark, root))


@query
def missing_reconcile(spark, root):
    """Feeds missing by strict name pattern against feeds missing by the log's looser match."""
    dated = dated_files(spark, root)
    # one row per file and required feed; a feed no file of the day brings is missing by both
    strict = F.coalesce(intake.name_matches(F.col("name"), F.col("feed")), F.lit(False))
    wanted = dated.where(F.col("feed").isin(REQUIRED)).groupBy("file_date", "feed").agg(
        (~F.bool_or(strict)).alias("in_input"), (~F.bool_or("permitted")).alias("in_log")
    )
    return intake.missing_reconcile(wanted)


@query
def distinct_dates(spark, root):
    return order_dates(spark, root)


@query
def date_min_max(spark, root):
    return intake.date_min_max(order_dates(spark, root))


@query
def date_sort(spark, root):
    return order_dates(spark, root).orderBy("file_date")


@query
def day_route(spark, root):
    return intake.day_route(working_files(spark, root), spine(spark, root), REQUIRED)


@query
def intake_log(spark, root):
    return full_log(spark, root)


@query
def unpermitted_log(spark, root):
    return intake.unpermitted_log(dated_files(spark, root), RUN_DATE)


@query
def log_append(spark, root):
    path = fresh_path(spark, "log")
    log = full_log(spark, root)
    for _ in range(2):
        storage.sink_csv(log, path, append=True)
    schema = ", ".join(f"{n} string" for n in intake.LOG_COLUMNS)
    return storage.scan_csv(spark, path, schema).fillna("")


@query
def legacy_file_route(spark, root):
    return intake.legacy_file_route(dated_files(spark, root), "out/legacy/")


@query
def relative_date(spark, root):
    offset = (F.col("o_orderkey") % 7 - 3).cast("int")
    base = F.col("o_orderdate").cast("date")
    return table(spark, root, "orders").select(
        "o_orderkey", offset.alias("offset_days"), intake.relative_date(base, offset).alias("moved")
    )


@query
def strip_hyphens(spark, root):
    return files(spark, root).select("name", intake.strip_hyphens(F.col("name")).alias("stripped"))


# ---- prepare ---------------------------------------------------------------


@query
def location_group(spark, root):
    stores = table(spark, root, "supplier").select("s_suppkey", (F.col("s_nationkey") * 10).cast("int").alias(c.LOCATION))
    return prepare.with_location_group(stores)


@query
def table_route(spark, root):
    routed = prepare.table_route(intake.file_classify(files(spark, root)), MASTERS)
    return routed.where("status = 'all_valid'").select("name", "feed", "route")


@query
def location_group_list(spark, root):
    return prepare.location_groups(panel(spark, root))


@query
def denormalize(spark, root):
    return prepare.denormalize(*derived.fact_tables(written(store_lines(spark, root), "lines")))


GROUPS = [1, 2, 3]


def stored_feeds(spark: SparkSession, root: str) -> prepare.Feeds:
    """Feeds in folders by location group, as the intake leaves them."""
    folders = {}
    for name, rows in (("lines", prepare.with_location_group(store_lines(spark, root))), ("stock", panel(spark, root))):
        folders[name] = fresh_path(spark, name)
        rows.hint("rebalance", c.LOCATION_GROUP).write.partitionBy(c.LOCATION_GROUP).parquet(folders[name])
    return derived.panel_feeds(*(spark.read.parquet(folders[name]) for name in ("lines", "stock")))


@query
def denormalize_features(spark, root):
    """Feeds of three location groups to the panel, through the audit chain, to the features."""
    rows = prepare.denormalize_panel(stored_feeds(spark, root), GROUPS)
    return historical_features(written(audit.apply_audit(rows).select(*INPUT), "audited"))


@query
def denormalize_day(spark, root):
    """The panel rows of one day."""
    rows = prepare.denormalize_panel(stored_feeds(spark, root), as_of=AS_OF)
    return rows.select(*c.KEY, *PANEL_MEASURES)


PANEL_MEASURES = [
    c.LOCATION_GROUP, c.CAT, c.DEPT, c.LOB, c.SALES_COUNT, c.SALES_UNITS, c.GROSS_SALES, c.RETURN_UNITS, c.IN_TRANSIT, c.ADJ_UNITS,
    c.DSD_UNITS, c.UNIT_RETAIL, c.END_SOH, c.START_TOTAL, c.END_TOTAL, c.AUDIT_FLAG, c.AUDIT_DATE, c.AUDIT_UNITS,
]


@query
def validate_rules(spark, root):
    return prepare.rule_report(table(spark, root, "lineitem"), RULES)


@query
def validate_errors(spark, root):
    checked = prepare.failed_rules(table(spark, root, "lineitem"), RULES)
    return prepare.error_rows(checked).select("l_orderkey", "l_linenumber", "failed_rules")


@query
def validate_success(spark, root):
    checked = prepare.failed_rules(table(spark, root, "lineitem"), RULES)
    return prepare.valid_rows(checked).select("l_orderkey", "l_linenumber", "l_quantity")


@query
def validate_once(spark, root):
    """The report, and the rows of either outcome, of one scan."""
    report, good, bad = prepare.validate_once(table(spark, root, "lineitem"), RULES, fresh_path(spark, "validated"))
    tally = lambda df, name: df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("rule"), "n_rows", F.lit(0).cast("long").alias("n_failed"), F.lit(name).alias("part")
    )
    broken = bad.select(F.explode("failed_rules").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n_rows"))
    broken = broken.select("rule", "n_rows", F.col("n_rows").alias("n_failed"), F.lit("error rows").alias("part"))
    parts = report.withColumn("part", F.lit("report")).unionByName(tally(good, "success")).unionByName(tally(bad, "error"))
    return parts.unionByName(broken)


@query
def error_threshold(spark, root):
    lines = table(spark, root, "lineitem").withColumn("ship_day", F.col("l_shipdate").cast("date"))
    return prepare.error_threshold(prepare.failed_rules(lines, RULES), "ship_day", 0.2)


@query
def panel_differences(spark, root):
    """A stored panel against a copy in which rows of one group were changed, left out and added."""
    left, right = fresh_path(spark, "panel"), fresh_path(spark, "panel")
    rows = written(panel(spark, root).select(*c.KEY, c.LOCATION_GROUP, c.CAT, c.SALES_UNITS, c.END_SOH), "panel")
    code = F.when(F.col(c.LOCATION_GROUP) == 2, (F.col(c.END_SOH) + F.dayofyear(c.DATE)) % 40)
    code = F.coalesce(code, F.lit(39))
    copy = rows.where(code != 0).withColumns(
        {c.SALES_UNITS: F.when(code == 1, F.col(c.SALES_UNITS) + 1).otherwise(F.col(c.SALES_UNITS)), c.CAT: F.when(code != 2, F.col(c.CAT))}
    )
    added = rows.where(code == 3).withColumn(c.SKU, F.concat(c.SKU, F.lit("+")))
    storage.sink_parquet(rows, left, [c.LOCATION_GROUP])
    storage.sink_parquet(copy.unionByName(added), right, [c.LOCATION_GROUP])
    return digests.panel_differences(spark.read.parquet(left), spark.read.parquet(right))


@query
def panel_reconcile(spark, root):
    return prepare.panel_reconcile(panel(spark, root))


# ---- audit -----------------------------------------------------------------


def _after(*steps):
    def run(df):
        for step in steps:
            df = step(df)
        return df

    return run


@query
def audit_scope(spark, root):
    return audit.audit_scope(panel(spark, root), AS_OF).select(*c.KEY, c.AUDIT_UNITS)


@query
def dedup_latest(spark, root):
    """Order lines as rows of the daily snapshot: many copies per key, loaded on the order's number."""
    lines = store_lines(spark, root).select(
        *c.KEY, F.date_add(c.DATE, F.pmod("order_key", F.lit(30)).cast("int")).alias(c.LOAD_DATE), "order_key", "line_no", "units"
    )
    return audit.dedup_latest(lines)


_balance = [audit.audit_day_units, audit.audit_backfill, audit.audit_balance_check]
over_panel("audit_day_units", audit.audit_day_units, [c.AUDIT_DAY_UNITS], panel)
over_panel("audit_backfill", audit.audit_backfill, [c.AUDIT_DATE, c.AUDIT_UNITS], panel)
over_panel("audit_balance_check", _after(*_balance), [c.AUDIT_UNITS], panel)
over_panel("audit_adj_units", _after(*_balance, audit.audit_adj_units), [c.AUDIT_ADJ_UNITS], panel)
over_panel("onhand_recorded", _after(*_balance, audit.audit_adj_units, audit.onhand_recorded), [c.ONHAND_RECORDED], panel)
over_panel(
    "dsd_correction",
    _after(*_balance, audit.audit_adj_units, audit.onhand_recorded, audit.dsd_correction),
    [c.DSD_UNITS, c.ONHAND_RECORDED],
    panel,
)
over_panel("last_cycle_count", audit.last_cycle_count, [c.LAST_CC_DATE], panel)
over_panel(
    "audit_prev_cc", _after(audit.last_cycle_count, *_balance, audit.audit_prev_cc), [c.AUDIT_PREV_CC_DATE], panel
)
over_panel("audit_adj_flag", _after(*_balance, audit.audit_adj_flag), [c.AUDIT_ADJ_FLAG], panel)
over_panel("pre_audit_cc_flag", lambda df: df, [c.PRE_AUDIT_CC_DAY_FLAG])
over_panel("audit_eop_soh", _after(*_balance, audit.audit_eop_soh), [c.AUDIT_ADJ_EOP_SOH], panel)
AUDIT_OUTPUT = [
    c.AUDIT_DAY_UNITS, c.AUDIT_DATE, c.AUDIT_UNITS, c.AUDIT_ADJ_UNITS, c.ONHAND_RECORDED, c.LAST_CC_DATE,
    c.AUDIT_PREV_CC_DATE, c.AUDIT_ADJ_FLAG, c.PRE_AUDIT_CC_DAY_FLAG, c.AUDIT_ADJ_EOP_SOH,
]
over_panel("audit_apply", lambda df: df, AUDIT_OUTPUT)


@query
def audit_daily_refresh(spark, root):
    """The audited panel as of AS_OF, its last three days taken in one by one: each rewrites
    the months its audits reach back to."""
    days = ["2000-06-28", "2000-06-29", AS_OF]
    rows, folder = written(panel(spark, root).where(F.col(c.DATE) <= F.to_date(F.lit(AS_OF))), "panel"), fresh_path(spark, "audits")
    audit_store.start(rows.where(F.col(c.DATE) < F.to_date(F.lit(days[0]))), folder, "2000-06-27")
    for before, day in zip(["2000-06-27", *days], days):
        audit_store.refresh(rows, folder, before, day)
    return spark.read.parquet(f"{folder}/audited").select(*c.KEY, *AUDIT_OUTPUT)

# ---- trailing features -----------------------------------------------------


def _trailing(name: str, wanted) -> None:
    over_panel(name, lambda df: rolling.trailing_features(df, wanted), list(wanted))


over_panel("rolling_filter", lambda df: rolling.rolling_filter(df, AS_OF), [c.SALES_UNITS], panel)
over_panel("daily_slice", lambda df: rolling.daily_filter(df, AS_OF), [c.SALES_UNITS], panel)
_trailing("itr_cogs", rolling.SALES_SUMS)
over_panel("itr_avg_start", rolling.opening_stock, [f"itr_avg_start_{n}" for n in (7, 14, 28)])
_trailing("in_out", rolling.IN_OUT)
_trailing("sales_windows", rolling.SALES_WINDOWS)
_trailing("stock_windows", rolling.STOCK_WINDOWS)
_trailing("oos_count", rolling.OOS_COUNTS)
over_panel("last_sale_day", rolling.last_sale_day, ["last_sale_day"])
_trailing("hist_sale_day_count", rolling.SALE_DAY_COUNTS)
over_panel("shrinkage_qty", rolling.shrinkage_qty, ["shrinkage_qty"])
over_panel(
    "categorical_shrinkage",
    rolling.categorical_shrinkage,
    ["categorical_shrinkage_qty_7", "categorical_shrinkage_scale_7"],
    lambda spark, root: stored_audited(spark, root, [*c.KEY, c.CAT, c.AUDIT_ADJ_UNITS]),
)
_trailing("avg_sale_28", rolling.SALE_28)
_trailing("avg_price_7", rolling.PRICE_7)
_trailing("avg_ip_qty", rolling.EOP_MEANS)
LEDGER_RATIOS = [f"LEDGER_BAL_RATIO_{n}" for n in (7, 14, 28)]
over_panel("ledger_balance", rolling.ledger_balance, LEDGER_RATIOS)

# ---- daily features --------------------------------------------------------

DAYS = (7, 14, 28)
over_panel("day_of_week", daily.day_of_week, ["day_of_week"], panel)
over_panel("clamp_eop_soh", daily.clamp_eop_soh, [c.AUDIT_ADJ_EOP_SOH], panel)
over_panel(
    "inventory_turnover",
    lambda df: daily.inventory_turnover(rolling.trailing_block(df)),
    [f"{x}_{n}" for x in ("itr_ratio", "inv_sales_ratio", "inv_shrinkage_ratio") for n in DAYS],
)
over_panel(
    "sell_through",
    lambda df: daily.sell_through(rolling.trailing_block(df)),
    [f"sell_through_rate_{n}" for n in (28, 56, 84)],
)
over_panel("sales_ratio", lambda df: daily.sales_ratio(rolling.trailing_block(df)), ["sales_ratio_7_28", "sales_ratio_28_84"])
over_panel("stock_ratio", lambda df: daily.stock_ratio(rolling.trailing_block(df)), ["stock_ratio_7_28", "stock_ratio_28_84"])
over_panel("sale_day_ratio", lambda df: daily.sale_day_ratio(rolling.trailing_block(df)), ["sale_day_ratio_28", "sale_day_ratio_84"])
over_panel(
    "index_scale",
    lambda df: daily.index_scale(rolling.trailing_features(df, rolling.SALE_28 | rolling.PRICE_7)),
    ["price_scale_7", "sale_scale_28"],
    lambda spark, root: stored_audited(spark, root, [*c.KEY, c.SALES_UNITS, c.UNIT_RETAIL]),
)
over_panel("oos_ratio", lambda df: daily.oos_ratio(rolling.trailing_block(df)), ["oos_ratio_28", "oos_ratio_84"])
over_panel("shelf_life", daily.shelf_life, ["REV_CUMULATIVE_SOH_SCALE"])
over_panel(
    "footfall",
    daily.footfall,
    ["daily_trans", "footfall_scale", "footfall_index"],
    lambda spark, root: written(panel(spark, root).select(*c.KEY, c.SALES_COUNT), "panel"),
)
over_panel(
    "event_flags",
    daily.event_flags,
    ["transfer_flag", "sales_flag", "returns_flag", "neg_cc_flag", "pos_cc_flag", "audit_day_flag"],
    panel,
)
over_panel(
    "decay_short", lambda df: daily.decay(state.decay_state(df), 7), ["sale_decay_decimal", "transfer_decay_decimal"], panel
)
over_panel(
    "decay", lambda df: daily.decay(state.decay_state(df)), ["sale_decay_decimal", "transfer_decay_decimal"], panel
)


def _state(spark, root):
    rows = stored_audited(spark, root)
    traffic = rows.groupBy(c.LOCATION, c.DATE).agg(F.sum(c.SALES_COUNT).alias("daily_trans"))
    return state.carry_state(rows, daily.footfall_by_day(traffic))


@query
def carry_state(spark, root):
    return _state(spark, root)


@query
def state_lag(spark, root):
    return state.state_lag(_state(spark, root))


@query
def advance_state(spark, root):
    """State of all pairs after AS_OF, from the state before it and the day's rows."""
    rows, today = stored_audited(spark, root), F.to_date(F.lit(AS_OF))
    past = rows.where(F.col(c.DATE) < today)
    traffic = past.groupBy(c.LOCATION, c.DATE).agg(F.sum(c.SALES_COUNT).alias("daily_trans"))
    history = state.carry_state(past, daily.footfall_by_day(traffic), state.UNITS)
    latest = F.max(F.struct(c.DATE, *state.STATE_COLUMNS, *state.UNITS)).alias("latest")
    before = written(history.groupBy(*c.PAIR).agg(latest).select(*c.PAIR, "latest.*"), "state")
    after = state.advance_state(before, rows.where(F.col(c.DATE) == today))
    return after.select(*c.KEY, *state.STATE_COLUMNS)


@query
def flagship_slice(spark, root):
    """Turnover and sell-through of the last 28 rows."""
    df = daily.sell_through(daily.inventory_turnover(rolling.trailing_block(audited(spark, root))))
    return df.select(*c.KEY, "itr_ratio_28", "sell_through_rate_28")


@query
def feature_assemble(spark, root):
    return historical_features(written(audited(spark, root).select(*INPUT), "audited"))


@query
def feature_assemble_bucketed(spark, root):
    """Audit chain and features over a panel table bucketed by pair."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = bucketed.read_by_pair(spark, bucketed.save_by_pair(panel(spark, root), buckets))
    return historical_features(audit.apply_audit(rows))


@query
def feature_assemble_incremental(spark, root):
    """One day on carried state, the panel as it stood that day."""
    known = panel(spark, root).where(F.col(c.DATE) <= F.to_date(F.lit(AS_OF)))
    rows = written(audit.apply_audit(known), "audited")
    traffic = rows.groupBy(c.LOCATION, c.DATE).agg(F.sum(c.SALES_COUNT).alias("daily_trans"))
    carried = written(state.carry_state(rows, daily.footfall_by_day(traffic)), "state")
    return incremental_features(rows, carried, AS_OF)


@query
def feature_daily_steps(spark, root):
    """Three days, each from the state partition of the day before and the day's rows."""
    days = ["2000-06-28", "2000-06-29", AS_OF]
    first, folder = F.to_date(F.lit(days[0])), fresh_path(spark, "state")
    rows = stored_audited(spark, root)
    start_state(rows.where(F.col(c.DATE) < first), folder, "2000-06-27")
    recent = fresh_path(spark, "days")
    rows.where(F.col(c.DATE).between(first, F.to_date(F.lit(AS_OF)))).write.partitionBy(c.LOAD_DATE).parquet(recent)
    made = [features_of_day(spark.read.parquet(recent), folder, a, b) for a, b in zip(["2000-06-27", *days], days)]
    return made[0].unionByName(made[1]).unionByName(made[2])


# ---- split, cascade, layers ------------------------------------------------

over_panel("data_split_historical", split.split_historical, ["data_split"], panel)
over_panel("data_split_incremental", split.split_incremental, ["data_split"], panel)
over_panel("split_filter", lambda df: split.split_filter(split.split_historical(df)), [c.SALES_UNITS], panel)
# the same operators where short histories are cut too, so that all parts occur at every size
over_panel("data_split_historical_short", lambda df: split.split_historical(df, 30), ["data_split"], panel)
over_panel("split_filter_short", lambda df: split.split_filter(split.split_historical(df, 30)), [c.SALES_UNITS], panel)


@query
def feature_cast(spark, root):
    text = panel(spark, root).select(
        *c.KEY, F.substring(c.SKU, 7, 9).alias("brand_text"), F.col(c.END_SOH).cast("string").alias("stock_text"), c.CAT
    )
    return cascade.feature_cast(text, ["brand_text", "stock_text", c.CAT])


CASCADE_OUTPUT = [
    "step", "binary_pred", "hl_orig_pred", "orig_pred", "orig_pred_temp", "orig_pred_low", "orig_pred_high", "OOS",
]
over_panel("cascade_predict", lambda df: df, CASCADE_OUTPUT, predicted)


def given_models() -> dict[str, trees.Ensemble]:
    return {k: trees.from_dump(dump, models.BASE[k], k in models.LOGISTIC) for k, dump in models.DUMPS.items()}


@query
def cascade_compiled(spark, root):
    """Scores of the given models, compiled to expressions, and the cascade on them."""
    scored = trees.score_with_trees(panel(spark, root), given_models())
    scores = ["binary_pred", "hl_score", "low_pred", "high_pred"]
    rounded = scored.withColumns({n: F.round(n, 6) for n in scores})
    return cascade.cascade_predict(rounded).select(*c.KEY, "binary_pred", "low_pred", "high_pred", "hl_score", "step", "orig_pred_low", "orig_pred_high")


@query
def cascade_models(spark, root):
    """The cascade on scores of fitted models, the older nine tenths of each pair as training data."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    features = [c.BEGIN_SOH, c.END_SOH, c.SALES_UNITS, c.RETURN_UNITS, c.IN_TRANSIT]
    scored_rows = derived.scored_panel(panel(spark, root), keep=tuple(features))
    parts = written(split.split_incremental(scored_rows), "split")
    train = VectorAssembler(inputCols=features, outputCol="__x").transform(split.split_filter(parts, "train"))
    small = {"featuresCol": "__x", "maxIter": 3, "maxDepth": 3, "seed": 1}
    low = F.col("BINARY_HL_TARGET_CLASSIFICATION") == 1
    fitted = {
        "binary": GBTClassifier(labelCol="BINARY_TARGET_CLASSIFICATION", **small).fit(train),
        "hl": GBTClassifier(labelCol="BINARY_HL_TARGET_CLASSIFICATION", **small).fit(train),
        "low": GBTRegressor(labelCol="TARGET_REGRESSION", **small).fit(train.where(low)),
        "high": GBTRegressor(labelCol="TARGET_REGRESSION", **small).fit(train.where(~low)),
    }
    compiled = {key: trees.from_fitted(model, features) for key, model in fitted.items()}
    scored = trees.score_with_trees(split.split_filter(parts), compiled)
    out = cascade.cascade_predict(scored)
    score = lambda name: F.col(name).between(0, 1).cast("int")
    limits = cascade.Thresholds()
    step = F.when(F.col("binary_pred") > limits.out_of_stock, 1).when(F.col("hl_orig_pred") > limits.low_stock, 3).otherwise(4)
    # fitted trees have no statement; what must hold for any scores has
    return out.select(
        *c.KEY,
        (score("binary_pred") * F.coalesce(score("hl_orig_pred"), F.lit(1))).alias("scores_are_shares"),
        (F.col("orig_pred_low") <= F.col("orig_pred_high")).cast("int").alias("range_is_ordered"),
        (F.col("step") == step).cast("int").alias("step_fits_scores"),
    )


@query
def range_postprocess(spark, root):
    rows = derived.scored_panel(panel(spark, root)).withColumn("orig_pred", F.col("high_pred"))
    return cascade.range_postprocess(rows).select(*c.KEY, "orig_pred_temp", "orig_pred_low", "orig_pred_high")


@query
def oos_flag(spark, root):
    rows = derived.scored_panel(panel(spark, root)).withColumn("orig_pred", F.col("low_pred"))
    return cascade.oos_flag(cascade.range_postprocess(rows)).select(*c.KEY, "OOS")


@query
def prediction_layers(spark, root):
    return cascade.prediction_layers(predicted(spark, root))


@query
def union_concat(spark, root):
    rows = predicted(spark, root)
    return cascade.union_concat(*(cascade.prediction_layer(rows, n) for n in ("final", "step_2", "step_4")))


# ---- metrics ---------------------------------------------------------------


@query
def actual_vs_predicted(spark, root):
    rows = panel(spark, root)
    guess = cascade.cascade_predict(derived.scored_panel(rows)).select(*c.KEY, "OOS")
    return metrics.actual_vs_predicted(derived.actuals(rows), guess)


@query
def confusion_counts(spark, root):
    return metrics.confusion_counts(actual_vs_predicted(spark, root))


@query
def confusion_percent(spark, root):
    return metrics.confusion_percent(metrics.confusion_counts(actual_vs_predicted(spark, root)))


@query
def classification_metrics(spark, root):
    return metrics.classification_metrics(
        predicted(spark, root), "step_1", "BINARY_TARGET_CLASSIFICATION", "binary_pred"
    )


@query
def roc_auc(spark, root):
    return metrics.roc_auc(predicted(spark, root), "BINARY_TARGET_CLASSIFICATION", "binary_pred")


@query
def roc_auc_labels(spark, root):
    """Text length as a score of quality: many distinct scores."""
    docs = table(spark, root, "documents").select("doc_id", "n_chars")
    return metrics.roc_auc(docs.join(table(spark, root, "labels"), "doc_id"), "quality", "n_chars")


@query
def regression_metrics(spark, root):
    rows = predicted(spark, root).where("step = 3")
    return metrics.regression_metrics(rows, "step_3", "TARGET_REGRESSION", "orig_pred", 13)


@query
def stock_confusion(spark, root):
    return metrics.stock_confusion(predicted(spark, root))


@query
def range_performance(spark, root):
    return metrics.range_performance(predicted(spark, root))


@query
def book_vs_model(spark, root):
    return metrics.book_vs_model(predicted(spark, root))


@query
def revenue_impact(spark, root):
    return metrics.revenue_impact(predicted(spark, root))


@query
def overall_metrics(spark, root):
    return metrics.overall_metrics(predicted(spark, root))


def _two_models(spark, root):
    base = panel(spark, root)
    both = derived.scored_panel(base, "new").withColumn("model", F.lit("new")).unionByName(
        derived.scored_panel(base, "prod").withColumn("model", F.lit("prod"))
    )
    return written(cascade.cascade_predict(both), "two_models")


@query
def champion_compare(spark, root):
    return metrics.champion_compare(_two_models(spark, root), 13)


@query
def promotion_decision(spark, root):
    scores = metrics.overall_metrics(_two_models(spark, root), ["model"])
    return metrics.promotion_decision(scores.select("model", F.col("f1_score").alias("score")))
