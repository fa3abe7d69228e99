"""SQL statement of each query that SQL can express: name -> statement."""

from __future__ import annotations

import re

from oracles.blocks import (
    AUDITED,
    AUDIT_STEPS,
    AUDITED_TO,
    CASCADE_TAIL,
    CATEGORY,
    CLASSIFIED,
    DAILY,
    DATED,
    DAY,
    FEEDS,
    FILES,
    HIST,
    KEY,
    LINES,
    LOG,
    PAIR,
    PANEL,
    PARSED,
    PREDICTED,
    ROLLED,
    ROUTED,
    SCHEDULED,
    SCORED,
    STATE,
    TWO_MODELS,
    decay,
    fixed,
    percent,
    ranged,
    rolling,
    shelf,
    traffic,
)
from stockweave.columns import FEATURES
from stockweave.sources.models import BASE, DUMPS, LOGISTIC

DAY_ = "2000-06-30"
STATEMENTS: dict[str, str] = {}


def put(name: str, ctes: str, body: str) -> None:
    STATEMENTS[name] = f"WITH {ctes.lstrip()}\n{body}" if ctes else body


def keyed(name: str, ctes: str, source: str, columns: list[str]) -> None:
    put(name, ctes, f"SELECT {KEY}, {', '.join(columns)} FROM {source}")


# scans and sinks
keyed("scan_csv_infer", PANEL, "panel", ["CAST(SALES_UNITS AS INT) AS SALES_UNITS", "CAT"])
keyed("scan_partition", PANEL, "panel WHERE LOCATION_GROUP=2", ["DAY_END_SOH", "LOCATION_GROUP"])
keyed("scan_glob", PREDICTED, "predicted WHERE step=3", ["orig_pred", "orig_pred_low", "orig_pred_high"])
keyed("scan_group_folders", PANEL, "panel WHERE LOCATION_GROUP=2", ["LOCATION_GROUP", "DAY_END_SOH"])
put(
    "scan_csv_kept",
    "",
    """SELECT CASE WHEN l_orderkey%13=0 THEN 'columns' WHEN l_orderkey%11=0 THEN 'value' ELSE 'row' END AS reason,
  CASE WHEN l_orderkey%13<>0 AND l_orderkey%11=0 THEN 'quantity' END AS field, count(*) AS n_lines FROM lineitem GROUP BY 1, 2""",
)
keyed("scan_csv_glob", PREDICTED, "predicted", ["OOS"])
keyed("sink_parquet", AUDITED, "audited", ["ONHAND_RECORDED", "AUDIT_ADJ_UNITS", "CAT"])
keyed("rolling_filter", PANEL, f"panel WHERE DATE >= DATE '{DAY_}' - INTERVAL 100 DAY", ["SALES_UNITS"])
keyed("daily_slice", PANEL, f"panel WHERE LOAD_DATE = DATE '{DAY_}'", ["SALES_UNITS"])


def split(min_rows: int) -> str:
    return f""",
ranks AS (SELECT SKU, LOCATION, DATE, SALES_UNITS, row_number() OVER ({PAIR}) AS rk, count(*) OVER (PARTITION BY SKU, LOCATION) AS n FROM panel),
cuts AS (SELECT *, n*9//10 AS c1, (n*9//10)*9//10 AS c2 FROM ranks),
split AS (SELECT SKU, LOCATION, DATE, SALES_UNITS, CASE WHEN n<{min_rows} OR rk<=c2 THEN 'train' WHEN rk<=c1 THEN 'validation' ELSE 'test' END AS data_split FROM cuts)"""


keyed("sink_partitioned", PANEL + split(10), "split", ["data_split"])
keyed("data_split_historical", PANEL + split(270), "split", ["data_split"])
keyed("data_split_incremental", PANEL + split(10), "split", ["data_split"])
keyed("split_filter", PANEL + split(270), "split WHERE data_split='test'", ["SALES_UNITS"])
keyed("data_split_historical_short", PANEL + split(30), "split", ["data_split"])
keyed("split_filter_short", PANEL + split(30), "split WHERE data_split='test'", ["SALES_UNITS"])
put(
    "cascade_models",
    PANEL + split(10),
    f"SELECT {KEY}, 1::INT AS scores_are_shares, 1::INT AS range_is_ordered, 1::INT AS step_fits_scores FROM split WHERE data_split='test'",
)
# stored once, whatever the optimiser would choose for parts that are read several times
ACTUAL = re.sub(r"\b(panel|predicted) AS \(", r"\1 AS MATERIALIZED (", PREDICTED) + """,
actual AS MATERIALIZED (SELECT SKU, LOCATION, DATE, CASE WHEN DAY_END_SOH+AUDIT_UNITS<=0 THEN 1 ELSE 0 END AS ACTUAL_OOS_FLAG FROM panel WHERE AUDIT_FLAG=1),
report AS (SELECT a.*, p.OOS FROM actual a JOIN predicted p ON a.SKU=p.SKU AND a.LOCATION=p.LOCATION AND a.DATE=p.DATE)"""
put("sink_report", ACTUAL, "SELECT * FROM report")
put("actual_vs_predicted", ACTUAL, "SELECT * FROM report")
put("master_passthrough", "", "SELECT * FROM part")
put(
    "merge_consolidated",
    PANEL,
    f"""SELECT LOCATION_GROUP, l AS LOAD_DATE, count(*) AS n_rows, CAST(sum(SALES_UNITS) AS BIGINT) AS sales_units
FROM panel CROSS JOIN (SELECT unnest([DATE '{DAY_}', DATE '2000-07-01']) AS l) GROUP BY LOCATION_GROUP, l""",
)

# intake
put("file_parse", PARSED, "SELECT * FROM parsed")
put(
    "file_pattern",
    FILES,
    """SELECT f.name, min(feeds.feed) AS pattern_feed FROM files f LEFT JOIN feeds
ON regexp_matches(split_part(f.name,'.',1), '^'||feeds.feed||'-[0-9]{8}-[0-9]+$') GROUP BY f.name""",
)
put(
    "file_extension",
    FILES,
    """SELECT name, string_split(name,'.')[-1] AS extension, CAST(string_split(name,'.')[-1] IN ('csv','gz') AS INT) AS permitted,
CAST(lower(string_split(name,'.')[-1]) IN ('csv','gz') AS INT) AS permitted_any_case FROM files""",
)
put("file_classify", CLASSIFIED, "SELECT * FROM classified")
put("intake_stream", CLASSIFIED, "SELECT * FROM classified")
put(
    "feeds_by_table",
    FILES + """, refs AS (SELECT DISTINCT regexp_extract(name, '^[A-Z_]+-[0-9]{4}') AS feed FROM files UNION SELECT feed FROM feeds)""",
    "SELECT name, refs.feed FROM files LEFT JOIN refs ON refs.feed<>'' AND contains(files.path, refs.feed)",
)
put("file_route", ROUTED, "SELECT name, status, target FROM routed")


put("file_table_groups", ROUTED, "SELECT string_split(target,'/')[-2] AS directory, target FROM routed WHERE status='all_valid'")
put("received_by_date", PARSED, "SELECT DISTINCT date_token, feed FROM parsed")
MISSING = PARSED + """,
gap AS (SELECT t.date_token, r.feed FROM (SELECT DISTINCT date_token FROM parsed) t CROSS JOIN required r
  WHERE NOT EXISTS (SELECT 1 FROM parsed p WHERE p.date_token=t.date_token AND p.feed=r.feed))"""
put("missing_feeds", MISSING, "SELECT date_token, feed FROM gap")
put(
    "missing_mandatory",
    MISSING,
    """SELECT t.date_token, coalesce(string_agg(g.feed, ',' ORDER BY g.feed), 'None') AS missing
FROM (SELECT DISTINCT date_token FROM parsed) t LEFT JOIN gap g ON g.date_token=t.date_token GROUP BY t.date_token""",
)
put("match_date_formats", DATED, "SELECT * FROM dated")
put(
    "date_gap_fill",
    "ends AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders WHERE o_orderstatus IN ('F','O'))",
    "SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS file_date FROM ends",
)
DATES = "dates AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS file_date FROM orders)"
put(
    "exclude_holidays",
    DATES,
    "SELECT file_date FROM dates WHERE file_date NOT IN (DATE '1997-07-04', DATE '1998-07-04', DATE '1998-12-25', DATE '1999-07-04')",
)
put("distinct_dates", DATES, "SELECT file_date FROM dates")
put("date_sort", DATES, "SELECT file_date FROM dates ORDER BY file_date")
put("date_min_max", DATES, "SELECT max(file_date) AS max_date, min(file_date) AS min_date FROM dates")
put("intake_log", LOG, "SELECT * FROM log")
put(
    "last_run_rows",
    LOG,
    """SELECT component, file_date AS run_date, file_date, priority, missed_files FROM log WHERE priority='critical'
AND file_date=(SELECT max(file_date) FROM log WHERE priority='critical')""",
)
put(
    "missing_from_log",
    LOG,
    "SELECT DISTINCT file_date, unnest(string_split(missed_files, ',')) AS feed FROM log WHERE missed_files<>''",
)
put(
    "missing_reconcile",
    DAY + """,
dd AS (SELECT DISTINCT file_date FROM day),
want AS (SELECT dd.file_date, r.feed FROM dd CROSS JOIN required r),
strict AS (SELECT DISTINCT file_date, feed FROM day WHERE regexp_matches(split_part(name,'.',1), '^'||feed||'-[0-9]{8}-[0-9]+$')),
loose AS (SELECT DISTINCT file_date, feed FROM day WHERE permitted),
ga AS (SELECT * FROM want EXCEPT SELECT * FROM strict), gb AS (SELECT * FROM want EXCEPT SELECT * FROM loose)""",
    """SELECT file_date, feed, 'input' AS only_in FROM (SELECT * FROM ga EXCEPT SELECT * FROM gb)
UNION ALL SELECT file_date, feed, 'log' FROM (SELECT * FROM gb EXCEPT SELECT * FROM ga)""",
)
put(
    "day_route",
    LOG,
    """SELECT file_date, 3-got AS n_missing, CASE WHEN got=3 THEN 'success' ELSE 'error' END AS route FROM miss""",
)
put(
    "unpermitted_log",
    DAY,
    """SELECT '1' AS sub_proc_id, '2' AS run_id, '3' AS task_id, 'Data Ingestion' AS component, '20000630' AS run_date,
strftime(file_date,'%Y%m%d') AS file_date, 'failed' AS status, 'moderate' AS priority, '' AS error_code, '' AS error_message,
'' AS missed_files, '' AS processed_files, name AS unpermitted_files, '' AS extra FROM day WHERE NOT permitted AND feed IS NOT NULL""",
)
put("log_append", LOG, "SELECT * FROM log UNION ALL SELECT * FROM log")
put(
    "legacy_file_route",
    DAY,
    """SELECT file_date, name, feed, 'out/legacy/'||strftime(file_date,'%Y%m%d')||'/'||feed||'/'||name AS target
FROM day WHERE permitted AND feed IS NOT NULL""",
)
put(
    "relative_date",
    "",
    """SELECT o_orderkey, CAST(o_orderkey%7-3 AS INT) AS offset_days,
CAST(CAST(o_orderdate AS DATE)+CAST(CASE WHEN o_orderkey%7-3>0 THEN o_orderkey%7-4 ELSE o_orderkey%7-3 END AS INT) AS DATE) AS moved FROM orders""",
)
put("strip_hyphens", FILES, "SELECT name, replace(name,'-','') AS stripped FROM files")

# prepare
put(
    "location_group",
    "",
    """SELECT s_suppkey, CAST(s_nationkey*10 AS INT) AS LOCATION, CAST(round(s_nationkey*10/50.0) AS INT) AS LOCATION_GROUP FROM supplier""",
)
put(
    "table_route",
    CLASSIFIED,
    """SELECT name, feed, CASE WHEN feed IN ('FD_SKU_MASTER','FD_CARRIER_DETAILS') THEN 'master' ELSE 'fact' END AS route
FROM classified WHERE status='all_valid'""",
)
put("location_group_list", PANEL, "SELECT DISTINCT LOCATION_GROUP FROM panel")
put(
    "denormalize",
    PANEL,
    f"SELECT {KEY}, SALES_UNITS_WITHOUT_RETURN, RETURN_UNITS, IN_TRANSIT_UNITS, POS_ADJ_UNITS, NEG_ADJ_UNITS, CAT, DEPT FROM panel",
)
_RULES = {
    "quantity_positive": "l_quantity > 0",
    "quantity_below_46": "l_quantity < 46",
    "discount_within_bounds": "l_discount BETWEEN 0 AND 0.09::DOUBLE",
    "ship_date_present": "l_shipdate IS NOT NULL",
    "return_flag_known": "l_returnflag IN ('A','N','R')",
}
put(
    "panel_differences",
    PANEL + """, coded AS (SELECT *, CASE WHEN LOCATION_GROUP=2 THEN (DAY_END_SOH + dayofyear(DATE)) % 40 ELSE 39 END AS code FROM panel)""",
    """SELECT CASE WHEN code=3 THEN SKU || '+' ELSE SKU END AS SKU, LOCATION, DATE, LOCATION_GROUP,
  CASE code WHEN 0 THEN 'left_only' WHEN 3 THEN 'right_only' ELSE 'changed' END AS kind,
  CASE code WHEN 1 THEN 'SALES_UNITS' WHEN 2 THEN 'CAT' ELSE '' END AS fields FROM coded WHERE code BETWEEN 0 AND 3""",
)
put(
    "validate_rules",
    "",
    " UNION ALL ".join(
        f"SELECT '{n}' AS rule, count(*) AS n_rows, count(*) FILTER (NOT coalesce({x}, false)) AS n_failed FROM lineitem"
        for n, x in _RULES.items()
    ),
)
_failed = "concat_ws(',', " + ", ".join(f"CASE WHEN coalesce({x}, false) THEN NULL ELSE '{n}' END" for n, x in _RULES.items()) + ")"
CHECKED = f"checked AS (SELECT *, {_failed} AS failed_rules FROM lineitem)"
put(
    "validate_once",
    CHECKED,
    " UNION ALL ".join(
        f"""SELECT '{n}' AS rule, count(*) AS n_rows, count(*) FILTER (NOT coalesce({x}, false)) AS n_failed, 'report' AS part FROM lineitem
UNION ALL SELECT '{n}', count(*), count(*), 'error rows' FROM lineitem WHERE NOT coalesce({x}, false) HAVING count(*) > 0"""
        for n, x in _RULES.items()
    )
    + """ UNION ALL SELECT 'success', count(*) FILTER (failed_rules=''), 0, 'success' FROM checked
UNION ALL SELECT 'error', count(*) FILTER (failed_rules<>''), 0, 'error' FROM checked""",
)
put("validate_errors", CHECKED, "SELECT l_orderkey, l_linenumber, failed_rules FROM checked WHERE failed_rules<>''")
put("validate_success", CHECKED, "SELECT l_orderkey, l_linenumber, l_quantity FROM checked WHERE failed_rules=''")
put(
    "error_threshold",
    CHECKED,
    """SELECT CAST(l_shipdate AS DATE) AS ship_day, count(*) AS n_rows, count(*) FILTER (failed_rules<>'') AS n_failed,
CASE WHEN count(*) FILTER (failed_rules<>'') > 0.2::DOUBLE*count(*) THEN 'stop' ELSE 'proceed' END AS decision FROM checked GROUP BY 1""",
)
put(
    "panel_reconcile",
    PANEL,
    f"""SELECT {KEY}, CAST(1 AS BIGINT) AS n_rows, abs(gap) AS open_units, 'open_balance' AS reason FROM (SELECT *,
DAY_END_TOTAL-DAY_START_TOTAL-IN_TRANSIT_UNITS-DSD_TRANSFERRED_UNITS-coalesce(AUDIT_UNITS,0)-ADJ_UNITS+SALES_UNITS AS gap FROM panel) WHERE gap<>0""",
)

# audit
put(
    "audit_scope",
    PANEL,
    f"""SELECT {KEY}, AUDIT_UNITS FROM panel WHERE (SKU, LOCATION) IN
(SELECT (SKU, LOCATION) FROM panel WHERE DATE=DATE '{DAY_}' AND AUDIT_DATE IS NOT NULL)""",
)
put(
    "dedup_latest",
    LINES + ", copies AS (SELECT SKU, LOCATION, DATE, CAST(DATE+CAST(ok%30 AS INT) AS DATE) AS LOAD_DATE, ok AS order_key, ln AS line_no, q AS units FROM li)",
    f"""SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY LOAD_DATE DESC, order_key DESC, line_no DESC, units DESC) AS rk
FROM copies) WHERE rk=1""",
)
for _name, _columns in {
    "audit_day_units": ["AUDIT_DAY_UNITS"],
    "audit_balance_check": ["AUDIT_UNITS"],
    "audit_adj_units": ["AUDIT_ADJ_UNITS"],
    "onhand_recorded": ["ONHAND_RAW AS ONHAND_RECORDED"],
    "dsd_correction": ["DSD_TRANSFERRED_UNITS", "ONHAND_RECORDED"],
    "last_cycle_count": ["LAST_CC_DATE"],
    "audit_prev_cc": ["AUDIT_PREV_CC_DATE"],
    "audit_adj_flag": ["AUDIT_ADJ_FLAG"],
    "pre_audit_cc_flag": ["PRE_AUDIT_CC_DAY_FLAG"],
    "audit_eop_soh": ["AUDIT_ADJ_EOP_SOH"],
    "audit_apply": [
        "AUDIT_DAY_UNITS", "AUDIT_DATE", "AUDIT_UNITS", "AUDIT_ADJ_UNITS", "ONHAND_RECORDED", "LAST_CC_DATE",
        "AUDIT_PREV_CC_DATE", "AUDIT_ADJ_FLAG", "PRE_AUDIT_CC_DAY_FLAG", "AUDIT_ADJ_EOP_SOH",
    ],
}.items():
    keyed(_name, AUDITED, "audited", _columns)
keyed("audit_daily_refresh", AUDITED_TO.replace("{day}", DAY_), "audited", [
    "AUDIT_DAY_UNITS", "AUDIT_DATE", "AUDIT_UNITS", "AUDIT_ADJ_UNITS", "ONHAND_RECORDED", "LAST_CC_DATE",
    "AUDIT_PREV_CC_DATE", "AUDIT_ADJ_FLAG", "PRE_AUDIT_CC_DAY_FLAG", "AUDIT_ADJ_EOP_SOH",
])
keyed("audit_backfill", AUDITED, "a2", ["AUDIT_DATE", "AUDIT_UNITS"])

# trailing and daily features
for _name, _columns in {
    "itr_cogs": [f"itr_cogs_{n}" for n in (7, 14, 28)],
    "itr_avg_start": [f"itr_avg_start_{n}" for n in (7, 14, 28)],
    "in_out": [f"{s}_{n}" for s in ("in", "out") for n in (28, 56, 84)],
    "sales_windows": ["cur_sales_7_28", "hist_sales_7_28", "cur_sales_28_84", "hist_sales_28_84"],
    "stock_windows": ["cur_stock_7_28", "hist_stock_7_28", "cur_stock_28_84", "hist_stock_28_84"],
    "oos_count": ["oos_count_28", "oos_count_84"],
    "last_sale_day": ["last_sale_day"],
    "hist_sale_day_count": ["hist_sale_day_count_28", "hist_sale_day_count_84"],
    "shrinkage_qty": ["shrinkage_qty"],
    "avg_sale_28": ["avg_sale_28"],
    "avg_price_7": ["avg_price_7"],
    "avg_ip_qty": [f"AVG_IP_QTY_EOP_SOH_{n}" for n in (7, 14, 28)],
    "ledger_balance": [f"LEDGER_BAL_RATIO_{n}" for n in (7, 14, 28)],
}.items():
    keyed(_name, ROLLED, "rolled", _columns)
put(
    "categorical_shrinkage",
    ROLLED + CATEGORY,
    """SELECT r.SKU, r.LOCATION, r.DATE, categorical_shrinkage_qty_7, coalesce(scale7,0::DOUBLE) AS categorical_shrinkage_scale_7
FROM rolled r LEFT JOIN cscale s ON r.CAT=s.CAT AND r.LOCATION=s.LOCATION AND r.DATE=s.DATE""",
)


def daily(name: str, columns: list[str]) -> None:
    keyed(name, ROLLED, "rolled", [f"{DAILY[n]} AS {n}" for n in columns])


daily("day_of_week", ["day_of_week"])
keyed("clamp_eop_soh", PANEL, "panel", ["CAST(greatest(DAY_END_SOH,0) AS BIGINT) AS AUDIT_ADJ_EOP_SOH"])
daily("inventory_turnover", [f"{x}_{n}" for x in ("itr_ratio", "inv_sales_ratio", "inv_shrinkage_ratio") for n in (7, 14, 28)])
daily("sell_through", [f"sell_through_rate_{n}" for n in (28, 56, 84)])
daily("sales_ratio", ["sales_ratio_7_28", "sales_ratio_28_84"])
daily("stock_ratio", ["stock_ratio_7_28", "stock_ratio_28_84"])
daily("sale_day_ratio", ["sale_day_ratio_28", "sale_day_ratio_84"])
daily("index_scale", ["price_scale_7", "sale_scale_28"])
daily("oos_ratio", ["oos_ratio_28", "oos_ratio_84"])
daily("event_flags", ["transfer_flag", "sales_flag", "returns_flag", "neg_cc_flag", "pos_cc_flag", "audit_day_flag"])
daily("flagship_slice", ["itr_ratio_28", "sell_through_rate_28"])
keyed("shelf_life", AUDITED + shelf(), "shelf", ["REV_CUMULATIVE_SOH_SCALE"])
put(
    "footfall",
    PANEL + traffic(),
    """SELECT p.SKU, p.LOCATION, p.DATE, daily_trans, footfall_scale, footfall_index FROM panel p
JOIN traffic t ON p.LOCATION=t.LOCATION AND p.DATE=t.DATE""",
)
keyed("decay_short", PANEL + decay(rows=7), "decayed", ["sale_decay_decimal", "transfer_decay_decimal"])
keyed("decay", PANEL + decay(), "decayed", ["sale_decay_decimal", "transfer_decay_decimal"])
put("carry_state", AUDITED + STATE, "SELECT * FROM state")
put(
    "advance_state",
    AUDITED + STATE,
    f"""SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY SKU, LOCATION ORDER BY DATE DESC) AS rk
FROM state WHERE DATE<=DATE '{DAY_}') WHERE rk=1""",
)
_lagged = [
    "meta_CUMULATIVE_SOH", "meta_CUMULATIVE_DAILY_OUT", "meta_CARRY_FORWARD_CUMULATIVE_SOH", "meta_CUMULATIVE_BATCH_QTY",
    "meta_REV_CUMULATIVE_SOH_MIN", "meta_REV_CUMULATIVE_SOH_MAX", "meta_footfall_daily_min", "meta_footfall_daily_max",
    "meta_ledger_bal_ip_qty_eop_soh",
]
keyed("state_lag", AUDITED + STATE, "state", [f'lag("{n}") OVER ({PAIR}) AS "{n}"' for n in _lagged])

_FROM = {"REV_CUMULATIVE_SOH_SCALE": "sh.", "sale_decay_decimal": "de.", "transfer_decay_decimal": "de.",
         "footfall_scale": "tr.", "footfall_index": "tr."}


def assembled(day_rows: str, shelf_name: str, traffic_name: str) -> str:
    picked = []
    for n in FEATURES:
        if n == "categorical_shrinkage_scale_7":
            picked.append("coalesce(cs.scale7,0::DOUBLE) AS categorical_shrinkage_scale_7")
        else:
            picked.append(f"{_FROM.get(n, 'dl.')}{n} AS {n}")
    return f"""SELECT dl.SKU, dl.LOCATION, dl.DATE, {', '.join(picked)} FROM {day_rows} dl
JOIN {shelf_name} sh ON dl.SKU=sh.SKU AND dl.LOCATION=sh.LOCATION AND dl.DATE=sh.DATE
JOIN decayed de ON dl.SKU=de.SKU AND dl.LOCATION=de.LOCATION AND dl.DATE=de.DATE
JOIN {traffic_name} tr ON dl.LOCATION=tr.LOCATION AND dl.DATE=tr.DATE
LEFT JOIN cscale cs ON dl.CAT=cs.CAT AND dl.LOCATION=cs.LOCATION AND dl.DATE=cs.DATE"""


_daily_rows = "SELECT *, " + ", ".join(f"{x} AS {n}" for n, x in DAILY.items()) + " FROM rolled"
put(
    "feature_assemble",
    ROLLED + CATEGORY + f",\ndl AS ({_daily_rows})" + shelf() + traffic("audited") + decay("audited"),
    assembled("dl", "shelf", "traffic"),
)
put(
    "denormalize_features",
    SCHEDULED.replace("FROM panel)", "FROM panel WHERE LOCATION_GROUP IN (1, 2, 3))") + "," + AUDIT_STEPS + rolling() + CATEGORY
    + f",\ndl AS ({_daily_rows})" + shelf() + traffic("audited") + decay("audited"),
    assembled("dl", "shelf", "traffic"),
)
keyed("denormalize_day", SCHEDULED, f"known WHERE DATE = DATE '{DAY_}'", [
    "LOCATION_GROUP", "CAT", "DEPT", "LOB", "SALES_COUNT", "SALES_UNITS", "SALES_UNITS_WITHOUT_RETURN", "RETURN_UNITS", "IN_TRANSIT_UNITS",
    "ADJ_UNITS", "DSD_TRANSFERRED_UNITS", "SALES_UNIT_RETAIL", "DAY_END_SOH", "DAY_START_TOTAL", "DAY_END_TOTAL", "AUDIT_FLAG", "AUDIT_DATE",
    "AUDIT_UNITS",
])
put(
    "feature_daily_steps",
    ROLLED + CATEGORY + f",\ndl AS ({_daily_rows})" + shelf() + traffic("audited") + decay("audited"),
    f"SELECT * FROM ({assembled('dl', 'shelf', 'traffic')}) AS f WHERE DATE BETWEEN DATE '2000-06-28' AND DATE '{DAY_}'",
)
STATEMENTS["feature_assemble_bucketed"] = STATEMENTS["feature_assemble"]
_seeds = {
    "soh": "coalesce(s_soh,0)", "out": "coalesce(s_out,0)", "batch": "coalesce(s_batch,0)",
    "carry": "coalesce(s_carry,0)", "low": "s_low", "high": "s_high",
}
_last_state = {
    "s_soh": "meta_CUMULATIVE_SOH", "s_out": "meta_CUMULATIVE_DAILY_OUT", "s_batch": "meta_CUMULATIVE_BATCH_QTY",
    "s_carry": "meta_CARRY_FORWARD_CUMULATIVE_SOH", "s_low": "meta_REV_CUMULATIVE_SOH_MIN", "s_high": "meta_REV_CUMULATIVE_SOH_MAX",
}
put(
    "feature_assemble_incremental",
    AUDITED_TO.replace("{day}", DAY_) + STATE + f""",
seed0 AS (SELECT SKU, LOCATION, CAST(arg_max(meta_ledger_bal_ip_qty_eop_soh, DATE) AS BIGINT) AS ledger_seed FROM state
  WHERE DATE < DATE '{DAY_}' - INTERVAL 100 DAY GROUP BY SKU, LOCATION),
slice AS (SELECT a.*, coalesce(ledger_seed,0) AS seed FROM audited a LEFT JOIN seed0 s ON a.SKU=s.SKU AND a.LOCATION=s.LOCATION
  WHERE a.DATE >= DATE '{DAY_}' - INTERVAL 100 DAY)"""
    + rolling("slice", "seed")
    + CATEGORY
    + f""",
tr0 AS (SELECT * FROM rolled WHERE LOAD_DATE=DATE '{DAY_}'),
dl AS ({_daily_rows.replace('FROM rolled', 'FROM tr0')}),
pair_seed AS (SELECT SKU, LOCATION, {', '.join(f'CAST(arg_max("{v}", DATE) AS BIGINT) AS {k}' for k, v in _last_state.items())}
  FROM state WHERE DATE < DATE '{DAY_}' GROUP BY SKU, LOCATION),
store_seed AS (SELECT LOCATION AS s_loc, CAST(arg_max(meta_footfall_daily_min, DATE) AS BIGINT) AS f_low, CAST(arg_max(meta_footfall_daily_max, DATE) AS BIGINT) AS f_high
  FROM state WHERE DATE < DATE '{DAY_}' GROUP BY LOCATION),
seeded AS (SELECT a.*, p.* EXCLUDE (SKU, LOCATION) FROM tr0 a LEFT JOIN pair_seed p ON a.SKU=p.SKU AND a.LOCATION=p.LOCATION)"""
    + shelf("seeded", _seeds, "shelf_day", "sd")
    + traffic("tr0", "traffic_day", "f_low", "f_high", "LEFT JOIN store_seed ON q1.LOCATION=s_loc", "q")
    + decay("audited"),
    assembled("dl", "shelf_day", "traffic_day"),
)

# cascade
put(
    "feature_cast",
    PANEL,
    f"""SELECT {KEY}, TRY_CAST(substr(SKU,7) AS INT) AS brand_text, CAST(DAY_END_SOH AS INT) AS stock_text, TRY_CAST(CAT AS INT) AS CAT FROM panel""",
)
_scores = ["binary_pred", "hl_orig_pred", "orig_pred", "orig_pred_temp", "orig_pred_low", "orig_pred_high"]
keyed("cascade_predict", PREDICTED, "predicted", ["step", *_scores, "OOS"])


def dumped(key: str) -> str:
    """Score of a given model: its dumped trees as conditions, added in order."""

    def tree(node: dict) -> str:
        if "leaf" in node:
            return f"{float(node['leaf'])!r}::DOUBLE"
        by_id = {x["nodeid"]: tree(x) for x in node["children"]}
        yes, no = by_id[node["yes"]], by_id[node["no"]]
        x = node["split"]
        return f"CASE WHEN {x} IS NULL THEN {by_id[node['missing']]} WHEN {x} < {node['split_condition']!r}::DOUBLE THEN {yes} ELSE {no} END"

    total = " + ".join([f"{BASE[key]!r}::DOUBLE", *(f"({tree(t)})" for t in DUMPS[key])])
    return f"round({f'1 / (1 + exp(-({total})))' if key in LOGISTIC else total}, 6)"


_given = {"binary": "binary_pred", "hl": "hl_score", "low": "low_pred", "high": "high_pred"}
keyed(
    "cascade_compiled",
    PANEL + ",\nscored AS (SELECT *, " + ", ".join(f"{dumped(k)} AS {n}" for k, n in _given.items()) + " FROM panel)" + CASCADE_TAIL,
    "predicted",
    ["binary_pred", "low_pred", "high_pred", "hl_score", "step", "orig_pred_low", "orig_pred_high"],
)
keyed(
    "range_postprocess",
    SCORED + ranged("high_pred", "scored", "bounded"),
    "bounded",
    ["centre+0::DOUBLE AS orig_pred_temp", "lo+0::DOUBLE AS orig_pred_low", "hi+0::DOUBLE AS orig_pred_high"],
)
keyed("oos_flag", SCORED + ranged("low_pred", "scored", "bounded"), "bounded", ["CASE WHEN lo=0 THEN 1 ELSE 0 END AS OOS"])
_full = ["binary_pred", "orig_pred_low", "orig_pred_high", "orig_pred", "hl_orig_pred", "orig_pred_temp", "OOS"]


def layer(name: str, has: list[str], where: str) -> str:
    cells = ", ".join(n if n in has else f"NULL AS {n}" for n in _full)
    return f"SELECT '{name}' AS layer, {KEY}, {cells} FROM predicted {where}"


put(
    "prediction_layers",
    PREDICTED,
    " UNION ALL ".join(
        [
            layer("concatenated", _full, ""),
            layer("final", ["OOS"], ""),
            layer("step_2", ["binary_pred", "hl_orig_pred"], "WHERE step<>1"),
            layer("step_3", _full[:-1], "WHERE step=3"),
            layer("step_4", _full[:-1], "WHERE step=4"),
        ]
    ),
)
STATEMENTS["sink_csv_projected"] = STATEMENTS["prediction_layers"]
_catalog = {"concatenated": "", "final": "", "step_2": "WHERE step<>1", "step_3": "WHERE step=3", "step_4": "WHERE step=4"}
put(
    "file_catalog",
    PREDICTED,
    " UNION ALL ".join(
        f"SELECT DISTINCT 'LOCATION_GROUP=' || LOCATION_GROUP || '/layer={n}' AS folder, CAST(1 AS BIGINT) AS n_files, true AS have_content, true AS in_bucket FROM predicted {w}"
        for n, w in _catalog.items()
    ),
)
put(
    "union_concat",
    PREDICTED,
    " UNION ALL BY NAME ".join(
        [
            f"SELECT {KEY}, OOS FROM predicted",
            f"SELECT {KEY}, binary_pred, hl_orig_pred FROM predicted WHERE step<>1",
            f"SELECT {KEY}, binary_pred, orig_pred_low, orig_pred_high, orig_pred, hl_orig_pred, orig_pred_temp FROM predicted WHERE step=4",
        ]
    ),
)

# metrics


def counts(truth: str, guess: str) -> str:
    return f"""count(*) FILTER ({truth} AND {guess}) AS tp, count(*) FILTER ({truth} AND NOT {guess}) AS fn,
count(*) FILTER (NOT {truth} AND NOT {guess}) AS tn, count(*) FILTER (NOT {truth} AND {guess}) AS fp"""


def _or0(x: str) -> str:
    return f"coalesce({x},0::DOUBLE)"


_p, _r = _or0(percent("tp", "tp+fp")), _or0(percent("tp", "tp+fn"))
RATES = {
    "tp_perc": _r,
    "fn_perc": _or0(percent("fn", "tp+fn")),
    "recall_perc": _r,
    "tn_perc": _or0(percent("tn", "tn+fp")),
    "fp_perc": _or0(percent("fp", "tn+fp")),
    "precision_perc": _p,
    "accuracy_perc": _or0(percent("tp+tn", "tp+fn+tn+fp")),
    "f1_score": _or0(f"round(2*round(100*{_p})*round(100*{_r})/nullif(round(100*{_p})+round(100*{_r}),0))/100::DOUBLE"),
}


def columns(items: dict[str, str], only=None) -> str:
    return ", ".join(f"{x} AS {n}" for n, x in items.items() if only is None or n in only)


_report = counts("ACTUAL_OOS_FLAG=1", "OOS=1")
put("confusion_counts", ACTUAL, f"SELECT {_report} FROM report")
put("confusion_percent", ACTUAL, f"SELECT *, {columns(RATES)} FROM (SELECT {_report} FROM report)")

_stock = counts("rev_ip_qty_eop_soh<=0", "orig_pred_low<=0")
_inside = "orig_pred_low<=rev_ip_qty_eop_soh AND orig_pred_high>=rev_ip_qty_eop_soh"
_under, _over = "rev_ip_qty_eop_soh<=CURDAY_IP_QTY_EOP_SOH", "rev_ip_qty_eop_soh>CURDAY_IP_QTY_EOP_SOH"


def n(where: str) -> str:
    return f"count(*) FILTER ({where})"


RANGES = {
    "under_accurate_perc": percent(n(f"{_under} AND {_inside}"), n(_under)),
    "under_overall_perc": percent(n(f"{_under} AND orig_pred_low<=CURDAY_IP_QTY_EOP_SOH"), n(_under)),
    "over_accurate_perc": percent(n(f"{_over} AND {_inside}"), n(_over)),
    "over_overall_perc": percent(n(f"{_over} AND orig_pred_high>CURDAY_IP_QTY_EOP_SOH"), n(_over)),
}
_gone = "BINARY_TARGET_CLASSIFICATION=1"
BOOK = {
    "br_pr_perc": percent(n(f"{_gone} AND IP_QTY_EOP_SOH<=0 AND orig_pred_low<=0"), "count(*)"),
    "br_pw_perc": percent(n(f"{_gone} AND IP_QTY_EOP_SOH<=0 AND orig_pred_low>0"), "count(*)"),
    "bw_pr_perc": percent(n(f"{_gone} AND IP_QTY_EOP_SOH>0 AND orig_pred_low<=0"), "count(*)"),
}


def _value(where: str) -> str:
    return f"CAST(coalesce(sum(TOTAL_RETAIL) FILTER ({_gone} AND {where}),0) AS BIGINT)"


REVENUE = {
    "br_pr_value": _value("orig_pred_low<=0 AND IP_QTY_EOP_SOH<=0"),
    "revenue_recovery": _value("orig_pred_low<=0 AND IP_QTY_EOP_SOH>0"),
    "loss": _value("orig_pred_low>0"),
    "loss_book_recovers": _value("orig_pred_low>0 AND IP_QTY_EOP_SOH<=0"),
}
put("stock_confusion", PREDICTED, f"SELECT *, {columns(RATES)} FROM (SELECT {_stock} FROM predicted)")
put("range_performance", PREDICTED, f"SELECT {columns(RANGES)} FROM predicted")
put("book_vs_model", PREDICTED, f"SELECT {columns(BOOK)} FROM predicted")
put("revenue_impact", PREDICTED, f"SELECT {columns(REVENUE)} FROM predicted")


def overall(by: str = "") -> str:
    head, tail = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return f"""SELECT * EXCLUDE (tp, fn, tn, fp), {columns(RATES)} FROM (SELECT {head}{_stock}, {columns(RANGES)}, {columns(BOOK)}, {columns(REVENUE)}
FROM predicted{tail})"""


put("overall_metrics", PREDICTED, overall())
put("sink_metrics", PREDICTED, overall())


def classified(step: str, truth: str, score: str, where: str = "", by: str = "") -> str:
    head, tail = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return f"""SELECT {head}{fixed('tp+tn', 'tp+tn+fp+fn', 3)} AS {step}_accuracy, {_or0(fixed('tp', 'tp+fp', 3))} AS {step}_precision,
{_or0(fixed('tp', 'tp+fn', 3))} AS {step}_recall, {_or0(fixed('2*tp', '2*tp+fp+fn', 3))} AS {step}_f1
FROM (SELECT {head}{counts(truth + '=1', score + '>0.5::DOUBLE')} FROM predicted {where}{tail})"""


def auc(source: str, truth: str, score: str, name: str, by: str = "") -> str:
    """Mean rank of the positives, ties sharing their mean rank."""
    head, part, tail = (f"{by}, ", f"PARTITION BY {by} ", f" GROUP BY {by}") if by else ("", "", "")
    return f"""SELECT {head}coalesce({fixed('2*won', '2*pos*neg', 3)},0::DOUBLE) AS {name} FROM (
SELECT {head}sum(CASE WHEN y=1 THEN below+tied/2.0 ELSE 0 END)::DOUBLE AS won, count(*) FILTER (y=1)::DOUBLE AS pos, count(*) FILTER (y=0)::DOUBLE AS neg FROM (
SELECT {head}{truth} AS y, count(*) FILTER ({truth}=0) OVER ({part}ORDER BY {score} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP) AS below,
count(*) FILTER ({truth}=0) OVER (PARTITION BY {head}{score}) AS tied FROM {source}){tail})"""


def regression(step: str, where: str, by: str = "") -> str:
    head, tail = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    r2 = "(CASE WHEN n<=1 THEN 0 WHEN spread=0 THEN (CASE WHEN sse=0 THEN 1 ELSE 0 END) ELSE 1-sse/(n*spread) END)"
    return f"""SELECT {head}round(1000*CASE WHEN n<=1 THEN 0 ELSE sse/n END)/1000::DOUBLE AS {step}_mean_squared_err, round(1000*{r2})/1000::DOUBLE AS {step}_r2,
round(1000*(1-(1-{r2})*(n-1)/nullif(n-12-1,0)))/1000::DOUBLE AS {step}_adjusted_r2 FROM (
SELECT {head}count(*) AS n, sum((TARGET_REGRESSION-orig_pred)*(TARGET_REGRESSION-orig_pred)) AS sse, var_pop(TARGET_REGRESSION) AS spread FROM predicted {where}{tail})"""


_t1, _t2 = "BINARY_TARGET_CLASSIFICATION", "BINARY_HL_TARGET_CLASSIFICATION"
put("classification_metrics", PREDICTED, classified("step_1", _t1, "binary_pred"))
put("roc_auc", PREDICTED, auc("predicted", _t1, "binary_pred", "roc_auc"))
put(
    "roc_auc_labels",
    "docs AS (SELECT quality, n_chars FROM documents JOIN labels USING (doc_id))",
    auc("docs", "quality", "n_chars", "roc_auc"),
)
put("regression_metrics", PREDICTED, regression("step_3", "WHERE step=3"))
put(
    "champion_compare",
    TWO_MODELS + ", passed AS (SELECT * FROM predicted WHERE step<>1)",
    f"""SELECT * FROM ({classified('step_1', _t1, 'binary_pred', '', 'model')})
JOIN ({auc('predicted', _t1, 'binary_pred', 'step_1_roc_auc', 'model')}) USING (model)
JOIN ({classified('step_2', _t2, 'hl_orig_pred', 'WHERE step<>1', 'model')}) USING (model)
JOIN ({auc('passed', _t2, 'hl_orig_pred', 'step_2_roc_auc', 'model')}) USING (model)
JOIN ({regression('step_3', 'WHERE step=3', 'model')}) USING (model)
JOIN ({regression('step_4', 'WHERE step=4', 'model')}) USING (model)
JOIN ({overall('model')}) USING (model)""",
)
put(
    "promotion_decision",
    TWO_MODELS + f", s AS ({overall('model')})",
    """SELECT *, CASE WHEN new_score>prod_score THEN 'promote' ELSE 'keep' END AS decision FROM (SELECT
max(f1_score) FILTER (model='new') AS new_score, max(f1_score) FILTER (model='prod') AS prod_score FROM s)""",
)
assert len(FEEDS) == 10 and HIST
