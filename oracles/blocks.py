"""Common table expressions the statements are assembled from.

Written from the definitions, not from the Spark code: sliding frames are
sliding frames here, forward looks are forward frames.
"""

from __future__ import annotations

PAIR = "PARTITION BY SKU, LOCATION ORDER BY DATE"
HIST = f"({PAIR} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
AHEAD = f"({PAIR} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
KEY = "SKU, LOCATION, DATE"


def last(n: int) -> str:
    return f"({PAIR} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def fixed(x: str, y: str, digits: int = 2) -> str:
    s = f"{10**digits}::DOUBLE"
    return f"((round({s}*({x})/nullif(({y})::DOUBLE,0))/{s})+0::DOUBLE)"


def ratio(x: str, y: str) -> str:
    return f"coalesce({fixed(x, y)},100::DOUBLE)"


def ratio_neg(x: str, y: str) -> str:
    return (
        f"CASE WHEN ({x}) IS NULL OR ({y}) IS NULL THEN -100::DOUBLE WHEN ({y})<>0 THEN {fixed(x, y)}"
        f" WHEN ({x})>=0 THEN 100::DOUBLE ELSE -100::DOUBLE END"
    )


def clamp(x: str) -> str:
    return f"(CASE WHEN ({x})<0 THEN 0 ELSE ({x}) END)"


def percent(x: str, y: str) -> str:
    return f"((round(10000::DOUBLE*({x})/nullif(({y})::DOUBLE,0))/100::DOUBLE)+0::DOUBLE)"


LINES = """
li AS (
  SELECT p.p_brand AS SKU, CAST(s.s_nationkey*10 AS INT) AS LOCATION, CAST(l.l_shipdate AS DATE) AS DATE,
         CAST(substr(p.p_brand,7) AS INT) AS bn, CAST(l.l_quantity AS BIGINT) AS q,
         CAST(round(l.l_extendedprice*100) AS BIGINT) AS cents,
         l.l_returnflag AS rf, l.l_linestatus AS ls, l.l_linenumber AS ln, l.l_orderkey AS ok
  FROM lineitem l JOIN part p ON l.l_partkey=p.p_partkey JOIN supplier s ON l.l_suppkey=s.s_suppkey)"""

PANEL = LINES + """,
d AS (
  SELECT SKU, LOCATION, DATE, bn,
    CAST(count(DISTINCT ok) AS BIGINT) AS SALES_COUNT,
    CAST(sum(CASE WHEN rf<>'R' THEN q ELSE 0 END) AS BIGINT) AS SALES_UNITS_WITHOUT_RETURN,
    CAST(sum(CASE WHEN rf='R' THEN -q ELSE 0 END) AS BIGINT) AS RETURN_UNITS,
    CAST(sum(CASE WHEN rf='R' THEN -q ELSE q END) AS BIGINT) AS SALES_UNITS,
    CAST(sum(CASE WHEN ls='F' THEN q ELSE 0 END) AS BIGINT) AS RECEIPT_UNITS,
    CAST(sum(CASE WHEN ls='O' AND ln<=2 THEN q ELSE 0 END) AS BIGINT) AS IN_TRANSIT_UNITS,
    CAST(sum(CASE WHEN ln=6 THEN q ELSE 0 END) AS BIGINT) AS POS_ADJ_UNITS,
    CAST(sum(CASE WHEN ln=7 THEN -q ELSE 0 END) AS BIGINT) AS NEG_ADJ_UNITS,
    CAST(sum(CASE WHEN ln=5 THEN (CASE WHEN rf='A' THEN -q ELSE q END) ELSE 0 END) AS BIGINT) AS DSD_TRANSFERRED_UNITS,
    CAST(sum(CASE WHEN rf<>'R' THEN cents ELSE 0 END) AS BIGINT) AS SALES_CENTS,
    CAST(sum(q) AS BIGINT) AS TOT_Q
  FROM li GROUP BY SKU, LOCATION, DATE, bn),
w AS (
  SELECT d.*, CAST(20 + sum(RECEIPT_UNITS-SALES_UNITS) OVER (PARTITION BY SKU,LOCATION ORDER BY DATE
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS DAY_END_SOH,
    lag(IN_TRANSIT_UNITS,1) OVER (PARTITION BY SKU,LOCATION ORDER BY DATE) AS prev_it FROM d),
panel AS (
SELECT SKU, LOCATION, DATE, CAST(round(LOCATION/50.0,0) AS INT) AS LOCATION_GROUP, DATE AS LOAD_DATE,
  concat('C',CAST(bn%5 AS VARCHAR)) AS CAT, concat('D',CAST(bn%3 AS VARCHAR)) AS DEPT,
  concat('L',CAST(bn%2 AS VARCHAR)) AS LOB,
  SALES_COUNT, SALES_UNITS, SALES_UNITS_WITHOUT_RETURN, RETURN_UNITS, IN_TRANSIT_UNITS, POS_ADJ_UNITS, NEG_ADJ_UNITS,
  POS_ADJ_UNITS+NEG_ADJ_UNITS AS ADJ_UNITS, DSD_TRANSFERRED_UNITS,
  CASE WHEN SALES_UNITS_WITHOUT_RETURN>0 THEN CAST(floor(SALES_CENTS/SALES_UNITS_WITHOUT_RETURN) AS BIGINT) ELSE 0 END AS SALES_UNIT_RETAIL,
  SALES_CENTS AS TOTAL_RETAIL,
  DAY_END_SOH-RECEIPT_UNITS+SALES_UNITS AS DAY_BEGIN_SOH, DAY_END_SOH,
  coalesce(prev_it,0) AS DAY_START_INTRANS, IN_TRANSIT_UNITS AS DAY_END_INTRANS,
  DAY_END_SOH-RECEIPT_UNITS+SALES_UNITS+coalesce(prev_it,0) AS DAY_START_TOTAL, DAY_END_SOH+IN_TRANSIT_UNITS AS DAY_END_TOTAL,
  DAY_END_SOH AS IP_QTY_EOP_SOH, DAY_END_SOH AS CURDAY_IP_QTY_EOP_SOH,
  CASE WHEN TOT_Q%10=0 THEN 1 ELSE 0 END AS AUDIT_FLAG,
  CASE WHEN TOT_Q%10=0 THEN DATE END AS AUDIT_DATE,
  CASE WHEN TOT_Q%10=0 THEN CAST(SALES_COUNT%5-2 AS BIGINT) END AS AUDIT_UNITS
FROM w)"""

AUDIT_STEPS = f"""
a1 AS (SELECT *, CAST(CASE WHEN DATE=AUDIT_DATE THEN AUDIT_UNITS ELSE 0 END AS BIGINT) AS AUDIT_DAY_UNITS FROM known),
a2 AS (SELECT * REPLACE (first_value(AUDIT_DATE IGNORE NULLS) OVER {AHEAD} AS AUDIT_DATE,
                         first_value(AUDIT_UNITS IGNORE NULLS) OVER {AHEAD} AS AUDIT_UNITS) FROM a1),
a3 AS (SELECT * REPLACE (CAST(CASE WHEN DAY_START_TOTAL+IN_TRANSIT_UNITS+DSD_TRANSFERRED_UNITS+AUDIT_UNITS+ADJ_UNITS-SALES_UNITS=DAY_END_TOTAL
                         THEN AUDIT_UNITS ELSE 0 END AS BIGINT) AS AUDIT_UNITS) FROM a2),
a4 AS (SELECT *, AUDIT_UNITS+ADJ_UNITS AS AUDIT_ADJ_UNITS FROM a3),
a5 AS (SELECT *, CAST(CASE WHEN DAY_END_SOH+SALES_UNITS-AUDIT_ADJ_UNITS>DAY_BEGIN_SOH
                 THEN DAY_END_SOH+SALES_UNITS-AUDIT_ADJ_UNITS-DAY_BEGIN_SOH ELSE 0 END AS BIGINT) AS ONHAND_RAW FROM a4),
a6 AS (SELECT *, CASE WHEN DSD_TRANSFERRED_UNITS<0 THEN ONHAND_RAW+DSD_TRANSFERRED_UNITS ELSE ONHAND_RAW END AS ONHAND_RECORDED,
         last_value(CASE WHEN ADJ_UNITS<>0 THEN DATE END IGNORE NULLS) OVER {HIST} AS LAST_CC_DATE FROM a5),
a7 AS (SELECT *, CASE WHEN AUDIT_FLAG=1 THEN coalesce(LAST_CC_DATE, min(DATE) OVER
         (PARTITION BY SKU, LOCATION, AUDIT_DATE ORDER BY DATE)) END AS own_cc,
         CASE WHEN AUDIT_FLAG=1 AND AUDIT_DAY_UNITS=0 THEN 'N' WHEN AUDIT_FLAG=1 AND AUDIT_DAY_UNITS<>0 THEN 'Y' END AS own_flag FROM a6),
a8 AS (SELECT *, first_value(own_cc IGNORE NULLS) OVER {AHEAD} AS AUDIT_PREV_CC_DATE,
         first_value(own_flag IGNORE NULLS) OVER {AHEAD} AS AUDIT_ADJ_FLAG FROM a7),
audited AS (SELECT *, CASE WHEN DATE>=AUDIT_PREV_CC_DATE AND DATE<=AUDIT_DATE AND AUDIT_ADJ_FLAG='N' AND AUDIT_FLAG=0
         THEN 1 ELSE 0 END AS PRE_AUDIT_CC_DAY_FLAG,
         CAST(greatest(0, CASE WHEN AUDIT_UNITS<>0 AND AUDIT_DAY_UNITS<>0 THEN DAY_END_SOH-AUDIT_UNITS ELSE DAY_END_SOH END) AS BIGINT)
           AS AUDIT_ADJ_EOP_SOH FROM a8)"""

AUDITED = PANEL + ", known AS (SELECT * FROM panel)," + AUDIT_STEPS
AUDITED_TO = PANEL + ", known AS (SELECT * FROM panel WHERE DATE <= DATE '{day}')," + AUDIT_STEPS

#: Only audits in a count period of their store count.
_SCHEDULED = "AUDIT_FLAG=1 AND (month(DATE) + LOCATION / 10) % 3 = 0 AND day(DATE) <= 25"
SCHEDULED = PANEL + f""", known AS (SELECT * REPLACE (CASE WHEN {_SCHEDULED} THEN 1 ELSE 0 END AS AUDIT_FLAG,
  CASE WHEN {_SCHEDULED} THEN AUDIT_DATE END AS AUDIT_DATE, CASE WHEN {_SCHEDULED} THEN AUDIT_UNITS END AS AUDIT_UNITS) FROM panel)"""


def _sum(x: str, n: int, name: str) -> str:
    return f"CAST(sum({x}) OVER {last(n)} AS BIGINT) AS {name}"


ROLLING_COLUMNS = ", ".join(
    [_sum("SALES_UNITS", n, f"itr_cogs_{n}") for n in (7, 14, 28)]
    + [f"lag(DAY_END_SOH,{n}) OVER ({PAIR}) AS itr_avg_start_{n}" for n in (7, 14, 28)]
    + [_sum("ONHAND_RECORDED", n, f"in_{n}") for n in (28, 56, 84)]
    + [_sum("SALES_UNITS", n, f"out_{n}") for n in (28, 56, 84)]
    + [
        _sum(x, n, f"{side}_{label}_{s}_{l}")
        for label, x in (("sales", "SALES_UNITS"), ("stock", "DAY_END_SOH"))
        for s, l in ((7, 28), (28, 84))
        for side, n in (("cur", s), ("hist", l))
    ]
    + [_sum("CASE WHEN DAY_END_SOH<=0 THEN 1 ELSE 0 END", n, f"oos_count_{n}") for n in (28, 84)]
    + [
        f"coalesce(last_value(CASE WHEN SALES_UNITS_WITHOUT_RETURN>0 THEN DATE END IGNORE NULLS) OVER {HIST},"
        f" first_value(DATE) OVER {HIST}) AS last_sale_day"
    ]
    + [
        f"CAST(count(CASE WHEN SALES_UNITS_WITHOUT_RETURN>0 THEN 1 END) OVER {last(n)} AS BIGINT) AS hist_sale_day_count_{n}"
        for n in (28, 84)
    ]
    + ["CAST(CASE WHEN AUDIT_ADJ_UNITS<0 THEN -AUDIT_ADJ_UNITS ELSE 0 END AS BIGINT) AS shrinkage_qty"]
    + [_sum("SALES_UNITS", 28, "avg_sale_28")]
    + [
        f"CAST(sum(nullif(SALES_UNIT_RETAIL,0)) OVER {last(7)} AS DOUBLE)/nullif(count(nullif(SALES_UNIT_RETAIL,0)) OVER {last(7)},0) AS avg_price_7"
    ]
    + [
        f"CAST(sum(IP_QTY_EOP_SOH) OVER {last(n)} AS DOUBLE)/count(IP_QTY_EOP_SOH) OVER {last(n)} AS AVG_IP_QTY_EOP_SOH_{n}"
        for n in (7, 14, 28)
    ]
)


def rolling(source: str = "audited", seed: str = "0") -> str:
    """Trailing block and ledger over ``source``; ``seed`` is the carried ledger per row."""
    return f""",
r1 AS (SELECT *, {ROLLING_COLUMNS},
  CAST(sum(ONHAND_RECORDED-(SALES_UNITS-AUDIT_ADJ_UNITS)) OVER {HIST} AS BIGINT)+{seed} AS ledger FROM {source}),
rolled AS (SELECT *, """ + ", ".join(
        ratio_neg(f"sum(ledger) OVER {last(n)}", f"sum(IP_QTY_EOP_SOH) OVER {last(n)}") + f" AS LEDGER_BAL_RATIO_{n}"
        for n in (7, 14, 28)
    ) + " FROM r1)"


ROLLED = AUDITED + rolling()

CATEGORY = """,
cday AS (SELECT CAT, LOCATION, DATE, CAST(sum(shrinkage_qty) AS BIGINT) AS s FROM rolled GROUP BY ALL),
cweek AS (SELECT *, CAST(sum(s) OVER (PARTITION BY LOCATION, CAT ORDER BY DATE ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS
  categorical_shrinkage_qty_7 FROM cday),
cscale AS (SELECT CAT, LOCATION, DATE, categorical_shrinkage_qty_7, """ + fixed(
    "categorical_shrinkage_qty_7-min(categorical_shrinkage_qty_7) OVER (PARTITION BY LOCATION, DATE)",
    "max(categorical_shrinkage_qty_7) OVER (PARTITION BY LOCATION, DATE)-min(categorical_shrinkage_qty_7) OVER (PARTITION BY LOCATION, DATE)",
) + " AS scale7 FROM cweek)"


def daily_columns() -> dict[str, str]:
    end, lost = clamp("DAY_END_SOH"), "CASE WHEN AUDIT_ADJ_UNITS<0 THEN -AUDIT_ADJ_UNITS ELSE 0 END"
    out = {}
    for n in (7, 14, 28):
        cogs, two = clamp(f"itr_cogs_{n}"), f"({clamp(f'itr_avg_start_{n}')}+{end})"
        out[f"itr_ratio_{n}"] = ratio(f"2*{cogs}", two)
        out[f"inv_sales_ratio_{n}"] = ratio(two, f"2*{cogs}")
        out[f"inv_shrinkage_ratio_{n}"] = ratio(f"2*({lost})", two)
    for n in (28, 56, 84):
        out[f"sell_through_rate_{n}"] = ratio(clamp(f"out_{n}"), f"in_{n}")
    for label in ("sales", "stock"):
        for s, l in ((7, 28), (28, 84)):
            out[f"{label}_ratio_{s}_{l}"] = ratio(
                f"{l // s}*{clamp(f'cur_{label}_{s}_{l}')}", clamp(f"hist_{label}_{s}_{l}")
            )
    for n in (28, 84):
        gap = f"round(100*{ratio(str(n), f'hist_sale_day_count_{n}')})"
        out[f"sale_day_ratio_{n}"] = fixed("100*datediff('day',last_sale_day,DATE)", gap)
        out[f"oos_ratio_{n}"] = fixed(f"oos_count_{n}", str(n))
    out["day_of_week"] = "CAST(isodow(DATE)-1 AS INT)"
    out["transfer_flag"] = "CASE WHEN IN_TRANSIT_UNITS>0 THEN 1 ELSE 0 END"
    out["sales_flag"] = "CASE WHEN SALES_UNITS_WITHOUT_RETURN>0 THEN 1 ELSE 0 END"
    out["returns_flag"] = "CASE WHEN RETURN_UNITS<>0 THEN 1 ELSE 0 END"
    out["neg_cc_flag"] = "CASE WHEN NEG_ADJ_UNITS<>0 THEN 1 ELSE 0 END"
    out["pos_cc_flag"] = "CASE WHEN POS_ADJ_UNITS<>0 THEN 1 ELSE 0 END"
    out["audit_day_flag"] = "CASE WHEN AUDIT_FLAG=1 THEN 1 ELSE 0 END"
    day = "(PARTITION BY LOCATION, DATE)"
    for name, x in (("price_scale_7", "coalesce(avg_price_7,0)"), ("sale_scale_28", "coalesce(avg_sale_28,0)")):
        out[name] = fixed(f"{x}-min({x}) OVER {day}", f"max({x}) OVER {day}-min({x}) OVER {day}")
    return out


DAILY = daily_columns()


def shelf(source: str = "audited", seeds: dict[str, str] | None = None, name: str = "shelf", p: str = "sh") -> str:
    """Shelf-life recurrences; seeds: soh, out, batch, carry, low, high as expressions per row."""
    s = {"soh": "0", "out": "0", "batch": "0", "carry": "0", "low": "NULL::BIGINT", "high": "NULL::BIGINT"} | (seeds or {})
    fell = "DAY_END_INTRANS<DAY_START_INTRANS"
    return f""",
{p}1 AS (SELECT *, CAST(sum(DAY_BEGIN_SOH) OVER {HIST} AS BIGINT)+{s['soh']} AS cum_soh,
  CAST(sum(SALES_UNITS+RETURN_UNITS-AUDIT_ADJ_UNITS) OVER {HIST} AS BIGINT)+{s['out']} AS cum_out,
  coalesce(CAST(sum(CASE WHEN {fell} THEN DAY_START_INTRANS-DAY_END_INTRANS END) OVER {HIST} AS BIGINT),0)+{s['batch']} AS cum_batch
  FROM {source}),
{p}2 AS (SELECT *, coalesce(last_value(CASE WHEN {fell} THEN cum_soh END IGNORE NULLS) OVER {HIST}, {s['carry']}) AS carry FROM {p}1),
{p}3 AS (SELECT *, cum_soh-CASE WHEN cum_out>=cum_batch THEN 0 ELSE carry END AS rev FROM {p}2),
{p}4 AS (SELECT *, least(min(rev) OVER {HIST}, {s['low']}) AS rev_min, greatest(max(rev) OVER {HIST}, {s['high']}) AS rev_max FROM {p}3),
{name} AS (SELECT *, {fixed('rev-rev_min', 'rev_max-rev_min')} AS REV_CUMULATIVE_SOH_SCALE FROM {p}4)"""


def traffic(source: str = "panel", name: str = "traffic", low: str = "NULL::BIGINT", high: str = "NULL::BIGINT", join: str = "", p: str = "t") -> str:
    w = "(PARTITION BY LOCATION ORDER BY DATE)"
    hundredths = f"CAST(round(footfall_scale*100) AS INT)"
    return f""",
{p}1 AS (SELECT LOCATION, DATE, CAST(sum(SALES_COUNT) AS BIGINT) AS daily_trans FROM {source} GROUP BY LOCATION, DATE),
{p}2 AS (SELECT {p}1.*, least(min(daily_trans) OVER {w}, {low}) AS footfall_min, greatest(max(daily_trans) OVER {w}, {high}) AS footfall_max FROM {p}1 {join}),
{p}3 AS (SELECT *, {fixed('daily_trans-footfall_min', 'footfall_max-footfall_min')} AS footfall_scale FROM {p}2),
{name} AS (SELECT *, CASE WHEN footfall_scale IS NULL OR {hundredths}<=0 THEN 1 ELSE CAST(ceil({hundredths}/10.0) AS INT) END AS footfall_index FROM {p}3)"""


def _happened(label: str, x: str) -> str:
    since = (
        f"coalesce(last_value(CASE WHEN {x}>0 THEN DATE END IGNORE NULLS) OVER {HIST}, first_value(DATE) OVER {HIST})"
    )
    units = f"coalesce(last_value(CASE WHEN {x}>0 THEN {x} END IGNORE NULLS) OVER {HIST},0)"
    days = f"datediff('day',{since},DATE)"
    return (
        f"CAST({days} AS INT) AS meta_{label}_cur_day_count, "
        f"floor(100::DOUBLE*{units}/({days}+1))/100::DOUBLE AS meta_{label}_decay_decimal"
    )


DECAY_STATE = f"SELECT *, {_happened('sale', 'SALES_UNITS_WITHOUT_RETURN')}, {_happened('transfer', 'IN_TRANSIT_UNITS')} FROM "


def decay(source: str = "panel", name: str = "decayed", rows: int = 84) -> str:
    prev = ", ".join(
        f"lag(CAST(round(100*meta_{d}_decay_decimal) AS BIGINT)) OVER (PARTITION BY SKU, LOCATION, meta_{d}_cur_day_count ORDER BY DATE) AS p_{d}"
        for d in ("sale", "transfer")
    )
    out = ", ".join(
        f"CASE WHEN count(p_{d}) OVER {last(rows)}<{rows} THEN 0::DOUBLE ELSE {fixed(f'sum(p_{d}) OVER {last(rows)}', str(100 * rows))} END AS {d}_decay_decimal"
        for d in ("sale", "transfer")
    )
    return f""",
ds AS ({DECAY_STATE} {source}),
dp AS (SELECT *, {prev} FROM ds),
{name} AS (SELECT *, {out} FROM dp)"""


STATE_SELECT = """SELECT s.SKU, s.LOCATION, s.DATE,
  cum_soh::DOUBLE AS "meta_CUMULATIVE_SOH", cum_out::DOUBLE AS "meta_CUMULATIVE_DAILY_OUT",
  carry::DOUBLE AS "meta_CARRY_FORWARD_CUMULATIVE_SOH", cum_batch::DOUBLE AS "meta_CUMULATIVE_BATCH_QTY",
  rev_min::DOUBLE AS "meta_REV_CUMULATIVE_SOH_MIN", rev_max::DOUBLE AS "meta_REV_CUMULATIVE_SOH_MAX",
  footfall_min::DOUBLE AS meta_footfall_daily_min, footfall_max::DOUBLE AS meta_footfall_daily_max,
  ledger::DOUBLE AS meta_ledger_bal_ip_qty_eop_soh,
  meta_sale_cur_day_count, meta_sale_decay_decimal, meta_transfer_cur_day_count, meta_transfer_decay_decimal
FROM shelf s JOIN traffic t ON s.LOCATION=t.LOCATION AND s.DATE=t.DATE"""

# every recurrence over the audited panel, then the state table
STATE = (
    f",\nled AS (SELECT *, CAST(sum(ONHAND_RECORDED-(SALES_UNITS-AUDIT_ADJ_UNITS)) OVER {HIST} AS BIGINT) AS ledger FROM audited),"
    f"\nlds AS ({DECAY_STATE} led)" + shelf("lds") + traffic("audited") + f",\nstate AS ({STATE_SELECT})"
)


def spread(x: str, n: int) -> str:
    return f"((({x})%{n}+{n})%{n})::DOUBLE/1000::DOUBLE"


def scored(shift: int, model: str = "new") -> str:
    day = "datediff('day',DATE '1990-01-01',DATE)"
    return f"""SELECT SKU, LOCATION, DATE, LOCATION_GROUP, IP_QTY_EOP_SOH, CURDAY_IP_QTY_EOP_SOH, TOTAL_RETAIL, '{model}' AS model,
  {spread(f'DAY_END_SOH*37+SALES_UNITS*11+{day}*13+LOCATION+{shift}', 1000)} AS binary_pred,
  {spread(f'DAY_END_SOH*53+SALES_UNITS*29+{day}*7+{shift}', 1000)} AS hl_score,
  {spread(f'DAY_END_SOH*71+SALES_UNITS*3+{day}*31+{shift}', 1500)} AS low_pred,
  1::DOUBLE+{spread(f'DAY_END_SOH*17+SALES_UNITS*41+{day}*5+{shift}', 900)} AS high_pred,
  stock AS rev_ip_qty_eop_soh, CASE WHEN stock<=0 THEN 1 ELSE 0 END AS BINARY_TARGET_CLASSIFICATION,
  CASE WHEN stock<=DAY_END_SOH THEN 1 ELSE 0 END AS BINARY_HL_TARGET_CLASSIFICATION,
  {spread('stock*29+DAY_END_SOH', 1200)} AS TARGET_REGRESSION
FROM (SELECT *, CAST(DAY_END_SOH+2*coalesce(AUDIT_UNITS,0)+(SALES_COUNT+{day})%7-3 AS BIGINT) AS stock FROM panel)"""


def ranged(pred: str, source: str, name: str) -> str:
    """The range rules in their order, one step per expression."""
    return f""",
g1 AS (SELECT *, round_even(round_even(({pred})*100,0)/100::DOUBLE*CURDAY_IP_QTY_EOP_SOH,0) AS centre FROM {source}),
g2 AS (SELECT *, round_even(centre-centre*0.15::DOUBLE,0) AS l0, round_even(centre+centre*0.15::DOUBLE,0) AS h0 FROM g1),
g3 AS (SELECT *, CASE WHEN l0=h0 THEN l0-2 ELSE l0 END AS l1 FROM g2),
g4 AS (SELECT *, CASE WHEN h0-l1=1 THEN l1-1 ELSE l1 END AS l2 FROM g3),
{name} AS (SELECT *, CASE WHEN l2<0 THEN h0+1 ELSE h0 END AS hi, CASE WHEN l2<0 THEN 0::DOUBLE ELSE l2 END AS lo FROM g4)"""


CASCADE_TAIL = """,
staged AS (SELECT *, CASE WHEN binary_pred>0.5::DOUBLE THEN 1 WHEN hl_score>0.5::DOUBLE THEN 3 ELSE 4 END AS step FROM scored),
picked AS (SELECT *, CASE WHEN step<>1 THEN hl_score END AS hl_orig_pred,
  CASE step WHEN 1 THEN 0::DOUBLE WHEN 3 THEN low_pred ELSE high_pred END AS orig_pred FROM staged)""" + ranged(
    "orig_pred", "picked", "bounded"
) + """,
p1 AS (SELECT *, CASE WHEN step<>1 THEN centre+0::DOUBLE END AS orig_pred_temp, CASE WHEN step=1 THEN 0::DOUBLE ELSE lo+0::DOUBLE END AS orig_pred_low,
  CASE WHEN step=1 THEN 0::DOUBLE ELSE hi+0::DOUBLE END AS orig_pred_high FROM bounded),
predicted AS (SELECT *, CASE WHEN orig_pred_low=0 THEN 1 ELSE 0 END AS OOS FROM p1)"""

SCORED = PANEL + f",\nscored AS ({scored(0)})"
PREDICTED = SCORED + CASCADE_TAIL
TWO_MODELS = PANEL + f",\nscored AS ({scored(0)} UNION ALL {scored(137, 'prod')})" + CASCADE_TAIL

FEEDS = [
    "FD_STORE_INV", "FD_SALES", "FD_CARRIER_DETAILS", "FD_SKU_MASTER", "FD_RETURNS",
    "FD_PHYSICAL_INVENTORY_COUNT_SCHEDULE", "FD_INV_ADJ", "FD_PHYSICAL_INV_ADJUSTMENTS",
    "FD_STORE_TRANSFERS_IN", "FD_DSD_INVOICE",
]
_feed_list = ", ".join(f"'{f}'" for f in FEEDS)
FILES = f"""
f0 AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS file_date, ([{_feed_list}, 'UNKNOWN'])[CAST(o_orderkey%11 AS INT)+1] AS fd,
  CASE WHEN o_orderkey%7=0 THEN strftime(o_orderdate,'%Y%m%d') ELSE strftime(o_orderdate,'%d%m%Y') END AS dt FROM orders),
files AS (SELECT 'drop/'||name AS path, name, file_date FROM (SELECT file_date,
  CASE WHEN k%19=0 THEN fd||'-'||dt||'_'||k||'-23' WHEN k%23=0 THEN fd||'_ERROR-'||dt||'12-'||k ELSE fd||'-'||dt||'-'||k END
  ||'.'||CASE WHEN k%13=0 THEN 'txt' WHEN k%17=0 THEN 'CSV' WHEN k%5=0 THEN 'csv.gz' ELSE 'csv' END AS name FROM f0)),
feeds AS (SELECT unnest([{_feed_list}]) AS feed),
required AS (SELECT unnest(['FD_STORE_INV','FD_SALES','FD_RETURNS']) AS feed)"""
PARSED = FILES + """,
parts AS (SELECT path, name, regexp_split_to_array(name, '-|\\.') AS p FROM files),
parsed AS (SELECT path, name, p[1] AS feed, p[2] AS date_token FROM parts WHERE len(p)>1)"""
CLASSIFIED = FILES + """,
m AS (SELECT f.path, f.name, feeds.feed FROM files f LEFT JOIN feeds ON contains(f.path, feeds.feed)),
mm AS (SELECT *, split_part(name,'.',1) AS stem, string_split(name,'.')[-1] AS ext FROM m),
good AS (SELECT *, coalesce(regexp_matches(stem, '^'||feed||'-[0-9]{8}-[0-9]+$'), false) AS ok FROM mm),
classified AS (SELECT path, name, CASE WHEN ok THEN feed ELSE '' END AS feed,
  CASE WHEN ok THEN split_part(stem,'-',2) ELSE '' END AS file_date,
  CASE WHEN ok AND ext IN ('csv','gz') THEN 'all_valid' WHEN ok THEN 'valid_name' ELSE 'file_name_error' END AS status FROM good)"""
ROUTED = CLASSIFIED + """,
routed AS (SELECT *, CASE status WHEN 'all_valid' THEN 'out/success/'||feed||'/'||name
  WHEN 'valid_name' THEN 'out/error/extension_error/'||feed||'/'||name ELSE 'out/error/file_name_error/'||name END AS target FROM classified)"""
DATED = FILES + """,
dates AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS file_date FROM orders),
dated AS (SELECT dates.file_date, f.path, f.name FROM files f JOIN dates
  ON contains(f.name, strftime(dates.file_date,'%d%m%Y')) OR contains(f.name, strftime(dates.file_date,'%Y%m%d')))"""
DAY = DATED + """,
day AS (SELECT dated.*, feeds.feed, lower(string_split(name,'.')[-1]) IN ('csv','gz') AS permitted
  FROM dated LEFT JOIN feeds ON contains(dated.path, feeds.feed))"""
LOG = DAY + """,
allday AS (SELECT * FROM (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)) - INTERVAL 5 DAY, max(CAST(o_orderdate AS DATE)) + INTERVAL 5 DAY, INTERVAL 1 DAY)) AS DATE) AS file_date
  FROM orders WHERE o_orderstatus IN ('F','O')) WHERE file_date NOT IN (DATE '1997-07-04', DATE '1998-07-04', DATE '1998-12-25', DATE '1999-07-04')),
tday AS (SELECT * FROM day WHERE file_date IN (SELECT file_date FROM allday)),
seen AS (SELECT DISTINCT file_date, feed FROM tday WHERE permitted AND feed IS NOT NULL),
miss AS (SELECT a.file_date, count(s.feed) AS got, string_agg(r.feed, ',' ORDER BY r.feed) FILTER (s.feed IS NULL) AS missed
  FROM allday a CROSS JOIN required r LEFT JOIN seen s ON s.file_date=a.file_date AND s.feed=r.feed GROUP BY a.file_date),
cnt AS (SELECT file_date, feed||':'||count(*) AS cell FROM tday WHERE permitted AND feed IS NOT NULL GROUP BY file_date, feed),
done AS (SELECT file_date, string_agg(cell, ',' ORDER BY cell) AS processed FROM cnt GROUP BY file_date),
rows_ AS (SELECT file_date, 'failed' AS status, 'critical' AS priority, CASE WHEN got=0 THEN 'DATA_ING_ERR_001' ELSE 'DATA_ING_ERR_002' END AS error_code,
  CASE WHEN got=0 THEN 'All Files missed for the day' ELSE 'Mandatory files missed for the day' END AS error_message, missed AS missed_files, '' AS processed_files
  FROM miss WHERE got<3 UNION ALL SELECT file_date, 'success', '', '', '', '', processed FROM done WHERE file_date IN (SELECT file_date FROM allday)),
log AS (SELECT '1' AS sub_proc_id, '2' AS run_id, '3' AS task_id, 'Data Ingestion' AS component, '20000630' AS run_date,
  strftime(file_date,'%Y%m%d') AS file_date, status, priority, error_code, error_message, missed_files, processed_files,
  '' AS unpermitted_files, '' AS extra FROM rows_)"""
