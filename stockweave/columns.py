"""Fixed column vocabulary of the inventory panel.

The panel holds one row per (SKU, LOCATION, DATE).  Units and money are
integers (money in cents), so every sum is exact whatever the partitioning.
"""

from __future__ import annotations

SKU = "SKU"
LOCATION = "LOCATION"
DATE = "DATE"
KEY = [SKU, LOCATION, DATE]
PAIR = [SKU, LOCATION]

LOCATION_GROUP = "LOCATION_GROUP"
LOAD_DATE = "LOAD_DATE"
CAT = "CAT"
DEPT = "DEPT"
LOB = "LOB"

SALES_COUNT = "SALES_COUNT"
SALES_UNITS = "SALES_UNITS"
GROSS_SALES = "SALES_UNITS_WITHOUT_RETURN"
RETURN_UNITS = "RETURN_UNITS"
IN_TRANSIT = "IN_TRANSIT_UNITS"
POS_ADJ = "POS_ADJ_UNITS"
NEG_ADJ = "NEG_ADJ_UNITS"
ADJ_UNITS = "ADJ_UNITS"
DSD_UNITS = "DSD_TRANSFERRED_UNITS"
UNIT_RETAIL = "SALES_UNIT_RETAIL"
TOTAL_RETAIL = "TOTAL_RETAIL"
BEGIN_SOH = "DAY_BEGIN_SOH"
END_SOH = "DAY_END_SOH"
START_INTRANS = "DAY_START_INTRANS"
END_INTRANS = "DAY_END_INTRANS"
START_TOTAL = "DAY_START_TOTAL"
END_TOTAL = "DAY_END_TOTAL"
EOP_SOH = "IP_QTY_EOP_SOH"
BOOK = "CURDAY_IP_QTY_EOP_SOH"
AUDIT_FLAG = "AUDIT_FLAG"
AUDIT_DATE = "AUDIT_DATE"
AUDIT_UNITS = "AUDIT_UNITS"

# derived by the audit chain
AUDIT_DAY_UNITS = "AUDIT_DAY_UNITS"
AUDIT_ADJ_UNITS = "AUDIT_ADJ_UNITS"
ONHAND_RECORDED = "ONHAND_RECORDED"
LAST_CC_DATE = "LAST_CC_DATE"
AUDIT_PREV_CC_DATE = "AUDIT_PREV_CC_DATE"
AUDIT_ADJ_FLAG = "AUDIT_ADJ_FLAG"
PRE_AUDIT_CC_DAY_FLAG = "PRE_AUDIT_CC_DAY_FLAG"
AUDIT_ADJ_EOP_SOH = "AUDIT_ADJ_EOP_SOH"

# carried state
LEDGER_STATE = "meta_ledger_bal_ip_qty_eop_soh"
SHELF_STATE = [
    "meta_CUMULATIVE_SOH",
    "meta_CUMULATIVE_DAILY_OUT",
    "meta_CARRY_FORWARD_CUMULATIVE_SOH",
    "meta_CUMULATIVE_BATCH_QTY",
    "meta_REV_CUMULATIVE_SOH_MIN",
    "meta_REV_CUMULATIVE_SOH_MAX",
]
FOOTFALL_STATE = ["meta_footfall_daily_min", "meta_footfall_daily_max"]
DAILY_STATE = SHELF_STATE + FOOTFALL_STATE

# The feature columns of the output, with these names and in this order.
FEATURES = [
    "inv_shrinkage_ratio_7", "REV_CUMULATIVE_SOH_SCALE", "LEDGER_BAL_RATIO_28", "sale_scale_28",
    "LEDGER_BAL_RATIO_7", "price_scale_7", "sale_day_ratio_84", "sale_day_ratio_28", "footfall_scale",
    "sale_decay_decimal", "itr_ratio_28", "itr_ratio_7", "sell_through_rate_56", "LEDGER_BAL_RATIO_14",
    "itr_ratio_14", "sales_ratio_28_84", "oos_ratio_28", "inv_shrinkage_ratio_14", "stock_ratio_7_28",
    "sell_through_rate_84", "transfer_decay_decimal", "inv_shrinkage_ratio_28",
    "categorical_shrinkage_scale_7", "oos_ratio_84", "inv_sales_ratio_7", "stock_ratio_28_84",
    "inv_sales_ratio_28", "inv_sales_ratio_14", "sell_through_rate_28", "footfall_index",
    "sales_ratio_7_28", "CAT", "CURDAY_IP_QTY_EOP_SOH", "DEPT", "LOB", "audit_day_flag", "day_of_week",
]
