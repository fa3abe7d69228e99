"""Given models of the cascade: JSON dumps of small boosted ensembles."""

from __future__ import annotations

# The trees of the four models, as dumped.
DUMPS: dict[str, list[dict]] = {
    "binary": [
        {"nodeid": 0, "split": "DAY_END_SOH", "split_condition": 12, "yes": 1, "no": 2, "missing": 2, "children": [
            {"nodeid": 1, "split": "SALES_UNITS", "split_condition": 30, "yes": 3, "no": 4, "missing": 3, "children": [
                {"nodeid": 3, "leaf": 0.75}, {"nodeid": 4, "leaf": 1.5}]},
            {"nodeid": 2, "leaf": -0.875}]},
        {"nodeid": 0, "split": "DAY_BEGIN_SOH", "split_condition": 5, "yes": 1, "no": 2, "missing": 1, "children": [
            {"nodeid": 1, "leaf": 0.5}, {"nodeid": 2, "leaf": -0.25}]},
    ],
    "hl": [
        {"nodeid": 0, "split": "AUDIT_UNITS", "split_condition": 1, "yes": 1, "no": 2, "missing": 2, "children": [
            {"nodeid": 1, "leaf": -0.5}, {"nodeid": 2, "split": "RETURN_UNITS", "split_condition": 0, "yes": 3, "no": 4, "missing": 4, "children": [
                {"nodeid": 3, "leaf": 1.25}, {"nodeid": 4, "leaf": 0.125}]}]},
    ],
    "low": [
        {"nodeid": 0, "split": "SALES_UNITS", "split_condition": 20, "yes": 1, "no": 2, "missing": 1, "children": [
            {"nodeid": 1, "leaf": 0.5}, {"nodeid": 2, "leaf": 0.25}]},
        {"nodeid": 0, "split": "IN_TRANSIT_UNITS", "split_condition": 0.5, "yes": 1, "no": 2, "missing": 1, "children": [
            {"nodeid": 1, "leaf": 0.0625}, {"nodeid": 2, "leaf": -0.125}]},
    ],
    "high": [
        {"nodeid": 0, "split": "DAY_END_SOH", "split_condition": 100, "yes": 1, "no": 2, "missing": 1, "children": [
            {"nodeid": 1, "split": "SALES_COUNT", "split_condition": 2, "yes": 3, "no": 4, "missing": 3, "children": [
                {"nodeid": 3, "leaf": 0.875}, {"nodeid": 4, "leaf": 0.75}]},
            {"nodeid": 2, "leaf": 1.125}]},
    ],
}
BASE = {"binary": -0.25, "hl": 0.125, "low": 0.0, "high": 0.0625}
LOGISTIC = {"binary", "hl"}
