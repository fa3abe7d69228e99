"""Run a query on Spark and its statement on DuckDB and compare the rows exactly."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb

#: The smallest of the given table folders.
SMALL = "/root/testdata/sf0.001"

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        path = Path(root) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def cell(value):
    if value is None:
        return "null"
    if isinstance(value, bool):
        return f"b{int(value)}"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"f{value!r}"
    if isinstance(value, int):
        return f"i{value}"
    if isinstance(value, decimal.Decimal):
        return f"d{value}"
    if isinstance(value, datetime.datetime):
        return f"t{value.isoformat()}"
    if isinstance(value, datetime.date):
        return f"D{value.isoformat()}"
    return f"s{value}"


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql, limit=3):
    """Empty when both sides agree, else a description of the first differences."""
    spark_columns, spark_rows = normalised(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    duck_columns, duck_rows = normalised([d[0] for d in result.description], result.fetchall())
    if spark_columns != duck_columns:
        return f"columns differ: {spark_columns} / {duck_columns}"
    if len(spark_rows) != len(duck_rows):
        return f"row counts differ: {len(spark_rows)} / {len(duck_rows)}"
    out = []
    for a, b in zip(spark_rows, duck_rows):
        if a != b:
            out.append(str([(n, x, y) for n, x, y in zip(spark_columns, a, b) if x != y] + [a[:4]]))
            if len(out) == limit:
                break
    return "; ".join(out)
