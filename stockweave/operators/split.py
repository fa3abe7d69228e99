"""Time-ordered train / validation / test split.

The splitting routine itself is missing; ours cuts each pair's history by date:
the newest tenth is test, the newest tenth of the rest validation.  Pairs with
too little history stay whole in train.  The cut depends on ranks alone, so batch
borders and partition counts cannot change it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockweave import columns as c
from stockweave.functions.windows import pair_order

HISTORICAL_MIN_ROWS = 270
INCREMENTAL_MIN_ROWS = 10


def split_by_time(df: DataFrame, min_rows: int, tenths: int = 9) -> DataFrame:
    """``tenths`` of 10 go to train + validation, and the same share of those to train."""
    rank = F.row_number().over(pair_order())
    size = F.count(F.lit(1)).over(Window.partitionBy(*c.PAIR))
    ranked = df.withColumns({"__rank": rank, "__size": size})
    not_test = F.floor(F.col("__size") * tenths / 10)
    train = F.floor(not_test * tenths / 10)
    part = (
        F.when(F.col("__size") < min_rows, "train")
        .when(F.col("__rank") <= train, "train")
        .when(F.col("__rank") <= not_test, "validation")
        .otherwise("test")
    )
    return ranked.withColumn("data_split", part).drop("__rank", "__size")


def split_historical(df: DataFrame, min_rows: int = HISTORICAL_MIN_ROWS) -> DataFrame:
    return split_by_time(df, min_rows)


def split_incremental(df: DataFrame, min_rows: int = INCREMENTAL_MIN_ROWS) -> DataFrame:
    return split_by_time(df, min_rows)


def split_filter(df: DataFrame, part: str = "test") -> DataFrame:
    return df.where(F.col("data_split") == part)
