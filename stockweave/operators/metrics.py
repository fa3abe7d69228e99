"""Scores of predictions against truth.

Each group of metrics is one conditional aggregate over one scan, optionally per
``model``.  Empty denominators give 0 where the figure is defined so, else null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave import columns as c
from stockweave.functions.exprs import fixed_ratio, percent, percent_or_zero


def actual_vs_predicted(actual: DataFrame, predicted: DataFrame) -> DataFrame:
    """Audited truth next to the prediction of the same key."""
    return actual.join(predicted, c.KEY, "inner")


def _confusion(truth: Column, guess: Column) -> dict[str, Column]:
    return {
        "tp": F.count_if(truth & guess),
        "fn": F.count_if(truth & ~guess),
        "tn": F.count_if(~truth & ~guess),
        "fp": F.count_if(~truth & guess),
    }


def _aggregate(df: DataFrame, by: list[str], figures: dict[str, Column]) -> DataFrame:
    return df.groupBy(*by).agg(*(x.alias(n) for n, x in figures.items()))


def confusion_counts(report: DataFrame, by: list[str] = ()) -> DataFrame:
    flags = F.col("ACTUAL_OOS_FLAG"), F.col("OOS")
    figures = {
        "tp": F.count_if((flags[0] == 1) & (flags[1] == 1)),
        "fn": F.count_if((flags[0] == 1) & (flags[1] == 0)),
        "tn": F.count_if((flags[0] == 0) & (flags[1] == 0)),
        "fp": F.count_if((flags[0] == 0) & (flags[1] == 1)),
    }
    return _aggregate(report, list(by), figures)


def confusion_percent(counts: DataFrame) -> DataFrame:
    """Rates in percent; F1 is taken from the rounded precision and recall."""
    tp, fn, tn, fp = (F.col(n) for n in ("tp", "fn", "tn", "fp"))
    out = counts.withColumns(
        {
            "tp_perc": percent_or_zero(tp, tp + fn),
            "fn_perc": percent_or_zero(fn, tp + fn),
            "recall_perc": percent_or_zero(tp, tp + fn),
            "tn_perc": percent_or_zero(tn, tn + fp),
            "fp_perc": percent_or_zero(fp, tn + fp),
            "precision_perc": percent_or_zero(tp, tp + fp),
            "accuracy_perc": percent_or_zero(tp + tn, tp + fn + tn + fp),
        }
    )
    p, r = (F.round(F.col(n) * 100) for n in ("precision_perc", "recall_perc"))
    harmonic = F.round(F.try_divide(2 * p * r, p + r)) / F.lit(100.0)
    return out.withColumn("f1_score", F.coalesce(harmonic, F.lit(0.0)))


def classification_metrics(
    df: DataFrame, step: str, truth: str, score: str, threshold: float = 0.5, by: list[str] = ()
) -> DataFrame:
    """Accuracy, precision, recall and F1 of ``score > threshold``, three decimals."""
    counts = _aggregate(df, list(by), _confusion(F.col(truth) == 1, F.col(score) > threshold))
    tp, fn, tn, fp = (F.col(n) for n in ("tp", "fn", "tn", "fp"))
    zero = F.lit(0.0)
    return counts.select(
        *by,
        fixed_ratio(tp + tn, tp + tn + fp + fn, 3).alias(f"{step}_accuracy"),
        F.coalesce(fixed_ratio(tp, tp + fp, 3), zero).alias(f"{step}_precision"),
        F.coalesce(fixed_ratio(tp, tp + fn, 3), zero).alias(f"{step}_recall"),
        F.coalesce(fixed_ratio(2 * tp, 2 * tp + fp + fn, 3), zero).alias(f"{step}_f1"),
    )


def roc_auc(df: DataFrame, truth: str, score: str, name: str = "roc_auc", by: list[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, ties averaged; 0 when truth has one class.

    Rows are first counted per distinct score, so a score shared by many rows is
    one row.  The scores are range-partitioned and ranked inside each range only;
    the ranges, one row each, are then put in order.  No task sees all scores.
    """
    by = list(by)
    positive = F.col(truth) == 1
    per_score = df.groupBy(*by, score).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    ranged = per_score.repartitionByRange(*by, score).withColumn("__range", F.spark_partition_id())
    exact = "decimal(38,0)"
    inside = Window.partitionBy(*by, "__range").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranged.withColumn("below", F.coalesce(F.sum("neg").over(inside), F.lit(0)))
    # twice the number of (positive, lower negative) pairs: a tie counts one, a win two
    won = F.col("pos").cast("decimal(19,0)") * (2 * F.col("below") + F.col("neg")).cast("decimal(19,0)")
    ranges = ranked.groupBy(*by, "__range").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum(won.cast(exact)).cast(exact).alias("won")
    )
    # one row per range: as many as there are partitions
    earlier = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    lower = F.coalesce(F.sum("neg").over(earlier), F.lit(0))
    placed = ranges.withColumn(
        "won",
        F.col("won") + (F.col("pos").cast("decimal(19,0)") * (2 * lower).cast("decimal(19,0)")).cast(exact),
    )
    totals = placed.groupBy(*by).agg(
        F.sum("won").cast("double").alias("won"),
        F.sum("pos").cast("double").alias("pos"),
        F.sum("neg").cast("double").alias("neg"),
    )
    area = fixed_ratio(F.col("won"), 2 * F.col("pos") * F.col("neg"), 3)
    return totals.select(*by, F.coalesce(area, F.lit(0.0)).alias(name))


def regression_metrics(df: DataFrame, step: str, truth: str, pred: str, columns: int, by: list[str] = ()) -> DataFrame:
    """MSE, R2 and R2 adjusted for ``columns - 1`` predictors, three decimals."""
    y, error = F.col(truth), F.col(truth) - F.col(pred)
    sums = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(error * error).alias("sse"), F.var_pop(y).alias("spread")
    )
    n, k = F.col("n"), F.lit(columns - 1)
    unexplained = F.try_divide(F.col("sse"), n * F.col("spread"))
    flat = F.when(F.col("sse") == 0, 1.0).otherwise(0.0)  # constant truth
    r2 = F.when(n <= 1, 0.0).otherwise(F.coalesce(1 - unexplained, flat))
    adjusted = 1 - F.try_divide((1 - r2) * (n - 1), (n - k - 1).cast("double"))

    def three(x: Column) -> Column:
        return F.round(x * 1000) / F.lit(1000.0)

    return sums.select(
        *by,
        three(F.when(n <= 1, 0.0).otherwise(F.col("sse") / n)).alias(f"{step}_mean_squared_err"),
        three(r2).alias(f"{step}_r2"),
        three(adjusted).alias(f"{step}_adjusted_r2"),
    )


TRUE_STOCK = "rev_ip_qty_eop_soh"


def _stock_figures() -> dict[str, Column]:
    return _confusion(F.col(TRUE_STOCK) <= 0, F.col("orig_pred_low") <= 0)


def stock_confusion(df: DataFrame, by: list[str] = ()) -> DataFrame:
    """Confusion of 'true stock is gone' against 'range reaches down to zero'."""
    return confusion_percent(_aggregate(df, list(by), _stock_figures()))


def _range_figures() -> dict[str, Column]:
    actual, book = F.col(TRUE_STOCK), F.col(c.BOOK)
    low, high = F.col("orig_pred_low"), F.col("orig_pred_high")
    inside = (low <= actual) & (high >= actual)
    under, over = actual <= book, actual > book
    return {
        "n_under": F.count_if(under),
        "under_inside": F.count_if(under & inside),
        "under_overall": F.count_if(under & (low <= book)),
        "n_over": F.count_if(over),
        "over_inside": F.count_if(over & inside),
        "over_overall": F.count_if(over & (high > book)),
    }


def _range_percent() -> dict[str, Column]:
    return {
        "under_accurate_perc": percent(F.col("under_inside"), F.col("n_under")),
        "under_overall_perc": percent(F.col("under_overall"), F.col("n_under")),
        "over_accurate_perc": percent(F.col("over_inside"), F.col("n_over")),
        "over_overall_perc": percent(F.col("over_overall"), F.col("n_over")),
    }


def range_performance(df: DataFrame, by: list[str] = ()) -> DataFrame:
    """How often the range holds the true quantity, at or below the book and above it."""
    counts = _aggregate(df, list(by), _range_figures())
    return counts.select(*by, *(x.alias(n) for n, x in _range_percent().items()))


def _cases() -> dict[str, Column]:
    gone = F.col("BINARY_TARGET_CLASSIFICATION") == 1
    book_right, model_right = F.col(c.EOP_SOH) <= 0, F.col("orig_pred_low") <= 0
    return {
        "br_pr": gone & book_right & model_right,
        "br_pw": gone & book_right & (F.col("orig_pred_low") > 0),
        "bw_pr": gone & (F.col(c.EOP_SOH) > 0) & model_right,
        "pw": gone & (F.col("orig_pred_low") > 0),
    }


def _book_figures() -> dict[str, Column]:
    return {"n": F.count(F.lit(1))} | {n: F.count_if(x) for n, x in _cases().items() if n != "pw"}


def _book_percent() -> dict[str, Column]:
    return {f"{n}_perc": percent(F.col(n), F.col("n")) for n in ("br_pr", "br_pw", "bw_pr")}


def book_vs_model(df: DataFrame, by: list[str] = ()) -> DataFrame:
    """Book right / wrong against prediction right / wrong among true stock-outs."""
    counts = _aggregate(df, list(by), _book_figures())
    return counts.select(*by, *(x.alias(n) for n, x in _book_percent().items()))


def _revenue_figures() -> dict[str, Column]:
    case = _cases()
    names = {
        "br_pr_value": case["br_pr"],
        "revenue_recovery": case["bw_pr"],
        "loss": case["pw"],
        "loss_book_recovers": case["br_pw"],
    }
    return {
        n: F.coalesce(F.sum(F.when(x, F.col(c.TOTAL_RETAIL))), F.lit(0)).cast("bigint") for n, x in names.items()
    }


def revenue_impact(df: DataFrame, by: list[str] = ()) -> DataFrame:
    """Retail value of the four cases, whole units."""
    return _aggregate(df, list(by), _revenue_figures())


def overall_metrics(df: DataFrame, by: list[str] = ()) -> DataFrame:
    """The full score document: confusion, ranges, book against model, revenue; one scan."""
    by = list(by)
    figures = _stock_figures() | _range_figures() | _book_figures() | _revenue_figures()
    counts = _aggregate(df, by, figures)
    out = confusion_percent(counts).withColumns(_range_percent() | _book_percent())
    return out.select(
        *by,
        "tp_perc", "tn_perc", "fp_perc", "fn_perc", "precision_perc", "recall_perc", "f1_score",
        "accuracy_perc", *_range_percent(), *_book_percent(), *_revenue_figures(),
    )


def champion_compare(predictions: DataFrame, columns: int) -> DataFrame:
    """One row of step and overall metrics per ``model``, side by side.

    Step 1 is scored on all rows, not only on those it flagged.
    """
    by = ["model"]
    passed = predictions.where(F.col("step") != 1)
    parts = [
        classification_metrics(predictions, "step_1", "BINARY_TARGET_CLASSIFICATION", "binary_pred", by=by),
        roc_auc(predictions, "BINARY_TARGET_CLASSIFICATION", "binary_pred", "step_1_roc_auc", by=by),
        classification_metrics(passed, "step_2", "BINARY_HL_TARGET_CLASSIFICATION", "hl_orig_pred", by=by),
        roc_auc(passed, "BINARY_HL_TARGET_CLASSIFICATION", "hl_orig_pred", "step_2_roc_auc", by=by),
        regression_metrics(predictions.where("step = 3"), "step_3", "TARGET_REGRESSION", "orig_pred", columns, by=by),
        regression_metrics(predictions.where("step = 4"), "step_4", "TARGET_REGRESSION", "orig_pred", columns, by=by),
        overall_metrics(predictions, by=by),
    ]
    table = parts[0]
    for part in parts[1:]:
        table = table.join(part, by, "left")  # one row per model on both sides
    return table


def promotion_decision(scores: DataFrame, compare: bool = True) -> DataFrame:
    """Promote the new model when its score is strictly higher, or always when the
    comparison is off.  ``scores``: model ('new' / 'prod'), score."""
    row = scores.agg(
        F.max(F.when(F.col("model") == "new", F.col("score"))).alias("new_score"),
        F.max(F.when(F.col("model") == "prod", F.col("score"))).alias("prod_score"),
    )
    better = F.lit(not compare) | F.coalesce(F.col("new_score") > F.col("prod_score"), F.lit(False))
    return row.withColumn("decision", F.when(better, "promote").otherwise("keep"))
