"""Four-stage prediction cascade as one projection.

Stage 1 flags out-of-stock; stage 2 decides between the low-stock regression
(stage 3) and the high-stock one (stage 4).  Rows carry the four scores, so the
branches are ``when`` arms of one pass rather than filtered copies and a union.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave import columns as c

LAYERS = {
    "final": c.KEY + ["OOS"],
    "concatenated": c.KEY + [
        "binary_pred", "orig_pred_low", "orig_pred_high", "orig_pred", "hl_orig_pred",
        "orig_pred_temp", "OOS",
    ],
    "step_2": c.KEY + ["binary_pred", "hl_orig_pred"],
    "step_3": c.KEY + [
        "binary_pred", "orig_pred_low", "orig_pred_high", "orig_pred", "hl_orig_pred", "orig_pred_temp",
    ],
    "step_4": c.KEY + [
        "binary_pred", "orig_pred_low", "orig_pred_high", "orig_pred", "hl_orig_pred", "orig_pred_temp",
    ],
}


@dataclass(frozen=True)
class Thresholds:
    out_of_stock: float = 0.5
    low_stock: float = 0.5


def feature_cast(df: DataFrame, features: list[str]) -> DataFrame:
    """Text features as integers; text that is no number becomes null."""
    text = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    return df.withColumns({n: F.col(n).try_cast("int") for n in features if n in text})


def score_with_models(df: DataFrame, models: dict[str, object], features: list[str]) -> DataFrame:
    """Scores from fitted ``pyspark.ml`` models (binary, hl, low, high), JVM only.

    Classifiers give the probability of class 1, regressors their prediction.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    out = VectorAssembler(inputCols=features, outputCol="__x", handleInvalid="keep").transform(df)
    target = {"binary": "binary_pred", "hl": "hl_score", "low": "low_pred", "high": "high_pred"}
    for key, name in target.items():
        model = models[key]
        classifier = model.hasParam("probabilityCol")
        made = ["prediction"] + (["probability", "rawPrediction"] if classifier else [])
        scored = model.transform(out)
        value = F.get(vector_to_array("probability"), 1) if classifier else F.col("prediction")
        out = scored.withColumn(name, value).drop(*made)
    return out.drop("__x")


def range_postprocess(df: DataFrame) -> DataFrame:
    """Quantity range around a predicted share (``orig_pred``) of the book quantity.

    Halves round to even throughout, on the scaled value for the two decimals.
    The lower bound is widened first where both bounds meet, then where they lie
    one apart (after the first step), then a negative one is lifted to 0 at the
    cost of one more above.

    One projection per step: nested into one expression, each step would repeat
    the previous ones several times over.
    """
    share = F.rint(F.col("orig_pred") * 100) / F.lit(100.0)
    centre, low, high = F.col("orig_pred_temp"), F.col("orig_pred_low"), F.col("orig_pred_high")
    margin = centre * F.lit(0.15)
    # adding 0 turns a negative zero into a plain one
    out = df.withColumn("orig_pred_temp", F.rint(share * F.col(c.BOOK)) + F.lit(0.0))
    out = out.withColumns(
        {"orig_pred_low": F.rint(centre - margin), "orig_pred_high": F.rint(centre + margin)}
    )
    out = out.withColumn("orig_pred_low", F.when(low == high, low - 2).otherwise(low))
    out = out.withColumn("orig_pred_low", F.when(high - low == 1, low - 1).otherwise(low))
    return out.withColumns(
        {
            "orig_pred_low": F.when(low < 0, F.lit(0.0)).otherwise(low + F.lit(0.0)),
            "orig_pred_high": F.when(low < 0, high + 1).otherwise(high) + F.lit(0.0),
        }
    )


def oos_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("OOS", F.when(F.col("orig_pred_low") == 0, 1).otherwise(0))


def cascade_predict(scored: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """``scored`` has binary_pred, hl_score, low_pred and high_pred."""
    out = F.col("binary_pred") > limits.out_of_stock
    low_stock = F.col("hl_score") > limits.low_stock
    zero = F.lit(0.0)
    staged = scored.withColumns(
        {
            "step": F.when(out, 1).when(low_stock, 3).otherwise(4),
            "hl_orig_pred": F.when(~out, F.col("hl_score")),
            "orig_pred": F.when(out, zero).when(low_stock, F.col("low_pred")).otherwise(F.col("high_pred")),
        }
    )
    flagged = F.col("step") == 1
    return oos_flag(
        range_postprocess(staged).withColumns(
            {
                "orig_pred_temp": F.when(~flagged, F.col("orig_pred_temp")),
                "orig_pred_low": F.when(flagged, zero).otherwise(F.col("orig_pred_low")),
                "orig_pred_high": F.when(flagged, zero).otherwise(F.col("orig_pred_high")),
            }
        )
    )


def prediction_layer(predicted: DataFrame, layer: str) -> DataFrame:
    """One output layer; stage 2 saw all rows stage 1 let pass."""
    rows = {"step_2": F.col("step") != 1, "step_3": F.col("step") == 3, "step_4": F.col("step") == 4}
    kept = predicted.where(rows[layer]) if layer in rows else predicted
    return kept.select(*LAYERS[layer])


def prediction_layers(predicted: DataFrame) -> DataFrame:
    """All layers in one frame with a ``layer`` tag, from a single read of the input."""
    tags = F.array_compact(
        F.array(
            F.lit("final"),
            F.lit("concatenated"),
            F.when(F.col("step") != 1, "step_2"),
            F.when(F.col("step") == 3, "step_3"),
            F.when(F.col("step") == 4, "step_4"),
        )
    )
    tagged = predicted.withColumn("layer", F.explode(tags))

    def present(name: str) -> Column:
        return F.when(F.col("layer").isin([l for l, cols in LAYERS.items() if name in cols]), F.col(name)).alias(name)

    rest = [n for n in LAYERS["concatenated"] if n not in c.KEY]
    return tagged.select("layer", *c.KEY, *(present(n) for n in rest))


def union_concat(*parts: DataFrame) -> DataFrame:
    """Rows of frames whose columns differ; a column a part lacks is null there."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out
