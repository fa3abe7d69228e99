"""Fitted tree ensembles as column expressions: scored in the JVM, without a model in the task.

An ensemble comes from a fitted ``pyspark.ml`` model or from the JSON dump of a boosted model
(one document a tree: ``split``, ``split_condition``, ``yes``, ``no``, ``missing``,
``children`` or ``leaf``).  A tree becomes nested conditions on the feature columns, so the
scan reads only the features that some split uses.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Leaf:
    value: float


@dataclass(frozen=True)
class Split:
    """``low`` is taken where the feature is under the threshold (or equal, if ``closed``);
    a null or NaN feature takes ``low`` if ``missing_low``."""

    feature: str
    threshold: float
    closed: bool
    missing_low: bool
    low: Leaf | Split
    high: Leaf | Split


@dataclass(frozen=True)
class Ensemble:
    """base + sum of weight * tree; ``logistic``: 1 / (1 + exp(-logistic * sum))."""

    trees: tuple[Leaf | Split, ...]
    weights: tuple[float, ...]
    base: float = 0.0
    logistic: float | None = None

    def features(self) -> set[str]:
        def of(node) -> set[str]:
            return set() if isinstance(node, Leaf) else {node.feature} | of(node.low) | of(node.high)

        return set().union(*(of(t) for t in self.trees))


def from_dump(trees: list[str | dict], base: float = 0.0, logistic: bool = False) -> Ensemble:
    """Ensemble of a boosted model's JSON dump."""

    def read(node: dict) -> Leaf | Split:
        if "leaf" in node:
            return Leaf(float(node["leaf"]))
        child = {x["nodeid"]: x for x in node["children"]}
        low, high = (read(child[node[side]]) for side in ("yes", "no"))
        return Split(node["split"], float(node["split_condition"]), False, node.get("missing", node["yes"]) == node["yes"], low, high)

    read_trees = tuple(read(json.loads(t) if isinstance(t, str) else t) for t in trees)
    return Ensemble(read_trees, (1.0,) * len(read_trees), base, 1.0 if logistic else None)


def from_fitted(model, features: list[str]) -> Ensemble:
    """Ensemble of a fitted gradient-boosted ``pyspark.ml`` model over continuous features."""

    def read(node) -> Leaf | Split:
        if node.getClass().getSimpleName() == "LeafNode":
            return Leaf(float(node.prediction()))
        split = node.split()
        if split.getClass().getSimpleName() != "ContinuousSplit":
            raise ValueError("only continuous features can be compiled")
        sides = read(node.leftChild()), read(node.rightChild())
        return Split(features[split.featureIndex()], float(split.threshold()), True, False, *sides)

    trees = tuple(read(t._java_obj.rootNode()) for t in model.trees)
    # a boosted classifier's margin counts twice in its link
    return Ensemble(trees, tuple(float(w) for w in model.treeWeights), 0.0, 2.0 if model.hasParam("probabilityCol") else None)


def compiled(ensemble: Ensemble) -> Column:
    """The score as an expression of the feature columns."""

    def of(node: Leaf | Split) -> Column:
        if isinstance(node, Leaf):
            return F.lit(node.value)
        x = F.col(node.feature).cast("double")
        missing = x.isNull() | F.isnan(x)
        below = x <= node.threshold if node.closed else x < node.threshold
        low, high = of(node.low), of(node.high)
        return F.when(missing, low if node.missing_low else high).when(below, low).otherwise(high)

    terms = [F.lit(ensemble.base), *(F.lit(w) * of(t) for w, t in zip(ensemble.weights, ensemble.trees))]
    total = reduce(lambda a, b: a + b, terms)
    return total if ensemble.logistic is None else F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-ensemble.logistic) * total))


def score_with_trees(df: DataFrame, ensembles: dict[str, Ensemble]) -> DataFrame:
    """The columns the cascade reads, from the four ensembles binary, hl, low and high."""
    target = {"binary": "binary_pred", "hl": "hl_score", "low": "low_pred", "high": "high_pred"}
    return df.withColumns({name: compiled(ensembles[key]) for key, name in target.items()})
