"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm.store import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: each vertex hands its smallest neighbour on to its larger neighbours
    (large) or to its smaller ones and itself (small)."""
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    else:
        both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    # the smaller side has one row a vertex; a vertex with very many neighbours is split by
    # the adaptive skew join
    joined = both.join(least, "u")
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.least("u", "m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) of every vertex of the edges (a, b): component is the smallest vertex
    that is reachable.

    Alternates large and small stars; each round is written to the shared folder, and the
    end is seen from a count and a hash sum of the edges.  Rounds grow with the logarithm
    of the longest path; running out of them raises an error, never a partial result.
    """
    current = stored(edges.select("a", "b").where(F.col("a") != F.col("b")).distinct(), "links")
    seen = None
    for _ in range(rounds):
        current = stored(_star(_star(current, True), False), "stars")
        state = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen:
            ends = current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
            return current.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(ends)
        seen = state
    raise RuntimeError("components did not settle; raise rounds")
