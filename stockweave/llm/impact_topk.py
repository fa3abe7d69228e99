"""Exact top-k inner products with an impact-ordered, score-at-a-time index.

A component d of a shard's vectors gives two posting lists: "up" impacts x - min_d for
queries with a positive weight and "down" impacts max_d - x for negative ones.  All impacts
are then non-negative and a score is

    base(query) + sum over d of |q_d| * impact_d.

Impacts are quantised to levels of ``step``; the postings of a range of levels are one
segment.  A block of queries takes the segments from the highest levels down, one matrix
product each, as the lists of dense vectors are full.  What a vector has not been met in can
add less than the lowest level so far, so every pair has a lower and an upper bound.  A query
stops as soon as the vectors whose upper bound reaches its threshold are few, or no segment
is left, and rescores exactly those.  The threshold is the k-th lower bound, or the k-th score
that the query has from its first shard; a shard that cannot reach it is passed over.

Bounds are whole numbers in floating point; they are computed in a type that holds them
exactly, and scores beyond 2**53 are refused.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockweave.llm.store import stored

#: Queries that go through the segments together.
TOGETHER = 256
#: Shares of all postings in the segments, from the highest level down.
SEGMENTS = (0.25, 1.0)
NONE = -(1 << 62)


class ImpactIndex:
    """Posting segments by descending level over the rows of an integer matrix."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, step: int = 8):
        self.vectors, self.ids, self.step = vectors, ids, step
        self.low, self.high = vectors.min(axis=0), vectors.max(axis=0)
        impacts = np.concatenate([vectors - self.low, self.high - vectors], axis=1)
        self.most = impacts.max(axis=0)
        levels = impacts // step
        ordered = np.sort(levels, axis=None)[::-1]
        cuts = [int(ordered[min(len(ordered), int(s * len(ordered))) - 1]) if s < 1 else 0 for s in SEGMENTS]
        self.segments, above = [], None
        for cut in sorted(set(cuts), reverse=True):
            inside = levels >= cut if above is None else (levels >= cut) & (levels < above)
            self.segments.append((cut, np.where(inside, levels, 0), inside))
            above = cut

    def weights(self, queries: np.ndarray) -> np.ndarray:
        return np.concatenate([np.maximum(queries, 0), np.maximum(-queries, 0)], axis=1)

    def base(self, queries: np.ndarray) -> np.ndarray:
        return np.maximum(queries, 0) @ self.low - np.maximum(-queries, 0) @ self.high

    def reach(self, queries: np.ndarray) -> np.ndarray:
        """The largest score that any row of the shard could have."""
        return self.base(queries) + self.weights(queries) @ self.most

    def possible(self, queries: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray, few: int) -> list[np.ndarray]:
        """For each query the rows that may be among its k best; rows with its id are out."""
        weight = self.weights(queries)
        total = weight.sum(axis=1)
        largest = int(total.max(initial=0)) * (int(self.most.max(initial=0)) + self.step)
        if largest + int(np.abs(self.base(queries)).max(initial=0)) >= 1 << 53:
            raise ValueError("scores beyond 2**53 cannot be bounded exactly")
        kind = np.float32 if largest < 1 << 24 else np.float64
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(queries)
        live, rows = np.arange(len(queries)), np.arange(len(self.ids))
        lower, met = (np.zeros((len(queries), len(rows)), kind) for _ in range(2))
        floor = (floor - self.base(queries)).clip(-1).astype(kind)  # impacts count from the base
        for number, (cut, levels, inside) in enumerate(self.segments):
            w = weight[live].astype(kind)
            lower += self.step * (w @ levels[rows].T.astype(kind))
            if number + 1 < len(self.segments):
                met += w @ inside[rows].T.astype(kind)
                rest = total[live, None].astype(kind) - met
                upper = lower + met * (self.step - 1) + rest * max(cut * self.step - 1, 0)
            else:
                upper = lower + total[live, None].astype(kind) * (self.step - 1)
            self_row = self.ids[rows][None, :] == own[live, None]
            upper[self_row] = -2
            if len(rows) > k:
                known = np.where(self_row, kind(-2), lower)
                least = np.maximum(floor[live], np.partition(known, len(rows) - k - 1, axis=1)[:, len(rows) - k])
            else:
                least = floor[live]
            good = upper >= least[:, None]
            count = good.sum(axis=1)
            ready = (count <= few) | (number + 1 == len(self.segments))
            for i in np.flatnonzero(ready):
                out[live[i]] = rows[good[i] & ~self_row[i]]
            if ready.all():
                break
            keep, used = ~ready, good[~ready].any(axis=0)
            live, rows = live[keep], rows[used]
            lower, met = lower[keep][:, used], met[keep][:, used]
        return out

    def top(self, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, scores) of the k best rows of each query, ties to the smaller id; rows under
        the query's floor may be missing."""
        out = []
        few = max(4 * k, len(self.ids) // 64)
        for start in range(0, len(queries), TOGETHER):
            part = slice(start, start + TOGETHER)
            for query, rows in zip(queries[part], self.possible(queries[part], own[part], k, floor[part], few)):
                scores = self.vectors[rows] @ query
                best = np.lexsort((self.ids[rows], -scores))[:k]
                out.append((self.ids[rows][best], scores[best]))
        return out


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(id, vector array<long>) = floor(scale * x), x as double; vectors that are null or hold
    a null, infinite or NaN component are left out."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return df.where(x.isNotNull() & ~bad).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(x, lambda v: F.floor(F.lit(scale) * v.cast("double")).cast("long")).alias("vector"),
    )


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    shard_rows: int = 8192,
    block_rows: int = 8192,
    step: int = 8,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best of all vectors but its own id.

    Both inputs have (id, vector array<long>).  Vectors are dealt by id to shards of about
    ``shard_rows``, queries to blocks of about ``block_rows``.  Each query first meets one
    shard, which gives it a threshold, and then the others, each pair of shard and block
    being one group with its own index that yields at most k rows a query; from these the k
    best overall are taken.  Both sizes set the work's layout only: results are exact.
    Shorter vectors count as padded by zeros; a row given twice counts once; different
    vectors with one id are candidates each, and queries each; with fewer than k candidates a
    query gets them all; other columns are not read; empty tables give an empty result.
    """
    shards = max(1, -(-vectors.count() // shard_rows))
    blocks = max(1, -(-queries.count() // block_rows))
    deal = lambda n: F.pmod(F.xxhash64("id"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    no_floor = F.lit(NONE).cast("long").alias("floor")

    def best(cell: pd.DataFrame) -> pd.DataFrame:
        width = max(map(len, cell["vector"]))
        matrix = _matrix(cell["vector"], width)
        asks, ids, floor = cell["asks"].to_numpy(bool), cell["id"].to_numpy(np.int64), cell["floor"].to_numpy(np.int64)
        out = {"query_id": [np.zeros(0, np.int64)], "vec_id": [np.zeros(0, np.int64)], "score": [np.zeros(0, np.int64)]}
        if width and asks.any() and not asks.all():
            wanted = np.unique(np.c_[ids, floor, matrix][asks], axis=0)
            rows = np.unique(np.c_[ids, matrix][~asks], axis=0)
            index = ImpactIndex(np.ascontiguousarray(rows[:, 1:]), rows[:, 0], step)
            wanted = wanted[index.reach(wanted[:, 2:]) >= wanted[:, 1]]
            for own, (found, scores) in zip(wanted[:, 0], index.top(wanted[:, 2:], wanted[:, 0], wanted[:, 1], k)):
                for name, x in (("query_id", np.full(len(found), own)), ("vec_id", found), ("score", scores)):
                    out[name].append(x)
        return pd.DataFrame({n: np.concatenate(x) for n, x in out.items()})

    kind = "query_id long, vec_id long, score long"
    no = F.lit(False).alias("asks")
    yes = F.lit(True).alias("asks")
    # a query's first shard is the one its id is dealt to, and it meets that one alone
    held = vectors.select("id", "vector", no, deal(shards).alias("shard"), no_floor)
    asked = queries.select("id", "vector", yes, deal(shards).alias("shard"), no_floor)
    first = held.unionByName(asked).groupBy("shard").applyInPandas(best, kind)
    if shards > 1:
        first = stored(first, "first")
        order = Window.partitionBy("query_id").orderBy(F.desc("score"))
        # of queries with one id but different vectors the lower threshold holds for each only
        # if each had its own: such ids get none
        twice = queries.groupBy("id").agg(F.count_distinct("vector").alias("vectors"))
        kth = first.withColumn("place", F.row_number().over(order)).where(F.col("place") == k)
        floors = kth.join(twice.where("vectors = 1"), F.col("id") == F.col("query_id")).select("id", F.col("score").alias("floor"))
        seeking = queries.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(NONE).cast("long")))
        seeking = seeking.select("id", "vector", yes, deal(shards).alias("home"), every(shards).alias("shard"), deal(blocks).alias("block"), "floor")
        seeking = seeking.where("shard <> home").drop("home")
        cells = held.withColumn("block", every(blocks)).unionByName(seeking)
        first = first.unionByName(cells.groupBy("shard", "block").applyInPandas(best, kind))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s
)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 5
"""
