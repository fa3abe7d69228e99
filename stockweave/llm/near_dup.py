"""Near-duplicates by HyperMinHash.

A text's set of word shingles is hashed into buckets; a bucket keeps the number of leading
zeros of its smallest value and the next mantissa bits.  Registers are banded to find
candidates; a Jaccard estimate corrected for chance collisions of registers thins them out,
and the links are confirmed on the full sets.

No bucket is expanded into pairs.  Equal sets are one class first.  In round one each member
of a band bucket meets only the bucket's smallest member; confirmed links give components.
In round two only buckets that still hold several components are looked at, in blocks, and
only pairs from different components come out that pass the estimate and an upper bound of
the intersection.  So every pair that
shares a bucket is either confirmed, refuted, or inside one component already.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm import hashing
from stockweave.llm.components import components
from stockweave.llm.store import stored

BUCKETS = 128
MANTISSA = 10
ROWS = 4
BANDS = BUCKETS // ROWS
#: An empty bucket looks for a filled one at these places in turn.
TRIES = 64
_STEPS = (
    hashing.mix(np.arange(1, BUCKETS * TRIES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(BUCKETS)
).astype(np.int64).reshape(BUCKETS, TRIES)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row; letters A-Z count as a-z.  A row with
    fewer words than ``width`` has its whole sequence as one, without words none."""
    data = np.frombuffer(data.tobytes().translate(hashing.LOWER), np.uint8)
    starts, ends, first = hashing.words(data, offsets)
    single = hashing.Stretches(data).of(starts, ends)
    runs = hashing.grams(single, width)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= width:
            out.append(np.unique(runs[a : b - width + 1]))
        elif b > a:
            out.append(hashing.grams(single[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """HyperMinHash registers, one row of BUCKETS uint16 a set: leading zeros of the bucket's
    minimum above, mantissa bits below.  Empty buckets copy a filled one at a place that
    depends on the bucket alone, so equal sets agree and similar ones mostly do."""
    out = np.zeros((len(sets), BUCKETS), np.uint16)
    filled = np.zeros((len(sets), BUCKETS), bool)
    values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    # sets are sorted, so the first value of a (row, bucket) is its minimum
    cell = row * BUCKETS + (values >> np.uint64(57)).astype(np.int64)
    head = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, int)
    low = (values[head] & np.uint64((1 << 57) - 1)) >> np.uint64(4)  # 53 bits: exact as doubles
    zeros = 53 - np.frexp(low.astype(float))[1]
    mantissa = ((low << zeros.astype(np.uint64)) & np.uint64((1 << 52) - 1)) >> np.uint64(52 - MANTISSA)
    out.ravel()[cell[head]] = (zeros.astype(np.uint64) << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
    filled.ravel()[cell[head]] = True
    original, known = out.copy(), filled.copy()
    has_any = known.any(axis=1)
    for t in range(TRIES):
        r, b = np.nonzero(~filled & has_any[:, None])
        if not len(r):
            break
        source = _STEPS[b, t]
        good = known[r, source]
        out[r[good], b[good]] = original[r[good], source[good]]
        filled[r[good], b[good]] = True
    for r in np.flatnonzero(has_any & ~filled.all(axis=1)):
        places = np.flatnonzero(known[r])
        for b in np.flatnonzero(~filled[r]):
            out[r, b] = original[r, places[np.searchsorted(places, b) % len(places)]]
    return out


def chance(n: int, m: int) -> float:
    """Probability that the registers of a bucket agree for disjoint sets of n and m
    elements: the smallest values, with means 1/x and 1/y, fall into one cell of the grid.
    A cell at [u, u + d) with d = u / 2**MANTISSA (to within the binade) has probability
    about x y d**2 exp(-(x + y) u); summed over the grid this is the integral below."""
    x, y = max(n / BUCKETS, 1.0), max(m / BUCKETS, 1.0)
    return min(1.0, x * y / (x + y) ** 2 * (2.0 ** -MANTISSA) * 1.5)


def estimate(left: np.ndarray, right: np.ndarray, expected: float | np.ndarray) -> np.ndarray:
    """Jaccard estimate from the share of equal registers, without the chance agreements."""
    share = (left == right).mean(axis=-1)
    return np.clip((share - expected) / (1 - expected), 0, 1)


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, n, digest, registers) of every row; digest is a 128-bit hash of the full set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in hashing.chunks(batch.column(1)):
                sets = shingle_sets(data, offsets, width)
                packed = registers(sets)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        pa.array([r.tobytes() for r in packed], pa.binary()),
                    ],
                    ["id", "n", "digest", "registers"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "id long, n long, digest binary, registers binary")


def _confirm(pairs: DataFrame, texts: DataFrame, width: int, part: int, whole: int) -> DataFrame:
    """Pairs (a, b) whose full sets meet part / whole of intersection over union."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                rows = batch.slice(start, 128)
                sets = []
                for column in (2, 3):
                    sets.append([s for _, d, o in hashing.chunks(rows.column(column)) for s in shingle_sets(d, o, width)])
                keep = []
                for x, y in zip(*sets):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(whole * common >= part * (len(x) + len(y) - common))
                yield rows.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return joined.mapInArrow(run, "a long, b long")


def _sketches(texts: DataFrame, width: int) -> DataFrame:
    """(id, sketch): the low 32 bits of every shingle hash of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in hashing.chunks(batch.column(1)):
                sets = shingle_sets(data, offsets, width)
                packed = pa.array([s.astype(np.uint32).tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(sets)), packed], ["id", "sketch"])

    return texts.select("id", "text").mapInArrow(run, "id long, sketch binary")


SLOTS = 1 << 20


def _across(cell: pd.DataFrame, cut: float, part: int, whole: int) -> pd.DataFrame:
    """Pairs of one block of a bucket that lie in different components and may be linked.

    A pair is looked at in the first band it shares only.  Its estimate must reach the cut,
    and an upper bound of the intersection (shingles of one whose low bits occur in the
    other) must reach the threshold, so hardly any pair comes out that is not a link.
    """
    cell = cell.drop_duplicates(["id", "side"])
    left, right = cell[cell["side"] != 1], cell[cell["side"] != 0]
    out = []
    if len(left) and len(right):
        mine, theirs = (np.frombuffer(b"".join(x["registers"]), np.uint16).reshape(-1, BUCKETS) for x in (left, right))
        band = int(cell["band"].iloc[0])
        sketches = [np.frombuffer(x, np.uint32) % SLOTS for x in right["sketch"]]
        ids, comps, n = (right[c].to_numpy() for c in ("id", "component", "n"))
        table = np.zeros(SLOTS, bool)
        rows = zip(*(left[c] for c in ("id", "component", "n", "sketch")))
        for i, (own, component, size, sketch) in enumerate(rows):
            other = np.flatnonzero((comps != component) & (whole * np.minimum(n, size) >= part * np.maximum(n, size)))
            if not len(other):
                continue
            equal = mine[i][None, :] == theirs[other]
            first = equal.reshape(len(other), BANDS, ROWS).all(axis=2).argmax(axis=1)
            expected = chance(int(size), int(size))
            other = other[(first == band) & ((equal.mean(axis=1) - expected) / (1 - expected) >= cut)]
            if not len(other):
                continue
            slots = np.frombuffer(sketch, np.uint32) % SLOTS
            table[slots] = True
            common = np.array([np.count_nonzero(table[sketches[j]]) for j in other])
            table[slots] = False
            good = other[whole * common >= part * (size + n[other] - common)]
            out.append(pd.DataFrame({"a": np.minimum(own, ids[good]), "b": np.maximum(own, ids[good])}))
    return pd.concat(out) if out else pd.DataFrame({"a": [], "b": []}, dtype=np.int64)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    part: int = 75,
    whole: int = 100,
    margin: float = 0.2,
    block: int = 1024,
) -> DataFrame:
    """(id, n_shingles, component_id, kept): texts are linked when whole * |intersection| >=
    part * |union| of their shingle sets; a component's smallest id is kept.

    32 bands of 4 registers miss a pair at exactly 0.75 with probability 5e-6; the estimate
    must reach the threshold less ``margin``, over five standard deviations.  A null or
    empty text has no shingle and is linked with nothing.  Rows with equal text are one
    class whatever their number; a repeated row stays repeated; a row without an id is
    linked with nothing, has no component, and is kept.  Other columns are not carried.
    """
    spark = docs.sparkSession
    cut = part / whole - margin
    signed = stored(signatures(docs, id_col, text_col, width), "signatures")
    classes = signed.where("n > 0 and id is not null").groupBy("digest").agg(F.min("id").alias("rep"))
    members = stored(signed.select("id", "n", "digest").join(classes, "digest", "left").select("id", "n", "rep"), "members")
    reps = stored(
        signed.join(classes, "digest").where("id = rep").dropDuplicates(["id"]).select("id", "n", "registers"), "classes"
    )
    bands = reps.select("id", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"), "registers").select(
        "id",
        "band",
        F.xxhash64("band", F.substring("registers", F.col("band") * (2 * ROWS) + 1, F.lit(2 * ROWS))).alias("bucket"),
    )
    shared = bands.groupBy("bucket").agg(F.min("id").alias("a"), F.max("id").alias("last")).where("a < last").drop("last")
    crowded = stored(bands.join(shared, "bucket"), "buckets")  # (bucket, id, a)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(
        crowded.select("id").distinct(), "id"
    )
    texts = stored(texts.dropDuplicates(["id"]), "texts")

    stars = crowded.where("id > a").select("a", F.col("id").alias("b")).distinct()
    left, right = (reps.select(F.col("id").alias(k), F.col("n").alias(f"n{k}"), F.col("registers").alias(f"r{k}")) for k in "ab")

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r = [np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, BUCKETS) for i in (2, 3)]
            n, m = (batch.column(i).to_numpy() for i in (4, 5))
            expected = np.array([chance(int(x), int(y)) for x, y in zip(n, m)])
            keep = (estimate(r[0], r[1], expected) >= cut) & (whole * np.minimum(n, m) >= part * np.maximum(n, m))
            yield batch.select([0, 1]).filter(pa.array(keep))

    signed_pairs = stars.join(left, "a").join(right, "b").select("a", "b", "ra", "rb", "na", "nb")
    tried = stored(signed_pairs.mapInArrow(likely, "a long, b long"), "stars-tried")
    links = stored(_confirm(tried, texts, width, part, whole), "links")
    groups = components(links)

    labelled = crowded.select("bucket", "band", "id").join(groups, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = labelled.groupBy("bucket").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("size")
    ).where("x < y")
    open_rows = labelled.join(mixed.select("bucket", F.ceil(F.col("size") / block).alias("blocks")), "bucket")
    own = F.pmod(F.xxhash64("id"), "blocks")
    # a row goes as left side (0) to the cells at and after its block, as right side (1) to
    # those before it, and as both (2) where they meet
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = open_rows.withColumn("own", own).withColumn("other", other).select(
        "bucket",
        "band",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
        "id",
        "component",
    )
    dealt = stored(dealt, "cells")
    sketched = stored(_sketches(texts.join(dealt.select("id").distinct(), "id"), width), "sketches")
    cells = dealt.join(reps, "id").join(sketched, "id")
    rest = cells.groupBy("bucket", "i", "j").applyInPandas(lambda c: _across(c, cut, part, whole), "a long, b long")
    rest = rest.distinct().join(tried, ["a", "b"], "left_anti")
    more = stored(_confirm(stored(rest, "rest"), texts, width, part, whole), "more-links")
    if not more.isEmpty():
        groups = components(links.unionByName(more))
    out = members.join(groups.select(F.col("id").alias("rep"), "component"), "rep", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "rep", "id"))
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), g AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [ws]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: ws[i:i + 4])) END AS sh FROM w
), n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles FROM g),
s AS (SELECT doc_id, unnest(sh) AS k FROM g),
cls AS MATERIALIZED (SELECT doc_id, md5(CAST(list_sort(sh) AS VARCHAR)) AS d FROM g WHERE len(sh) > 0),
rep AS MATERIALIZED (SELECT d, min(doc_id) AS rep FROM cls GROUP BY d),
rs AS MATERIALIZED (SELECT s.doc_id, hash(s.k) AS k FROM s JOIN rep ON s.doc_id = rep.rep),
i AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM rs x JOIN rs y ON x.k = y.k AND x.doc_id < y.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (
  SELECT a, b FROM i JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * c >= 75 * (p.n_shingles + q.n_shingles - c)
), pairs AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(id, r) AS (SELECT rep, rep FROM rep UNION SELECT pairs.b, reach.r FROM reach JOIN pairs ON pairs.a = reach.id),
comp AS (SELECT id, min(r) AS component FROM reach GROUP BY id)
SELECT n.doc_id, n_shingles, coalesce(component, n.doc_id) AS component_id,
  n.doc_id = coalesce(component, n.doc_id) AS kept
FROM n LEFT JOIN cls USING (doc_id) LEFT JOIN rep USING (d) LEFT JOIN comp ON comp.id = rep.rep
"""
