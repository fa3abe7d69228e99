"""Repeated windows across texts: what the substring and the suffix-array operator share.

A window is ``width`` consecutive units (words or bytes).  Its key is the smallest hash of
the ``gram``-unit stretches in it, so equal windows have equal keys, and neighbouring
windows mostly share theirs: a text falls into runs of windows with one key, one row each.

1. Keys that occur once cannot repeat.  One shuffle of (key, id) finds the others; copies
   inside a task are settled there, so a key brings one row a task at most.
2. Runs with a shared key are cut out with the words or bytes their windows cover.  Runs of
   equal content form a class with the earliest as its representative.
3. Representatives are dealt to shards by key; the operator's index in each shard tells
   which windows of a representative occur earlier.  A key with very many different
   contents is split: its windows take the smallest gram that is not such a hot one.
4. Members of a class that come after the representative repeat as a whole, the others as
   the representative does.  The spans are joined back to their texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave.llm import hashing
from stockweave.llm.store import stored

#: Rows of one task that are looked through together for keys that occur twice.
LOCAL = 1 << 18
TOP = np.uint64(1 << 63)


@dataclass(frozen=True)
class Unit:
    """Words or bytes, the window's width in units, and that of the grams that key it."""

    words: bool
    width: int
    gram: int

    def runs(self, data: np.ndarray, offsets: np.ndarray, hot: np.ndarray | None = None):
        """Runs of windows with one key: (row, first window, number of windows, key), and the
        start and end of each unit (None for bytes).  Grams in ``hot`` are taken last."""
        starts = ends = None
        if self.words:
            starts, ends, first = hashing.words(data, offsets)
            grams = hashing.grams(hashing.Stretches(data).of(starts, ends), self.gram)
            total = len(starts)
        else:
            first, total = offsets, len(data)
            grams = hashing.Stretches(data).windows(self.gram) if total >= self.gram else np.zeros(0, np.uint64)
        grams = grams >> np.uint64(1)
        if hot is not None:
            grams = np.where(np.isin(grams, hot), grams | TOP, grams)
        keys = hashing.sliding_min(grams, self.width - self.gram + 1)
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        n = max(0, total - self.width + 1)
        at = np.flatnonzero(row[:n] == row[self.width - 1 :][:n])
        keys, row = keys[at], row[at]
        head = np.ones(len(at), bool)
        head[1:] = (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])
        head = np.flatnonzero(head)
        count = np.diff(np.r_[head, len(at)])
        row = row[head]
        return row, at[head] - first[row], count, keys[head], starts, ends

    def anchors(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, key) of every place of a byte text whose gram is the smallest of some window
        around it.  A window that repeats inside one run brings its key twice."""
        if len(data) < self.width:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        grams = hashing.Stretches(data).windows(self.gram) >> np.uint64(1)
        span = self.width - self.gram + 1
        keys = hashing.sliding_min(grams, span)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        n = len(data) - self.width + 1
        keys[row[:n] != row[self.width - 1 :]] = 0
        # the largest key of the windows around a place: its gram never lies under it
        edge = np.zeros(span - 1, np.uint64)
        most = ~hashing.sliding_min(~np.r_[edge, keys, edge], span)
        at = np.flatnonzero(grams == most)
        return row[at], grams[at]

    def cut(self, data: np.ndarray, offsets: np.ndarray, starts, ends, row: int, start: int, n: int) -> bytes:
        """Content under n windows: bytes, or words joined by one space."""
        if not self.words:
            a = int(offsets[row]) + start
            return data[a : a + n + self.width - 1].tobytes()
        a = int(np.searchsorted(starts, offsets[row])) + start
        return b" ".join(data[starts[a] : ends[a + n + self.width - 2]].tobytes().split())


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def shared_keys(rows: DataFrame, unit: Unit) -> DataFrame:
    """(id, keys): the keys of each text that occur elsewhere too, or twice in it."""

    def flush(keys: list[np.ndarray], ids: list[np.ndarray]) -> pa.RecordBatch:
        key, owner = np.concatenate(keys), np.concatenate(ids)
        _, lead, inverse, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        apart = np.arange(1, len(key) + 1, dtype=np.int64)
        apart[lead] = 0
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (key.view(np.int64), owner, count[inverse] > 1, apart)], ["key", "id", "many", "apart"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids, held = [], [], 0
        for batch in batches:
            own = batch.column(0).to_numpy()
            for first, data, offsets in hashing.chunks(batch.column(1)):
                if unit.words:
                    row, _, _, key, _, _ = unit.runs(data, offsets)
                else:
                    row, key = unit.anchors(data, offsets)
                keys.append(key)
                ids.append(own[first + row])
                held += len(key)
                if held >= LOCAL:
                    yield flush(keys, ids)
                    keys, ids, held = [], [], 0
        if held:
            yield flush(keys, ids)

    found = rows.where("id is not null").mapInArrow(run, "key long, id long, many boolean, apart long")
    # apart is 0 for one row of a key and flush; the others are known to be shared and are
    # spread by it
    together = Window.partitionBy("key", "apart")
    known = found.withColumn("known", F.col("many") | (F.count("*").over(together) > 1) | (F.max("many").over(together)))
    return known.where("known").groupBy("id").agg(F.collect_set("key").alias("keys"))


SEGMENT = "key long, id long, start long, n long, digest binary, content binary"


def segments(rows: DataFrame, keys: DataFrame, unit: Unit) -> DataFrame:
    """The runs of each text whose key is among its shared ones, with their content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, texts = batch.column(0).to_numpy(), batch.column(1)
            lists = batch.column(2)
            for first, data, offsets in hashing.chunks(texts):
                row, start, n, key, starts, ends = unit.runs(data, offsets)
                signed = key.view(np.int64)
                borders = np.searchsorted(row, np.arange(len(offsets)))
                good = np.zeros(len(row), bool)
                for r in range(len(offsets) - 1):
                    a, b = borders[r], borders[r + 1]
                    if a < b:
                        good[a:b] = np.isin(signed[a:b], lists[first + r].values.to_numpy(zero_copy_only=False))
                chosen = np.flatnonzero(good)
                for part in np.array_split(chosen, max(1, len(chosen) // 4096)):
                    content = [unit.cut(data, offsets, starts, ends, int(row[i]), int(start[i]), int(n[i])) for i in part]
                    yield _batch(signed[part], own[first + row[part]], start[part], n[part], content)

    return rows.join(keys, "id").select("id", "text", "keys").mapInArrow(run, SEGMENT)


def _digest(content: bytes) -> bytes:
    return hashlib.blake2b(content, digest_size=16).digest()


def _batch(key, ids, start, n, content) -> pa.RecordBatch:
    columns = [pa.array(np.asarray(x, np.int64)) for x in (key, ids, start, n)]
    columns += [pa.array([_digest(c) for c in content], pa.binary()), pa.array(content, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["key", "id", "start", "n", "digest", "content"])


def split_hot(reps: DataFrame, hot: list[int], unit: Unit) -> DataFrame:
    """Cut representatives of hot keys into runs keyed by their smallest gram that is not hot."""
    taken = np.array(hot, np.int64).view(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parents, ids, begin = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for first, data, offsets in hashing.chunks(batch.column(3)):
                row, start, n, key, starts, ends = unit.runs(data, offsets, taken)
                content = [unit.cut(data, offsets, starts, ends, *map(int, x)) for x in zip(row, start, n)]
                own = first + row
                out = _batch(hashing.mix(key ^ TOP).view(np.int64), ids[own], begin[own] + start, n, content)
                yield pa.RecordBatch.from_arrays(
                    [parents.take(pa.array(own)), pa.array(start.astype(np.int64)), *out.columns], ["parent", "shift", *out.schema.names]
                )

    rows = reps.select("digest", "id", "start", "content")
    return rows.mapInArrow(run, f"parent binary, shift long, {SEGMENT}")


def classes_of(runs: DataFrame) -> DataFrame:
    """One row a digest: its earliest run.  Combined before the shuffle, so a text with any
    number of copies sends one row a task."""
    first = F.min(F.struct("id", "start", "n", "key", "content")).alias("first")
    return runs.groupBy("digest").agg(first).select("digest", "first.*")


def _expanded(runs: DataFrame, classes: DataFrame, verdicts: DataFrame, later: Column, carry: list[str]) -> DataFrame:
    """Repeated windows (carry.., shift, n) of runs, from those of their classes."""
    joined = runs.select("digest", "id", "start", "n", *[c for c in carry if c not in ("id", "start")]).join(
        classes.select("digest", F.col("id").alias("rep_id"), F.col("start").alias("rep_start")), "digest"
    )
    whole = joined.where(later).select(*carry, F.lit(0).cast("long").alias("off"), "n")
    partly = joined.where(~later).drop("n").join(verdicts, "digest").select(*carry, "off", "n")
    return whole.unionByName(partly)


def verdicts(
    runs: DataFrame, classes: DataFrame, unit: Unit, later: Column, shard: Callable, shard_windows: int, depth: int = 3
) -> DataFrame:
    """(digest, off, n): stretches of windows of each class's representative that occur earlier."""
    spark = runs.sparkSession
    total = classes.agg(F.count("*"), F.sum("n")).first()
    hot = []
    if depth and total[0]:
        # at most 2000 keys can have more than a 2000th of all rows, or than 64 of up to 128,000
        limit = max(64, total[0] // 2000)
        hot = [r["key"] for r in classes.groupBy("key").count().where(F.col("count") > limit).select("key").collect()]
    shards = max(1, -(-(total[1] or 0) // shard_windows), spark.sparkContext.defaultParallelism)
    cool = classes.join(F.broadcast(spark.createDataFrame([(k,) for k in hot], "key long")), "key", "left_anti") if hot else classes
    dealt = cool.select("digest", "id", "start", "n", "content", F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"))
    out = dealt.groupBy("shard").applyInPandas(shard, "digest binary, off long, n long")
    if not hot:
        return out
    warm = classes.join(F.broadcast(spark.createDataFrame([(k,) for k in hot], "key long")), "key", "left_semi")
    parts = stored(split_hot(warm, hot, unit), "parts")
    inner = stored(classes_of(parts), "part-classes")
    found = verdicts(parts, inner, unit, later, shard, shard_windows, depth - 1)
    back = _expanded(parts, inner, found, later, ["parent", "shift"])
    return out.unionByName(back.select(F.col("parent").alias("digest"), (F.col("shift") + F.col("off")).alias("off"), "n"))


def repeated(
    docs: DataFrame, unit: Unit, later: Column, shard: Callable, shard_windows: int, id_col: str, text_col: str
) -> DataFrame:
    """(id, spans): for each text with repeated windows the stretches (first, n) of them."""
    rows = _rows(docs, id_col, text_col)
    runs = stored(segments(rows, shared_keys(rows, unit), unit), "runs")
    classes = stored(classes_of(runs), "classes")
    found = stored(verdicts(runs, classes, unit, later, shard, shard_windows), "verdicts")
    windows = _expanded(runs, classes, found, later, ["id", "start"])
    stretch = F.struct((F.col("start") + F.col("off")).alias("first"), F.col("n"))
    return windows.groupBy("id").agg(F.collect_set(stretch).alias("stretches"))


def covered(stretches, width: int) -> list[tuple[int, int]]:
    """Merged (start, end) units under the windows of the stretches."""
    out: list[list[int]] = []
    for s in sorted((x["first"], x["first"] + x["n"] + width - 1) for x in stretches or ()):
        if out and s[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s[1])
        else:
            out.append(list(s))
    return [tuple(x) for x in out]


def kept_texts(docs: DataFrame, spans: DataFrame, unit: Unit, id_col: str, text_col: str) -> DataFrame:
    """(id, n, n_removed, spans, kept): every text without its repeated units; spans are the
    maximal removed stretches, kept the other bytes, or words joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                rows = []
                for text, stretches in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    units = text.encode().split() if unit.words else text.encode()
                    gone = covered(stretches, unit.width)
                    kept, at = [], 0
                    for a, b in [*gone, (len(units), len(units))]:
                        kept.append(units[at:a])
                        at = b
                    kept = b" ".join(w for x in kept for w in x) if unit.words else b"".join(kept)
                    rows.append((len(units), sum(b - a for a, b in gone), [{"start": a, "end": b} for a, b in gone], kept))
                n, removed, gone, kept = zip(*rows)
                span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(gone, span), pa.array(kept, pa.binary())],
                    ["id", "n", "n_removed", "spans", "kept"],
                )

    joined = _rows(docs, id_col, text_col).join(spans, "id", "left").select("id", "text", "stretches")
    out = joined.mapInArrow(run, "id long, n long, n_removed long, spans array<struct<start:long,end:long>>, kept binary")
    return out.withColumnRenamed("id", id_col)


def stretches_of(flags: np.ndarray, owner: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, first, n) of the runs of set flags with consecutive offsets of one owner."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at, at
    head = np.ones(len(at), bool)
    head[1:] = (owner[at[1:]] != owner[at[:-1]]) | (offset[at[1:]] != offset[at[:-1]] + 1)
    head = np.flatnonzero(head)
    return owner[at[head]], offset[at[head]], np.diff(np.r_[head, len(at)])


def result(cell: pd.DataFrame, flags: np.ndarray, owner: np.ndarray, offset: np.ndarray) -> pd.DataFrame:
    who, first, n = stretches_of(flags, owner, offset)
    digest = cell["digest"].to_numpy()
    return pd.DataFrame({"digest": digest[who] if len(who) else np.zeros(0, object), "off": first.astype(np.int64), "n": n.astype(np.int64)})
