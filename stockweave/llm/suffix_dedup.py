"""Suffix-array dedup by bytes: bucket-pointer refinement.

A shard's text positions are first sorted into buckets by their q bytes.  Every position
holds a pointer to its bucket's place in the suffix order.  Buckets of several positions are
refined by sorting on the pointers found q places later; the new pointers describe 2q bytes
and are what the next pass reads, at twice the distance, until ``width`` bytes are
covered.  Buckets of one position are final and are not looked at again.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm import repeats

WIDTH = 100
GRAM = 32
Q = 8


def bucket_pointers(text: np.ndarray, width: int) -> np.ndarray:
    """For every position the place of its bucket in the order of the suffixes by their first
    ``width`` bytes: equal pointers mean equal strings.  The text counts as padded by zeros."""
    n = len(text)
    padded = np.r_[text, np.zeros(Q, np.uint8)].astype(np.uint64)
    value = np.zeros(n, np.uint64)
    for j in range(Q):
        value = value << np.uint64(8) | padded[j : j + n]
    order = np.argsort(value, kind="stable")
    pointer = np.empty(n, np.int64)
    along = value[order]
    heads = np.r_[True, along[1:] != along[:-1]] if n else np.zeros(0, bool)
    pointer[order] = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    del value, along, padded
    single = heads & np.r_[heads[1:], True] if n else heads
    active = order[~single]  # in bucket order
    known = Q
    while known < width and len(active):
        step = min(known, width - known)
        later = active + step
        # past the end counts as before everything
        second = np.where(later < n, pointer[np.minimum(later, n - 1)] + 1, 0)
        first = pointer[active]
        sort = np.argsort(first * (n + 1) + second, kind="stable")
        active, first, second = active[sort], first[sort], second[sort]
        border = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])]
        parent = np.r_[True, first[1:] != first[:-1]]
        at = np.arange(len(active))
        # a sub-bucket lies behind its bucket's start by the number of members before it
        inside = np.maximum.accumulate(np.where(border, at, 0)) - np.maximum.accumulate(np.where(parent, at, 0))
        pointer[active] = first + inside
        active = active[~(border & np.r_[border[1:], True])]
        known += step
    return pointer


def search_shard(cell: pd.DataFrame) -> pd.DataFrame:
    """Windows of the shard's runs that also start earlier."""
    text = np.frombuffer(b"".join(cell["content"]), np.uint8)
    lengths = cell["content"].map(len).to_numpy()
    starts = np.cumsum(lengths) - lengths
    pointer = bucket_pointers(text, WIDTH)
    n = cell["n"].to_numpy()
    owner = np.repeat(np.arange(len(cell)), n)
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    bucket = pointer[starts[owner] + offset]
    # windows in the order of (id, start); the first of each bucket stays
    order = np.lexsort((cell["start"].to_numpy()[owner] + offset, cell["id"].to_numpy()[owner]))
    ids, places = cell["id"].to_numpy()[owner][order], (cell["start"].to_numpy()[owner] + offset)[order]
    _, lead, inverse = np.unique(bucket[order], return_index=True, return_inverse=True)
    earlier = np.empty(len(order), bool)
    earlier[order] = (ids[lead][inverse] != ids) | (places[lead][inverse] != places)
    return repeats.result(cell, earlier, owner, offset)


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_windows: int = 500_000) -> DataFrame:
    """(id, n, n_removed, spans, kept): every text's UTF-8 bytes without those covered by a
    string of 100 bytes that also starts earlier: in a document with a smaller id, or in
    the same one at an earlier place, overlaps included.

    A null text has no bytes; a row without an id loses nothing and counts for nobody; a
    repeated row stays repeated (same id, same places).  Shards hold about
    ``shard_windows`` windows each.
    """
    unit = repeats.Unit(words=False, width=WIDTH, gram=GRAM)
    later = (F.col("id") > F.col("rep_id")) | ((F.col("id") == F.col("rep_id")) & (F.col("start") > F.col("rep_start")))
    spans = repeats.repeated(docs, unit, later, search_shard, shard_windows, id_col, text_col)
    return repeats.kept_texts(docs, spans, unit, id_col, text_col)
