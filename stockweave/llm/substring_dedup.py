"""Substring dedup by words: a compressed FM-index per shard.

The shard's runs of words are indexed once: suffixes sorted by their first 64 words, the
transform of the text as a wavelet matrix of packed bits.  Runs are then streamed from
right to left through backward search.  The match is kept at ``width - 1`` words (a
lookup of the enclosing interval replaces shortening it) and extended by one, so each step
gives the matching statistic up to ``width``: windows that reach it are matches, and the
interval tells the smallest document in it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm import repeats

WIDTH = 50
GRAM = 8


class BitVector:
    """Packed bits with a count before every 64."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.counts = np.r_[0, np.cumsum(np.bitwise_count(self.words))[:-1]].astype(np.int32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        word = i >> 6
        low = self.words[word] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
        return self.counts[word] + np.bitwise_count(low)


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit vector per symbol bit, high bits first."""

    def __init__(self, values: np.ndarray, sigma: int):
        self.levels = []
        current = values
        for shift in reversed(range(max(1, int(sigma - 1).bit_length()))):
            bits = (current >> shift & 1).astype(bool)
            self.levels.append((shift, BitVector(bits), int(len(bits) - bits.sum())))
            current = np.r_[current[~bits], current[bits]]
        symbols = np.arange(sigma)
        self.base = self._descend(symbols, np.zeros(sigma, np.int64))

    def _descend(self, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.rank(i)
            i = np.where(symbols >> shift & 1, zeros + ones, i - ones)
        return i

    def rank(self, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._descend(symbols, i) - self.base[symbols]


def _pairs(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Dense ranks of pairs, in order."""
    return np.unique(high * (int(low.max(initial=0)) + 1) + low, return_inverse=True)[1]


def _later(x: np.ndarray, by: int) -> np.ndarray:
    """x moved left; past the end 0, under all ranks, which start at 1."""
    return np.r_[x[by:], np.zeros(min(by, len(x)), x.dtype)]


class FMIndex:
    """Index of a sequence of symbols >= 1 for windows of ``width`` <= 64 symbols.  The last
    symbol must be one that no window holds."""

    def __init__(self, text: np.ndarray, width: int, owner: np.ndarray):
        ranks, span, at = text.astype(np.int64), 1, {}
        while span < 64:
            ranks = _pairs(ranks, _later(ranks, span)) + 1
            span *= 2
            at[span] = ranks
        self.order = np.argsort(ranks, kind="stable")
        self.sigma = int(text.max(initial=0)) + 1
        self.wavelet = WaveletMatrix(text[self.order - 1], self.sigma)
        counts = np.bincount(text, minlength=self.sigma)
        self.first = np.r_[0, np.cumsum(counts)[:-1]]
        self.width = width
        self.short = self._intervals(self._depth(at, width - 1))
        start, end = self._intervals(self._depth(at, width))
        heads = np.unique(start)
        least = np.minimum.reduceat(owner[self.order], heads) if len(heads) else heads
        self.least = least[np.searchsorted(heads, start)]

    @staticmethod
    def _depth(at: dict[int, np.ndarray], depth: int) -> np.ndarray:
        """Ranks by the first ``depth`` symbols, from two overlapping stretches."""
        span = max(s for s in at if s <= depth)
        return _pairs(at[span], _later(at[span], depth - span)) if span < depth else at[span]

    def _intervals(self, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Interval of equal ranks around each place of the order."""
        along = ranks[self.order]
        heads = np.flatnonzero(np.r_[True, along[1:] != along[:-1]]) if len(along) else np.zeros(0, int)
        ends = np.r_[heads[1:], len(along)]
        which = np.searchsorted(heads, np.arange(len(along)), side="right") - 1
        return heads[which], ends[which]

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: intervals of symbol + match."""
        base = self.first[symbols]
        return base + self.wavelet.rank(symbols, low), base + self.wavelet.rank(symbols, high)

    def least_owners(self, streams: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """For every place of the streamed symbols the smallest owner of an occurrence of the
        window that starts there, -1 without one.  Streams are stretches of ``streams``."""
        out = np.full(len(streams), -1, np.int64)
        live = np.argsort(-lengths, kind="stable")
        low, high = np.zeros(len(live), np.int64), np.full(len(live), len(self.order), np.int64)
        depth = np.zeros(len(live), np.int64)
        begin, size = starts[live], lengths[live]
        for step in range(int(lengths.max(initial=0))):
            n = int(np.searchsorted(-size, -step, side="left"))  # streams longer than step
            if n < len(low):
                low, high, depth = low[:n], high[:n], depth[:n]
            place = begin[:n] + size[:n] - 1 - step
            symbols = streams[place]
            known = symbols < self.sigma
            symbols = np.where(known, symbols, 0)
            low, high = self.extend(symbols, low, high)
            depth = depth + 1
            lost = ~known | (low >= high)
            if lost.any():
                # start again with what follows this place: symbol by symbol, as far as it goes
                for i in np.flatnonzero(lost):
                    low[i], high[i], depth[i] = self._again(streams, int(place[i]), int(begin[i] + size[i]))
            full = depth >= self.width
            at = np.where(full, low, 0)
            out[place[full]] = self.least[at[full]]
            low = np.where(full, self.short[0][at], low)
            high = np.where(full, self.short[1][at], high)
            depth = np.where(full, self.width - 1, depth)
        return out

    def _again(self, streams: np.ndarray, place: int, end: int) -> tuple[int, int, int]:
        """Interval and length of the longest match that starts at a place."""
        best = (0, len(self.order), 0)
        low, high = 1, min(self.width, end - place)
        while low <= high:  # longer matches contain shorter ones
            length = (low + high) // 2
            a, b = np.array([0]), np.array([len(self.order)])
            for p in range(place + length - 1, place - 1, -1):
                if streams[p] >= self.sigma or a[0] >= b[0]:
                    b = a
                    break
                a, b = self.extend(streams[p : p + 1], a, b)
            if a[0] < b[0]:
                best, low = (int(a[0]), int(b[0]), length), length + 1
            else:
                high = length - 1
        return best


def search_shard(cell: pd.DataFrame) -> pd.DataFrame:
    """Windows of the shard's runs that occur in a document with a smaller id."""
    numbers: dict[bytes, int] = {}
    parts, lengths = [], []
    for content in cell["content"]:
        found = [numbers.setdefault(w, len(numbers) + 2) for w in content.split()]
        lengths.append(len(found))
        parts.append(np.array([*found, 1], np.int64))  # 1 ends a run
    text = np.concatenate(parts)
    lengths = np.array(lengths)
    starts = np.r_[0, np.cumsum(lengths + 1)[:-1]]
    ids, inverse = np.unique(cell["id"].to_numpy(), return_inverse=True)
    index = FMIndex(text, WIDTH, np.repeat(inverse, lengths + 1))
    least = index.least_owners(text, starts, lengths)
    n = cell["n"].to_numpy()
    owner = np.repeat(np.arange(len(cell)), n)
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    found = least[starts[owner] + offset]
    return repeats.result(cell, (found >= 0) & (found < inverse[owner]), owner, offset)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_windows: int = 200_000) -> DataFrame:
    """(id, n, n_removed, spans, kept): every text without the words covered by a window of 50
    words whose sequence also starts in a document with a smaller id.

    Words are runs of other bytes than space and \\t \\n \\v \\f \\r.  Spans are stretches of
    word numbers, kept the other words joined by one space.  A null text has no words; a
    row without an id loses nothing and counts for nobody; a repeated row stays repeated
    (its copy has no smaller id).  Shards hold about ``shard_windows`` windows each.
    """
    unit = repeats.Unit(words=True, width=WIDTH, gram=GRAM)
    later = F.col("id") > F.col("rep_id")
    spans = repeats.repeated(docs, unit, later, search_shard, shard_windows, id_col, text_col)
    return repeats.kept_texts(docs, spans, unit, id_col, text_col)


SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), win AS (
  SELECT doc_id, unnest(range(1, len(ws) - 48)) AS i, ws FROM w WHERE len(ws) >= 50
), h AS MATERIALIZED (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h FROM win
), m AS MATERIALIZED (SELECT h, min(doc_id) AS least FROM h GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM h JOIN m USING (h) WHERE least < doc_id
), g AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id),
k AS (
  SELECT w.doc_id, ws, coalesce(gone, []) AS gone,
    list_filter(ws, lambda x, p: NOT list_contains(coalesce(gone, []), p)) AS kept
  FROM w LEFT JOIN g USING (doc_id)
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed,
  sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""
