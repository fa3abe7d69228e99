"""Benchmark decontamination by CGK embedding and coordinate-sampling LSH.

Texts and items are sequences of words (letters and digits, lower case).  An item of n words
is found where a stretch of a text is at an edit distance of at most n // ``share`` words
from it; items of fewer than ``exact_below`` words must stand there as they are.

1. Gate, without loss: an edit takes at most three of the n - 2 word triples of an item, so
   such a stretch, of at most n + n // share words, holds at least n - 2 - 3 * (n // share)
   triples of the items of n words.  Windows of n words are laid over every run of places
   from which so many follow, a twelfth of the item apart, and over its last place.
2. A random walk embeds windows and items: at step j the current word is written down, and a
   random bit of (j, word) tells whether to move on.  Small edit distance becomes small
   Hamming distance.  Each table keys a few coordinates of one walk; a window meets an item
   where a key agrees.
3. The edit distance of the item to the best stretch around the windows is computed exactly.

Short items are looked up by the hash of their words, and compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm import hashing

WALKS = 8
#: Tables and sampled coordinates of each; the tests measure what they find.
TABLES = 128
COORDINATES = 3
#: Windows that are embedded together.
_TOGETHER = 4096
_WORD_BYTES = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Limits:
    """``share``: one edit in so many words; ``exact_below``: items of fewer words must agree
    exactly; ``least_words``: items of fewer words are no evidence and not looked for."""

    share: int = 5
    exact_below: int = 8
    least_words: int = 5

    def allowed(self, n: int) -> int:
        """Word edits that still count as the item."""
        return n // self.share if n >= self.exact_below else 0

    def needed(self, n: int) -> int:
        """Triples that a stretch within the allowed edits keeps at least."""
        return n - 2 - 3 * self.allowed(n)


def embed(words: np.ndarray, walk: int) -> np.ndarray:
    """CGK embedding of rows of word hashes (0: past the end) into twice their length: the walk
    stays on each word for two steps on average, and what follows would mostly be padding."""
    rows, n = words.shape
    padded = np.concatenate([words, np.zeros((rows, 1), np.uint64)], axis=1).ravel()
    line = np.arange(rows) * (n + 1)
    at, end = line.copy(), line + n
    out = np.empty((2 * n, rows), np.uint64)
    bits = None
    for j in range(2 * n):
        if j % 64 == 0:
            bits = hashing.mix(padded + np.uint64((1 + walk * 64 + j // 64) * 0x9E3779B97F4A7C15 % (1 << 64)))
        out[j] = padded[at]
        at = np.minimum(at + ((bits[at] >> np.uint64(j % 64)) & np.uint64(1)).astype(np.int64), end)
    return out


def table_keys(words: np.ndarray) -> np.ndarray:
    """One key a row and table, from sampled coordinates of the embeddings."""
    rows, n = words.shape
    keys = np.empty((rows, TABLES), np.uint64)
    for walk in range(WALKS):
        coded = embed(words, walk)
        for table in range(walk, TABLES, WALKS):
            draw = hashing.mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * _STEP + np.uint64(table * 1009 + n))
            key = np.full(rows, table + 1, np.uint64)
            for place in draw % np.uint64(2 * n):
                key = key * np.uint64(hashing.BASE) + coded[int(place)]
            keys[:, table] = hashing.mix(key)
    return keys


def distance(item: list[bytes], text: list[bytes]) -> int:
    """Least edit distance, in words, of the item to any stretch of the text: one column of
    the alignment table as bits of two integers."""
    n = len(item)
    places: dict[bytes, int] = {}
    for i, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << i
    full, last = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score, best = full, 0, n, n
    for word in text:
        equal = places.get(word, 0)
        down = equal | minus
        cross = (((equal & plus) + plus) ^ plus) | equal
        up = minus | ~(cross | plus) & full
        less = plus & cross
        score += bool(up & last) - bool(less & last)
        up, less = up << 1 & full, less << 1 & full
        plus, minus = less | ~(down | up) & full, up & down
        best = min(best, score)
    return best


def _sorted(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys in order with their owners, and a table of low bits that spares most lookups, of 16 to
    32 bytes a key up to 4 MB."""
    order = np.argsort(keys, kind="stable")
    low = np.zeros(1 << min(22, max(8, len(keys).bit_length() + 4)), bool)
    low[(keys & np.uint64(len(low) - 1)).astype(np.int64)] = True
    return keys[order], owners[order], low


def _lookup(table: tuple, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``keys``, owner) of all equal pairs."""
    known, owners, low = table
    at = np.flatnonzero(low[(keys & np.uint64(len(low) - 1)).astype(np.int64)])
    begin, end = (np.searchsorted(known, keys[at], side=side) for side in ("left", "right"))
    n = end - begin
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(at, n), owners[np.repeat(begin, n) + inside]


class Items:
    """A block of benchmark items ready for lookups."""

    def __init__(self, ids: list[int], texts: list[bytes], limits: Limits):
        self.limits = limits
        words = [t.translate(_WORD_BYTES).split() for t in texts]
        keep = [i for i, w in enumerate(words) if len(w) >= max(1, limits.least_words)]
        self.ids, self.words = [ids[i] for i in keep], [words[i] for i in keep]
        hashes, by_length = [], {}
        for i, item in enumerate(self.words):
            data = np.frombuffer(b" ".join(item), np.uint8)
            starts, ends, _ = hashing.words(data, np.array([0, len(data)]))
            hashes.append(hashing.Stretches(data).of(starts, ends))
            by_length.setdefault(len(item), []).append(i)
        self.exact, self.tables = {}, {}
        self.triples = [np.unique(hashing.grams(h, 3)) for h in hashes]
        for n, members in sorted(by_length.items()):
            rows, own = np.stack([hashes[i] for i in members]), np.array(members)
            # items whose edits could take all their triples are compared exactly too
            if n < limits.exact_below or limits.needed(n) < 1:
                self.exact[n] = _sorted(np.concatenate([hashing.grams(r, n) for r in rows]), own)
            else:
                # the keys hold the number of their table, so one lookup serves all tables
                self.tables[n] = _sorted(table_keys(rows).ravel(), np.repeat(own, TABLES))
        # listed triples of the long items, each with the lengths of the items that have it
        long = [(np.unique(np.concatenate([self.triples[i] for i in by_length[n]])), n) for n in self.tables]
        flat = np.concatenate([*(t for t, _ in long), np.zeros(0, np.uint64)])
        order = np.argsort(flat, kind="stable")
        self.listed, begins = np.unique(flat[order], return_index=True)
        self.first = np.r_[begins, len(flat)]
        self.lengths = np.concatenate([*(np.full(len(t), n) for t, n in long), np.zeros(0, np.int64)])[order]
        self.bitmap = np.zeros(1 << 20, bool)
        self.bitmap[(self.listed & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, length) of the triples of items of each length, by length and place."""
        at = np.flatnonzero(self.bitmap[(grams & np.uint64((1 << 20) - 1)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.listed, grams[at]), max(0, len(self.listed) - 1))
        same = self.listed[place] == grams[at] if len(self.listed) else np.zeros(0, bool)
        at, place = at[same], place[same]
        n = self.first[place + 1] - self.first[place]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at, length = np.repeat(at, n), self.lengths[np.repeat(self.first[place], n) + inside]
        order = np.lexsort((at, length))
        return at[order], length[order]


def windows(n: int, limits: Limits, at: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, start) of the windows for items of n words, whose triples stand at ``at``."""
    need, reach = limits.needed(n), n + limits.allowed(n) - 3
    head = np.arange(max(0, len(at) - need + 1))
    tail = head + need - 1
    row = np.searchsorted(first, at, side="right") - 1
    near = (at[tail] - at[head] <= reach) & (row[tail] == row[head])
    head, tail, row = head[near], tail[near], row[head[near]]
    if not len(head):
        return head, head
    # from any start in [low, high] the triples from head to tail are within the longest stretch
    low = np.maximum(first[row], at[tail] - reach)
    high = at[head]
    new = np.r_[True, (row[1:] != row[:-1]) | (low[1:] > high[:-1] + 1)]
    begin = np.flatnonzero(new)
    low, high, row = low[begin], np.maximum.reduceat(high, begin), row[begin]
    step = max(1, n // 12)
    count = (high - low) // step + 1
    start = np.repeat(low, count) + step * (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
    return np.r_[np.repeat(row, count), row], np.r_[start, high]


def match(items: Items, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
    """(row, item, distance) for every item in the rows of a buffer."""
    data = np.frombuffer(data.tobytes().translate(_WORD_BYTES), np.uint8)
    starts, ends, first = hashing.words(data, offsets)
    if not len(starts) or not items.ids:
        return []
    hashes, limits = hashing.Stretches(data).of(starts, ends), items.limits
    found: dict[tuple[int, int], int] = {}
    for n, table in items.exact.items():
        at, owner = _lookup(table, hashing.grams(hashes, n))
        row = np.searchsorted(first, at, side="right") - 1
        for a, r, i in zip(at.tolist(), row.tolist(), owner.tolist()):
            if a + n <= first[r + 1] and data[starts[a] : ends[a + n - 1]].tobytes().split() == items.words[i]:
                found[r, i] = 0
    if not items.tables or len(starts) < 3:
        return [(r, i, e) for (r, i), e in sorted(found.items())]

    grams = hashing.grams(hashes, 3)
    at, length = items.hits(grams)
    # no triples that reach into the next row
    whole = at + 3 <= first[np.searchsorted(first, at, side="right")]
    at, length = at[whole], length[whole]
    pairs = [np.zeros((0, 3), np.int64)]
    for n in np.unique(length).tolist():
        rows, begin = windows(n, limits, at[length == n], first)
        for a in range(0, len(begin), _TOGETHER):
            r, s = rows[a : a + _TOGETHER], begin[a : a + _TOGETHER]
            place = s[:, None] + np.arange(n)
            symbols = np.where(place < first[r + 1][:, None], hashes[np.minimum(place, len(hashes) - 1)], np.uint64(0))
            window, owner = _lookup(items.tables[n], table_keys(symbols).ravel())
            met = np.unique(np.stack([window // TABLES, owner], axis=1), axis=0)
            pairs.append(np.c_[r[met[:, 0]], met[:, 1], s[met[:, 0]]])
    pairs = np.concatenate(pairs)
    if not len(pairs):
        return [(r, i, e) for (r, i), e in sorted(found.items())]
    pairs = pairs[np.lexsort((pairs[:, 2], pairs[:, 1], pairs[:, 0]))]
    r, i, s = pairs.T
    n = np.array([len(w) for w in items.words])[i]
    k = np.array([limits.allowed(x) for x in range(int(n.max()) + 1)])[n]
    low = np.maximum(first[r], s - 2 * k)
    high = np.minimum(first[r + 1], s + n + 2 * k)
    # overlapping stretches of one item are searched as one
    new = np.r_[True, (r[1:] != r[:-1]) | (i[1:] != i[:-1]) | (low[1:] > high[:-1])]
    begin = np.flatnonzero(new)
    for r, i, a, b in zip(r[begin].tolist(), i[begin].tolist(), low[begin].tolist(), np.maximum.reduceat(high, begin).tolist()):
        own = (r, i)
        # an item's own triples bound the distance from below
        if found.get(own) == 0 or np.isin(items.triples[i], grams[a : max(a, b - 2)]).sum() + _repeated(items, i) < limits.needed(len(items.words[i])):
            continue
        edits = distance(items.words[i], data[starts[a] : ends[b - 1]].tobytes().split())
        if edits <= limits.allowed(len(items.words[i])):
            found[own] = min(edits, found.get(own, edits))
    return [(r, i, e) for (r, i), e in sorted(found.items())]


def _repeated(items: Items, i: int) -> int:
    """Triples of an item that are the same as an earlier one of it."""
    return max(0, len(items.words[i]) - 2) - len(items.triples[i])


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int, limits: Limits) -> Iterator:
    """Broadcast blocks of the benchmark, of about ``block_chars`` each."""
    text = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    rows = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("long").alias("item"), text.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    for block in range(blocks):
        # at most block_chars on average, whatever the size of the benchmark
        chosen = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        ids, texts = [r["item"] for r in chosen], [r["text"].encode() for r in chosen]
        yield benchmark.sparkSession.sparkContext.broadcast((ids, texts, limits))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_chars: int = 8_000_000,
    limits: Limits = Limits(),
) -> DataFrame:
    """(id, item, n_words long, edits long): items found in each whole text, with the words of
    the item and the least edit distance.

    Items are broadcast in blocks of about ``block_chars``; a larger benchmark takes one pass
    over the texts a block.  Items under ``limits.least_words`` are not looked for; null texts
    and items count as empty; rows without an id are found under a null id; repeated rows give
    repeated results; other columns are not read.
    """
    searched = docs.select(F.col(id_col).cast("long").alias("id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    out = None
    for shared in _blocks(benchmark, item_col, item_text_col, block_chars, limits):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = Items(*shared.value)
            for batch in batches:
                found = []
                for first, data, offsets in hashing.chunks(batch.column(1)):
                    found += [(first + row, item, edits) for row, item, edits in match(items, data, offsets)]
                own = batch.column(0).take(pa.array([row for row, _, _ in found], pa.int64()))
                columns = [[items.ids[i] for _, i, _ in found], [len(items.words[i]) for _, i, _ in found], [e for _, _, e in found]]
                yield pa.RecordBatch.from_arrays([own, *(pa.array(c, pa.int64()) for c in columns)], ["id", "item", "n_words", "edits"])

        part = searched.mapInArrow(run, "id long, item long, n_words long, edits long")
        out = part if out is None else out.unionByName(part)
    return out.withColumnsRenamed({"id": id_col, "item": item_col})


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_chars: int = 8_000_000,
    limits: Limits = Limits(),
) -> DataFrame:
    """The rows of ``docs`` whose text holds no item, whole and whatever their id."""
    schema = docs.schema
    for shared in _blocks(benchmark, item_col, item_text_col, block_chars, limits):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = Items(*shared.value)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for first, data, offsets in hashing.chunks(batch.column(batch.num_columns - 1)):
                    keep[[first + row for row, _, _ in match(items, data, offsets)]] = False
                yield batch.select(range(batch.num_columns - 1)).filter(pa.array(keep))

        lowered = F.lower(F.coalesce(F.col(text_col), F.lit("")))
        docs = docs.select("*", lowered.alias("lower-cased text of this stage")).mapInArrow(run, schema)
    return docs
