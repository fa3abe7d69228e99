"""Spelling variants: words one edit apart, grouped under their most frequent neighbour.

Words are letter-count vectors.  One replaced letter puts two words of equal length at a
squared distance of 2, one letter more or less words of adjacent length at 1, so near words
are found among the pairs that a product of letter-count matrices (a Gram matrix, block by
block) puts there; the edit itself is verified on the letters.

- Letters fall into ``CLASSES`` classes; a cell is a length with the number of letters of
  each class.  An edit changes two of these numbers by one at most, so a word meets its own
  cell and the cells of one step only: as left side at home, as right side in those whose
  key is not larger.
- A cell of many words is cut into parts of left rows, each of which sees all right rows of
  the cell.
- Inside a group the rows are sorted by finer classes and cut into blocks; a pair of blocks
  whose ranges of these counts lie too far apart is passed over, the others are multiplied.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm import hashing
from stockweave.llm.store import stored

#: Classes of letters in a cell's key, and the finer ones that order a group.
CLASSES = 4
FINE = 12
#: Left rows of a group, and rows of a block of the product.
PART = 8192
ROWS = 256
#: Text bytes looked at together, and words held before they are passed on.
CHUNK = 1 << 21
HELD = 1 << 19

#: One code for each letter: a-z, then U+00C0 to U+00FF.
_LETTERS = [*range(97, 123), *range(0xC0, 0x100)]
_CODE = np.zeros(256, np.uint8)
_CODE[_LETTERS] = np.arange(len(_LETTERS))


def _crc_table() -> np.ndarray:
    """Remainders of the reflected polynomial of CRC-32 for each byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


_CRC = _crc_table()


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the maximal runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8 bytes."""
    low = data | 32
    plain = (low >= 97) & (low <= 122)
    lead = np.zeros(len(data), bool)
    lead[:-1] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0xC0)
    inside = plain | lead
    inside[1:] |= lead[:-1]
    before = np.r_[False, inside[:-1]] if len(data) else inside
    edges = offsets[:-1]
    before[edges[edges < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.r_[inside[1:], False] if len(data) else inside
    edges = offsets[1:]
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def _checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, state: np.ndarray) -> np.ndarray:
    """CRC-32 of each stretch, going on from ``state`` (the checksum of what stands before)."""
    state = state ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(starts - ends, kind="stable")  # long ones first
    starts, length, state = starts[order], (ends - starts)[order], state[order]
    live = len(order)
    for j in range(int(length[0]) if len(length) else 0):
        live = int(np.searchsorted(-length[:live], -j, side="left"))
        head = state[:live]
        state[:live] = _CRC[(head ^ data[starts[:live] + j]) & np.uint32(255)] ^ (head >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = state
    return out ^ np.uint32(0xFFFFFFFF)


def word_counts(docs: DataFrame, id_col: str, text_col: str, shortest: int, drop_every: int) -> DataFrame:
    """(word, n): lower-cased runs of at least ``shortest`` letters after the seeded slips."""

    def flush(held: list[tuple[np.ndarray, np.ndarray, pa.Array]]) -> pa.RecordBatch:
        label, n = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        words = pa.concat_arrays([h[2] for h in held])
        _, lead, place = np.unique(label, return_index=True, return_inverse=True)
        return pa.RecordBatch.from_arrays(
            [words.take(pa.array(lead)), pa.array(np.bincount(place, weights=n, minlength=len(lead)).astype(np.int64))], ["word", "n"]
        )

    def counted(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        label, lead, n = np.unique(hashing.Stretches(data).of(starts, ends), return_index=True, return_counts=True)
        length = ends[lead] - starts[lead]
        offsets = np.r_[0, np.cumsum(length)]
        at = np.arange(offsets[-1]) - np.repeat(offsets[:-1], length) + np.repeat(starts[lead], length)
        words = pa.Array.from_buffers(pa.large_string(), len(lead), [None, pa.py_buffer(offsets), pa.py_buffer(data[at].tobytes())])
        return label, n, words.cast(pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            seeds = np.array([zlib.crc32(f"{x}:".encode()) for x in batch.column(0).to_pylist()], np.uint32)
            for first, data, offsets in hashing.chunks(batch.column(1), CHUNK):
                data = np.frombuffer(data.tobytes().translate(hashing.LOWER), np.uint8)
                starts, ends, row = letter_runs(data, offsets)
                # continuation bytes do not count as letters
                marks = np.r_[0, np.cumsum((data & 0xC0) == 0x80)]
                length = ends - starts - (marks[ends] - marks[starts])
                sums = _checksums(data, starts, ends, seeds[first + row])
                slips = sums % np.uint32(drop_every) == 0
                whole = ~slips & (length >= shortest)
                parts = [counted(data, starts[whole], ends[whole])]
                made = []
                for a, b, h in zip(starts[slips], ends[slips], sums[slips]):
                    word = data[a:b].tobytes().decode()
                    at = int(h) % len(word)
                    if len(word) > shortest:
                        made.append((word[:at] + word[at + 1 :]).encode())
                if made:
                    edges = np.cumsum([0, *map(len, made)])
                    parts.append(counted(np.frombuffer(b"".join(made), np.uint8), edges[:-1], edges[1:]))
                held += parts
                size += sum(len(p[0]) for p in parts)
                if size >= HELD:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(letters padded with zeros, length) of the words; letter codes start at 1."""
    length = np.array([len(w) for w in words], np.int64)
    out = np.zeros((len(words), int(length.max(initial=1)) + 1), np.uint8)
    flat = _CODE[np.frombuffer("".join(words).encode("latin-1"), np.uint8)] + 1
    row = np.repeat(np.arange(len(words)), length)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)] = flat
    return out, length


def _letter_counts(letters: np.ndarray) -> np.ndarray:
    counts = np.zeros((len(letters), len(_LETTERS)), np.float32)
    row, column = np.nonzero(letters)
    np.add.at(counts, (row, letters[row, column] - 1), 1)
    return counts


def _classes(counts: np.ndarray, n: int) -> np.ndarray:
    """Letters of each of n classes, by the letter's code modulo n."""
    return np.stack([counts[:, k::n].sum(axis=1) for k in range(n)], axis=1).astype(np.int64)


def one_edit(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Whether the rows differ by exactly one inserted, deleted or replaced letter."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    swap = la > lb
    short, long = np.where(swap[:, None], b, a), np.where(swap[:, None], a, b)
    size = np.minimum(la, lb)
    differs = short != long
    replaced = (la == lb) & (differs.sum(axis=1) == 1)
    # as far as the words agree from the left, and beyond that one letter further in the long one
    prefix = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    shifted = short[:, :-1] != long[:, 1:]
    shifted &= np.arange(width - 1) < size[:, None]
    last = np.where(shifted.any(axis=1), width - 2 - shifted[:, ::-1].argmax(axis=1), -1)
    inserted = (np.abs(la - lb) == 1) & (last < prefix)
    return replaced | inserted


def _near(group: pd.DataFrame) -> pd.DataFrame:
    """Near pairs of a group: left rows (side 0) with left rows, and with right rows (side 1)."""
    group = group.sort_values(["side", "word"], kind="stable", ignore_index=True)
    words = group["word"].tolist()
    letters, length = _matrix(words)
    counts = _letter_counts(letters)
    left = (group["side"] == 0).to_numpy()
    home, own = group["home"].to_numpy(), group["own"].to_numpy()
    order = np.lexsort((*_classes(counts, FINE).T[::-1], length))
    sides = []
    for side in (order[left[order]], order):
        cuts = [side[k : k + ROWS] for k in range(0, len(side), ROWS)]
        fine = [np.c_[_classes(counts[c], FINE), length[c]] for c in cuts]
        sides.append((cuts, np.array([f.min(axis=0) for f in fine]), np.array([f.max(axis=0) for f in fine])))
    (rows, low, high), (others, low2, high2) = sides
    square = (counts**2).sum(axis=1)
    found = []
    for r, a, b in zip(rows, low, high):
        gap = np.maximum(0, np.maximum(a - high2, low2 - b))
        reach = np.flatnonzero((gap[:, -1] <= 1) & (gap[:, :-1].sum(axis=1) <= 2) & (gap.max(axis=1) <= 1))
        if not len(reach):
            continue
        at = np.concatenate([others[k] for k in reach])
        for k in range(0, len(at), 4096):
            part = at[k : k + 4096]
            apart = square[r][:, None] + square[part][None, :] - 2 * (counts[r] @ counts[part].T)
            i, j = np.nonzero((apart <= 2) & (apart > 0))
            i, j = r[i], part[j]
            # a pair is met once: inside a cell by the smaller word, across cells by the left one
            once = (home[i] != home[j]) | (own[i] < own[j]) | ((own[i] == own[j]) & (i < j))
            i, j = i[once], j[once]
            good = one_edit(letters[i], length[i], letters[j], length[j])
            found.append(np.stack([i[good], j[good]]))
    i, j = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    spelled = np.array(words, object)
    return pd.DataFrame({"a": spelled[i], "b": spelled[j]}, dtype=object)


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b) of all pairs of ``words`` that are one edit apart, each once."""
    steps = [np.zeros(CLASSES, np.int64)]
    for k in range(CLASSES):
        one = np.zeros(CLASSES, np.int64)
        one[k] = 1
        steps += [one, -one]
        for m in range(CLASSES):
            if m != k:
                other = np.zeros(CLASSES, np.int64)
                other[m] = 1
                steps.append(one - other)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_pylist()
            if not own:
                continue
            classes = _classes(_letter_counts(_matrix(own)[0]), CLASSES)
            home = classes @ (1024 ** np.arange(CLASSES, dtype=np.int64))
            for step in steps:
                cell = home + step @ (1024 ** np.arange(CLASSES, dtype=np.int64))
                take = pa.array(((classes + step) >= 0).all(axis=1) & (cell <= home))
                side = int(step.any())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).filter(take), pa.array(home).filter(take), pa.array(cell).filter(take), pa.array([side] * int(take.true_count), pa.int32())],
                    ["word", "home", "cell", "side"],
                )

    dealt = words.select("word").mapInArrow(keyed, "word string, home long, cell long, side int")
    dealt = stored(dealt, "cells")
    sizes = dealt.where("side = 0").groupBy("cell").agg(F.ceil(F.count("*") / PART).alias("parts"))
    dealt = dealt.join(sizes, "cell").withColumn("own", F.pmod(F.xxhash64("word"), "parts"))
    # a left row lives in its part; it is a right row of the parts before it
    at_home = dealt.where("side = 0").select("word", "home", "cell", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("own"))).alias("part"))
    at_home = at_home.withColumn("side", (F.col("part") != F.col("own")).cast("int"))
    abroad = dealt.where("side = 1").select("word", "home", "cell", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    groups = at_home.unionByName(abroad.withColumn("side", F.lit(1)))
    return groups.groupBy("cell", "part").applyInPandas(_near, "a string, b string")


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shortest: int = 6,
    least: int = 5,
    factor: int = 5,
    drop_every: int = 199,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``shortest`` letters or more
    with ``least`` occurrences.

    A null text has no word; a null id counts as the empty string in the seeded slips;
    repeated rows count each time; other columns are not read; an empty table gives no rows.
    Forms grow by ``factor`` from word to form, so a chain of them ends after a logarithmic
    number of steps, and jumping doubles their length each round.
    """
    words = stored(word_counts(docs, id_col, text_col, shortest, drop_every).where(F.col("n") >= least), "words")
    pairs = stored(near_pairs(words), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"))
    )
    found = both.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = found.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other"))).alias("best")
    )
    formed = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("best.minus") >= factor * F.col("n"), F.col("best.other")).alias("form"),
        F.when(-F.col("best.minus") >= factor * F.col("n"), -F.col("best.minus")).alias("form_n"),
    )
    formed = stored(formed, "forms")
    roots = stored(formed.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = stored(roots.join(ahead, "root", "left").select("word", "root", "next"), "roots")
        if joined.where("next is not null").isEmpty():
            break
        roots = joined.select("word", F.coalesce("next", "root").alias("root"))
    return formed.join(joined.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


SQL = r"""
WITH table_steps AS (
  SELECT list_transform(range(0, 256), lambda b: list_reduce(range(0, 8),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b)) AS crc
), runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
  FROM documents
), counted AS (SELECT id, run, count(*) AS c FROM runs GROUP BY ALL),
sums AS (
  SELECT run, c, xor(4294967295, list_reduce(
    list_transform(range(1, octet_length(encode(id || ':' || run)) + 1),
      lambda i: CAST(('0x' || substr(hex(encode(id || ':' || run)), 2 * i - 1, 2)) AS BIGINT)),
    lambda s, b: xor(s // 256, crc[CAST(xor(s, b) % 256 AS BIGINT) + 1]), 4294967295)) AS h
  FROM counted, table_steps
), slipped AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, CAST(h % length(run) + 2 AS BIGINT)) ELSE run END AS word, c FROM sums
), words AS MATERIALIZED (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5
), gaps AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
cut AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM gaps),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, min(struct_pack(minus := -other_n, other := other)) AS best FROM near GROUP BY word
), formed AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.minus >= 5 * n THEN best.other END AS form,
    CASE WHEN -best.minus >= 5 * n THEN -best.minus END AS form_n
  FROM words LEFT JOIN best USING (word)
), chain AS (
  WITH RECURSIVE walk(word, root, form) AS (
    SELECT word, word, form FROM formed
    UNION ALL SELECT walk.word, formed.word, formed.form FROM walk JOIN formed ON formed.word = walk.form
  ) SELECT word, root FROM walk WHERE form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN chain USING (word)
"""
