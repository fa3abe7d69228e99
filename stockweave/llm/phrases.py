"""Collocations by weighted acyclic automata.

1. Words are counted for each language; those with ``least`` occurrences are the dictionary.
   A word's label is a 64-bit hash of language and word.
2. Each task sorts its n-grams and builds a count transducer of them for each prefix range
   (``transducers.build``); the transducers of one range meet in a group, their union adds
   the weights, and paths of at least ``least`` stay.  Pairs come first, then three and four
   words together.  A phrase cannot be more frequent than its parts, so only n-grams whose
   shorter parts pass are built; what has passed travels as a bit table of bounded size,
   which may let a rare n-gram through but never holds a frequent one back.
3. The parts of the candidates are looked up by composing their automaton with the count
   transducer of their prefix range.
4. Scores, the drop rule and the ranks are integer DataFrame expressions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave.llm import hashing, transducers
from stockweave.llm.store import stored

#: N-grams that a task gathers before it builds their transducers.
FLUSH = 1 << 19
#: Bytes of text that are cut into words together.
CHUNK = 1 << 20
#: Distinct words that a task holds before it passes their counts on.
HELD = 1 << 18
#: Bits of a block of the bit table.
BLOCK = 1 << 17
LONGEST = 4
LABELS = [f"l{j + 1}" for j in range(LONGEST)]

_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2


def _seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(label, piece, row, starts, ends, bytes) of the words of the texts, chunk by chunk;
    column 0 holds the texts, column 1 the languages.  Pieces of different rows differ."""
    seeds = {lang: _seed(lang) for lang in batch.column(1).unique().to_pylist()}
    seed = np.array([seeds[lang] for lang in batch.column(1).to_pylist()], np.uint64)
    for first, data, offsets in hashing.chunks(batch.column(0), CHUNK):
        data = np.frombuffer(data.tobytes().translate(hashing.LOWER), np.uint8)
        kind = _KIND[data]
        inside = kind == 0
        before = np.r_[False, inside[:-1]] if len(data) else inside
        edges = offsets[:-1]
        before[edges[edges < len(data)]] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.r_[inside[1:], False] if len(data) else inside
        edges = offsets[1:]
        after[edges[edges > 0] - 1] = False
        ends = np.flatnonzero(inside & ~after) + 1
        row = np.searchsorted(offsets, starts, side="right") - 1
        piece = np.searchsorted(np.flatnonzero(kind == 2), starts) + row
        label = hashing.mix(hashing.Stretches(data).of(starts, ends) ^ seed[first + row])
        yield np.maximum(label, np.uint64(1)), piece, first + row, starts, ends, data


def _rows(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang")
    )


def word_counts(rows: DataFrame) -> DataFrame:
    """(lang, word, label, n) of all words."""

    def flush(held: list[tuple]) -> pa.RecordBatch:
        label, n = (np.concatenate([h[k] for h in held]) for k in (2, 3))
        own, lead, place = np.unique(label, return_index=True, return_inverse=True)
        lang, words = (pa.concat_arrays([h[k] for h in held]).take(pa.array(lead)) for k in (0, 1))
        n = np.bincount(place, weights=n, minlength=len(own)).astype(np.int64)
        return pa.RecordBatch.from_arrays([lang, words, pa.array(own.view(np.int64)), pa.array(n)], ["lang", "word", "label", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for label, _, row, starts, ends, data in _texts(batch):
                own, lead, n = np.unique(label, return_index=True, return_counts=True)
                length = ends[lead] - starts[lead]
                offsets = np.r_[0, np.cumsum(length)]
                at = np.arange(offsets[-1]) - np.repeat(offsets[:-1], length) + np.repeat(starts[lead], length)
                words = pa.Array.from_buffers(
                    pa.large_string(), len(own), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at].tobytes())]
                ).cast(pa.string())
                held.append((batch.column(1).take(pa.array(row[lead])), words, own, n))
                size += len(own)
                if size >= HELD:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)

    counted = rows.mapInArrow(run, "lang string, word string, label long, n long")
    return counted.groupBy("lang", "word", "label").agg(F.sum("n").alias("n"))


def bit_table(keys: DataFrame, most_bits: int = 1 << 26) -> np.ndarray:
    """A bit for each 64-bit key; 16 bits a key up to ``most_bits`` in all, so at most 8 MB
    come to the driver.  Beyond, more bits are shared: the table passes more, never less."""
    bits = BLOCK
    total = keys.count()
    while bits < most_bits and bits < 16 * total:
        bits *= 2

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            slot = batch["key"].to_numpy().view(np.uint64) >> np.uint64(1) & np.uint64(bits - 1)
            for block in np.unique(slot // BLOCK):
                table = blocks.setdefault(int(block), np.zeros(BLOCK, bool))
                table[(slot[slot // BLOCK == block] % BLOCK).astype(np.int64)] = True
        if blocks:
            yield pd.DataFrame({"block": list(blocks), "bits": [np.packbits(t).tobytes() for t in blocks.values()]})

    def merged(block: pd.DataFrame) -> pd.DataFrame:
        table = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in block["bits"]])
        return pd.DataFrame({"block": block["block"].iloc[:1], "bits": [table.tobytes()]})

    kind = "block long, bits binary"
    out = np.zeros(bits // 8, np.uint8)
    rows = keys.select("key").mapInPandas(local, kind).groupBy("block").applyInPandas(merged, kind)
    for row in rows.collect():  # most_bits / BLOCK rows at most
        out[row["block"] * BLOCK // 8 : (row["block"] + 1) * BLOCK // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def _passes(table: np.ndarray, key: np.ndarray) -> np.ndarray:
    slot = key >> np.uint64(1) & np.uint64(len(table) * 8 - 1)
    return (table[slot >> np.uint64(3)] >> (np.uint8(7) - (slot & np.uint64(7)).astype(np.uint8))) & np.uint8(1) == 1


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return hashing.mix(a * np.uint64(hashing.BASE) + b)


def shard_transducers(rows: DataFrame, words, pairs, ranges: int) -> DataFrame:
    """(part, automaton): the count transducers of each task by prefix range.  ``words`` and
    ``pairs`` are broadcast bit tables; without ``pairs`` the n-grams are pairs, with them
    they have three and four words."""
    ends = np.array([k * (1 << 64) // ranges for k in range(ranges)], np.uint64)

    def flush(held: dict[int, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        phrases, weights = [], []
        for blocks in held.values():
            gram = np.concatenate(blocks)
            phrases.append(gram)
            weights.append(np.ones(len(gram), np.int64))
        built = transducers.build(phrases, weights, ends, 3 if pairs else 2)
        if built:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in built], pa.int64()), pa.array([transducers.pack(t) for _, t in built], pa.binary())], ["part", "automaton"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        size = 0
        for batch in batches:
            for label, piece, *_ in _texts(batch):
                known = _passes(words.value, label)
                together = (piece[1:] == piece[:-1]) & known[1:] & known[:-1]
                if pairs is None:
                    found = {2: np.flatnonzero(together)}
                else:
                    at = np.flatnonzero(together)
                    together[at] = _passes(pairs.value, _pair(label[at], label[at + 1]))
                    three = together[1:] & together[:-1]
                    four = three[1:] & three[:-1]
                    # a start of four words gives its first three as well
                    found = {3: np.flatnonzero(three), 4: np.flatnonzero(four)}
                for n, at in found.items():
                    held.setdefault(n, []).append(label[at[:, None] + np.arange(n)])
                    size += len(at)
                if size >= FLUSH:
                    yield from flush(held)
                    held, size = {}, 0
        if size:
            yield from flush(held)

    return rows.mapInArrow(run, "part long, automaton binary")


def _frame(found: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
    """Rows (l1, .., l4, n); 0 stands for no label."""
    labels = [np.pad(m, ((0, 0), (0, LONGEST - m.shape[1]))) for m, _ in found]
    matrix = np.concatenate(labels) if labels else np.zeros((0, LONGEST), np.uint64)
    out = pd.DataFrame(matrix.view(np.int64), columns=LABELS)
    out["n"] = np.concatenate([n for _, n in found]) if found else np.zeros(0, np.int64)
    return out


_PHRASE = ", ".join(f"{c} long" for c in LABELS) + ", n long"


def frequent(shards: DataFrame, least: int) -> DataFrame:
    """(l1, .., l4, n): union of the transducers of each prefix range, paths of ``least``."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        return _frame(transducers.paths(transducers.union([transducers.unpack(x) for x in part["automaton"]]), least))

    return shards.groupBy("part").applyInPandas(run, _PHRASE)


def _automaton(rows: pd.DataFrame) -> list[transducers.Layer]:
    """One transducer of the phrases (l1, ..) with the counts n."""
    matrix = rows[LABELS].to_numpy().view(np.uint64)
    length, n = (matrix != 0).sum(axis=1), rows["n"].to_numpy()
    sizes = range(1, LONGEST + 1)
    built = transducers.build([matrix[length == k, :k] for k in sizes], [n[length == k] for k in sizes], np.zeros(1, np.uint64), 1)
    return built[0][1] if built else []


def looked_up(counts: DataFrame, parts: DataFrame, ranges: int) -> DataFrame:
    """(l1, .., l4, n) of the phrases of ``parts`` that ``counts`` holds, by composition."""
    place = F.pmod(F.xxhash64("l1", "l2"), F.lit(ranges)).alias("part")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _frame(transducers.compose(_automaton(left), _automaton(right)))

    asked = parts.select(place, *LABELS, F.lit(1).cast("long").alias("n"))
    return counts.select(place, *LABELS, "n").groupBy("part").cogroup(asked.groupBy("part")).applyInPandas(run, _PHRASE)


def _key(labels: list, name: str) -> Column:
    """LABELS of a part: its labels, then zeros."""
    return F.array(*labels, *[F.lit(0).cast("long")] * (LONGEST - len(labels))).alias(name)


def _cuts() -> Column:
    """All (k, first part, rest) of a candidate, by its number of words."""
    cols = [F.col(c) for c in LABELS]
    by_size = {m: F.array(*[F.struct(F.lit(k).alias("k"), _key(cols[:k], "first"), _key(cols[k:m], "rest")) for k in range(1, m)]) for m in (2, 3, 4)}
    return F.when(F.col("l3") == 0, by_size[2]).when(F.col("l4") == 0, by_size[3]).otherwise(by_size[4])


def _inner() -> Column:
    """All shorter phrases of two words and more inside a candidate of three or four."""
    cols = [F.col(c) for c in LABELS]
    by_size = {m: F.array(*[_key(cols[i : i + n], "x") for n in range(2, m) for i in range(m - n + 1)]) for m in (3, 4)}
    return F.when(F.col("l4") == 0, by_size[3]).otherwise(by_size[4])


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = 30,
    top: int = 2000,
    scale: int = 2_000_000,
    share: int = 80,
    words_per_range: int = 250_000,
    most_bits: int = 1 << 26,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two to four words of
    each language.

    Pieces end at ``.,;:!?`` and line ends; words are runs without blanks in them, A-Z as
    a-z.  A null text has no word, a null language is ``und``; repeated rows count each time;
    other columns are not read.  Empty tables give no rows.  Counts are exact up to chance
    collisions of 64-bit labels; two frequent words with one label raise an error.
    """
    spark = docs.sparkSession
    rows = _rows(docs, text_col, lang_col)
    counted = stored(word_counts(rows), "words")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    words = stored(counted.where(F.col("n") >= least), "dictionary")
    if words.groupBy("label").count().where("count > 1").limit(1).count():
        raise RuntimeError("two words share a label")
    total = counted.agg(F.sum("n")).first()[0] or 0
    ranges = max(32, -(-total // words_per_range))
    word_bits = spark.sparkContext.broadcast(bit_table(words.select(F.col("label").alias("key")), most_bits))
    two = stored(frequent(stored(shard_transducers(rows, word_bits, None, ranges), "shards"), least), "pairs")
    pair_bits = spark.sparkContext.broadcast(bit_table(_pair_keys(two), most_bits))
    more = stored(frequent(stored(shard_transducers(rows, word_bits, pair_bits, ranges), "shards"), least), "longer")
    none = F.lit(0).cast("long")
    candidates = two.unionByName(more)
    counts = words.select(F.col("label").alias("l1"), *[none.alias(c) for c in LABELS[1:]], "n").unionByName(candidates)

    cuts = stored(candidates.select(*LABELS, F.col("n").alias("a"), F.explode(_cuts()).alias("c")).select(*LABELS, "a", "c.*"), "cuts")
    parts = cuts.select(F.explode(F.array("first", "rest")).alias("p")).distinct()
    parts = parts.select(*[F.col("p")[j].alias(c) for j, c in enumerate(LABELS)])
    known = stored(looked_up(counts, parts, max(16, -(-total // (4 * words_per_range)))), "parts").select(F.array(*LABELS).alias("p"), "n")
    scored = cuts.join(known.select(F.col("p").alias("first"), F.col("n").alias("l")), "first").join(
        known.select(F.col("p").alias("rest"), F.col("n").alias("r")), "rest"
    )
    # whole numbers of up to 38 digits, cut off by the integer division
    score = F.expr(f"(cast({scale} as decimal(18,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + r)")
    best = scored.withColumn("score", score).groupBy(*LABELS, "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    inside = candidates.where("l3 <> 0").select(F.explode(_inner()).alias("p"), F.col("n").alias("around"))
    inside = inside.groupBy("p").agg(F.max("around").alias("around"))
    kept = best.withColumn("p", F.array(*LABELS)).join(inside, "p", "left")
    big = lambda c: F.col(c).cast("decimal(19,0)")
    kept = kept.where(F.col("around").isNull() | (100 * big("around") < share * big("a")))
    spelled = kept.select("p", "a", "best", F.posexplode("p").alias("pos", "label")).where("label <> 0")
    spelled = spelled.join(words.select("label", "lang", "word"), "label").groupBy("p", "a", "best").agg(
        F.first("lang").alias("lang"),
        F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"])).alias("phrase"),
    )
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    ranked = spelled.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("total").alias("n"), F.col("best.score").alias("score")
    )


def _pair_keys(two: DataFrame) -> DataFrame:
    """(key) of the frequent pairs, as the tasks compute it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"key": _pair(*(batch[c].to_numpy().view(np.uint64) for c in ("l1", "l2"))).view(np.int64)})

    return two.select("l1", "l2").mapInPandas(run, "key long")


SQL = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces),
g AS (
  SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS p
  FROM w, (VALUES (1), (2), (3), (4)) AS sizes(m) WHERE len(ws) >= m
), f AS MATERIALIZED (SELECT lang, p, m, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
split AS MATERIALIZED (SELECT lang, p, m, a, string_split(p, ' ') AS ws FROM f WHERE m >= 2),
places AS (SELECT lang, p, a, ws, unnest(range(1, m)) AS k FROM split),
halves AS MATERIALIZED (
  SELECT lang, p, a, k, array_to_string(ws[1:k], ' ') AS first, array_to_string(ws[k + 1:], ' ') AS rest FROM places
), cuts AS (
  SELECT h.lang, h.p, h.a, k, x.a AS l, y.a AS r, 2000000::HUGEINT * h.a // (x.a + y.a) AS score
  FROM halves h JOIN f x ON x.lang = h.lang AND x.p = h.first JOIN f y ON y.lang = h.lang AND y.p = h.rest
), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inner_parts AS (
  SELECT lang, unnest(list_transform(range(1, m - s + 2), lambda i: array_to_string(ws[i:i + s - 1], ' '))) AS p, a AS around
  FROM split, (VALUES (2), (3)) AS sizes(s) WHERE s < m
), most AS (SELECT lang, p, max(around) AS around FROM inner_parts GROUP BY ALL),
kept AS (
  SELECT best.*, best.p AS phrase FROM best LEFT JOIN most USING (lang, p)
  WHERE around IS NULL OR 100::HUGEINT * around < 80 * a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
