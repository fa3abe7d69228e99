"""Languages of a document as a mixture.

Each word of a document is drawn from one of the languages of its mixture, and its letter
trigrams from that language: P(word | language) is the product over the word's letters of
the probability of (letter before, letter, letter after), word borders included.

- Trigram counts of every labelled training text, by language, give the probabilities; they
  are smoothed towards those of all languages together.
- Expectation-maximisation over the words of a document gives its proportions.
- Languages enter in the order of their proportions, one at a time, each set fitted anew, as
  long as the log-likelihood less ``penalty`` * log(words) for each language grows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.llm.store import stored

#: Places of the trigram table of a language.
SLOTS = 1 << 16
#: Slots of a language that travel in one row.
BLOCK = 1 << 12
#: Characters of short texts that are looked at together; a longer text stays whole.
CHUNK = 1 << 19
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def texts_of(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Runs of lower-cased texts of about CHUNK characters: (first row, texts); null is empty."""
    first, held, size = 0, [], 0
    for k, text in enumerate(column.to_pylist()):
        text = (text or "").lower()
        if held and size + len(text) > CHUNK:
            yield first, held
            first, held, size = k, [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield first, held


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slot of each letter's trigram, first letter of each word, text of each word)."""
    code = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[code]
    at = np.flatnonzero(letter)
    if not len(at):
        return at, at, at
    plain = np.where(letter, code, 0).astype(np.uint64)
    key = (plain[at - 1] << np.uint64(42)) | (plain[at] << np.uint64(21)) | plain[at + 1]
    slot = (key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 16)
    first = np.flatnonzero(~letter[at - 1])
    border = np.cumsum([1] + [len(t) + 1 for t in texts])
    return slot.astype(np.int64), first, np.searchsorted(border, at[first], side="right") - 1


def held_out(id_col: str, parts: int = 4, left: int = 2) -> Column:
    """Rows kept from training; a row without an id is not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == left, F.lit(False))


@dataclass
class Model:
    """``table[k]`` has the log-probability of each trigram slot in language k."""

    languages: list[str]
    table: np.ndarray
    penalty: float
    rounds: int

    def proportions(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(texts x languages): proportions, 0 for languages that are not in the set; and the
        number of words of each text."""
        slot, first, owner = trigrams(texts)
        words = np.bincount(owner, minlength=len(texts)) if len(owner) else np.zeros(len(texts), int)
        out = np.zeros((len(texts), len(self.languages)))
        rows = np.flatnonzero(words)
        if not len(rows) or not self.languages:
            return out, words
        last = np.r_[first[1:], len(slot)]
        logs = np.empty((len(self.languages), len(first)))
        for k, table in enumerate(self.table):
            sums = np.r_[0.0, np.cumsum(table[slot], dtype=np.float64)]
            logs[k] = sums[last] - sums[first]
        top = logs.max(axis=0)
        chances = np.exp(logs - top)
        count = words[rows]
        head = np.cumsum(count) - count
        whole = np.add.reduceat(top, head)
        every = np.ones((len(self.languages), len(rows)), bool)
        share, _ = self._fit(chances, count, head, every)
        order = np.argsort(-share, axis=0, kind="stable")
        cost = self.penalty * np.log(count + 1.0)
        # one language: the best by its whole likelihood, and then the others by proportion
        alone = np.add.reduceat(logs, head, axis=1)
        lead = alone.argmax(axis=0)
        chosen = np.zeros_like(every)
        chosen[lead, np.arange(len(rows))] = True
        best, result = alone.max(axis=0) - whole, chosen.astype(float)
        place = np.where(order == lead, -1, np.arange(len(self.languages))[:, None])
        order = np.take_along_axis(order, np.argsort(place, axis=0, kind="stable"), axis=0)
        live = np.arange(len(rows))
        for size in range(1, len(self.languages)):
            trial = chosen[:, live].copy()
            trial[order[size, live], np.arange(len(live))] = True
            member = np.repeat(np.arange(len(live)), count[live])
            words_at = np.arange(len(member)) + np.repeat(head[live] - (np.cumsum(count[live]) - count[live]), count[live])
            share, likelihood = self._fit(chances[:, words_at], count[live], np.cumsum(count[live]) - count[live], trial)
            better = likelihood - cost[live] > best[live]
            live = live[better]
            if not len(live):
                break
            best[live] = likelihood[better] - cost[live]
            result[:, live] = share[:, better]
            chosen[:, live] = trial[:, better]
        out[rows] = result.T
        return out, words

    def _fit(self, chances: np.ndarray, count: np.ndarray, head: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proportions of the allowed languages (languages x texts), and the log-likelihood."""
        share = allowed / allowed.sum(axis=0)
        used = np.flatnonzero(allowed.any(axis=1))
        for step in range(self.rounds + 1):
            weighted = [np.repeat(share[k], count) * chances[k] for k in used]
            total = np.maximum(np.sum(weighted, axis=0), 1e-300)
            if step == self.rounds:
                return share, np.add.reduceat(np.log(total), head)
            share = np.zeros_like(share)
            for k, x in zip(used, weighted):
                share[k] = np.add.reduceat(x / total, head) / count


def learn(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    penalty: float = 3.0,
    rounds: int = 8,
    smoothing: float = 2000.0,
    most_languages: int = 512,
) -> Model:
    """Count the trigrams of all rows with a language.  The model has ``SLOTS`` numbers a
    language; more than ``most_languages`` different labels raise an error."""
    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for first, texts in texts_of(batch.column(0)):
                slot, head, owner = trigrams(texts)
                own = langs[first : first + len(texts)]
                names, number = np.unique(own.astype(str), return_inverse=True)
                lang = np.repeat(number[owner], np.diff(np.r_[head, len(slot)])) if len(slot) else slot
                found = np.bincount(lang * SLOTS + slot, minlength=len(names) * SLOTS).reshape(-1, SLOTS)
                for name, x in zip(names, found):
                    counts[name] = counts[name] + x if name in counts else x
        for name, x in counts.items():
            at = np.flatnonzero(x)
            at = at if len(at) else np.zeros(1, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(x[at])], ["lang", "slot", "n"])

    counted = rows.mapInArrow(run, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.zeros(BLOCK, np.int64)
        x[rows["slot"].to_numpy() % BLOCK] = rows["n"].to_numpy()
        return pd.DataFrame({"lang": rows["lang"].iloc[:1], "block": rows["slot"].iloc[:1] // BLOCK, "n": [x.tobytes()]})

    counted = stored(counted, "trigrams")
    languages = [r["lang"] for r in counted.select("lang").distinct().orderBy("lang").limit(most_languages + 1).collect()]
    if len(languages) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    number = {lang: k for k, lang in enumerate(languages)}
    table = np.zeros((len(languages), SLOTS))
    blocks = counted.withColumn("block", F.floor(F.col("slot") / BLOCK)).groupBy("lang", "block")
    for r in blocks.applyInPandas(packed, "lang string, block long, n binary").collect():  # SLOTS numbers a language
        table[number[r["lang"]], r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(r["n"], np.int64)
    pooled = (table.sum(axis=0) + 0.05) / (table.sum() + 0.05 * SLOTS)
    table = np.log((table + smoothing * pooled) / (table.sum(axis=1, keepdims=True) + smoothing))
    return Model(languages, table.astype(np.float32), penalty, rounds)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, mixture) of every row: the language of the largest proportion
    (ties: the first by name), its proportion, and all languages of the set with theirs.

    A text that is null or has no letter is ``und`` with score 0 and an empty mixture, and
    so is every text if nothing was learned.  Repeated rows give repeated results; other
    columns are not read.
    """
    languages = np.array([*model.languages, UNKNOWN], object)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most most_languages tables

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in texts_of(batch.column(1)):
                share, _ = shared.value.proportions(texts)
                lead = share.argmax(axis=1) if share.shape[1] else np.zeros(len(texts), int)
                score = share[np.arange(len(texts)), lead] if share.shape[1] else np.zeros(len(texts))
                lead = np.where(score > 0, lead, len(languages) - 1)
                mixture = [[(str(languages[k]), float(row[k])) for k in np.flatnonzero(row)] for row in share]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.array(languages[lead].tolist(), pa.string()),
                        pa.array(np.clip(score, 0, 1)),
                        pa.array(mixture, pa.map_(pa.string(), pa.float64())),
                    ],
                    ["id", "lang_pred", "score", "mixture"],
                )

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(run, f"id {kind}, lang_pred string, score double, mixture map<string,double>")
    return out.withColumnRenamed("id", id_col)


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score, mixture); the held-out quarter is not learned from."""
    model = learn(docs.where(~held_out(id_col)), text_col, lang_col)
    found = identify(docs, model, id_col, text_col)
    return found.select(id_col, held_out(id_col).alias("held_out"), "lang_pred", "score", "mixture")
