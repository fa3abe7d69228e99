"""Toxicity by weak supervision.

Voters: terms mined from labelled rows (whole words and word beginnings), a small public
list of insults, spellings of it with digits, patterns of the text, and silence (no term
found).  A generative label model with one firing rate per voter and class is anchored in
the labelled rows and refined by expectation-maximisation over the vote patterns of all
texts; correlations of voters inside the toxic class discount their evidence.  A linear
classifier over votes and hashed word beginnings is then trained on the posterior labels.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stockweave.llm.pretokens import Generations
from stockweave.llm.store import stored

# Common English insults, and digits that stand for letters.
INSULTS = [
    "bastard", "clown", "coward", "creep", "cretin", "disgusting", "dumb", "filth", "fool", "freak", "garbage",
    "idiot", "imbecile", "jerk", "liar", "loser", "lunatic", "moron", "pathetic", "pig", "psycho", "scum", "stupid",
    "trash", "ugly", "vermin", "worthless",
]
LEET = str.maketrans("013457@$", "oieastas")
DISMISSALS = ["shut up", "get lost", "drop dead", "go to hell", "screw you", "you people"]
MASKED = re.compile(r"[^\W\d_]\*+[^\W\d_]")
# names that no mined term can have
PATTERNS = {
    "!shouting": lambda text: "!!" in text or "?!" in text,
    "!masked": lambda text: "*" in text and MASKED.search(text) is not None,
    "!dismissal": lambda text: any(phrase in text for phrase in DISMISSALS),
}
WORD = re.compile(r"[^\W_]+")
DIGIT_IN_WORD = re.compile(r"[a-z][013457@$]|[013457@$][a-z]")
PREFIXES = (3, 4, 5, 6)
HASHED = 1 << 13
#: A word beginning is also listed as "k:beginning", which takes k distinct words.
TIMES = (2, 3)
SILENT = "!silence"


def terms(word: str) -> list[str]:
    """Names under which a lower-case word can be listed: itself and its beginnings."""
    return ["=" + word, *(word[:k] for k in PREFIXES if len(word) >= k)]


def text_terms(text: str | None) -> set[str]:
    """All names under which a text can be found."""
    seen = Counter(t for w in set(WORD.findall((text or "").lower())) for t in set(terms(w)))
    return {*seen, *(f"{k}:{t}" for t, n in seen.items() if n > 1 and t[0] != "=" for k in TIMES if n >= k)}


def tokens(text: str | None) -> set[str]:
    """Distinct stretches between white space, lower case."""
    return set((text or "").lower().split())


@dataclass
class Model:
    """Voter names, firing rates by class, discounts, and the classifier's weights."""

    voters: list[str]
    prior: float = 0.1
    rates: np.ndarray | None = None  # (2, voters): clean, toxic
    discount: np.ndarray | None = None
    bias: float = 0.0
    weights: np.ndarray | None = None  # voters, then 2 amounts, then hashed beginnings
    number: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        self.number = {v: i for i, v in enumerate(self.voters)}
        # what a single token can bring: the names without their counts
        self.base: dict[str, list[tuple[int, int]]] = {}
        for i, v in enumerate(self.voters):
            times, name = (int(v[0]), v[2:]) if v[1:2] == ":" else (1, v)
            self.base.setdefault(name, []).append((times, i))

    def logit(self, fired: list[int]) -> float:
        """Log-odds of the label model; a voter that does not fire abstains."""
        evidence = np.log(self.rates[1, fired] / self.rates[0, fired]) * self.discount[fired]
        return math.log(self.prior / (1 - self.prior)) + float(evidence.sum())


class Finder:
    """Finds the listed terms of a model in texts with one automaton over all of them."""

    def __init__(self, model: Model):
        self.model = model
        plain, spelt = {}, {}
        for name in model.base:
            if name not in PATTERNS and name != SILENT:
                group = spelt if name[0] == "@" else plain
                group.setdefault(name.lstrip("=@"), []).append(name)
        self.plain, self.spelt = self._automaton(plain), self._automaton(spelt)

    @staticmethod
    def _automaton(names: dict[str, list[str]]):
        out = ahocorasick.Automaton()
        for text, group in names.items():
            out.add_word(text, (len(text), tuple(group)))
        if names:
            out.make_automaton()
        return out

    @staticmethod
    def _words(automaton, text: str) -> Iterator[tuple[str, int, str]]:
        """(name, start, word) of every listed beginning of a word."""
        size = len(text)
        for last, (length, names) in automaton.iter(text) if len(automaton) else ():
            start, stop = last - length + 1, last + 1
            if start and text[start - 1].isalnum():
                continue
            while stop < size and text[stop].isalnum():
                stop += 1
            for name in names:
                if name[0] not in "=@" or stop == last + 1:
                    yield name, start, text[start:stop]

    def vote(self, text: str | None) -> tuple[list[int], int]:
        """(voters that fire, number of distinct words with a listed term)."""
        text, model = (text or "").lower(), self.model
        words: dict[str, set[str]] = {}
        for name, _, word in self._words(self.plain, text):
            words.setdefault(name, set()).add(word)
        if DIGIT_IN_WORD.search(text):
            for name, start, word in self._words(self.spelt, text.translate(LEET)):
                if text[start : start + len(word)] != word:
                    words.setdefault(name, set()).add(word)
        fired = {i for name, found in words.items() for times, i in model.base[name] if len(found) >= times}
        if not fired:
            fired.add(model.number[SILENT])
        fired.update(model.number[name] for name, shows in PATTERNS.items() if shows(text))
        return sorted(fired), len(set().union(*words.values()))


def hashed(token: str) -> list[int]:
    """Hashed beginnings of the words of a token."""
    return [zlib.crc32(word[:4].encode()) % HASHED for word in WORD.findall(token)]


class Weights(Generations):
    """Classifier weight of each token."""

    def __init__(self, weights: np.ndarray, size: int = 200_000):
        super().__init__(size)
        self.weights = weights

    def compute(self, token: str) -> float:
        return float(self.weights[hashed(token)].sum())


def learnable(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """Labels that may be learnt from: crc32 of the id as text leaves no remainder 1 by 3."""
    rows = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    return rows.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(label_col).cast("int").alias("toxic"))


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _mine(sample: DataFrame, most: int, least_score: float) -> list[str]:
    """Terms whose log-odds for the label, less 1.64 standard errors, reach a least score."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                found = text_terms(text)
                found.add("")
                seen[min(1, max(0, int(toxic)))].update(found)
            if sum(map(len, seen)) > 1_000_000:
                yield _counts(seen)
                seen = (Counter(), Counter())
        yield _counts(seen)

    counts = sample.select("text", "toxic").mapInPandas(count, "term string, toxic int, n long")
    table = counts.groupBy("term").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("p"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("q"),
    )
    table = stored(table.where("p >= 3 or term = ''"), "terms")
    total = table.where("term = ''").first()
    if total is None or not total["p"] or not total["q"]:
        return []
    p, q = F.col("p") + 0.5, F.col("q") + 0.5
    score = F.log(p / q) + math.log(total["q"] / total["p"]) - 1.64 * F.sqrt(1 / p + 1 / q)
    best = table.where("term <> ''").withColumn("score", score).where(F.col("score") >= least_score)
    ranked = best.orderBy(F.desc("score"), "term").limit(40 * most).collect()
    return _without_nested({r["term"]: (r["p"], r["score"]) for r in ranked})[:most]


def _without_nested(ranked: dict[str, tuple[int, float]]) -> list[str]:
    """Leave out a term where a shorter beginning of it finds clearly more at about its score,
    and a beginning where a longer one finds the same."""

    def shorter(term: str) -> list[str]:
        times, name = (term[:2], term[2:]) if term[1:2] == ":" else ("", term)
        word = name.removeprefix("=")
        names = [word[:k] for k in PREFIXES if k <= len(word) and word[:k] != name]
        return [t + n for n in names for t in ("", *(f"{k}:" for k in TIMES))] if not times else [times + n for n in names]

    dropped = set()
    for term, (p, score) in ranked.items():
        for other in shorter(term):
            if other in ranked:
                q, less = ranked[other]
                if q > 1.1 * p and less >= score - 0.3:
                    dropped.add(term)
                elif p >= 0.95 * q and score >= less:
                    dropped.add(other)
    return [t for t in ranked if t not in dropped]


def _counts(seen: tuple[Counter, Counter]) -> pd.DataFrame:
    parts = [pd.DataFrame({"term": list(c), "toxic": k, "n": list(c.values())}) for k, c in enumerate(seen)]
    return pd.concat(parts).astype({"term": object, "toxic": "int32", "n": "int64"})


def _moments(patterns: DataFrame, model: Model) -> None:
    """One round of expectation-maximisation over the patterns of all texts."""

    def expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = len(model.voters)
        alone, both = np.zeros((2, size + 1)), np.zeros((size, size))
        for batch in batches:
            for fired, n in zip(batch["fired"], batch["n"]):
                fired = list(fired)
                toxic = n / (1 + math.exp(-max(-60.0, min(60.0, model.logit(fired)))))
                alone[0, fired] += n - toxic
                alone[1, fired] += toxic
                alone[:, size] += n - toxic, toxic
                both[np.ix_(fired, fired)] += toxic
        for kind, matrix in ((0, alone), (1, both)):
            i, j = np.nonzero(matrix)
            yield pd.DataFrame({"kind": kind, "i": i, "j": j, "x": matrix[i, j]})

    sums = patterns.mapInPandas(expect, "kind int, i int, j int, x double").groupBy("kind", "i", "j").agg(F.sum("x").alias("x"))
    size = len(model.voters)
    alone, both = np.zeros((2, size + 1)), np.zeros((size, size))
    for r in sums.collect():  # at most voters squared
        (both if r["kind"] else alone)[r["i"], r["j"]] = r["x"]
    if not alone[:, size].sum():
        return
    model.prior = float(np.clip(alone[1, size] / alone[:, size].sum(), 0.005, 0.5))
    model.rates = (alone[:, :size] + model.rates * 10) / (alone[:, size:] + 10)
    n = max(alone[1, size], 1.0)
    mean = np.diag(both) / n
    spread = np.sqrt(np.clip(mean * (1 - mean), 1e-9, None))
    correlation = (both / n - np.outer(mean, mean)) / np.outer(spread, spread)
    np.fill_diagonal(correlation, 0)
    model.discount = 1 / (1 + np.clip(correlation, 0, 1).sum(axis=1))


def _fit(features: pd.DataFrame, model: Model, rounds: int = 150, penalty: float = 2e-3) -> None:
    """Logistic regression on posterior labels by accelerated gradient steps."""
    size = len(model.voters) + 2 + HASHED
    rows = np.repeat(np.arange(len(features)), features["index"].map(len))
    index = np.concatenate([*features["index"], np.zeros(0, np.int64)]).astype(np.int64)
    value = np.concatenate([*features["value"], np.zeros(0)])
    target = features["posterior"].to_numpy()
    weights, bias, ahead, ahead_bias = np.zeros(size), 0.0, np.zeros(size), 0.0
    n = max(1, len(features))
    # the largest row norm bounds the curvature
    norm = np.bincount(rows, weights=value * value, minlength=n).max(initial=1.0) + 1
    step = 4 / norm
    for t in range(rounds):
        z = np.bincount(rows, weights=ahead[index] * value, minlength=n)[: len(target)] + ahead_bias
        error = 1 / (1 + np.exp(-np.clip(z, -60, 60))) - target
        gradient = np.bincount(index, weights=value * error[rows], minlength=size) / n + penalty / 10 * ahead
        old, old_bias = weights, bias
        weights, bias = ahead - step * gradient * 10, ahead_bias - step * error.sum() / n * 10
        ahead = weights + t / (t + 3) * (weights - old)
        ahead_bias = bias + t / (t + 3) * (bias - old_bias)
    model.weights, model.bias = weights, float(bias)


def _amounts(hits: int, n: int) -> list[float]:
    return [math.log1p(hits), 10 * hits / (n + 10)]


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = 12_000,
    most_terms: int = 96,
    least_score: float = 1.5,
    rounds: int = 3,
) -> Model:
    """Fit the model.

    Terms are mined and the classifier is fitted on at most ``sample_rows`` labelled rows
    (those with the smallest hash of the id); the label model sees the vote patterns of all
    texts.  Without labelled rows of both classes the public list votes with fixed rates.
    """
    spark = docs.sparkSession
    chosen = learnable(labels, id_col, label_col).orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # at most sample_rows pairs of id and label
    sample = stored(rows.join(F.broadcast(chosen), "id"), "labelled")
    mined = _mine(sample, most_terms, least_score)
    listed = ["=" + w for w in INSULTS if "=" + w not in mined] + ["@" + w for w in INSULTS]
    model = Model([*mined, *listed, *PATTERNS, SILENT])
    size = len(model.voters)

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, seen = Finder(model), Counter()
        for batch in batches:
            for text in batch.column(0):
                seen[tuple(finder.vote(text.as_py())[0])] += 1
            if len(seen) > 100_000:
                yield _patterns(seen)
                seen = Counter()
        yield _patterns(seen)

    # rates where nothing is known: terms fire more often in toxic texts, silence in clean ones
    model.rates = np.tile(np.array([[0.002], [0.1]]), (1, size))
    for name in PATTERNS:
        model.rates[:, model.number[name]] = 0.05, 0.06
    model.rates[:, model.number[SILENT]] = 0.95, 0.05
    model.discount = np.ones(size)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(model)
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                fired, hits = finder.vote(text)
                own = tokens(text)
                scale = 1 / math.sqrt(max(1, len(own)))
                seen = Counter(h for t in own for h in hashed(t))
                index = [*fired, size, size + 1, *(size + 2 + h for h in seen)]
                value = [*([1.0] * len(fired)), *_amounts(hits, len(own)), *(n * scale for n in seen.values())]
                out.append((fired, index, value))
            fired, index, value = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(fired, pa.list_(pa.int32())), pa.array(index, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float64())), batch.column(1)],
                ["fired", "index", "value", "toxic"],
            )

    features = sample.select("text", "toxic").mapInArrow(
        known, "fired array<int>, index array<int>, value array<double>, toxic int"
    ).toPandas()  # at most sample_rows
    gold = features["toxic"].to_numpy() == 1
    if gold.any() and not gold.all():
        counts = np.zeros((2, size))
        for fired, toxic in zip(features["fired"], gold):
            counts[int(toxic), fired] += 1
        model.rates = (counts + model.rates * 2) / (np.array([[(~gold).sum()], [gold.sum()]]) + 2)
        model.prior = float(np.clip(gold.mean(), 0.005, 0.5))
    model.rates = np.clip(model.rates, 1e-4, 1 - 1e-4)
    seen = stored(
        rows.select("text").mapInArrow(patterns, "fired array<int>, n long").groupBy("fired").agg(F.sum("n").alias("n")), "patterns"
    )
    for _ in range(rounds):
        _moments(seen, model)
        model.rates = np.clip(model.rates, 1e-4, 1 - 1e-4)
    # the label itself is one more voter, right 19 times of 20
    own = np.where(gold, 1, -1) * math.log(19)
    logits = np.array([model.logit(list(f)) for f in features["fired"]]) + own if len(features) else np.zeros(0)
    features["posterior"] = 1 / (1 + np.exp(-np.clip(logits, -60, 60)))
    if len(features):
        _fit(features, model)
    return model


def _patterns(seen: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([list(k) for k in seen], pa.list_(pa.int32())), pa.array(list(seen.values()), pa.int64())], ["fired", "n"]
    )


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with a column of scores from 0 to 1; a null text counts as empty.  The
    classifier's answer, or the label model's where there was nothing to train it on."""
    size = len(model.voters)
    kind = StructType([*docs.schema.fields, StructField(out_col, DoubleType())])
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, at, w = Finder(model), columns.index(text_col), model.weights
        words = Weights(w[size + 2 :]) if w is not None else {}
        for batch in batches:
            out = []
            for text in batch.column(at):
                text = text.as_py()
                fired, hits = finder.vote(text)
                if w is None:
                    z = model.logit(fired)
                else:
                    own = tokens(text)
                    z = model.bias + float(w[fired].sum()) + float(np.dot(w[size : size + 2], _amounts(hits, len(own))))
                    # fsum: the order of a set of strings differs between processes
                    z += math.fsum(map(words.__getitem__, own)) / math.sqrt(max(1, len(own)))
                out.append(1 / (1 + math.exp(-max(-60.0, min(60.0, z)))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], [*batch.schema.names, out_col])

    return docs.mapInArrow(run, kind)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """(id, held_out, score, predicted) of every whole text; see ``learn`` and ``score``.

    A row without an id is not held out; repeated rows give repeated results.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scored = score(rows, learn(docs, labels, id_col, text_col))
    return scored.select(
        F.col("id").alias(id_col),
        held_out("id").alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
