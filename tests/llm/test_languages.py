"""Languages on held-out rows, and the mixture of a text."""

import random
import zlib

import numpy as np
import pytest

from stockweave.llm import languages
from stockweave.llm.queries import QUERIES


def prose(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(n))


ALPHABETS = {"aa": "abcdeio", "bb": "abxyzuk", "cc": "äöüßrst", "dd": "мнопрст"}


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    rows = [(lang, prose(rng, letters, 60)) for lang, letters in ALPHABETS.items() for _ in range(40)]
    return languages.learn(spark.createDataFrame(rows, "lang string, text string"))


def test_held_out_rows_are_found(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op12_language_id"](spark, small).join(docs, "doc_id").toPandas()
    assert len(found) == docs.count() and found["score"].between(0, 1).all()
    assert list(found["held_out"]) == [zlib.crc32(str(i).encode()) % 4 == 2 for i in found["doc_id"]]
    held = found[found["held_out"]]
    assert len(held) > 20 and (held["lang_pred"] == held["lang"]).mean() > 0.96


def test_mixtures_are_taken_apart(model):
    rng = random.Random(2)
    texts = [
        prose(rng, ALPHABETS["aa"], 30),
        prose(rng, ALPHABETS["aa"], 30) + ". " + prose(rng, ALPHABETS["cc"], 10),
        prose(rng, ALPHABETS["dd"], 10) + "\n" + prose(rng, ALPHABETS["bb"], 20) + " " + prose(rng, ALPHABETS["cc"], 10),
        "",
        "12 - 34",
    ]
    share, words = model.proportions(texts)
    assert list(words) == [30, 40, 40, 0, 0] and model.languages == sorted(ALPHABETS)
    expected = [[1, 0, 0, 0], [0.75, 0, 0.25, 0], [0, 0.5, 0.25, 0.25], [0] * 4, [0] * 4]
    assert np.allclose(share, expected, atol=0.03)
    assert [set(np.flatnonzero(s)) for s in share] == [set(np.flatnonzero(e)) for e in expected]


def test_proportions_equal_plain_expectation_maximisation(model):
    rng = random.Random(3)
    text = prose(rng, ALPHABETS["aa"], 12) + " " + prose(rng, ALPHABETS["bb"], 9)
    logs = []
    for word in text.split():
        padded = [0, *map(ord, word), 0]
        keys = [(a << 42 | b << 21 | c) * 0x9E3779B97F4A7C15 % (1 << 64) >> 48 for a, b, c in zip(padded, padded[1:], padded[2:])]
        logs.append(model.table[:2, keys].astype(float).sum(axis=1))
    logs, share = np.array(logs), np.array([0.5, 0.5])
    for _ in range(model.rounds):
        chance = share * np.exp(logs)
        share = (chance / chance.sum(axis=1, keepdims=True)).mean(axis=0)
    assert np.allclose(model.proportions([text])[0][0], [*share, 0, 0])


def test_texts_looked_at_together_do_not_matter(model):
    rng = random.Random(4)
    texts = [prose(rng, ALPHABETS[rng.choice("abcd") * 2], rng.randint(0, 40)) for _ in range(30)] + ["x" * 70_000]
    together, _ = model.proportions(texts)
    assert np.allclose(together, np.concatenate([model.proportions([t])[0] for t in texts]))


def test_odd_rows(odd, empty, model):
    found = languages.identify(odd, model).collect()
    assert len(found) == odd.count()
    kinds = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found if r["doc_id"] is not None}
    assert kinds[4] == kinds[5] == kinds[6] == ("und", 0.0) and all(0 <= r["score"] <= 1 for r in found)
    assert languages.identify(empty, model).count() == 0
    unlearned = languages.language_id(odd)  # no row has a language
    assert {r["lang_pred"] for r in unlearned.collect()} == {"und"} and unlearned.count() == odd.count()
    assert languages.language_id(empty).count() == 0


def test_held_out_labels_do_not_matter(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    wrong = docs.selectExpr("doc_id", "text", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 'zz', lang) as lang")
    a, b = (languages.learn(d.where(~languages.held_out("doc_id"))) for d in (docs, wrong))
    assert a.languages == b.languages and np.array_equal(a.table, b.table)


def test_too_many_labels_are_refused(spark):
    with pytest.raises(ValueError):
        languages.learn(spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "lang string, text string"), most_languages=2)
