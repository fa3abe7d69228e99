"""Word and byte windows that repeat, against direct counting."""

import hashlib
import random

import numpy as np
import pandas as pd
import pytest

from stockweave.llm import repeats, substring_dedup, suffix_dedup


def bytes_brute(rows):
    first = {}
    for i, text in rows:
        data = (text or "").encode()
        for s in range(len(data) - 99 if i is not None else 0):
            w = data[s : s + 100]
            first[w] = min(first.get(w, (i, s)), (i, s))
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - 99 if i is not None else 0):
            if first[data[s : s + 100]] < (i, s):
                gone[s : s + 100] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((str(i), len(data), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out)


def words_brute(rows):
    first = {}
    for i, text in rows:
        words = (text or "").encode().split()
        for s in range(len(words) - 49 if i is not None else 0):
            w = tuple(words[s : s + 50])
            first[w] = min(first.get(w, i), i)
    out = []
    for i, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for s in range(len(words) - 49 if i is not None else 0):
            if first[tuple(words[s : s + 50])] < i:
                gone.update(range(s, s + 50))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((str(i), len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.fixture(scope="module")
def rows(odd_rows):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    line = "Licensed under these terms and some more words that are common to all of the documents here today. "
    base = prose(300)
    more = [(1000 + k, prose(rng.randint(0, 60)) + " " + line + prose(rng.randint(0, 90))) for k in range(200)]
    more += [(2000 + k, base[: rng.randint(0, 900)] + prose(3) + base[rng.randint(0, 900) :]) for k in range(40)]
    more += [(3000, "x " * 300), (3001, "x " * 200 + "y " * 99), (3002, (prose(60) + "\n") * 3)]
    return [r for r in odd_rows if r[0] != 13] + more


def test_bytes_against_brute_force(spark, rows):
    out = suffix_dedup.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    got = sorted((str(r["doc_id"]), r["n"], r["n_removed"], len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in out.collect())
    assert got == bytes_brute(rows)


def test_words_against_brute_force(spark, rows):
    out = substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    got = sorted((str(r["doc_id"]), r["n"], r["n_removed"], hashlib.sha256(r["kept"]).hexdigest()) for r in out.collect())
    assert got == words_brute(rows)


def test_clashing_columns_and_empty_tables(odd, empty):
    assert substring_dedup.substring_dedup(odd).count() == odd.count()
    assert substring_dedup.substring_dedup(empty).count() == 0
    assert suffix_dedup.suffix_dedup(empty).count() == 0


def test_bucket_pointers_tell_equal_strings():
    rng = np.random.default_rng(1)
    text = np.concatenate([rng.integers(97, 99, 400), np.tile([97, 98, 99], 80), np.full(150, 97)]).astype(np.uint8)
    pointer = suffix_dedup.bucket_pointers(text, 100)
    padded = text.tobytes() + bytes(100)
    strings = [padded[i : i + 100] for i in range(len(text) - 100)]
    assert [pointer[: len(strings)][i] for i in np.argsort(strings, kind="stable")] == sorted(pointer[: len(strings)])
    assert len(set(strings)) == len(set(pointer[: len(strings)].tolist()))


def test_matching_statistics_of_streams_that_are_not_indexed():
    rng = np.random.default_rng(2)
    text = np.r_[rng.integers(2, 5, 400), 1]
    index = substring_dedup.FMIndex(text, 6, np.arange(401) // 40)
    stream = np.r_[rng.integers(2, 5, 120), 9, text[100:160], rng.integers(2, 5, 60)]
    least = index.least_owners(stream, np.array([0]), np.array([len(stream)]))
    places = {}
    for s in range(395):
        places.setdefault(tuple(text[s : s + 6]), s // 40)
    for s in range(len(stream) - 5):
        assert least[s] == places.get(tuple(stream[s : s + 6]), -1)


def test_hot_keys_are_split_without_loss(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(6))
    line = " ".join(word() for _ in range(40))
    rows = [(k, f"{' '.join(word() for _ in range(20))} {line} {' '.join(word() for _ in range(20))}") for k in range(300)]
    rows += [(1000 + k, t[30:]) for k, (_, t) in enumerate(rows[:100])]
    out = substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((str(r["doc_id"]), r["n"], r["n_removed"], hashlib.sha256(r["kept"]).hexdigest()) for r in out.collect())
    assert got == words_brute(rows)


def test_stretches():
    flags = np.array([1, 1, 0, 1, 1], bool)
    cell = pd.DataFrame({"digest": [b"a", b"b"]})
    out = repeats.result(cell, flags, np.array([0, 0, 0, 0, 1]), np.array([0, 1, 2, 3, 0]))
    assert out.values.tolist() == [[b"a", 0, 2], [b"a", 3, 1], [b"b", 0, 1]]
