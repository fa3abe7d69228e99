"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from stockweave.llm import hashing, spellings


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, shortest=6, least=5, factor=5, drop_every=199):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % drop_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= shortest and c >= least}
    near = {w: [v for v in n if is_near(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    syllables = ["an", "er", "ti", "on", "sch", "é", "ü", "ou", "th"]
    vocabulary = ["".join(rng.choice(syllables) for _ in range(rng.randint(2, 5))) for _ in range(120)]
    rows = []
    for k in range(300):
        words = [vocabulary[int(rng.paretovariate(0.7)) % 120] for _ in range(rng.randint(0, 60))]
        for i in range(len(words)):
            if rng.random() < 0.1 and words[i]:
                at = rng.randrange(len(words[i]))
                words[i] = words[i][:at] + rng.choice(["", "x", words[i][at] * 2]) + words[i][at + 1 :]
        rows.append((k, rng.choice([" ", ", ", "-1-", "×", "ł"]).join(w.upper() if rng.random() < 0.1 else w for w in words)))
    return rows + [(None, "Etwas etwas etwas"), (1000, None), (1001, ""), rows[3], rows[3], (1002, "langeswort " * 20_000)]


def test_variants_equal_brute_force(spark, rows, monkeypatch):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    df = df.selectExpr("*", "1 as n", "'x' as word", "'y' as id", "2 as cell", "3 as side", "'f' as form", "4 as root")
    expected = brute(rows)
    assert any(r[1] for r in expected) and any(r[1] and r[2] != r[1] for r in brute(rows, factor=2))
    assert {tuple(r) for r in spellings.variants(df).collect()} == expected
    assert {tuple(r) for r in spellings.variants(df, factor=2, drop_every=3, least=2).collect()} == brute(rows, 6, 2, 2, 3)
    monkeypatch.setattr(spellings, "PART", 2)  # many parts of a cell
    assert {tuple(r) for r in spellings.variants(df, shortest=3).collect()} == brute(rows, 3)


def test_odd_and_empty_tables(odd, odd_rows, empty):
    assert {tuple(r) for r in spellings.variants(odd, least=2).collect()} == brute(odd_rows, least=2)
    assert spellings.variants(empty).count() == 0


def test_checksums_equal_the_library():
    rng = random.Random(4)
    words = [bytes(rng.choice(b"abc\xc3\xa9xyz") for _ in range(rng.randint(1, 30))) for _ in range(200)]
    data = np.frombuffer(b"".join(words), np.uint8)
    edges = np.cumsum([0, *map(len, words)])
    seeds = np.array([zlib.crc32(f"{k}:".encode()) for k in range(200)], np.uint32)
    found = spellings._checksums(data, edges[:-1], edges[1:], seeds)
    assert list(found) == [zlib.crc32(f"{k}:".encode() + w) for k, w in enumerate(words)]


def test_runs_stop_at_other_letters():
    text = "Abc×é÷ ĀbÁłz ﬁ  É"
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = spellings.letter_runs(data, np.array([0, len(data)]))
    assert [data[a:b].tobytes().decode() for a, b in zip(starts, ends)] == re.findall("[A-Za-zÀ-ÿ]+", text)
    assert hashing.LOWER[ord("A")] == ord("a")


def test_one_edit_equals_brute_force():
    rng = random.Random(6)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(120)]
    letters, length = spellings._matrix(words)
    i, j = np.meshgrid(range(120), range(120))
    i, j = i.ravel(), j.ravel()
    found = spellings.one_edit(letters[i], length[i], letters[j], length[j])
    assert list(found) == [is_near(words[a], words[b]) for a, b in zip(i, j)]
