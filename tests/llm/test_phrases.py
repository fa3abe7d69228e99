"""Count transducers and collocations against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from stockweave.llm import phrases, transducers


def shard(rng, n, words):
    grams = Counter()
    for _ in range(n):
        path = tuple(rng.choice(words) for _ in range(rng.randint(1, 4)))
        grams[path] += rng.randint(1, 3)
    return grams


def automata(grams, ranges, prefix=1):
    sizes = [{g: c for g, c in grams.items() if len(g) == k} for k in range(1, 5)]
    return dict(
        transducers.build(
            [np.array(list(x), np.uint64).reshape(-1, k + 1) for k, x in enumerate(sizes)],
            [np.array(list(x.values()), np.int64) for x in sizes],
            np.array([k * (1 << 64) // ranges for k in range(ranges)], np.uint64),
            prefix,
        )
    )


def read(found):
    return {tuple(map(int, row)): int(n) for matrix, counts in found for row, n in zip(matrix, counts) if n}


@pytest.mark.parametrize("ranges", [1, 5])
def test_union_adds_the_counts_of_the_shards(ranges):
    rng = random.Random(ranges)
    words = [rng.getrandbits(64) for _ in range(12)]
    shards = [shard(rng, 200, words) for _ in range(4)]
    total = sum(shards, Counter())
    built = [automata(s, ranges) for s in shards]
    found = {}
    for part in range(ranges):
        own = [transducers.unpack(transducers.pack(b[part])) for b in built if part in b]
        found |= read(transducers.paths(transducers.union(own), 1)) if own else {}
    assert found == dict(total)


def test_equal_states_are_one():
    grams = {(a, b, c): 2 for a in range(1, 6) for b in range(10, 14) for c in range(20, 23)}
    (layers,) = automata(Counter(grams), 1).values()
    assert [len(layer.first) - 1 for layer in layers] == [1, 1, 1]
    assert read(transducers.paths(transducers.union([layers]), 1)) == grams
    grams[(3, 12, 21)] = 5  # one other count parts its path from the rest
    (layers,) = automata(Counter(grams), 1).values()
    assert [len(layer.first) - 1 for layer in layers] == [1, 2, 2]


def test_composition_gives_the_counts_of_the_parts_that_exist():
    rng = random.Random(3)
    words = [rng.getrandbits(64) for _ in range(8)]
    counts = shard(rng, 400, words)
    wanted = Counter({g: 1 for g in shard(rng, 300, words)})
    (left,), (right,) = automata(counts, 1).values(), automata(wanted, 1).values()
    assert read(transducers.compose(left, right)) == {g: c for g, c in counts.items() if g in wanted}


def brute(rows, least, top):
    f, n = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for m in range(1, 5):
                for i in range(len(words) - m + 1):
                    f[lang, tuple(words[i : i + m])] = f.get((lang, tuple(words[i : i + m])), 0) + 1
    around = Counter()
    for (lang, p), c in f.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                if c >= least:
                    around[lang, p[i : i + m]] = max(around[lang, p[i : i + m]], c)
    out = {}
    for (lang, p), a in f.items():
        if len(p) >= 2 and a >= least and 100 * around[lang, p] < 80 * a:
            score, k = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    }


def test_collocations_equal_brute_force(spark):
    rng = random.Random(5)
    words = ["the", "The", "of", "Zürich", "ß", "new", "york", "a.b", "x"]
    rows = []
    for k in range(120):
        text = rng.choice(["", "New  York\tcity hall", "of the"]) + " "
        text += " ".join(rng.choice(words) + rng.choice(["", "", "", ",", "\n", "!"]) for _ in range(rng.randint(0, 40)))
        rows.append((k, text, rng.choice(["en", "de", None, "und"])))
    rows += [(5, None, "fr"), (6, "", None), rows[0], rows[0], (7, "so long " * 3000, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    df = df.selectExpr("*", "1 as n", "'x' as p", "2 as l1", "3 as label", "4 as part", "5 as rank", "'w' as word")
    for least, top in ((3, 2000), (2, 7)):
        found = phrases.collocations(df, least=least, top=top, words_per_range=50)
        assert {tuple(r) for r in found.collect()} == brute(rows, least, top)
    small = phrases.collocations(df, least=3, most_bits=1 << 17)  # a fuller table changes nothing
    assert {tuple(r) for r in small.collect()} == brute(rows, 3, 2000)


def test_collocations_of_odd_and_empty_tables(odd, odd_rows, empty):
    found = phrases.collocations(odd, least=5)
    assert {tuple(r) for r in found.collect()} == brute([(i, t, None) for i, t in odd_rows], 5, 2000)
    assert phrases.collocations(empty).count() == 0
