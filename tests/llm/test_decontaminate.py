"""Edited benchmark items next to, inside and in lists with each other; short items."""

import random

import numpy as np
import pytest

from stockweave.llm import decontaminate

LIMITS = decontaminate.Limits()


def edited(rng, item, edits, fresh):
    """The item with so many word edits of all kinds."""
    out = list(item)
    for _ in range(edits):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        out[at : at + (kind != 0)] = [] if kind == 2 else [next(fresh)]
    return out


def test_edited_items_are_found_whatever_stands_around_them(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(2000)]
    fresh = (f"new{i}" for i in range(10**6))
    items = [[rng.choice(words) for _ in range(n)] for n in [*range(8, 60), *[30] * 28]]
    items.append(items[22] + items[40] + items[3])  # other items nested
    rows, expected = [], set()
    # the case of the review: substitutions in the first half of A and the second half of B
    a, b = list(items[52]), list(items[53])
    a[3], a[9], b[18], b[25] = "x1", "x2", "x3", "x4"
    rows.append((0, a + b))
    expected |= {(0, 52), (0, 53)}
    for k in range(1, 300):
        chosen = rng.sample(range(80), rng.choice([1, 2, 3, 12]))  # alone, adjacent, lists
        text = [rng.choice(words) for _ in range(rng.randrange(30))]
        for i in chosen:
            text += edited(rng, items[i], rng.randint(0, len(items[i]) // 5), fresh)
        rows.append((k, text + [rng.choice(words) for _ in range(rng.randrange(30))]))
        expected |= {(k, i) for i in chosen}
    for k in range(300, 330):
        rows.append((k, edited(rng, items[80], 10, fresh)))
        expected.add((k, 80))
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in rows], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    out = {(r["doc_id"], r["item_id"]): r["edits"] for r in decontaminate.leaks(docs, bench).collect()}
    encoded = [[w.encode() for w in x] for x in items]
    exact = {
        (k, i): d
        for k, t in rows
        for i, x in enumerate(encoded)
        if (d := decontaminate.distance(x, [w.encode() for w in t])) <= LIMITS.allowed(len(x))
    }
    # nothing wrong is found, and of what comparing all pairs finds hardly anything is missed
    assert expected <= set(exact) and set(out.items()) <= set(exact.items())
    assert len(out) >= 0.99 * len(exact)
    worst = {x for x, d in exact.items() if d == LIMITS.allowed(len(items[x[1]]))}
    assert len(worst) > 50 and len(worst & set(out)) >= 0.97 * len(worst)


@pytest.mark.parametrize("n", [8, 13, 24, 60])
def test_embedding_brings_near_sequences_together(n):
    rng = np.random.default_rng(n)
    words = rng.integers(1, 1 << 62, (200, n)).astype(np.uint64)
    near = words.copy()
    near[np.arange(200), rng.integers(0, n, 200)] += np.uint64(1)  # one word replaced
    far = rng.integers(1, 1 << 62, (200, n)).astype(np.uint64)
    apart = lambda a, b: (decontaminate.embed(a, 1) != decontaminate.embed(b, 1)).mean()
    assert apart(words, words) == 0 and apart(words, near) < 0.5 < 0.9 < apart(words, far)
    agree = lambda a, b: (decontaminate.table_keys(a) == decontaminate.table_keys(b)).any(axis=1).mean()
    assert agree(words, near) > 0.95 and agree(words, far) < 0.3


def test_short_items_and_limits(spark):
    items = [(1, "alpha beta"), (2, "one two three four five"), (3, "Uno, dos: tres cuatro cinco seis"), (4, ""), (5, None), (6, "a " * 9)]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as id", "2 as doc_id", "3 as edits")
    rows = [
        (1, "x ALPHA, beta y"), (2, "one two three four five six"), (3, "one two three for five"), (4, "uno dos tres cuatro cinco seis"),
        (5, None), (None, "see one two three four five"), (6, "alphabeta"), (7, "a a a a a a a a a a a"), (8, "one two three\nfour five"), (8, "alpha"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as item_id", "3 as item", "'t' as found")
    found = lambda **k: sorted((r["doc_id"] or -1, r["item_id"], r["edits"]) for r in decontaminate.leaks(docs, bench, **k).collect())
    assert found() == [(-1, 2, 0), (2, 2, 0), (4, 3, 0), (7, 6, 0), (8, 2, 0)]
    assert found(limits=decontaminate.Limits(least_words=1)) == [(-1, 2, 0), (1, 1, 0), (2, 2, 0), (4, 3, 0), (7, 6, 0), (8, 2, 0)]
    assert found(block_chars=10) == found()
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"] or "") for r in kept.collect()) == [
        (1, rows[0][1]), (3, rows[2][1]), (5, ""), (6, "alphabeta"), (8, "alpha")
    ]
    assert decontaminate.clean(docs, bench.where("false")).count() == len(rows)


def test_the_index_of_items_is_small_whatever_their_lengths():
    import tracemalloc

    texts = [" ".join(f"w{n}x{i}" for i in range(n)).encode() for n in range(8, 60)]
    tracemalloc.start()
    items = decontaminate.Items(list(range(len(texts))), texts, LIMITS)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(items.tables) == 52 and held < 20_000_000
