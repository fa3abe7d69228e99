"""Near-duplicates against the exact join of sets, components against a union-find."""

import random

import numpy as np

from stockweave.llm import near_dup
from stockweave.llm.components import components


def find(parent, x):
    while parent.setdefault(x, x) != x:
        x = parent[x]
    return x


def brute(rows):
    sets = {}
    for i, text in rows:
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())
    parent, ids = {}, sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(parent, a), find(parent, b)))
                parent[y] = x
    return {i: (len(sets[i]), find(parent, i), find(parent, i) == i) for i in ids}


def corpus():
    rng = random.Random(6)
    words = ["w%d" % k for k in range(2000)]
    rows = []
    for group in range(25):
        base = [rng.choice(words) for _ in range(rng.randint(6, 250))]
        for copy in range(rng.randint(1, 12)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((group * 100 + copy, " ".join(text)))
    return rows


def test_components_equal_the_exact_join(spark):
    rows = corpus()
    out = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r[0]: tuple(r[1:]) for r in out.collect()} == brute(rows)


def test_blocks_of_a_large_bucket(spark):
    rng = random.Random(9)
    base = ["w%d" % k for k in range(120)]
    rows = []
    for k in range(120):
        text = list(base)
        for _ in range(rng.randint(2, 5)):
            text[rng.randrange(len(text))] = "x%d" % rng.randrange(5000)
        rows.append((k, " ".join(text)))
    out = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=16)
    assert {r[0]: tuple(r[1:]) for r in out.collect()} == brute(rows)


def test_odd_rows(odd, empty):
    rows = near_dup.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert by_id[2][0][1:] == (1, False) and by_id[3][0][1:] == (1, False) and by_id[14] == [by_id[14][0]] * 2
    assert by_id[4] == [(0, 4, True)] and by_id[6] == [(0, 6, True)] and by_id[8] == [(1, 7, False)]
    assert all(kept and component is None for _, component, kept in by_id[None])
    assert near_dup.near_duplicates(empty).count() == 0


def test_estimate_is_close():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(60):
        shared, own = rng.integers(0, 2**63, 600, dtype=np.uint64), rng.integers(0, 2**63, 200, dtype=np.uint64)
        sets = [np.unique(np.r_[shared, own[:100]] * np.uint64(2)), np.unique(np.r_[shared, own[100:]] * np.uint64(2))]
        regs = near_dup.registers(sets)
        errors.append(float(near_dup.estimate(regs[0], regs[1], near_dup.chance(700, 700))) - 0.75)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 300)]
    out = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(out) == set(range(201)) | set(range(1000, 1300))
    assert all(c == (0 if i < 1000 else 1000) for i, c in out.items())
