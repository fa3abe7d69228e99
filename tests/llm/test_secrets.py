"""Secret scan: fixed patterns against Python's, Markov spans on planted strings, redaction."""

import hashlib
import random
import re
import string

from stockweave.llm import secret_scan

KEYS = "|".join("".join(f"[{c.upper()}{c}]" for c in w) for w in ("password", "passwd", "secret", "token"))
ASSIGN = re.compile(rf"""({KEYS}|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def test_base_spans_equal_brute_force(spark, odd, odd_rows):
    rng = random.Random(2)
    bits = ["token", "Secret", "=", ":", " ", '"', "'", "AKIA", "api_key", "APIKEY", "abcdef0123456789", "XYZ12345", "é🙂", "-", "passwd"]
    more = [(100 + k, "".join(rng.choice(bits) for _ in range(rng.randint(0, 30)))) for k in range(400)]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = sorted((str(r["doc_id"]), r["base_sha256"], r["n_assign"], r["n_access"], r["n_hex"]) for r in secret_scan.scan(docs).collect())
    expected = []
    for i, text in odd_rows + more:
        spans = base_spans(text)
        joined = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        counts = [sum(k == kind for _, k, _ in spans) for kind in range(3)]
        expected.append((str(i), hashlib.sha256(joined.encode()).hexdigest(), *counts))
    assert got == sorted(expected)


def test_markov_adds_random_tokens_and_leaves_ordinary_ones(spark):
    rng = random.Random(4)
    parts = ["con", "ver", "sion", "table", "hand", "ler", "pro", "cess", "ing", "inter", "national", "data", "model", "est"]
    name = lambda: "".join(rng.choice(parts) for _ in range(5)) + rng.choice(["", "_v2", "2024"])
    ordinary = [(k, " ".join(name() for _ in range(30))) for k in range(200)]
    key = lambda: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(32)) + "7q"
    planted = [(1000 + k, f"the {key()} here") for k in range(50)]
    rows = secret_scan.scan(spark.createDataFrame(ordinary + planted, "doc_id long, text string")).collect()
    found = {r["doc_id"]: r["n_markov"] for r in rows}
    assert sum(found[i] for i, _ in planted) >= 48
    assert sum(found[i] > 0 for i, _ in ordinary) == 0


def test_redaction_keeps_columns_and_the_rest_of_the_text(odd, empty):
    out = secret_scan.redact(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    row = out.where("doc_id = 12").first()
    assert row["text"] == 'x [SECRET]" [SECRET] [SECRET]' and row["n_chars"] == len(row["text"])
    assert out.where("doc_id = 1").first()["text"] == odd.where("doc_id = 1").first()["text"]
    assert secret_scan.redact(empty).count() == 0 and secret_scan.scan(empty).count() == 0


def test_scores_do_not_move_with_the_number_of_tokens(spark):
    """Names with digits stay under the threshold, and keys above it, whatever the corpus' size."""
    rng = random.Random(5)
    parts = ["customer", "record", "window", "enter", "prise", "vaccin", "ation", "covid", "invoice", "summary", "data", "set", "line", "view"]
    names = ["customer_record_v2", "windows10-enterprise", "covid19vaccination", "invoice2024summary", "dataset_2019-view2"]
    keys = ["".join(rng.choice(string.ascii_letters + string.digits) for _ in range(28)) + "a1" for _ in range(20)]

    def scores(count):
        made = {"".join(rng.choice(parts) for _ in range(rng.randint(3, 6))) + rng.choice(["", "", "2", "_v3", "19"]) for _ in range(count)}
        docs = spark.createDataFrame([(" ".join(made),)], "text string")
        ratios, threshold = secret_scan.train(docs)
        asked = spark.createDataFrame([(x,) for x in names + keys], "t string")
        found = {r["t"]: r["s"] for r in asked.selectExpr("t", secret_scan._best("t", ratios) + " as s").collect()}
        assert all(found[x] < threshold for x in names) and sum(found[x] >= threshold for x in keys) >= 17
        return found

    few, many = scores(2_000), scores(100_000)
    assert max(abs(few[x] - many[x]) for x in names) < 3
