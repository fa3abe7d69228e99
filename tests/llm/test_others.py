"""Top-k, decontamination, pages, toxicity, and the pipeline."""

import random

import numpy as np
import pytest

import corpus_pipeline
from stockweave.llm import decontaminate, html_text, impact_topk, toxicity
from stockweave.llm.queries import QUERIES


def test_topk_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(0, 0.3, (700, 12))
    vectors[50:60] = vectors[0]  # ties
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(5000, None), (5050, [float("nan")] * 12), (5100, [None] * 12), (5150, [float("inf")] + [0.0] * 11), (650, rows[650][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    table = impact_topk.quantised(df, "vec_id", "embedding", 256.0)
    out = impact_topk.top_k(table, table.where("id % 50 = 0"), shard_rows=100, block_rows=5).collect()
    matrix = np.floor(256 * vectors).astype(np.int64)
    expected = set()
    for q in range(0, 700, 50):
        scores = matrix @ matrix[q]
        order = [i for i in np.lexsort((np.arange(700), -scores)) if i != q][:5]
        expected |= {(q, k + 1, int(i), int(scores[i])) for k, i in enumerate(order)}
    assert {tuple(r) for r in out} == expected and len(out) == len(expected)
    none = table.where("false")
    assert impact_topk.top_k(none, none).count() == 0
    few = table.where("id < 3")
    assert impact_topk.top_k(few, few.where("id = 0")).count() == 2


def test_distance_equals_the_full_table():
    def full(item, text):
        last = [0] * (len(text) + 1)
        for i, x in enumerate(item, 1):
            row = [i]
            for j, y in enumerate(text, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
            last = row
        return min(last)

    rng = random.Random(1)
    for _ in range(300):
        item = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 70))]
        text = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 90))]
        assert decontaminate.distance(item, text) == full(item, text)


def test_planted_items_are_found_and_clean_texts_left(spark, odd, empty):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
    prose = lambda n: [rng.choice(words) for _ in range(n)]
    items = [prose(rng.randint(10, 60)) for _ in range(60)]
    rows, expected = [], set()
    for k in range(600):
        item = rng.randrange(60)
        part, edits = list(items[item]), rng.randint(0, len(items[item]) // 8)
        for _ in range(edits):
            part[rng.randrange(len(part))] = "other"
        rows.append((k, " ".join(prose(rng.randint(0, 80))) + " " + ", ".join(part).upper() + ". " + " ".join(prose(rng.randint(0, 80)))))
        expected.add((k, item))
    rows += [(1000 + k, " ".join(prose(150))) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)] + [(99, None), (98, ""), (97, "abc")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()}
    assert len(found & expected) >= 0.97 * len(expected) and not {d for d, _ in found if d >= 1000}
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench, block_chars=5000).collect()} == found
    assert decontaminate.leaks(odd, bench).count() == 0 and decontaminate.leaks(empty, bench).count() == 0
    assert decontaminate.leaks(docs, bench.where("false")).count() == 0


PAGE = """<html><head><title>T</title><script>if(a<b){"</p>"}</script></head><body class="has-sidebar"><div id="top-nav"><a href="/">Home</a>
</div><div class="wrap"><div class="cookie-notice">We use cookies</div><div class="c%d post"><h1>Head &amp; title</h1><div class="txt"><p>One
<b>bo</b>ld&nbsp;text<br>more %d<p>Second para with <a href="x">link</a> inside<div class="ad-slot">Buy!</div></div></div>
<div class="sidebar"><ul><li>x</li></ul></div><section id="comments"><p>nice post, a very long comment by a reader</p></section></div>
<form><input><p>Subscribe</p></form><footer>(c)</footer></body></html>"""


def test_pages(spark):
    rows = [(k, "http://H.example/%d" % k, PAGE % (k, k)) for k in range(30)]
    rows += [(100, None, None), (101, "x", ""), (102, "http://b/", "plain &lt; text"), (103, "http://b/", "<article>cut <p>of")]
    rows += [(104, "http://c/", "<form><p>all in a form</form>"), (0, rows[0][1], rows[0][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as id", "3 as text", "4 as paths")
    for hosts in (50_000, 0):
        out = html_text.main_text(df, broadcast_hosts=hosts).collect()
        text = {r["page_id"]: r["text"] for r in out}
        assert len(out) == len(rows)
        assert all(text[k] == f"Head & title One bold text more {k} Second para with link inside" for k in range(30))
        assert text[100] == text[101] == "" and text[102] == "plain < text" and text[103] == "cut of" and text[104] == "all in a form"
    assert html_text.main_text(df.where("false")).count() == 0


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(2000)]
    rows, labels = [], []
    for k in range(900):
        toxic = k % 6 == 0
        text = [rng.choice(words) for _ in range(rng.randint(20, 80))]
        for _ in range(3 * toxic):
            text[rng.randrange(len(text))] = rng.choice(["zorgan", "zorgest", "zorgin", "quexo"])
        rows.append((k, " ".join(text)))
        labels.append((k, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_on_held_out_rows(labelled):
    docs, labels = labelled
    out = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert 200 < len(out) < 400
    assert (out["predicted"] == out["toxic"]).mean() > 0.98


def test_toxicity_without_labels_or_rows(odd, empty, labelled):
    _, labels = labelled
    rows = toxicity.toxicity(odd, labels.where("false")).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    score = {r["doc_id"]: r["score"] for r in rows}
    assert score[15] > score[1]
    assert toxicity.toxicity(empty, labels).count() == 0


def test_held_out_labels_do_not_matter(labelled):
    docs, labels = labelled
    import zlib

    wrong = labels.toPandas()
    out = wrong["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)
    wrong.loc[out, "toxic"] = 1 - wrong.loc[out, "toxic"]
    a, b = toxicity.learn(docs, labels), toxicity.learn(docs, docs.sparkSession.createDataFrame(wrong))
    assert a.voters == b.voters and np.allclose(a.weights, b.weights)


def test_pipeline_stages_on_odd_rows(spark, odd, empty, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([(15, 1), (1, 0)], "doc_id long, toxic int").write.parquet(f"{root}/labels.parquet")
    item = " ".join(odd.where("doc_id = 9").first()["text"].split()[100:130])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, root), name)
        assert docs.columns == odd.columns
    ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
    assert 9 not in ids and 2 not in ids and 3 not in ids and ids.count(14) == 0 and {1, 4, 5, 7, 10, 12, None} <= set(ids)
    assert "[SECRET]" in docs.where("doc_id = 12").first()["text"]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, root).count() == len(ids)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, root).count() == 0


def test_pipeline_runs_and_each_stage_takes_effect(spark, small):
    out = corpus_pipeline.run(spark, small)
    total = spark.read.parquet(f"{small}/documents.parquet").count()
    assert 0.5 * total < out.count() < total


def test_query_names():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]
