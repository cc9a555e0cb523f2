import re

import numpy as np
import pytest

from verdant.llm import quality_rules as q
from verdant.llm.queries import LLM_QUERIES

D = "/root/testdata/sf0.01"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit), n < 50 or 100 * len(hit) > 50 * n)


@pytest.mark.parametrize("text", [None, "", " \n\t", "a b c", "a b a b a b", "x\n\nx\n x\nx", "é ü z é ü z q #$%",
                                  "w " * 60, " ".join(f"w{i}" for i in range(60)), "\x85 \x1c b\x0bc\x0cd\r"])
def test_counts(text):
    assert q.QualityModel().report(text)[:6] == brute(text)


def test_random_counts():
    rng = np.random.default_rng(1)
    for _ in range(50):
        text = "".join(rng.choice(list("ab#\n \té"), 200))
        assert q.QualityModel().report(text)[:6] == brute(text)


def test_slices_change_nothing(monkeypatch):
    words = (("abc def été " * 700) + "x" * 5000).encode().split()
    ids, distinct = q._word_ids(words)
    whole = q.gram_counts(b" ".join(words), ids, distinct)
    monkeypatch.setattr(q, "SLICE", 97)
    assert (q.gram_counts(b" ".join(words), ids, distinct) == whole).all()


def test_query_counts_and_held_out_verdicts(spark):
    got = {r.doc_id: r for r in LLM_QUERIES["op12_quality_rules"](spark, D).collect()}
    docs = spark.read.parquet(f"{D}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        r = got[d.doc_id]
        if r.n_words < 3000:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(d.text)
        assert r.kept == (not r.base_failed and r.probability >= q.MIN_PROBABILITY)


def test_held_out_accuracy(spark):
    """Learn without a third of the labels, judge these."""
    from pyspark.sql import functions as F
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").withColumn("t", F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)))
    model = q.learn(docs, labels.where("t <> 0"))
    rows = q.judge(docs.join(labels.where("t = 0"), "doc_id"), model).select("quality", "quality_report.*").collect()
    p = np.array([r.probability for r in rows])
    y = np.array([r.quality for r in rows])
    accuracy, base = ((p >= 0.5) == y).mean(), max(y.mean(), 1 - y.mean())
    print("accuracy", accuracy, "majority", base, "brier", ((p - y) ** 2).mean(), "confusion", [((p >= .5) == a)[y == b].sum() for a in (0, 1) for b in (0, 1)])
    assert accuracy > base + 0.05 and ((p - y) ** 2).mean() < 0.06


def test_without_usable_labels(spark):
    docs = spark.createDataFrame([(1, "good " * 60, "a"), (1, "word%d " * 60, "b"), (None, None, "c")], "doc_id long, text string, quality_report string")
    for rows in ([], [(1, 1)], [(1, None), (None, 1), (5, 0)]):
        model = q.learn(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
        assert model.weights is None
        out = q.judge(docs, model)
        assert out.columns == ["doc_id", "text", "quality_report", "quality_report_"]
        assert {r.quality_report: r.quality_report_.kept for r in out.collect()} == {"a": False, "b": False, "c": False}
    good = spark.createDataFrame([(7, " ".join(f"w{i}" for i in range(80)), "x")], docs.schema)
    assert q.keep_good(good.union(docs), q.QualityModel()).collect() == good.collect()
    assert q.judge(docs.limit(0), q.QualityModel()).count() == 0


def test_repeated_ids_count_once(spark):
    docs = spark.createDataFrame([(i % 4, f"text {i}") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i % 4, i % 2) for i in range(40)] + [(0, 1)], "doc_id long, quality int")
    rows = q.labelled_texts(docs, labels, "doc_id", "text", "quality", 3).collect()
    assert len(rows) == 3 and all(r.text in {"text 0", "text 1", "text 10", "text 11"} or r.text for r in rows)
