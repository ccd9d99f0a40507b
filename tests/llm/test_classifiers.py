"""Language ID and toxicity, against held-out labels and edge rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import language, toxicity
from tests.llm import cases

LARGER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("classes", [2, 3, 4, 5, 6, 12, 40])
def test_codewords_correct_errors(classes):
    code = language.codewords(classes)
    distance = (code.shape[1] - code @ code.T) / 2 + code.shape[1] * np.eye(classes)
    assert distance.min() >= (1 if classes == 2 else 2)
    assert (np.abs(code.sum(0)) < classes).all()


def test_long_texts_count_in_parts(monkeypatch):
    text = "Élan vital, ÄÖ; " * 40
    whole = language.gram_counts(text)
    monkeypatch.setattr(language, "_PIECE", len(text))
    assert np.array_equal(language.gram_counts(text), whole)
    assert whole.sum() > 0 and language.gram_counts("123 !!").sum() == 0


def test_language_of_held_out_documents(spark):
    found = language.op5_language_id(spark, LARGER)
    lang = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", F.col("lang").alias("truth"))
    rows = found.join(lang, "doc_id").where("held_out").collect()
    assert len(rows) > 250 and sum(r.lang_pred == r.truth for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    again = {r.doc_id: r.score for r in language.op5_language_id(spark, LARGER).collect()}
    assert all(again[r.doc_id] == pytest.approx(r.score, abs=1e-6) for r in rows)


def test_language_edges(spark):
    docs = cases.edge_documents(spark)
    model = language.fit(docs)
    assert model.languages == ["aa", "bb"]
    rows = language.identify(docs, model).collect()
    assert len(rows) == len(cases.rows())
    for r in rows:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score, r.ambiguous) == ("und", 0.0, False)
        else:
            assert r.lang_pred in ("aa", "bb") and 0 < r.score <= 1
    kept = language.accepted(docs, model)
    assert kept.columns == docs.columns
    assert all(any(c.isalpha() for c in r.text) for r in kept.collect())


def test_language_without_labels(spark):
    unlabelled = cases.edge_documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in language.identify(unlabelled, language.fit(unlabelled)).collect()} == {("und", 0.0)}
    one = unlabelled.withColumn("lang", F.lit("aa"))
    assert {r.lang_pred for r in language.identify(one, language.fit(one)).collect()} == {"aa", "und"}
    empty = cases.no_documents(spark)
    assert language.identify(empty, language.fit(empty)).count() == 0
    assert language.identify(cases.null_documents(spark), language.fit(empty)).count() == 3


def bags(n, seed=0):
    random = np.random.default_rng(seed)
    out, labels = [], []
    for i in range(n):
        sentences = [{f"w{random.integers(50)}" for _ in range(6)} for _ in range(8)]
        if i % 3 == 0:
            sentences[random.integers(8)].add("bad" if i % 2 else "worse")
        out.append(sentences)
        labels.append(int(i % 3 == 0))
    return out, np.array(labels)


def test_offending_sentences_are_located_from_document_labels():
    model = toxicity.train(*bags(300))
    assert {"bad", "worse"} <= {*model.weights}
    text = "w1 w2 w3. Then BAD w4! w5 w6\nw7 worse? w8"
    score, found = model.scores(text)
    assert score > 0.9
    assert [text[a:b].strip() for a, b, _ in found] == ["Then BAD w4", "w7 worse"]
    assert model.scores("w1 w2. w3 badly")[0] < 0.05
    assert model.scores("w1. " * 50_000)[0] < 0.05


def test_toxicity_of_held_out_documents(spark):
    large = "/root/testdata/sf0.1"
    found = toxicity.op4_toxicity(spark, large)
    rows = found.join(spark.read.parquet(f"{large}/labels.parquet"), "doc_id").where("held_out").collect()
    hits = [r.predicted for r in rows if r.toxic == 1]
    alarms = [r.predicted for r in rows if r.toxic == 0]
    assert sum(hits) >= 0.85 * len(hits) and sum(alarms) <= 0.01 * len(alarms)
    assert all(r.predicted == int(r.score >= toxicity.THRESHOLD) and 0 <= r.score <= 1 for r in rows)


def test_toxicity_edges(spark):
    docs = cases.edge_documents(spark)
    schema = "doc_id long, toxic int, quality int"
    labels = spark.createDataFrame([(0, 1, 1), (0, 0, 1), (7, 0, None), (None, 1, 1), (4, 1, 0), (99, 1, 1)], schema)
    for known in (labels, spark.createDataFrame([], schema), labels.where("toxic = 1"), labels.where("toxic = 0")):
        model = toxicity.fit(docs, known)
        rows = toxicity.score_documents(docs, model).collect()
        assert len(rows) == len(cases.rows()) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score_documents(cases.no_documents(spark), model).count() == 0
    assert {r.score for r in toxicity.score_documents(cases.null_documents(spark), toxicity.ToxicityModel()).collect()} == {0.0}
    one = toxicity.train([[{"a"}]], np.array([1]))
    assert one.scores("anything")[0] == 1.0 and one.scores(None)[0] == 1.0
