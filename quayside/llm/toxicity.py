"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence scores by a logistic model on the
words it holds; the document's score is the noisy-or of its sentences, one minus
the chance that none of them offends. Only document labels are learned from, yet
the fitted sentence scores tell which sentences offend.

Defined results: a null or empty text has no sentence with an offending word and
scores as any text without one. Without labelled rows, or with one class only,
every score is that class (0 without rows). Repeated rows score alike, and labels
that contradict each other for one document are used as given. Texts are read
whole. Other columns are passed through, and ``score``, ``offending`` replace
columns of that name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import free_name, held_out, learnable, sample_per_class

#: Labelled documents that the model is fitted on, per label.
SAMPLE = 2500
#: Documents with more characters are not used for fitting; they are scored like any other.
SAMPLE_CHARS = 20_000
#: A word becomes a feature from this chi-square against the labels on, and from so many documents.
LEAST_CHI_SQUARE, LEAST_DOCUMENTS = 30.0, 5
#: Documents scoring this much are predicted toxic.
THRESHOLD = 0.7
SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")


def terms(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


@dataclass
class ToxicityModel:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -40.0

    def scores(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """The score of a text and its offending sentences as (start, end, score)."""
        if not text or not self.weights:
            return (1.0 if self.bias > 0 else 0.0), []
        found, clean = [], 1.0
        for start, end in self.suspects(text):
            logit = self.bias + sum(self.weights.get(w, 0.0) for w in terms(text[start:end]))
            score = 1 / (1 + np.exp(-min(max(logit, -40.0), 40.0)))
            clean *= 1 - score
            if score >= 0.5:
                found.append((start, end, float(score)))
        return 1 - clean, found

    def suspects(self, text: str) -> Iterator[tuple[int, int]]:
        """Bounds of the sentences that hold a weighted word; a sentence without one does not offend."""
        known = self.weights.keys()
        if known.isdisjoint(terms(text)):
            return
        for sentence in SENTENCE.finditer(text):
            if not known.isdisjoint(terms(sentence[0])):
                yield sentence.span()


def train(bags: list[list[set[str]]], labels: np.ndarray, steps: int = 300) -> ToxicityModel:
    """Choose the telling words by chi-square, then fit their weights by the noisy-or likelihood of the documents."""
    if not len(labels) or labels.min() == labels.max():
        return ToxicityModel({}, 40.0 if len(labels) and labels[0] else -40.0)
    held = [set().union(*bag) for bag in bags]
    total, hits = Counter(), Counter()
    for words, label in zip(held, labels, strict=True):
        total.update(words)
        if label:
            hits.update(words)
    n, positive = len(labels), int(labels.sum())
    vocabulary = []
    for word, count in total.items():
        expected = count * positive / n
        spread = expected * (1 - positive / n) * (1 - count / n)
        if count >= LEAST_DOCUMENTS and spread > 0 and hits[word] > expected:
            if (hits[word] - expected) ** 2 / spread >= LEAST_CHI_SQUARE:
                vocabulary.append(word)
    if not vocabulary:
        return ToxicityModel()
    place = {w: i for i, w in enumerate(sorted(vocabulary))}
    document, sentence, column = [], [], []
    count = 0
    for d, bag in enumerate(bags):
        for words in bag:
            if features := [place[w] for w in words if w in place]:
                document.append(d)
                sentence += [count] * len(features)
                column += features
                count += 1
    document, sentence, column = (np.array(x, np.int64) for x in (document, sentence, column))
    weight, bias = np.full(len(place), 3.0), -3.0
    share = np.where(labels > 0, 0.5 / positive, 0.5 / (n - positive))
    for step in range(steps):
        logit = bias + np.bincount(sentence, weight[column], count)
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        clean = np.exp(np.bincount(document, np.log1p(-np.minimum(p, 1 - 1e-9)), n))
        # of a toxic document: log(1 - clean); of a clean one: log(clean)
        pull = np.where(labels > 0, share * clean / np.maximum(1 - clean, 1e-6), -share)[document] * p
        rate = 20 / (1 + step / 100)
        weight += rate * (np.bincount(column, pull[sentence], len(place)) - 1e-4 * weight)
        bias += rate * (pull.sum() - 1e-4 * bias)
        weight = np.maximum(weight, 0.0)
    return ToxicityModel({w: float(weight[i]) for w, i in place.items()}, float(min(bias, -2.0)))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", identity: str = "doc_id", label: str = "toxic") -> ToxicityModel:
    """Fit on about ``SAMPLE`` documents per label outside the held-out third; sentences are cut by the executors."""
    known = labels.select(F.col(identity).alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = sample_per_class(known.where(learnable() & F.col("label").isin(0, 1)), "label", SAMPLE, "doc_id")
    found = docs.select(F.col(identity).alias("doc_id"), F.col(text).alias("text"))
    found = found.where(learnable() & (F.length("text") <= SAMPLE_CHARS)).join(F.broadcast(known), "doc_id")

    def cut(batches):
        for batch in batches:
            rows = []
            for value in batch.column("text").to_pylist():
                bag = [" ".join(sorted(terms(s))) for s in SENTENCE.findall(value)]
                rows.append([s for s in bag if s])
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(rows, pa.list_(pa.string()))], names=["label", "bag"])

    rows = found.select("label", "text").mapInArrow(cut, "label int, bag array<string>").collect()
    rows.sort(key=lambda r: (r[0], r[1]))
    return train([[set(s.split()) for s in r[1]] for r in rows], np.array([r[0] for r in rows], np.int64))


def toxicity(model: ToxicityModel, text: Column) -> Column:
    """A struct (score, offending: bounds and scores of the offending sentences)."""

    @F.arrow_udf("score double, offending array<struct<start: int, end: int, score: double>>")
    def score(texts: pa.Array) -> pa.Array:
        rows = [model.scores(t.as_py()) for t in texts]
        spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        return pa.StructArray.from_arrays(
            [
                pa.array([float(r[0]) for r in rows], pa.float64()),
                pa.array([[{"start": a, "end": b, "score": p} for a, b, p in r[1]] for r in rows], spans),
            ],
            names=["score", "offending"],
        )

    return score.asNondeterministic()(text)


def score_documents(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """The rows with score and offending."""
    result = free_name(docs, "found")
    found = docs.drop("score", "offending").withColumn(result, toxicity(model, F.col(text)))
    return found.select("*", f"{result}.*").drop(result)


def op4_toxicity(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    found = score_documents(docs.select("doc_id", "text"), model)
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return found.select("doc_id", held_out().alias("held_out"), "score", predicted, "offending")
