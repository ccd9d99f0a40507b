"""Importance resampling, against brute force."""

import hashlib
import math
import re
import zlib

import pytest

from quayside.llm import importance
from tests.llm import cases

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(run.encode()) % 10_000 for run in runs]


def brute(rows, target):
    source, aim = [0] * 10_000, [0] * 10_000
    for counts, texts in ((source, [t for _, t in rows]), (aim, target)):
        for text in texts:
            for bucket in features(text)[1]:
                counts[bucket] += 1
    s, t = float(sum(source) + 10_000), float(sum(aim) + 10_000)
    gain = [math.floor(1000 * math.log((b + 1) * s / ((a + 1) * t))) for a, b in zip(source, aim, strict=True)]
    found = []
    for key, text in rows:
        n, buckets = features(text)
        weight = sum(gain[b] for b in buckets)
        score = None
        if key is not None:
            h = int(hashlib.sha256(f"42:{key}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append([key, n, len(buckets), weight, score, None])
    open_ = sorted((f for f in found if f[1] >= 20 and f[0] is not None), key=lambda f: (-f[4], f[0]))
    for place, row in enumerate(open_[: 5 * len(open_) // 100], 1):
        row[5] = place
    return sorted(map(tuple, found), key=repr)


def check(spark, rows, target):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = importance.resampled(docs, spark.createDataFrame([(t,) for t in target], "text string"))
    assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    found = sorted((tuple(r) for r in found.collect()), key=repr)
    assert found == brute(rows, target)
    return found


def test_documents(spark):
    rows = [(r.doc_id, r.text) for r in cases.documents(spark).collect()]
    target = [r.text for r in spark.read.parquet(f"{cases.TABLES}/benchmark.parquet").collect()]
    found = check(spark, rows, target)
    assert max(r[5] or 0 for r in found) == 5 * sum(r[1] >= 20 for r in found) // 100 > 5
    query = importance.op12_importance_resampling(spark, cases.TABLES)
    assert sorted((tuple(r) for r in query.collect()), key=repr) == sorted(((r[0], *r[2:]) for r in found), key=repr)


def test_edge_documents(spark):
    rows = [(r.doc_id, r.text) for r in cases.edge_documents(spark).collect()]
    check(spark, rows, ["one two", None, "", rows[0][1]])
    check(spark, rows, [])


def test_text_of_the_documents_is_bytes():
    for text in cases.texts() + ["A-b_c9É\x7f\x80İ", "ÀB ÇD"]:
        n, buckets = importance.feature_buckets(None if text is None else text.encode())
        assert (n, sorted(buckets.tolist())) == (features(text)[0], sorted(features(text)[1]))


def test_extra_columns_and_empty_table(spark):
    target = spark.createDataFrame([("a",)], "text string")
    assert importance.resampled(spark.createDataFrame([], cases.TEXT_SCHEMA), target).collect() == []


def scores(spark, pairs):
    rows = [(key, 20, 1, 0, score) for key, score in pairs]
    return spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long")


@pytest.mark.parametrize("percent", [1, 5, 50, 100])
def test_ties_at_the_cutoff_go_to_smaller_ids(spark, percent):
    pairs = [(i * 37 % 400, (i * 37 % 400) % 3 - 5) for i in range(400)]
    found = importance.drawn(scores(spark, pairs), percent).collect()
    best = sorted(pairs, key=lambda p: (-p[1], p[0]))[: percent * 4]
    assert {r.doc_id: r["rank"] for r in found if r["rank"]} == {key: i for i, (key, _) in enumerate(best, 1)}
    assert len(found) == 400


def test_rows_that_repeat_at_the_cutoff(spark):
    found = importance.drawn(scores(spark, [(7, 3)] * 100 + [(1, 2)] * 5)).collect()
    assert sorted(r["rank"] for r in found if r["rank"]) == [1, 2, 3, 4, 5]
    assert len(found) == 105


def test_ranks_go_on_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(importance, "RANGE", 10)
    pairs = [(i, (i * 7919) % 1009) for i in range(900)]
    found = importance.drawn(scores(spark, pairs), 40).collect()
    best = sorted(pairs, key=lambda p: (-p[1], p[0]))[:360]
    assert {r.doc_id: r["rank"] for r in found if r["rank"]} == {key: i for i, (key, _) in enumerate(best, 1)}


def test_cutoff_by_counts(spark):
    values = [-(2**62), -5, -5, 0, 3, 3, 3, 2**62]
    rows = spark.createDataFrame([(v,) for v in values], "v long")
    for wanted in range(1, len(values) + 1):
        least = sorted(values)[-wanted]
        assert importance.cutoff(rows, rows["v"], wanted) == (least, sum(v > least for v in values))
    assert importance.cutoff(rows, rows["v"], 9) is None
    assert importance.cutoff(rows, rows["v"], 0) is None
