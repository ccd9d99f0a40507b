import math
import random

import pytest
from pyspark.sql import functions as F

from quayside.llm import mixing
from tests.conftest import plan_of
from tests.llm import cases


def exact_quantile(good, total, draws, chance):
    least, most, below = max(0, draws - (total - good)), min(good, draws), 0
    for x in range(least, most + 1):
        below += math.comb(good, x) * math.comb(total - good, draws - x) / math.comb(total, draws)
        if chance < below:
            return x
    return most


def test_hypergeometric_quantiles(spark):
    random_ = random.Random(3)
    rows = [(0, 0, 0, 0.3), (5, 5, 3, 0.2), (0, 7, 3, 0.9), (1, 1, 1, 0.5), (3, 9, 0, 0.5), (3, 9, 9, 0.5)]
    for _ in range(150):
        total = random_.randint(1, 400)
        rows.append((random_.randint(0, total), total, random_.randint(0, total), random_.random()))
    frame = spark.createDataFrame(rows, "k long, m long, n long, u double")
    found = frame.withColumn("x", mixing.hypergeometric(*(F.col(c) for c in "kmnu"))).collect()
    assert [r.x for r in found] == [exact_quantile(r.k, r.m, r.n, r.u) for r in found]


def brute_targets(sizes: dict) -> dict:
    """Pour by weight, stop what is full, share what is left among the others, until nothing is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    full = set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        shared = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if shared[s] > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in full else shared[s] for s in names}
        full |= over


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    random_ = random.Random(seed)
    sizes = {f"s{i}": random_.choice([0, 1, 5, 40, 1000, 3]) for i in range(random_.randint(1, 9))} | {None: 30}
    frame = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(sizes.items())], "doc_id long, source string, size long")
    found = {r.source: r.target for r in mixing.targets(frame).collect()}
    assert found == pytest.approx(brute_targets(sizes))


def checked(frame, docs):
    """Targets are met to a document, nothing exceeds three times its size, and every copy has a shard."""
    rows = frame.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in rows) == sorted(
        (r.doc_id is None, r.doc_id or 0, len(cases.words(r.text))) for r in docs.select("doc_id", "text").collect()
    )
    for r in rows:
        assert r.taken == len(r.shards) * r.size and r.taken <= 3 * r.size
    return rows


def test_documents_of_many_sources(spark):
    docs = cases.documents(spark)
    rows = checked(mixing.op1_mixing(spark, cases.TABLES), docs)
    source = {r.doc_id: r.source for r in docs.collect()}
    longest = max(r.size for r in rows)
    for name in {*source.values()}:
        own = [r for r in rows if source[r.doc_id] == name]
        assert abs(sum(r.taken for r in own) - own[0].target) <= longest / 2
    again = mixing.op1_mixing(spark, cases.TABLES).collect()
    assert sorted((r.doc_id, r.taken, r.shards) for r in rows) == sorted((r.doc_id, r.taken, r.shards) for r in again)


def test_every_unit_is_in_one_shard(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD", 8)
    quotas = spark.createDataFrame([(0, 50), (1, 0), (2, 7), (3, 300)], "source_no int, units long")
    rows = mixing.splitting_tree(quotas).collect()
    assert sorted((r.source_no, r.unit) for r in rows) == [(s, u) for s, n in ((0, 50), (2, 7), (3, 300)) for u in range(n)]
    shards = [r.shard for r in rows]
    assert {*shards} == {*range(45)}
    assert {shards.count(s) for s in {*shards}} <= {7, 8}


def test_a_hot_source_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 4)
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", 1 + i % 50) for i in range(3000)]
    sizes = spark.createDataFrame(rows, "doc_id long, source string, size long").withColumns({"tie": F.lit(0), "no": F.lit(0)})
    found = mixing.planned(sizes, sizes).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) <= 25 for r in found)


@pytest.mark.parametrize("key", [7, None])
def test_equal_rows_are_taken_one_by_one(spark, key):
    """A source of one row that repeats meets its target like any other, and is spread over blocks and shards."""
    rows = [(key, "a b c d e", "s1")] * 900 + [(i, "f g h i j", "s2") for i in range(900)] + [(key, "a b c d f", "s1")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    sizes = mixing.sized(docs).drop("row")
    sizes = mixing.numbered(sizes, mixing.repeats(sizes)).persist()
    same = [r.no for r in sizes.where("source = 's1'").groupBy("tie").agg(F.sort_array(F.collect_list("no")).alias("no")).collect()]
    assert sorted(same) == [list(range(5)), list(range(900))]
    assert {r.no for r in sizes.where("source = 's2'").select("no").distinct().collect()} == {0}
    found = mixing.planned(sizes, sizes).collect()
    assert len(found) == len(rows)
    for name in ("s1", "s2"):
        own = [r for r in found if r.source == name]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 2.5
        assert max(map(len, (r.shards for r in own))) <= 3
    hot = [s for r in found if r.source == "s1" for s in r.shards]
    assert len({*hot}) > 5 * len(hot) / 905 / 64
    mix = mixing.mixed(docs)
    assert sorted((r.source, r.n) for r in mix.groupBy("source").agg(F.count("*").alias("n")).collect()) == sorted(
        (name, sum(len(r.shards) for r in found if r.source == name)) for name in ("s1", "s2")
    )


def test_edges(spark):
    rows = mixing.mixed(cases.edge_documents(spark))
    assert rows.columns[: len(cases.rows()[0])] == cases.edge_documents(spark).columns
    taken = [r.text for r in rows.collect()]
    assert taken and all(cases.words(t) for t in taken)
    assert mixing.mixed(cases.no_documents(spark)).count() == 0
    assert mixing.mixed(cases.null_documents(spark)).count() == 0
    sizes = mixing.sized(cases.edge_documents(spark)).drop("row")
    sizes = mixing.numbered(sizes, mixing.repeats(sizes))
    assert mixing.planned(sizes, sizes).count() == len(cases.rows())


def test_no_python_in_the_plan(spark):
    plan = plan_of(mixing.op1_mixing(spark, cases.TABLES))
    assert "Python" not in plan and "Arrow" not in plan
