"""Relational and keyed tables, and the options that go to real connectors.

No database, broker or search cluster runs here: their connectors are checked
by the options they are given, the folder variants by their rows.
"""

import glob
import json

import pytest

from quayside import Index, KeyedTable, RelationalTable, Topic, read, write
from quayside.operators import search
from quayside.operators.upsert import latest_per_key
from quayside.sources import indexes, tables, topics
from quayside.sources.tables import compact_keyed, jdbc_bounds_options
from tests.conftest import plan_of, same_rows


def test_exactly_one_backend():
    for make in (
        lambda **k: RelationalTable("t", **k),
        lambda **k: KeyedTable("k", "t", keys=("id",), **k),
        lambda **k: Index("i", **k),
        lambda **k: Topic("t", **k),
    ):
        with pytest.raises(ValueError):
            make()
    with pytest.raises(ValueError):
        RelationalTable("t", url="jdbc:postgresql://db/x", folder="/x")
    with pytest.raises(ValueError):
        KeyedTable("k", "t", folder="/x")


def test_relational_modes(spark, folder):
    target = RelationalTable("public.people", folder=folder)
    one = spark.createDataFrame([(1, "a")], "id int, name string")
    two = spark.createDataFrame([(2, "b")], "id int, name string")
    write(one, target, "errorifexists")
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        write(two, target, "errorifexists")
    write(two, target, "ignore")
    assert same_rows(read(spark, target), one)
    write(two, target, "append")
    assert read(spark, target).count() == 2
    write(two, target, "overwrite")
    assert same_rows(read(spark, target), two)


def test_jdbc_options():
    table = RelationalTable(
        "public.orders",
        url="jdbc:postgresql://db:5432/shop",
        properties={"user": "u", "driver": "org.postgresql.Driver"},
        partition_column="id",
        num_partitions=32,
        batch_size=500,
    )
    options = tables.jdbc_options(table)
    assert options["url"] == "jdbc:postgresql://db:5432/shop" and options["dbtable"] == "public.orders"
    assert options["user"] == "u" and options["batchsize"] == 500
    assert tables.jdbc_partition_options(table, 1, 900) == {
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "900",
        "numPartitions": 32,
    }
    assert tables.jdbc_partition_options(table, None, None) == {}


def test_connector_options():
    keyed = KeyedTable("shop", "carts", hosts="node-1")
    assert tables.connector_options(keyed) == {
        "keyspace": "shop",
        "table": "carts",
        "spark.cassandra.connection.host": "node-1",
    }
    topic = Topic("t", brokers="b:9092", offset="latest", options={"maxOffsetsPerTrigger": "1000"})
    assert topics.batch_read_options(topic)["startingOffsets"] == "earliest"
    assert topics.stream_read_options(topic)["startingOffsets"] == "latest"
    assert topics.stream_read_options(topic)["maxOffsetsPerTrigger"] == "1000"
    assert topics.write_options(topic)["topic"] == "t"
    index = Index("people", nodes="es:9200", bulk_size=1, id_column="id")
    assert indexes.write_options(index) == {
        "es.nodes": "es:9200",
        "es.resource": "people",
        "es.batch.size.entries": "1",
        "es.mapping.id": "id",
    }


def test_keyed_writes_replace_by_key(spark, folder):
    target = KeyedTable("k", "t", folder=folder, keys=("a", "b"), order_by=("at",))
    schema = "a int, b string, at int, v string"

    def rows(*values):
        return spark.createDataFrame(list(values), schema)

    write(rows((1, "x", 1, "old"), (1, "x", 3, "new"), (1, "x", 2, "mid"), (2, None, 1, "null key")), target, "append")
    assert same_rows(read(spark, target), rows((1, "x", 3, "new"), (2, None, 1, "null key")))
    # A later write wins whatever its order columns say; keys without a new row stay.
    write(rows((1, "x", 0, "later"), (3, "z", 1, "added")), target, "append")
    write(rows((2, None, 9, "replaced")), target, "append")
    want = rows((1, "x", 0, "later"), (2, None, 9, "replaced"), (3, "z", 1, "added"))
    assert same_rows(read(spark, target), want)
    write(rows((7, "q", 1, "only")), target, "overwrite")
    assert same_rows(read(spark, target), rows((7, "q", 1, "only")))


def test_all_columns_are_keys(spark, folder):
    target = KeyedTable("k", "t", folder=folder, keys=("a", "b"))
    frame = spark.createDataFrame([(1, 2), (1, 2), (3, 4)], "a int, b int")
    write(frame, target, "append")
    write(frame, target, "append")
    assert read(spark, target).count() == 2


def test_hot_key_is_reduced_before_the_shuffle(spark):
    frame = spark.range(30_000).selectExpr("IF(id % 3 = 0, 0, id) AS key", "id AS version", "CAST(id AS string) AS v")
    best = latest_per_key(frame, ["key"], ["version"])
    assert best.where("key = 0").first()["v"] == "29997"
    plan = plan_of(best)
    partial = next(i for i, line in enumerate(plan.splitlines()) if "WindowGroupLimit" in line and "Partial" in line)
    assert partial > next(i for i, line in enumerate(plan.splitlines()) if "Exchange hashpartitioning" in line)  # printed top down


def test_keyed_writes_without_rows(spark, folder):
    target = KeyedTable("k", "t", folder=folder, keys=("a",))
    frame = spark.createDataFrame([(1, "x")], "a int, v string")
    write(frame.limit(0), target, "append")
    assert read(spark, target).count() == 0 and read(spark, target).schema == frame.schema
    write(frame, target, "append")
    write(frame.limit(0), target, "append")
    assert same_rows(read(spark, target), frame)
    write(frame.limit(0), target, "overwrite")
    assert read(spark, target).count() == 0


def test_keyed_overwrite_leaves_nothing_behind(spark, folder):
    target = KeyedTable("k", "t", folder=folder, keys=("a",))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for i in range(3):
            write(spark.createDataFrame([(i, "x")], "a int, v string"), target, "append")
        write(spark.createDataFrame([(9, "only")], "a int, v string"), target, "overwrite")
        assert [r["a"] for r in read(spark, target).collect()] == [9]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_keyed_writes_with_other_columns_and_maps(spark, folder):
    target = KeyedTable("k", "t", folder=folder, keys=("a",))
    write(spark.createDataFrame([(1, {"m": 1}), (1, {"m": 1}), (2, None)], "a int, m map<string,int>"), target, "append")
    write(spark.createDataFrame([(2, "new")], "a int, extra string"), target, "append")
    rows = {r["a"]: (r["m"], r["extra"]) for r in read(spark, target).collect()}
    assert rows == {1: ({"m": 1}, None), 2: (None, "new")}


def test_compacted_keyed_table(spark, folder):
    target = KeyedTable("k", "t", folder=folder, keys=("a",))
    for i in range(4):
        write(spark.createDataFrame([(i % 2, i)], "a int, v int"), target, "append")
    before = sorted(read(spark, target).collect())
    compact_keyed(spark, target)
    assert sorted(read(spark, target).collect()) == before == [(0, 2), (1, 3)]
    assert len(glob.glob(f"{folder}/k.t/row_version=*")) == 1


def test_save_modes_of_keyed_tables(spark, folder):
    target = KeyedTable("k", "t", folder=folder, keys=("a",))
    frame = spark.createDataFrame([(1, 1)], "a int, v int")
    write(frame, target, "errorifexists")
    with pytest.raises(FileExistsError):
        write(frame, target, "errorifexists")
    write(frame.selectExpr("a", "v + 1 AS v"), target, "ignore")
    assert same_rows(read(spark, target), frame)


def test_jdbc_bounds_are_asked_of_the_database():
    table = RelationalTable("s.t", url="jdbc:x", partition_column="id", properties={"user": "u"})
    options = jdbc_bounds_options(table)
    assert options["query"] == "SELECT min(id) AS low, max(id) AS high FROM s.t"
    assert "dbtable" not in options and options["user"] == "u"


def test_index_ids(spark, folder):
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "id int, text string")
    made_up = Index("random", folder=folder)
    write(frame, made_up)
    write(frame, made_up)
    ids = [r["_id"] for r in read(spark, made_up).collect()]
    assert len(set(ids)) == 4
    taken = Index("taken", folder=folder, id_column="id")
    write(frame, taken)
    assert sorted(r["_id"] for r in read(spark, taken).collect()) == ["1", "2"]


def test_documents_need_not_have_the_same_fields(spark, folder):
    index = Index("mixed", folder=folder, id_column="id")
    write(spark.createDataFrame([(1, "a")], "id int, text string"), index)
    write(spark.createDataFrame([(2, True)], "id int, flag boolean"), index)
    rows = read(spark, index).select("_id", "text", "flag").collect()
    assert sorted(rows) == [("1", "a", None), ("2", None, True)]


def test_cluster_evaluates_the_search():
    index = Index("people", nodes="es:9200")

    def asked(query):
        return json.loads(indexes.read_options(index, query)["es.query"])["query"]

    assert "es.query" not in indexes.read_options(index)
    assert asked(search.MatchAll()) == {"match_all": {}}
    assert asked(search.Match("f", "a b")) == {"match": {"f": "a b"}}
    assert asked(search.Terms("f", ("a", "b"))) == {"terms": {"f": ["a", "b"]}}
    assert asked(search.Range("integer", "n", lte="7")) == {"range": {"n": {"lte": 7}}}
    assert asked(search.Range("string", "n", gte="a", lte="b")) == {"range": {"n": {"lte": "b", "gte": "a"}}}
    assert asked(search.Fuzzy("f", "a"))["fuzzy"]["f"]["fuzziness"] == "AUTO"
    without = asked(search.BoolMatchPhrase("must-not", [("f", "a b")]))
    assert without == {"bool": {"must_not": [{"match_phrase": {"f": "a b"}}]}}
    like = asked(search.MoreLikeThis(["f"], ["a"]))["more_like_this"]
    assert like["min_term_freq"] == 1 and like["max_query_terms"] == 12 and like["minimum_should_match"] == "30%"
    rest = {
        "term": search.Term("f", "a"),
        "common": search.CommonTerms("f", "a"),
        "query_string": search.QueryString("a"),
        "simple_query_string": search.SimpleString("a"),
        "prefix": search.Prefix("f", "a"),
        "wildcard": search.Wildcard("f", "a*"),
        "regexp": search.Regex("f", "a."),
        "exists": search.Exists("f"),
        "ids": search.Ids(["1"]),
    }
    assert all(list(asked(query)) == [kind] for kind, query in rest.items())
