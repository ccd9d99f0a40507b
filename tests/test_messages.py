"""JSON rows, JSON schemas and topics."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quayside import Topic, read, write
from quayside.functions import messages
from quayside.functions.mapping import apply_mapping, stringify
from quayside.sources import topics
from tests.conftest import same_rows

SCHEMA = "id long, text string, at timestamp_ntz, tags array<string>"
ROWS = [
    (1, 'quote " back \\ slash', dt.datetime(2024, 1, 1, 1, 2, 3, 456789), ["a", "b"]),
    (2, None, None, None),
    (3, "line\nbreak", dt.datetime(1969, 12, 31), []),
]


def test_rows_survive_as_json(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    for keep in (False, True):
        texts = frame.select(messages.row_to_json(frame, keep).alias("value"))
        assert same_rows(messages.well_formed(messages.json_to_columns(texts, frame.schema)), frame)


def test_nulls_are_kept_or_left_out(spark):
    frame = spark.createDataFrame([(1, None)], "id int, text string")
    assert frame.select(messages.row_to_json(frame)).first()[0] == '{"id":1}'
    assert frame.select(messages.row_to_json(frame, True)).first()[0] == '{"id":1,"text":null}'


def test_empty_frame_gives_no_messages(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert frame.select(messages.row_to_json(frame)).count() == 0


def inferred(spark, *texts):
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    return messages.infer_json_schema(frame).simpleString()


def test_inferred_json_schema(spark):
    assert inferred(spark, '{"a": 1, "b": "x"}', '{"a": 2.5, "c": [1, 2]}', "oops") == (
        "struct<a:double,b:string,c:array<bigint>>"
    )
    assert inferred(spark, '{"a": null, "b": true}') == "struct<a:string,b:boolean>"
    assert inferred(spark, '{"a": 1}', '{"a": "x"}') == "struct<a:string>"
    assert inferred(spark, '{"o": {"OBJECT": 1, "x y": [{"k": 0.5}]}}') == (
        "struct<o:struct<OBJECT:bigint,x y:array<struct<k:double>>>>"
    )
    with pytest.raises(ValueError):
        inferred(spark, "1", "2")
    with pytest.raises(ValueError):
        inferred(spark)


def test_malformed_messages_are_kept_apart(spark):
    texts = ['{"id": 1}', "oops", None, "[1", '{"id": "x"}', "{}"]
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    parsed = messages.json_to_columns(frame, spark.createDataFrame([], "id int").schema)
    assert sorted(r["value"] for r in messages.malformed(parsed).collect()) == ["[1", "oops", '{"id": "x"}']
    assert messages.well_formed(parsed).count() == 3


def test_topic_keys(spark, folder):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    for key, test in ((None, F.col("key").isNull()), ("id", F.col("key").cast("string").rlike("^[123]$"))):
        topic = Topic(f"by-{key}", folder=folder, key=key, schema=frame.schema)
        write(frame, topic)
        raw = topics.read_messages(spark, topic)
        assert raw.schema.names == topics.MESSAGE_SCHEMA.names
        assert raw.where(test).count() == 3
        assert same_rows(read(spark, topic), frame)
    unique = Topic("unique", folder=folder, key="uuid", schema=frame.schema)
    write(frame, unique)
    assert topics.read_messages(spark, unique).select("key").distinct().count() == 3


def test_malformed_topic_fails_or_keeps(spark, folder):
    schema = spark.createDataFrame([], "id int").schema
    topic = Topic("t", folder=folder, schema=schema)
    topics.publish(spark.createDataFrame([(None, '{"id": 1}'), (None, "oops")], "key string, value string"), topic)
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read(spark, topic).collect()
    kept = read(spark, Topic("t", folder=folder, schema=schema, malformed="keep"))
    assert sorted((r["id"], r["_corrupt_record"]) for r in kept.collect() if r["id"]) == [(1, None)]
    assert [r["_corrupt_record"] for r in kept.collect() if not r["id"]] == ["oops"]


def test_mapping_casts_named_fields(spark):
    values = [("1", "2.5", "2024-05-06 07:08:09", "x", "true")]
    frame = spark.createDataFrame(values, "a string, b string, c string, d string, e string")
    kinds = {"a": "long", "b": "float", "c": "date", "e": "boolean"}
    mapping = {"properties": {name: {"type": kind} for name, kind in kinds.items()}}
    typed = apply_mapping(frame, mapping)
    assert typed.dtypes == [("a", "bigint"), ("b", "float"), ("c", "timestamp"), ("d", "string"), ("e", "boolean")]
    assert typed.first()["c"] == dt.datetime(2024, 5, 6, 7, 8, 9)
    assert {t for _, t in stringify(typed).dtypes} == {"string"}


def test_widened_types(spark):
    def kind(ddl):
        return spark.createDataFrame([], f"x {ddl}").schema["x"].dataType

    for known, other, both in [
        ("bigint", "bigint", "bigint"),
        ("bigint", "double", "double"),
        ("bigint", "string", "string"),
        ("boolean", "bigint", "string"),
        ("array<bigint>", "array<double>", "array<double>"),
        ("array<bigint>", "string", "string"),
        ("struct<a:bigint,b:string>", "struct<c:boolean,a:double>", "struct<a:double,b:string,c:boolean>"),
        ("array<struct<a:bigint>>", "array<struct<b:bigint>>", "array<struct<a:bigint,b:bigint>>"),
        ("struct<a:bigint>", "array<bigint>", "string"),
    ]:
        assert messages.widened(kind(known), kind(other)) == kind(both)


def test_texts_that_are_no_objects_widen_nothing(spark):
    known = spark.createDataFrame([], "a bigint").schema
    frame = spark.createDataFrame([("oops",), ("[1]",), ("3",), (None,)], "value string")
    assert messages.widen_json_schema(known, frame) == known
    more = frame.union(spark.createDataFrame([('{"b": [1, 2.5]}',)], "value string"))
    assert messages.widen_json_schema(known, more).simpleString() == "struct<a:bigint,b:array<double>>"
