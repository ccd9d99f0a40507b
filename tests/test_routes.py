"""Route rules, summaries, datasets and streams."""

import glob
import os
import time
from dataclasses import replace
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from quayside import (
    AvailableNow,
    Avro,
    Continuous,
    Csv,
    File,
    Index,
    Json,
    KeyedTable,
    Orc,
    Parquet,
    RelationalTable,
    Route,
    Timed,
    Topic,
    Xlsx,
    Xml,
    read,
    run_route,
    write,
)
from quayside.endpoints import End
from quayside.operators.search import MatchAll, Term
from quayside.sources import topics
from quayside.sources.files import dataset_of
from quayside.sources.storage import scratch_folder
from tests.conftest import same_rows

FILE = File(Json(), "/x/in")
TABLE = RelationalTable("t", folder="/x/tables")
INDEX = Index("i", folder="/x/indexes")
TOPIC = Topic("t", folder="/x/topics")
STREAM = replace(TOPIC, mode=Timed(), checkpoint="/x/checkpoint")


@pytest.mark.parametrize(
    "arguments",
    [
        {"input": FILE, "output": TABLE},
        {"input": FILE, "output": TABLE, "save_mode": "sometimes"},
        {"input": FILE, "output": INDEX, "save_mode": "append"},
        {"input": FILE, "output": TOPIC, "save_mode": "append"},
        {"input": INDEX, "output": TOPIC},
        {"input": replace(STREAM, checkpoint=None), "output": INDEX},
        {"input": STREAM, "output": TABLE, "save_mode": "overwrite"},
        {"input": STREAM, "output": INDEX, "search": MatchAll()},
        {"input": FILE, "output": STREAM},
    ],
)
def test_refused_routes(arguments):
    with pytest.raises(ValueError):
        Route(**arguments)


def test_ends():
    assert FILE.end() == End("file", "/x/in", "in", "json")
    assert STREAM.end().kind == "topic" and STREAM.end().name == "t"
    assert KeyedTable("k", "t", hosts="h").end() == End("keyed", "h", "t", "k")


def test_a_route_cannot_overwrite_its_input(spark, folder):
    write(spark.range(3), File(Json(), f"{folder}/data/one"), "append")
    for target in (f"{folder}/data/one", f"{folder}/data", f"{folder}/data/one/deeper"):
        with pytest.raises(ValueError):
            run_route(spark, Route(File(Json(), f"{folder}/data/one"), File(Parquet(), target), save_mode="overwrite"))
    assert read(spark, File(Json(), f"{folder}/data/one")).count() == 3
    beside = File(Parquet(), f"{folder}/data/one-b")
    run_route(spark, Route(File(Json(), f"{folder}/data/one"), beside, save_mode="overwrite"))


def test_rows_are_counted(spark, folder):
    frame = spark.range(100).withColumnRenamed("id", "n")
    source = File(Json(), f"{folder}/in", schema=frame.schema)
    write(frame, source, "append")
    for output in (File(Parquet(), f"{folder}/a"), File(Xlsx(), f"{folder}/b"), RelationalTable("t", folder=folder)):
        assert run_route(spark, Route(source, output, save_mode="append")).rows == 100
    assert run_route(spark, Route(source, Topic("t", folder=folder))).rows == 100
    assert run_route(spark, Route(source, File(Parquet(), f"{folder}/a"), save_mode="ignore")).rows is None


def test_index_route_drops_ids_and_casts(spark, folder):
    index = Index("i", folder=f"{folder}/i")
    write(spark.createDataFrame([("1", "new"), ("2", "old")], "n string, status string"), index)
    mapping = {"n": "long", "status": "keyword"}
    target = File(Parquet(), f"{folder}/out")
    run_route(spark, Route(index, target, save_mode="append", search=Term("status", "new"), mapping=mapping))
    found = read(spark, target)
    assert found.dtypes == [("n", "bigint"), ("status", "string")] and found.collect() == [(1, "new")]
    texts = File(Parquet(), f"{folder}/text")
    run_route(spark, Route(index, texts, save_mode="append", search=MatchAll(), mapping=mapping, stringify=True))
    assert {t for _, t in read(spark, texts).dtypes} == {"string"}


@pytest.mark.parametrize("fmt", [Json(), Csv(), Parquet(), Xlsx()])
def test_datasets_keep_their_relative_folder(spark, folder, fmt):
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    names = ["one", "deep/one", "with blank", "per%cent+plus", "é=x"]
    for name in names:
        write(frame, File(fmt, f"{folder}/in/{name}"), "append")
    write(frame, File(fmt, f"{folder}/in"), "append")
    source = File(fmt, f"{folder}/in", schema=frame.schema, datasets=True)
    found = read(spark, source)
    datasets = {r["dataset"] for r in found.collect()}
    if isinstance(fmt, Xlsx):  # every workbook is a dataset
        assert all("part-" in dataset and not dataset.endswith(".xlsx") for dataset in datasets)
        datasets = {dataset.rpartition("/")[0] or "." for dataset in datasets}
    assert datasets == {*names, "."}
    for out in (Parquet(), Xlsx()):
        target = File(out, f"{folder}/out-{type(out).__name__}", schema=frame.schema, datasets=True)
        run_route(spark, Route(source, target, save_mode="append"))
        assert same_rows(read(spark, target), found)


@pytest.mark.parametrize("fmt", [Json(), Xlsx()])
def test_save_mode_of_each_dataset(spark, folder, fmt):
    schema = "id int, dataset string"
    target = File(fmt, f"{folder}/out", schema=spark.createDataFrame([], "id int").schema, datasets=True)

    def rows(*values):
        return spark.createDataFrame(list(values), schema)

    def found():
        return sorted(tuple(r) for r in read(spark, target).collect())

    write(rows((1, "a"), (2, "b/c")), target, "errorifexists")
    write(rows((3, "d")), target, "errorifexists")
    with pytest.raises(Exception, match="already exists"):
        write(rows((9, "e"), (9, "b/c")), target, "errorifexists")
    assert found() == [(1, "a"), (2, "b/c"), (3, "d")]
    write(rows((9, "a"), (4, "f")), target, "ignore")
    write(rows((5, "b/c")), target, "overwrite")
    write(rows((6, "a")), target, "append")
    assert found() == [(1, "a"), (3, "d"), (4, "f"), (5, "b/c"), (6, "a")]


def test_dataset_of_any_file_system(spark):
    paths = [("hdfs://host:9000/data/in/a/part-0", "a"), ("hdfs://host:9000/data/in/part-0", ".")]
    frame = spark.createDataFrame(paths, "path string, want string")
    got = frame.select("want", dataset_of(F.col("path"), "hdfs://host:9000/data/in").alias("got"))
    assert got.where("want <> got").isEmpty()


def fake_session(master, shared=None):
    conf = SimpleNamespace(get=lambda key, default=None: shared if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_scratch_folder():
    shared = fake_session("spark://cluster", "hdfs://shared/area/")
    assert scratch_folder(shared, "x").startswith("hdfs://shared/area/quayside-x-")
    assert scratch_folder(shared, "x") != scratch_folder(shared, "x")
    with pytest.raises(ValueError):
        scratch_folder(fake_session("spark://cluster"), "x")
    assert "quayside-x-" in scratch_folder(fake_session("local[8]"), "x")


# --- streams ---------------------------------------------------------------


def numbers(spark, start, end):
    return spark.range(start, end).selectExpr("id AS n", "CAST(id AS string) AS text")


def source_topic(spark, folder, rows, **changes):
    topic = Topic("in", folder=f"{folder}/topics", schema=rows.schema, key="n")
    write(rows, topic)
    return replace(topic, mode=AvailableNow(), checkpoint=f"{folder}/checkpoint", **changes)


@pytest.mark.parametrize("kind", ["file", "xlsx", "relational", "keyed", "index", "topic"])
def test_resumed_stream_equals_batch(spark, folder, kind):
    rows = numbers(spark, 0, 50)
    topic = source_topic(spark, folder, rows)
    target = {
        "file": File(Csv(), f"{folder}/out", schema=rows.schema),
        "xlsx": File(Xlsx(), f"{folder}/out", schema=rows.schema),
        "relational": RelationalTable("t", folder=f"{folder}/tables"),
        "keyed": KeyedTable("k", "t", folder=f"{folder}/keyed", keys=("n",)),
        "index": Index("i", folder=f"{folder}/indexes", id_column="n"),
        "topic": Topic("out", folder=f"{folder}/topics", schema=rows.schema),
    }[kind]
    route = Route(topic, target, save_mode=None if kind in ("index", "topic") else "append")
    assert run_route(spark, route).rows == 50
    assert run_route(spark, route).rows == 0
    write(numbers(spark, 50, 60), replace(topic, checkpoint=None))
    assert run_route(spark, route).rows == 10
    assert same_rows(read(spark, target).drop("_id"), numbers(spark, 0, 60))
    # Batch writes and streams share the target.
    write(numbers(spark, 60, 65), target, route.save_mode)
    assert same_rows(read(spark, target).drop("_id"), numbers(spark, 0, 65))


def test_repeated_batch_replaces_itself(spark, folder):
    rows = numbers(spark, 0, 20)
    topic = source_topic(spark, folder, rows)
    target = RelationalTable("t", folder=f"{folder}/tables")
    route = Route(topic, target, save_mode="append")
    run_route(spark, route)
    for path in glob.glob(f"{folder}/checkpoint/commits/*") + glob.glob(f"{folder}/checkpoint/commits/.*crc"):
        __import__("os").remove(path)  # as if the run had died before its commit
    run_route(spark, route)
    assert same_rows(read(spark, target), rows)


def test_mirror_keeps_or_drops_keys(spark, folder):
    topic = source_topic(spark, folder, numbers(spark, 0, 10))
    for keep in (True, False):
        target = Topic(f"copy-{keep}", folder=f"{folder}/topics")
        source = replace(topic, keep_key=keep, checkpoint=f"{folder}/checkpoint-{keep}")
        run_route(spark, Route(source, target))
        copied = topics.texts(topics.read_messages(spark, target))
        wanted = topics.texts(topics.read_messages(spark, topic))
        assert same_rows(copied, wanted if keep else wanted.withColumn("key", F.lit(None).cast("string")))


def test_mirror_copies_bytes(spark, folder):
    topic = Topic("in", folder=folder, mode=AvailableNow(), checkpoint=f"{folder}/checkpoint")
    values = [(bytearray(b"\xff\x00k"), bytearray(b"\xfe\xfd")), (None, None)]
    rows = spark.createDataFrame(values, "key binary, value binary")
    topics.publish(rows, topic)
    target = Topic("copy", folder=folder)
    run_route(spark, Route(topic, target))
    assert same_rows(topics.read_messages(spark, target).select("key", "value"), rows)


def test_stream_sets_malformed_messages_aside(spark, folder):
    topic = source_topic(spark, folder, numbers(spark, 0, 10), malformed=f"{folder}/bad")
    bad = spark.createDataFrame([("k", "oops\nagain"), ("k", "{")], "key string, value string")
    topics.publish(bad, replace(topic, checkpoint=None))
    target = RelationalTable("t", folder=f"{folder}/tables")
    run_route(spark, Route(topic, target, save_mode="append"))
    assert same_rows(read(spark, target), numbers(spark, 0, 10))
    aside = read(spark, File(Json(), f"{folder}/bad"))
    assert sorted(r["value"] for r in aside.collect()) == ["oops\nagain", "{"]


@pytest.mark.parametrize("mode", [Timed(0.2), Continuous()])
def test_running_stream_follows_a_topic(spark, folder, mode):
    topic = source_topic(spark, folder, numbers(spark, 0, 5))
    target = RelationalTable("t", folder=f"{folder}/tables")
    result = run_route(spark, Route(replace(topic, mode=mode), target, save_mode="append"))
    try:
        assert result.rows is None and result.input.detail == type(mode).__name__.lower()
        result.query.processAllAvailable()
        write(numbers(spark, 5, 8), replace(topic, checkpoint=None))
        time.sleep(0.1)
        result.query.processAllAvailable()
        assert same_rows(read(spark, target), numbers(spark, 0, 8))
    finally:
        result.query.stop()


def test_latest_offset_skips_older_messages(spark, folder):
    topic = source_topic(spark, folder, numbers(spark, 0, 5), offset="latest")
    target = RelationalTable("t", folder=f"{folder}/tables")
    route = Route(topic, target, save_mode="append")
    run_route(spark, route)
    write(numbers(spark, 5, 8), replace(topic, checkpoint=None))
    run_route(spark, route)
    assert same_rows(read(spark, target), numbers(spark, 5, 8))


def test_latest_offset_holds_after_a_failed_first_batch(spark, folder):
    topic = source_topic(spark, folder, numbers(spark, 0, 5), offset="latest")
    target = RelationalTable("t", folder=f"{folder}/tables")
    with open(f"{folder}/blocked", "w"):
        pass  # a file where the table's folder should be
    for _ in range(2):
        with pytest.raises(Exception):
            run_route(spark, Route(topic, RelationalTable("t", folder=f"{folder}/blocked"), save_mode="append"))
    write(numbers(spark, 6, 8), replace(topic, checkpoint=None))
    run_route(spark, Route(topic, target, save_mode="append"))
    assert same_rows(read(spark, target), numbers(spark, 6, 8))


def test_a_refused_route_sets_nothing_aside(spark, folder):
    schema = numbers(spark, 0, 1).schema
    topic = Topic("t", folder=f"{folder}/topic", schema=schema, malformed=f"{folder}/bad")
    write(numbers(spark, 0, 3), topic)
    topics.publish(spark.createDataFrame([("k", "oops")], "key string, value string"), topic)
    target = File(Json(), f"{folder}/out", schema=schema)
    write(numbers(spark, 0, 1), target, "append")
    for _ in range(2):
        with pytest.raises(Exception):
            run_route(spark, Route(topic, target, save_mode="errorifexists"))
    assert not glob.glob(f"{folder}/bad/*")
    for _ in range(2):
        run_route(spark, Route(topic, target, save_mode="overwrite"))
        assert [r["value"] for r in read(spark, File(Json(), f"{folder}/bad")).collect()] == ["oops"]
    assert same_rows(read(spark, target), numbers(spark, 0, 3))


def test_batch_read_ignores_latest(spark, folder):
    topic = source_topic(spark, folder, numbers(spark, 0, 5), offset="latest")
    assert read(spark, replace(topic, mode=Topic("x", folder="/").mode)).count() == 5


@pytest.mark.parametrize("fmt", [Json(), Csv(), Parquet(), Orc(), Avro(), Xml(), Xlsx()])
def test_files_are_read_once_and_archived(spark, folder, fmt):
    rows = numbers(spark, 0, 10)
    for i in range(2):
        write(numbers(spark, 5 * i, 5 * i + 5), File(fmt, f"{folder}/in/set-{i}"), "append")
    source = File(
        fmt, f"{folder}/in", schema=rows.schema, datasets=True, checkpoint=f"{folder}/checkpoint",
        archive=f"{folder}/processed", files_per_batch=1,
    )
    target = File(fmt, f"{folder}/out", schema=rows.schema, datasets=True)
    route = Route(source, target, save_mode="append")
    assert run_route(spark, route).rows == 10
    write(numbers(spark, 10, 12), File(fmt, f"{folder}/in/set-2"), "append")
    assert run_route(spark, route).rows == 2
    found = read(spark, target)
    assert same_rows(found.select("n", "text"), numbers(spark, 0, 12))
    assert {r["dataset"].partition("/part-")[0] for r in found.collect()} == {"set-0", "set-1", "set-2"}
    assert glob.glob(f"{folder}/processed/**/part-*", recursive=True)
    assert all("/dataset=set-" in path for path in glob.glob(f"{folder}/out/**/part-*", recursive=True))
    assert {path.split("/")[-2][:6] for path in glob.glob(f"{folder}/out/*/_SUCCESS")} <= {"batch-"}


@pytest.mark.parametrize("malformed", ["fail", "keep", "folder"])
def test_a_stream_without_a_schema_learns_it(spark, folder, malformed):
    """Fields of later messages arrive, types grow, and a stream that is started again goes on from there."""
    aside = f"{folder}/bad" if malformed == "folder" else malformed
    topic = Topic("t", folder=f"{folder}/topic", mode=AvailableNow(), checkpoint=f"{folder}/checkpoint", malformed=aside)
    target = File(Json(), f"{folder}/out")
    route = Route(topic, target, save_mode="append")
    bad = [] if malformed == "fail" else ["oops", "[1]"]
    batches = [
        [],
        bad,
        ['{"id": 1, "in": {"a": 1}}', '{"id": 2}'],
        [],
        ['{"id": 3, "name": "x", "in": {"b": [true]}}', *bad],
        ['{"id": 4.5, "in": {"a": "text"}}'],
        ['{"id": 5}'],
    ]
    for values in batches:
        topics.publish(spark.createDataFrame([(None, v) for v in values], "key string, value string"), topic)
        run_route(spark, route)
    rows = {r["id"]: r for r in read(spark, target).where("id is not null").collect()}
    assert sorted(rows) == [1, 2, 3, 4.5, 5]
    assert rows[3]["name"] == "x" and rows[3]["in"]["b"] == [True] and rows[4.5]["in"]["a"] == "text" and rows[1]["in"]["a"] in ("1", 1)
    if malformed == "keep":
        # Spark's reader takes a field of that name for its own
        kept = spark.read.option("recursiveFileLookup", True).option("columnNameOfCorruptRecord", "_other").json(f"{folder}/out")
        assert sorted(r["_corrupt_record"] for r in kept.where("_corrupt_record is not null").collect()) == sorted(bad * 2)
    if malformed == "folder":
        assert sorted(r["value"] for r in spark.read.option("recursiveFileLookup", True).json(f"{folder}/bad").collect()) == sorted(bad * 2)
    versions = sorted(glob.glob(f"{folder}/checkpoint/schemas/*.json"))
    assert [os.path.basename(v) for v in versions] == ["00000001.json", "00000002.json", "00000003.json"]
    if malformed == "fail":
        topics.publish(spark.createDataFrame([(None, "oops")], "key string, value string"), topic)
        with pytest.raises(Exception, match="MALFORMED"):
            run_route(spark, route)
