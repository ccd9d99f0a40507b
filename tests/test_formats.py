"""Formats: all conversions of a golden frame, edge values, save modes, inference."""

import datetime as dt
import glob
import os
import subprocess
import sys
import zipfile
from itertools import permutations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from quayside import Avro, Csv, File, Json, Orc, Parquet, Route, Xlsx, Xml, read, run_route, write
from quayside.sources import xlsx
from tests.conftest import plan_of, same_rows

FORMATS = {
    "json": Json(),
    "csv": Csv(separator=";", multiline=True),
    "parquet": Parquet("snappy"),
    "orc": Orc("zlib"),
    "avro": Avro(),
    "xml": Xml("persons", "person"),
    "xlsx": Xlsx(),
}
PERSON = "id double, first_name string, last_name string, email string, gender string, ip_address string"
# The golden rows of the conversion tests.
PERSONS = [
    (6.0, "Marquita", "Jarrad", "mjarrad5@rakuten.co.jp", "Female", "247.246.40.151"),
    (7.0, "Bordie", "Altham", "baltham6@hud.gov", "Male", "234.202.91.240"),
    (8.0, "Dom", "Greson", "dgreson7@somehting.com", "Male", "103.7.243.71"),
    (9.0, "Alphard", "Meardon", "ameardon8@comsenz.com", "Male", "37.31.17.200"),
    (10.0, "Reynold", "Neighbour", "rneighbour9@gravatar.com", "Male", "215.57.123.52"),
]
EDGE_SCHEMA = "id long, text string, number double, flag boolean, day date, at timestamp_ntz, small int"
EDGES = [
    (1, "plain", 1.5, True, dt.date(2024, 2, 29), dt.datetime(2024, 1, 1, 0, 3, 52, 824425), -1),
    (2, None, None, None, None, None, None),
    (3, "", 0.0, False, dt.date(1970, 1, 1), dt.datetime(1970, 1, 1), 0),
    (4, "  blanks  ", -1e-7, True, dt.date(1999, 12, 31), dt.datetime(1999, 12, 31, 23, 59, 59, 999999), 7),
    (5, 'quote " sep ; , back \\ slash', 1e300, True, dt.date(2100, 1, 1), dt.datetime(2038, 1, 19, 3, 14, 8, 1), 8),
    (6, "two\nlines\r\nthree\ttab", 0.1, None, None, None, 9),
    (7, "<a b='c'>&amp; & \"</a>", 123456789.125, False, None, None, 10),
    (8, "naïve 日本語 кириллица 🙂", 3.0, False, None, None, 2147483647),
    (2**53 + 1, "_x000D_ literal", 2.0, True, None, None, -2147483648),
    (2**63 - 1, '""', 2.5, True, None, None, 3),
]


def cycle(spark, folder, frame, fmt, name="out"):
    target = File(fmt, f"{folder}/{name}", schema=frame.schema)
    write(frame, target, "errorifexists")
    return read(spark, target)


@pytest.mark.parametrize("first, second", list(permutations(FORMATS, 2)))
def test_conversion_keeps_golden_rows(spark, folder, first, second):
    persons = spark.createDataFrame(PERSONS, PERSON)
    source = File(FORMATS[first], f"{folder}/in", schema=persons.schema)
    target = File(FORMATS[second], f"{folder}/out", schema=persons.schema)
    for i, part in enumerate(persons.randomSplit([0.5, 0.5], seed=1)):
        write(part, File(FORMATS[first], f"{folder}/in/set-{i}"), "errorifexists")
    result = run_route(spark, Route(source, target, save_mode="append"))
    assert result.rows == len(PERSONS)
    assert [tuple(r) for r in read(spark, target).orderBy("id").collect()] == PERSONS


@pytest.mark.parametrize("name", list(FORMATS))
def test_edge_values_survive(spark, folder, name):
    frame = spark.createDataFrame(EDGES, EDGE_SCHEMA)
    if name == "xml":
        # Line ends in XML are always plain line feeds, and Spark's reader stops at the least int.
        frame = frame.where("id <> 6 AND small IS DISTINCT FROM -2147483648")
    assert same_rows(cycle(spark, folder, frame, FORMATS[name]), frame)


@pytest.mark.parametrize("name", list(FORMATS))
def test_empty_frame(spark, folder, name):
    frame = spark.createDataFrame([], PERSON)
    assert cycle(spark, folder, frame, FORMATS[name]).count() == 0


@pytest.mark.parametrize("name", ["json", "parquet", "orc", "avro", "xml"])
def test_nested_values(spark, folder, name):
    schema = "id int, tags array<string>, place struct<name: string, no: long>"
    frame = spark.createDataFrame([(1, ["a", "b"], ("x", 1)), (2, ["c"], ("y", None))], schema)
    assert same_rows(cycle(spark, folder, frame, FORMATS[name]), frame)


@pytest.mark.parametrize("name", ["csv", "xlsx"])
def test_nested_values_are_refused(spark, folder, name):
    with pytest.raises(TypeError):
        cycle(spark, folder, spark.createDataFrame([(1, ["a"])], "id int, tags array<string>"), FORMATS[name])


@pytest.mark.parametrize("name", list(FORMATS))
def test_save_modes(spark, folder, name):
    one = spark.createDataFrame(PERSONS[:1], PERSON)
    two = spark.createDataFrame(PERSONS[1:3], PERSON)
    target = File(FORMATS[name], f"{folder}/out", schema=one.schema)
    write(one, target, "errorifexists")
    with pytest.raises((PySparkException, FileExistsError)):
        write(two, target, "errorifexists")
    write(two, target, "ignore")
    assert read(spark, target).count() == 1
    write(two, target, "append")
    assert read(spark, target).count() == 3
    write(two, target, "overwrite")
    assert same_rows(read(spark, target), two)


@pytest.mark.parametrize("name", ["json", "parquet", "orc", "avro", "xml", "xlsx", "csv"])
def test_inferred_schema(spark, folder, name):
    fmt = Csv(separator=";", infer_schema=True) if name == "csv" else FORMATS[name]
    persons = spark.createDataFrame(PERSONS, PERSON)
    write(persons, File(fmt, f"{folder}/out"), "errorifexists")
    found = read(spark, File(fmt, f"{folder}/out"))
    assert same_rows(found.withColumn("id", found["id"].cast("double")), persons)


@pytest.mark.parametrize("codec", ["snappy", "gzip", None])
def test_parquet_codecs(spark, folder, codec):
    frame = spark.createDataFrame(PERSONS, PERSON)
    assert same_rows(cycle(spark, folder, frame, Parquet(codec)), frame)
    suffix = {"snappy": ".snappy.parquet", "gzip": ".gz.parquet", None: ".parquet"}[codec]
    names = glob.glob(f"{folder}/out/*.parquet")
    assert names and all(n.endswith(suffix) for n in names)
    assert codec is not None or not any(".snappy" in n or ".gz" in n for n in names)


@pytest.mark.parametrize("codec", ["snappy", "zlib", "lzo", None])
def test_orc_codecs(spark, folder, codec):
    frame = spark.createDataFrame(PERSONS, PERSON)
    assert same_rows(cycle(spark, folder, frame, Orc(codec)), frame)


def test_many_writers_unless_one_file_is_asked_for(spark, folder):
    frame = spark.range(100).repartition(4)
    write(frame, File(Json(), f"{folder}/many"), "append")
    write(frame, File(Json(), f"{folder}/one", single_file=True), "append")
    assert len(glob.glob(f"{folder}/many/part-*")) == 4
    assert len(glob.glob(f"{folder}/one/part-*")) == 1


def test_rebalanced_writers_leave_few_files(spark, folder):
    frame = spark.range(1000).repartition(50).where("id % 100 = 0")
    write(frame, File(Json(), f"{folder}/few", rebalance=True), "append")
    assert len(glob.glob(f"{folder}/few/part-*")) == 1
    by_set = frame.selectExpr("id", "CAST(id % 200 AS string) AS dataset")
    write(by_set, File(Json(), f"{folder}/sets", rebalance=True, datasets=True), "append")
    assert len(glob.glob(f"{folder}/sets/dataset=*/part-*")) == 2


def test_large_csv_files_are_split(spark, folder):
    write(spark.range(20_000).selectExpr("id", "repeat('x', 50) AS text"), File(Csv(), f"{folder}/one", single_file=True), "append")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        schema = spark.createDataFrame([], "id long, text string").schema
        found = read(spark, File(Csv(), f"{folder}/one", schema=schema))
        assert found.rdd.getNumPartitions() > 4 and found.count() == 20_000
        assert read(spark, File(Csv(multiline=True), f"{folder}/one", schema=schema)).rdd.getNumPartitions() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_failed_workbook_leaves_no_trace(spark, folder):
    target = File(Xlsx(), f"{folder}/books")
    with pytest.raises(Exception):
        write(spark.createDataFrame([("x" * 40_000,)], "text string"), target, "errorifexists")
    assert not os.path.exists(f"{folder}/books")
    good = spark.createDataFrame([("fine",)], "text string")
    write(good, target, "ignore")
    assert [r["text"] for r in read(spark, target).collect()] == ["fine"]
    os.makedirs(f"{folder}/empty")
    write(good, File(Xlsx(), f"{folder}/empty"), "errorifexists")
    assert read(spark, File(Xlsx(), f"{folder}/empty")).count() == 1


def test_many_datasets_of_one_task(spark, folder):
    frame = spark.range(1000).coalesce(1).selectExpr("id", "concat('set ', id % 500) AS dataset")
    target = File(Xlsx(), f"{folder}/books", datasets=True)
    write(frame, target, "append")
    assert len(glob.glob(f"{folder}/books/dataset=*/part-*.xlsx")) == 500
    assert read(spark, target).count() == 1000


def test_malformed_typed_records_fail(spark, folder):
    spark.createDataFrame([('{"id": 1}',), ("{oops",)], "value string").write.text(f"{folder}/in")
    schema = spark.createDataFrame([], "id int").schema
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read(spark, File(Json(), f"{folder}/in", schema=schema)).collect()
    keeping = spark.createDataFrame([], "id int, _corrupt_record string").schema
    rows = read(spark, File(Json(), f"{folder}/in", schema=keeping)).collect()
    assert sorted(r["_corrupt_record"] or "" for r in rows) == ["", "{oops"]


def test_columns_in_another_order_are_refused(spark, folder):
    write(spark.createDataFrame([(1, "x")], "a int, b string"), File(Csv(), f"{folder}/in"), "append")
    schema = spark.createDataFrame([], "b string, a int").schema
    with pytest.raises(Exception, match="header"):
        read(spark, File(Csv(), f"{folder}/in", schema=schema)).collect()


@pytest.mark.parametrize("name", ["json", "parquet", "orc", "xml", "xlsx"])
def test_files_with_different_columns(spark, folder, name):
    write(spark.createDataFrame([(1.5, "x")], "a double, b string"), File(FORMATS[name], f"{folder}/in/one"), "append")
    write(spark.createDataFrame([(2.5, "y")], "a double, c string"), File(FORMATS[name], f"{folder}/in/two"), "append")
    found = read(spark, File(FORMATS[name], f"{folder}/in"))
    assert sorted(found.columns) == ["a", "b", "c"]
    assert sorted(found.select("a", "b", "c").collect()) == [(1.5, "x", None), (2.5, None, "y")]


def test_workbook_limits(spark, folder):
    frame = spark.range(25).coalesce(1).selectExpr("id", "CAST(id AS string) AS text")
    write(frame, File(Xlsx(rows_per_workbook=10), f"{folder}/out"), "append")
    assert len(glob.glob(f"{folder}/out/*.xlsx")) == 3
    assert read(spark, File(Xlsx(), f"{folder}/out", schema=frame.schema)).count() == 25
    with pytest.raises(PySparkException, match="32767"):
        write(spark.sql("SELECT repeat('x', 40000) AS text"), File(Xlsx(), f"{folder}/long"), "append")
    assert not glob.glob(f"{folder}/long/*.xlsx")


FOREIGN = {
    "xl/workbook.xml": '<workbook xmlns="{main}" xmlns:r="{rels}"><sheets><sheet name="Data" sheetId="7" r:id="rId9"/>'
    '<sheet name="Other" sheetId="8" r:id="rId8"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    '<Relationship Id="rId8" Target="worksheets/none.xml"/><Relationship Id="rId9" Target="/xl/worksheets/data.xml"/>'
    "</Relationships>",
    "xl/sharedStrings.xml": '<sst xmlns="{main}"><si><t>when</t></si><si><r><t>na</t></r><r><t>me</t></r></si>'
    '<si><t xml:space="preserve"> a &amp; b </t></si></sst>',
    "xl/styles.xml": '<styleSheet xmlns="{main}"><numFmts count="1"><numFmt numFmtId="170" formatCode="0.00 &quot;days&quot;"/>'
    '</numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/></cellXfs></styleSheet>',
    "xl/worksheets/data.xml": '<?xml version="1.0"?><x:worksheet xmlns:x="{main}"><x:cols><x:col min="1" max="2"/></x:cols>'
    '<x:sheetData><x:row r="1"><x:c r="A1" t="s"><x:v>0</x:v></x:c><x:c r="B1" t="s"><x:v>1</x:v></x:c>'
    '<x:c r="D1" t="str"><x:v>flag</x:v></x:c><x:c r="E1" t="inlineStr"><x:is><x:t>days</x:t></x:is></x:c></x:row>'
    '<x:row r="2"><x:c r="A2" s="1"><x:v>45292.5</x:v></x:c><x:c r="B2" t="s"><x:v>2</x:v></x:c>'
    '<x:c r="D2" t="b"><x:v>1</x:v></x:c><x:c r="E2" s="2"><x:v>1.5E3</x:v></x:c></x:row>'
    '<x:row r="3"><x:c r="C3"><x:v>99</x:v></x:c><x:c r="D3" t="e"><x:v>#N/A</x:v></x:c><x:c r="E3"><x:v>-2</x:v></x:c></x:row>'
    '</x:sheetData><x:pageMargins left="1"/></x:worksheet>',
}


def test_workbook_of_another_program(spark, folder):
    names = {"main": xlsx.SHEET_NS.strip("{}"), "rels": xlsx.RELS}
    os.makedirs(f"{folder}/in")
    with zipfile.ZipFile(f"{folder}/in/book.xlsx", "w") as book:
        for part, text in FOREIGN.items():
            book.writestr(part, text.format(**names))
    found = read(spark, File(Xlsx(), f"{folder}/in"))
    assert found.dtypes == [("when", "timestamp_ntz"), ("name", "string"), ("flag", "boolean"), ("days", "double")]
    assert [tuple(r) for r in found.collect()] == [
        (dt.datetime(2024, 1, 1, 12), " a & b ", True, 1500.0),
        (None, None, None, -2.0),
    ]
    typed = spark.createDataFrame([], "when date, days int, absent string").schema
    assert read(spark, File(Xlsx(), f"{folder}/in", schema=typed)).collect() == [
        (dt.date(2024, 1, 1), 1500, None),
        (None, -2, None),
    ]


def test_wide_workbook(spark, folder):
    frame = spark.range(3).selectExpr(*[f"id + {i} AS c{i}" for i in range(60)])
    assert same_rows(cycle(spark, folder, frame, Xlsx()), frame)
    assert [xlsx._column_name(i) for i in (0, 25, 26, 51, 52, 701, 702)] == ["A", "Z", "AA", "AZ", "BA", "ZZ", "AAA"]
    assert all(xlsx._column_index(xlsx._column_name(i)) == i for i in range(2000))


TEXT = st.text(st.characters(blacklist_categories=("Cs",), blacklist_characters="\x00￾￿"), max_size=12)
MOMENTS = st.datetimes(dt.datetime(1900, 3, 1), dt.datetime(2200, 1, 1))
VALUES = st.tuples(
    st.one_of(st.none(), TEXT),
    st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)),
    st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False)),
    st.one_of(st.none(), MOMENTS),
)


@pytest.mark.parametrize("name", ["json", "csv", "parquet", "orc", "avro", "xlsx"])
@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(VALUES, min_size=30, max_size=60))
def test_any_values_survive(spark, tmp_path_factory, name, rows):
    # A first column that is never empty: a CSV line of one NULL would be a blank line.
    rows = [(i, *row) for i, row in enumerate(rows)]
    frame = spark.createDataFrame(rows, "i int, text string, whole long, real double, at timestamp_ntz")
    back = cycle(spark, str(tmp_path_factory.mktemp("any")), frame, FORMATS[name])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, frame.collect()))


def test_workers_need_no_package(tmp_path):
    """Workbook tasks run where only the driver can import the package."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "job.py"
    script.write_text(
        f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from quayside import File, Xlsx, read, write
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
target = File(Xlsx(), {str(tmp_path / "out")!r})
write(spark.range(7).selectExpr("id", "'x' AS text", "current_date() AS day"), target, "append")
print("rows", read(spark, target).count(), read(spark, target).where("text = 'x'").count())
"""
    )
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=200
    )
    assert "rows 7 7" in run.stdout, run.stderr[-3000:]


def test_files_of_a_folder_may_have_other_columns(spark, folder):
    """Files are grouped by their header, one scan each; columns are matched by name."""
    texts = {
        "a/1.csv": "id;name;n\n1;one;10\n2;;\n",
        "a/2.csv": "id;name;n\n3;three;30\n",
        "b/x [1]%20.csv": "n;extra;id\n40;\"a\nb\";4\n",
        "b/only header.csv": "other\n",
        "c/empty.csv": "",
        "c/bom.csv": "\ufeffid;name;n\n5;five;50\n",
    }
    for name, text in texts.items():
        os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
        with open(f"{folder}/{name}", "w", newline="") as out:
            out.write(text)
    fmt = Csv(separator=";", multiline=True)
    found = read(spark, File(fmt, folder))
    assert sorted(found.columns) == ["extra", "id", "n", "name", "other"]
    rows = {r.id: (r.name, r.n, r.extra, r.other) for r in found.collect()}
    assert rows == {"1": ("one", "10", None, None), "2": (None, None, None, None), "3": ("three", "30", None, None), "4": (None, "40", "a\nb", None), "5": ("five", "50", None, None)}
    assert plan_of(found).count("Scan csv") == 3

    schema = spark.createDataFrame([], "n int, id long, extra string, nowhere double").schema
    typed = read(spark, File(fmt, folder, schema=schema, datasets=True))
    assert typed.columns == ["n", "id", "extra", "nowhere", "dataset"]
    assert sorted((r.id, r.n, r.dataset) for r in typed.collect()) == [(1, 10, "a"), (2, None, "a"), (3, 30, "a"), (4, 40, "b"), (5, 50, "c")]

    inferred = read(spark, File(Csv(separator=";", multiline=True, infer_schema=True), f"{folder}/a"))
    assert dict(inferred.dtypes) == {"id": "int", "name": "string", "n": "int"}
    assert plan_of(inferred).count("Scan csv") == 1


def test_inferred_types_that_differ_are_strings(spark, folder):
    for name, text in {"1.csv": "a,b\n1,2\n", "2.csv": "b,a,c\nx,2.5,9\n"}.items():
        with open(f"{folder}/{name}", "w") as out:
            out.write(text)
    found = read(spark, File(Csv(infer_schema=True), folder))
    assert dict(found.dtypes) == {"a": "double", "b": "string", "c": "int"}
    assert sorted(tuple(r) for r in found.select("a", "b", "c").collect()) == [(1.0, "2", None), (2.5, "x", 9)]


def test_packed_files_have_headers(spark, folder):
    spark.createDataFrame([(1, "x")], "a int, b string").write.option("header", True).option("compression", "gzip").csv(f"{folder}/1")
    spark.createDataFrame([("y", 2)], "b string, c int").write.option("header", True).csv(f"{folder}/2")
    found = read(spark, File(Csv(), folder))
    assert sorted((r.a or "", r.b, r.c or "") for r in found.collect()) == [("", "y", "2"), ("1", "x", "")]


def test_workbooks_reach_python_in_slices(spark, folder, monkeypatch):
    """No row that is sent to Python holds a workbook, and none is lost between slices."""
    frame = spark.range(0, 3000, 1, 2).selectExpr("id", "concat('text ', id) AS text")
    target = File(Xlsx(rows_per_workbook=1000), f"{folder}/books", schema=frame.schema)
    write(frame, target, "errorifexists")
    files = spark.read.format("binaryFile").schema(xlsx.BINARY_FILE).load(target.path)
    monkeypatch.setattr(xlsx, "SLICE", 1000)
    parts = xlsx._sliced(files)
    rows = parts.selectExpr("path", "length(part) AS n", "last").collect()
    assert max(r.n for r in rows) == 1000 and sum(r.last for r in rows) == files.count() == 4
    assert sum(r.n for r in rows) == files.selectExpr("sum(length)").first()[0]
    assert same_rows(read(spark, target), frame)
    assert xlsx.infer_schema(files).names == ["id", "text"]
    held = [book.read() for _, book in xlsx._workbooks(parts.toArrow().to_batches())]
    assert sorted(held) == sorted(bytes(r.content) for r in files.select("content").collect())


def test_xml_files_are_bounded(spark, folder):
    """One task reads an XML file, so a task that writes many rows writes several."""
    frame = spark.range(0, 120_000, 1, 1).selectExpr("id", "concat('text ', id) AS text")
    for single, files in ((False, 3), (True, 1)):
        target = File(Xml("rows", "row"), f"{folder}/{single}", schema=frame.schema, single_file=single)
        write(frame, target, "errorifexists")
        assert len(glob.glob(f"{target.path}/part-*")) == files
        assert same_rows(read(spark, target), frame)
