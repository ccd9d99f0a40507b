"""Fields of structs and of arrays of structs: searches and mappings."""

import datetime as dt

import pytest

from quayside.functions.mapping import apply_mapping
from quayside.operators.fields import field_kinds, leaf_paths
from quayside.operators.search import (
    BoolMatchPhrase,
    CommonTerms,
    Exists,
    Fuzzy,
    Match,
    MoreLikeThis,
    Prefix,
    QueryString,
    Range,
    Regex,
    SimpleString,
    Term,
    Wildcard,
    search,
)

SCHEMA = """_id string, book struct<title:string,tags:array<string>,parts:array<struct<title:string,pages:int,notes:array<struct<by:string>>>>>,
    lists array<array<struct<a:string>>>, plain string"""


def part(title, pages, *by):
    return (title, pages, [(b,) for b in by] if by else None)


ROWS = [
    ("1", ("Harbour life", ["sea", "Port Town"], [part("The first crane", 10, "ann", "bob"), part("Two cranes", 30)]), [[("x y",)], []], "p"),
    ("2", ("Hills", None, [part(None, None, None), part("first hill", 99, "cy")]), [None, [("z",), None]], "first"),
    ("3", (None, [], []), None, None),
    ("4", None, [], "crane"),
    ("5", ("crane", ["sea"], [None, part("crane first the", 5)]), [[(None,)]], "q"),
]
KEYWORD = {"properties": {"book": {"properties": {"parts": {"type": "nested", "properties": {"title": {"type": "keyword"}}}}}}}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.mark.parametrize(
    ("query", "mapping", "want"),
    [
        (Match("book.title", "harbour crane"), None, "15"),
        (Match("book.parts.title", "crane"), None, "15"),
        (Match("book.parts.notes.by", "bob cy"), None, "12"),
        (Match("book.tags", "town"), None, "1"),
        (Match("lists.a", "y z"), None, "12"),
        (Match("book.parts.nothing", "crane"), None, ""),
        (Match("book.parts", "crane"), None, ""),
        (Term("book.parts.title", "first hill"), KEYWORD, "2"),
        (Term("book.parts.title", "first"), KEYWORD, ""),
        (Term("book.parts.title", "first"), None, "125"),
        (Prefix("book.parts.title", "cran"), None, "15"),
        (Wildcard("book.parts.title", "h?ll"), None, "2"),
        (Regex("book.parts.title", "cranes?"), None, "15"),
        (Fuzzy("book.parts.title", "hull"), None, "2"),
        (BoolMatchPhrase("must", [("book.parts.title", "the first")]), None, "1"),
        (BoolMatchPhrase("must-not", [("book.parts.title", "crane")]), None, "234"),
        (Range("integer", "book.parts.pages", gte="30"), None, "12"),
        (Range("integer", "book.parts.pages", gte="31", lte="98"), None, ""),
        (Exists("book.parts.title"), None, "125"),
        (Exists("book.parts.notes.by"), None, "12"),
        (Exists("book.title"), None, "125"),
        (Exists("lists.a"), None, "12"),
        (CommonTerms("book.parts.title", "crane hill", 0.3), None, "125"),
        (MoreLikeThis(["book.parts.title"], ["hill and crane"], min_doc_freq=1), None, "125"),
        (QueryString("book.parts.title:first AND -book.tags:sea"), None, "2"),
        (QueryString("crane"), None, "145"),
        (QueryString('"first the"~3'), None, "15"),
        (SimpleString("cy | y"), None, "12"),
    ],
)
def test_nested_fields(docs, query, mapping, want):
    assert "".join(sorted(r["_id"] for r in search(docs, query, mapping).collect())) == want


def test_paths():
    kinds = {"a": {"type": "text"}, "b": {"properties": {"c": {"type": "long"}, "d": {"properties": {"e": "date"}}}}, "f": "keyword"}
    assert field_kinds({"properties": kinds}) == field_kinds(kinds) == {"a": "text", "b.c": "long", "b.d.e": "date", "f": "keyword"}
    assert field_kinds(None) == {}


def test_leaf_paths(docs):
    paths = ["_id", "book.title", "book.tags", "book.parts.title", "book.parts.pages", "book.parts.notes.by", "lists.a", "plain"]
    assert leaf_paths(docs.schema) == paths


def test_mapping_of_objects(spark):
    rows = [
        ("1", ("2", [("3", "2024-01-02 03:04:05", None), None, (None, None, ["4", None])]), [["5"], None]),
        (None, None, None),
        ("6", (None, None), []),
    ]
    frame = spark.createDataFrame(rows, "a string, b struct<c:string,d:array<struct<e:string,f:string,g:array<string>>>>, h array<array<string>>")
    inner = {"e": {"type": "integer"}, "f": {"type": "date"}, "g": {"type": "double"}}
    mapping = {"properties": {"a": {"type": "long"}, "b": {"properties": {"d": {"type": "nested", "properties": inner}}}, "h": {"type": "short"}}}
    typed = apply_mapping(frame, mapping)
    assert typed.schema.simpleString() == (
        "struct<a:bigint,b:struct<c:string,d:array<struct<e:int,f:timestamp,g:array<double>>>>,h:array<array<smallint>>>"
    )
    found = [tuple(r) for r in typed.collect()]
    at = dt.datetime(2024, 1, 2, 3, 4, 5)
    assert found == [(1, ("2", [(3, at, None), None, (None, None, [4.0, None])]), [[5], None]), (None, None, None), (6, (None, None), [])]
    assert apply_mapping(frame, {"b": {"properties": {"c": {"type": "object"}}}}).schema == frame.schema
