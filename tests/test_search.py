"""Search semantics on small frames: absent fields, keywords, arrays, structs, plans."""

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quayside.operators.search import (
    BoolMatchPhrase,
    CommonTerms,
    Exists,
    Fuzzy,
    Ids,
    Match,
    MatchAll,
    MoreLikeThis,
    MultiMatch,
    Prefix,
    QueryString,
    Range,
    Regex,
    SimpleString,
    Term,
    Terms,
    Wildcard,
    sample_documents,
    search,
)
from tests.conftest import TABLES, plan_of

ROWS = [
    ("1", "Red apple pie", "new", 5, 1.5, ["x", "y"], ("north", 1)),
    ("2", "green Apple", "old", 7, None, [], ("south", 2)),
    ("3", None, "new", None, 0.5, None, None),
    ("4", "blue sky, red sea", None, 10, 2.5, ["y"], ("north east", 3)),
    ("5", "", "New", 7, 9.0, ["z"], ("west", None)),
]
SCHEMA = (
    "_id string, text string, status string, n int, score double, tags array<string>, "
    "place struct<name: string, no: int>"
)
MAPPING = {"properties": {"status": {"type": "keyword"}, "tags": {"type": "keyword"}}}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def ids(docs, query, mapping=MAPPING):
    return "".join(sorted(r["_id"] for r in search(docs, query, mapping).collect()))


@pytest.mark.parametrize(
    "query, want",
    [
        (MatchAll(), "12345"),
        (Match("text", "APPLE sky"), "124"),
        (Match("text", "..."), ""),
        (Match("status", "new"), "13"),
        (Match("n", "7"), "25"),
        (Match("n", "many"), ""),
        (Match("missing", "x"), ""),
        (Term("text", "apple"), "12"),
        (Term("text", "Apple"), ""),
        (Term("text", "red apple"), ""),
        (Term("status", "New"), "5"),
        (Terms("status", ["New", "old"]), "25"),
        (Terms("text", ["sky", "pie"]), "14"),
        (Terms("text", []), ""),
        (Term("tags", "y"), "14"),
        (Term("place.name", "north"), "14"),
        (Term("place.no", "2"), "2"),
        (Prefix("text", "app"), "12"),
        (Prefix("status", "n"), "13"),
        (Prefix("n", "1"), "4"),
        (Wildcard("text", "s?y"), "4"),
        (Wildcard("status", "?e*"), "135"),
        (Wildcard("status", "%"), ""),
        (Regex("status", "[nN]ew"), "135"),
        (Regex("status", "ne"), ""),
        (Regex("text", "(red|green)"), "124"),
        (Fuzzy("text", "aplpe"), "12"),
        (Fuzzy("status", "odl"), "2"),
        (Exists("text"), "1245"),
        (Exists("tags"), "145"),
        (Exists("score"), "1345"),
        (Exists("missing"), ""),
        (Ids(["2", "5", "9"]), "25"),
        (Ids([]), ""),
        (Range("integer", "n", gte="7"), "245"),
        (Range("integer", "n", lte="7", gte="6"), "25"),
        (Range("float", "score", lte="1.5"), "13"),
        (Range("string", "status", gte="new", lte="old"), "123"),
        (Range("long", "n"), "1245"),
        (BoolMatchPhrase("must", [("text", "red apple"), ("status", "new")]), "1"),
        (BoolMatchPhrase("must-not", [("text", "red apple"), ("text", "red sea")]), "235"),
        (BoolMatchPhrase("should", [("text", "apple pie"), ("text", "sky red")]), "14"),
        (BoolMatchPhrase("must-not", [("status", "new")]), "245"),
        (MultiMatch(["apple", "red"]), "1124"),
        (MultiMatch(["apple", "red"], dedupe=True), "124"),
        (CommonTerms("text", "apple sky", cutoff=0.2), "4"),
        (CommonTerms("text", "red apple", cutoff=0.2), "124"),
        (CommonTerms("text", "apple nowhere", cutoff=0.2), ""),
        (MoreLikeThis(["text"], ["red apple"], min_doc_freq=1), "124"),
        (MoreLikeThis(["text"], ["red apple"], min_doc_freq=1, share=1.0), "1"),
        (MoreLikeThis(["text"], ["red apple"]), ""),
        (MoreLikeThis(["text", "status"], ["red", "new"], min_doc_freq=1, share=1.0), "1"),
        (MoreLikeThis(["missing"], ["red"]), ""),
        (QueryString("red AND apple"), "1"),
        (QueryString("red OR sky"), "14"),
        (QueryString("red sky"), "14"),
        (QueryString("+red -apple"), "4"),
        (QueryString("NOT apple"), "345"),
        (QueryString("red AND NOT apple"), "4"),
        (QueryString("(green OR blue) AND apple"), "2"),
        (QueryString("apple AND red OR sky"), "1"),
        (QueryString('"red sea" || "apple pie"'), "14"),
        (QueryString("status:new && n:5"), "1"),
        (QueryString("n:[5 TO 7]"), "125"),
        (QueryString("n:{5 TO 7]"), "25"),
        (QueryString("n:[7 TO *]"), "245"),
        (QueryString("n:>7 score:<=0.5"), "34"),
        (QueryString("text:app*"), "12"),
        (QueryString("text:APP*"), "12"),
        (QueryString("text:aplpe~"), "12"),
        (QueryString("text:appl~1 status:/n.w/"), "123"),
        (QueryString("_exists_:score AND NOT _exists_:text"), "3"),
        (QueryString("*"), "12345"),
        (QueryString("*:*"), "12345"),
        (QueryString("text:*"), "1245"),
        (QueryString("red^2 (sky)^0.5"), "14"),
        (QueryString(""), ""),
        (QueryString("()"), ""),
        (SimpleString("red + apple"), "1"),
        (SimpleString("red apple"), "124"),
        (SimpleString("red | green"), "124"),
        (SimpleString("red + -apple"), "4"),
        (SimpleString("red | green + apple"), "12"),
        (SimpleString('"red sea"'), "4"),
        (SimpleString("app*"), "12"),
        (SimpleString("aplpe~1"), "12"),
        (SimpleString("(red apple"), "124"),
        (SimpleString("red ) + apple"), "1"),
        (SimpleString("+ | ("), ""),
        (SimpleString('"red'), "14"),
        (SimpleString("-apple"), "345"),
    ],
)
def test_members(docs, query, want):
    assert ids(docs, query) == want


WORDS = ["red", "apple", "sky", "new", "zzz"]


def has(row, word):
    return any(word in (row[i] or "").lower().replace(",", "").split() for i in (1, 2))


def queries(depth):
    """Random query texts with a plain Python test of a row."""
    word = st.sampled_from(WORDS).map(lambda w: (w, lambda row: has(row, w)))
    if depth == 0:
        return word
    inner = queries(depth - 1)

    def both(parts, joiner, test):
        texts = [f"({text})" for text, _ in parts]
        return joiner.join(texts), lambda row: test(check(row) for _, check in parts)

    some = st.lists(inner, min_size=2, max_size=3)
    return st.one_of(
        word,
        some.map(lambda parts: both(parts, " AND ", all)),
        some.map(lambda parts: both(parts, " OR ", any)),
        some.map(lambda parts: both(parts, " ", any)),
        inner.map(lambda part: (f"NOT ({part[0]})", lambda row: not part[1](row))),
        st.tuples(inner, inner).map(
            lambda ab: (f"+({ab[0][0]}) -({ab[1][0]})", lambda row: ab[0][1](row) and not ab[1][1](row))
        ),
    )


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(query=queries(3))
def test_query_string_against_python(docs, query):
    text, check = query
    want = "".join(row[0] for row in ROWS if check(row))
    assert ids(docs.select("_id", "text", "status"), QueryString(text), {}) == want
    simple = text.replace(" AND ", " + ").replace(" OR ", " | ").replace("NOT (", "-(")
    if "+(" not in text:  # there, a plus sign means something else
        assert ids(docs.select("_id", "text", "status"), SimpleString(simple), {}) == want


def test_unbalanced_query_string_raises(docs):
    for text in ("(red", "red)"):
        with pytest.raises(ValueError):
            search(docs, QueryString(text))


def test_bad_bool_filter_raises(docs):
    with pytest.raises(ValueError):
        search(docs, BoolMatchPhrase("maybe", [("text", "red")]))


def test_every_value_counts(docs):
    whole = search(docs, MultiMatch(["apple", "red"]))
    assert sorted(r["_id"] for r in whole.collect()) == ["1", "1", "2", "4"]


@pytest.mark.parametrize(
    "field, text, cutoff, want",
    [
        ("text", "apple sky", 0.2, "4"),
        ("text", "red apple", 0.2, "124"),
        ("text", "red apple nowhere", 0.2, ""),
        ("text", "apple", 0.0, "12"),
        ("text", "sky pie green", 0.2, "124"),
        ("status", "new", 0.2, "13"),
        ("tags", "z", 0.2, "5"),
        ("text", "...", 0.2, ""),
    ],
)
def test_common_terms(docs, field, text, cutoff, want):
    more = " ".join(f"absent{i}" for i in range(13))
    if field == "text" and want and cutoff < 1 and "nowhere" not in text:
        found = {r["_id"] for r in search(docs, CommonTerms(field, f"{text} {more}", 1.0)).collect()}
        assert found == {r["_id"] for r in search(docs, CommonTerms(field, text, 1.0)).collect()}
    assert ids(docs, CommonTerms(field, text, cutoff)) == want


def test_no_values(docs):
    assert ids(docs, MultiMatch([])) == ""


def test_many_words_find_what_few_do(spark):
    """NULL elements of arrays, and one word more than are looked up one by one."""
    frame = spark.createDataFrame([("1", ["achach", None]), ("2", ["achach"]), ("3", [None]), ("4", None)], "_id string, tags array<string>")
    for more in (0, 11, 12, 40):
        text = " ".join(["achach", *(f"absent{i}" for i in range(more))])
        for query in (CommonTerms("tags", text, 1.0), Match("tags", text), Terms("tags", text.split())):
            assert sorted(r["_id"] for r in search(frame, query).collect()) == ["1", "2"]
    like = MoreLikeThis(["tags"], ["achach"], min_doc_freq=1)
    assert sorted(r["_id"] for r in search(frame, like).collect()) == ["1", "2"]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["red", "apple", "sky", "no", "..."]), max_size=4), st.integers(0, 16))
def test_word_lists_of_any_length_agree(docs, words, more):
    wanted = [*words, *(f"absent{i}" for i in range(more))]
    one_by_one = {r["_id"] for w in wanted for r in search(docs, Term("text", w)).collect()}
    assert {r["_id"] for r in search(docs, Terms("text", wanted)).collect()} == one_by_one


def test_lists_of_any_length(spark):
    frame = spark.range(30_000).selectExpr("id AS _id", "IF(id % 3 = 0, 'hot', CAST(id AS string)) AS tag")
    for n in (2, 10_000, 10_001):
        many = [*map(str, range(n)), "none"]
        by_id = search(frame, Ids(many))
        assert by_id.count() == n and "Exchange" not in plan_of(by_id)
        by_tag = search(frame, Terms("tag", [*many, "hot"]), {"tag": "keyword"})
        assert by_tag.count() == sum(i % 3 == 0 or i < n for i in range(30_000))
        assert search(frame, Ids(many), id_column="absent").count() == 0


def test_frames_of_values_are_joined(spark):
    frame = spark.range(30_000).selectExpr("id AS _id", "IF(id % 3 = 0, 'hot', CAST(id AS string)) AS tag", "'x y' AS text")
    listed = spark.createDataFrame(pa.table({"v": [str(i) for i in range(10_001)] + ["hot", "none", None]}))
    found = search(frame, Ids(listed))
    assert found.count() == 10_001
    assert "BroadcastHashJoin" in plan_of(found) and "Exchange hashpartitioning" not in plan_of(found)
    by_tag = search(frame, Terms("tag", listed), {"tag": "keyword"})
    assert by_tag.count() == sum(i % 3 == 0 or i <= 10_000 for i in range(30_000))
    assert search(frame, Ids(listed), id_column="absent").count() == 0
    with pytest.raises(TypeError):
        search(frame, Terms("text", listed))


def test_field_groups(docs):
    group = ids(docs, QueryString("text:(apple OR sky)"))
    assert group == ids(docs, QueryString("text:apple OR text:sky")) != ""
    assert ids(docs, QueryString("status:(new)")) == ids(docs, QueryString("status:new"))
    assert ids(docs, QueryString("text:(red AND (apple OR sky))")) == ids(docs, QueryString("text:red AND (text:apple OR text:sky)"))


def test_more_than_two_edits_are_two(docs):
    for query in (QueryString, SimpleString):
        assert ids(docs, query("appla~5")) == ids(docs, query("appla~2")) == ids(docs, query("appla~12"))


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(alphabet='ab ~"()+|-*?\\/:[]{}^19', max_size=14))
def test_simple_string_never_raises(docs, text):
    search(docs, SimpleString(text))


def test_sample_is_strings(docs):
    sample = sample_documents(docs.drop("tags", "place"), 3)
    assert sample.count() == 3
    assert {t for _, t in sample.dtypes} == {"string"}


def test_complements(spark):
    documents = spark.read.parquet(f"{TABLES}/documents.parquet")
    n = documents.count()
    phrases = [("text", "in the"), ("text", "of the")]
    without = search(documents, BoolMatchPhrase("must-not", phrases)).count()
    assert without + search(documents, BoolMatchPhrase("should", phrases)).count() == n
    one_by_one = [search(documents, Term("text", w)) for w in ("achach", "thre")]
    either = one_by_one[0].union(one_by_one[1]).select("doc_id").distinct().count()
    assert search(documents, Terms("text", ["achach", "thre"])).count() == either
    assert search(documents, Prefix("text", "ach")).count() == search(documents, Wildcard("text", "ach*")).count()
    assert search(documents, Fuzzy("text", "thre", 0)).count() == search(documents, Term("text", "thre")).count()


@pytest.mark.parametrize(
    "table, query, pushed",
    [
        ("events", Term("event_type", "view"), "EqualTo(event_type,view)"),
        ("events", Terms("event_type", ["view", "click"]), "In(event_type, [click,view])"),
        ("events", Range("float", "value", gte="1"), "GreaterThanOrEqual(value,1.0)"),
        ("events", Range("float", "value", lte="2"), "LessThanOrEqual(value,2.0)"),
        ("events", Ids(["1", "2"]), "In(event_id, [1,2])"),
        ("events", Exists("value"), "IsNotNull(value)"),
        ("events", Prefix("event_type", "vi"), "StringStartsWith(event_type,vi)"),
    ],
)
def test_filters_reach_the_scan(spark, table, query, pushed):
    frame = spark.read.parquet(f"{TABLES}/{table}.parquet")
    plan = plan_of(search(frame, query, {"event_type": "keyword"}, id_column="event_id"))
    assert pushed in plan


def test_text_queries_stay_in_spark(spark):
    documents = spark.read.parquet(f"{TABLES}/documents.parquet")
    queries = [
        Match("text", "a b"),
        Fuzzy("text", "achach"),
        QueryString('achach OR "in the"'),
        SimpleString("a + b"),
        MultiMatch(["a", "b"]),
        CommonTerms("text", "in the"),
        MoreLikeThis(["text"], ["in the achach"]),
        Regex("text", "a.*"),
    ]
    for query in queries:
        plan = plan_of(search(documents, query))
        assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan
        assert "Cartesian" not in plan and "NestedLoop" not in plan
    for query in queries[:5]:
        assert "Exchange" not in plan_of(search(documents, query))
