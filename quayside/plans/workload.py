"""Every operator as a query over the given tables, with the SQL it must agree with.

``QUERIES`` maps a name to a function of (session, table folder); ``SQL`` maps
the same names to ANSI SQL over the tables. Queries that write go to a fresh
scratch folder and return what is read back.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from itertools import permutations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.endpoints import (
    AvailableNow,
    Avro,
    Continuous,
    Csv,
    Endpoint,
    File,
    Index,
    Json,
    KeyedTable,
    Orc,
    Parquet,
    RelationalTable,
    Timed,
    Topic,
    Xlsx,
    Xml,
)
from quayside.functions import messages
from quayside.functions.mapping import apply_mapping, stringify
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
    SearchQuery,
    SimpleString,
    Term,
    Terms,
    Wildcard,
    sample_documents,
    search,
)
from quayside.operators.term_table import TermTable, append_terms, search_terms_all
from quayside.plans.route import Route
from quayside.plans.run import run_route
from quayside.sources import topics
from quayside.sources.indexes import search_index, summarise_index
from quayside.sources.registry import read, write
from quayside.sources.storage import scratch_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a query function under a name, with its SQL."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


# --- search ----------------------------------------------------------------

TOKENS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}_]+')"
TEXT_TOKENS = TOKENS.format("text")


def sql_any(words: list[str], field: str = "text") -> str:
    listed = ", ".join(f"'{word}'" for word in words)
    return f"list_has_any({TOKENS.format(field)}, [{listed}])"


def sql_everywhere(word: str) -> str:
    return "(" + " OR ".join(sql_any([word], field) for field in ("text", "lang", "source")) + ")"


def sql_phrase(phrase: str, field: str = "text") -> str:
    return f"contains(' ' || array_to_string({TOKENS.format(field)}, ' ') || ' ', ' {phrase} ')"


def sql_exists(condition: str, field: str = "text") -> str:
    return f"len(list_filter({TOKENS.format(field)}, lambda t: {condition})) > 0"


def search_query(
    name: str, what: SearchQuery, where: str, source: str = "documents", id_column: str = "doc_id", mapping=None
) -> None:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return search(table(spark, folder, source), what, mapping, id_column)

    query(f"search_{name}", f"SELECT * FROM {source} WHERE {where}")(run)


# Oracle distances count bytes: every non-ASCII character is first made one
# ASCII character that the searched word does not hold.
ONE_BYTE = r"regexp_replace(t, '[^\x00-\x7F]', '~', 'g')"
EVENT_KEYWORDS = {"event_type": "keyword", "props": "keyword"}
ORDER_KEYWORDS = {"o_orderstatus": "keyword", "o_orderpriority": "keyword"}

search_query("match_all", MatchAll(), "true")
search_query("match", Match("text", "achach Achen"), sql_any(["achach", "achen"]))
search_query("term", Term("lang", "en"), sql_any(["en"], "lang"))
search_query(
    "term_keyword", Term("event_type", "purchase"), "event_type = 'purchase'", "events", "event_id", EVENT_KEYWORDS
)
search_query("terms", Terms("text", ["achach", "achen", "thre"]), sql_any(["achach", "achen", "thre"]))
search_query(
    "terms_keyword",
    Terms("o_orderstatus", ["F", "P"]),
    "o_orderstatus IN ('F', 'P')",
    "orders",
    "o_orderkey",
    ORDER_KEYWORDS,
)
search_query("prefix", Prefix("text", "achk"), sql_exists("starts_with(t, 'achk')"))
search_query("wildcard", Wildcard("text", "ach*n"), sql_exists("t LIKE 'ach%n'"))
search_query("wildcard_single", Wildcard("text", "th?r*"), sql_exists("t LIKE 'th_r%'"))
search_query(
    "regex",
    Regex("event_type", "(view|cl.*)"),
    "regexp_full_match(event_type, '(view|cl.*)')",
    "events",
    "event_id",
    EVENT_KEYWORDS,
)
search_query("regex_text", Regex("text", "ach[a-e]+n?"), sql_exists("regexp_full_match(t, 'ach[a-e]+n?')"))
search_query("fuzzy", Fuzzy("text", "achach"), sql_exists(f"damerau_levenshtein({ONE_BYTE}, 'achach') <= 2"))
search_query("fuzzy_short", Fuzzy("text", "thre"), sql_exists(f"damerau_levenshtein({ONE_BYTE}, 'thre') <= 1"))
search_query("exists", Exists("lang"), "lang IS NOT NULL")
search_query("ids", Ids(["0", "17", "42", "101", "106", "999", "none"]), "doc_id IN (0, 17, 42, 101, 106, 999)")
search_query(
    "phrase_must",
    BoolMatchPhrase("must", [("text", "in the"), ("lang", "en")]),
    f"{sql_phrase('in the')} AND {sql_any(['en'], 'lang')}",
)
search_query(
    "phrase_must_not",
    BoolMatchPhrase("must-not", [("text", "in the"), ("text", "of the")]),
    f"NOT ({sql_phrase('in the')} OR {sql_phrase('of the')})",
)
search_query(
    "phrase_should",
    BoolMatchPhrase("should", [("text", "in the"), ("text", "of the")]),
    f"{sql_phrase('in the')} OR {sql_phrase('of the')}",
)
search_query(
    "range_int",
    Range("integer", "n_chars", lte="900", gte="300"),
    "n_chars BETWEEN 300 AND 900",
)
search_query(
    "range_long", Range("long", "o_custkey", gte="500"), "o_custkey >= 500", "orders", "o_orderkey", ORDER_KEYWORDS
)
search_query(
    "range_float",
    Range("float", "value", lte="20.5", gte="1.25"),
    "value BETWEEN 1.25 AND 20.5",
    "events",
    "event_id",
    EVENT_KEYWORDS,
)
search_query(
    "range_string",
    Range("string", "o_orderpriority", lte="3-MEDIUM", gte="2-HIGH"),
    "o_orderpriority BETWEEN '2-HIGH' AND '3-MEDIUM'",
    "orders",
    "o_orderkey",
    ORDER_KEYWORDS,
)
search_query(
    "query_string",
    QueryString('(achach OR achk* OR "in the") AND lang:en -thre +n_chars:[300 TO *]'),
    f"""({sql_everywhere('achach')} OR {sql_phrase('in the')} OR {sql_exists("starts_with(t, 'achk')")}
        OR {sql_exists("starts_with(t, 'achk')", "lang")} OR {sql_exists("starts_with(t, 'achk')", "source")})
        AND {sql_any(['en'], 'lang')} AND NOT {sql_everywhere('thre')} AND n_chars >= 300""",
)
search_query(
    "simple_string",
    SimpleString('("in the" | achach) + fr -thre'),
    f"""(({sql_phrase('in the')} OR {sql_everywhere('achach')}) AND {sql_everywhere('fr')})
        OR NOT {sql_everywhere('thre')}""",
)



def sql_loose(words: list[str], slop: int, field: str = "text") -> str:
    """Documents with a place of each of different words, whose starts of the phrase are at most ``slop`` apart."""
    starts = ", ".join(f"p{i}.i - {i}" for i in range(len(words)))
    places = ", ".join(f"places p{i}" for i in range(len(words)))
    same = " AND ".join([f"p{i}.w = '{word}'" for i, word in enumerate(words)] + [f"p{i}.doc_id = p0.doc_id" for i in range(1, len(words))])
    tokens = TOKENS.format(field)
    return f"""SELECT p0.doc_id FROM {places.replace("places", f"(SELECT doc_id, unnest({tokens}) AS w, generate_subscripts({tokens}, 1) AS i FROM documents)")}
        WHERE {same} AND greatest({starts}) - least({starts}) <= {slop}"""


search_query(
    "phrase_gap",
    QueryString('text:"the in"~3 OR text:"anat of the"~6'),
    f"doc_id IN ({sql_loose(['the', 'in'], 3)}) OR doc_id IN ({sql_loose(['anat', 'of', 'the'], 6)})",
)
search_query(
    "phrase_gap_repeated",
    QueryString('text:"in the in"~4'),
    f"""doc_id IN (SELECT a.doc_id FROM {{0}} a, {{0}} b, {{0}} c WHERE a.doc_id = b.doc_id AND a.doc_id = c.doc_id
        AND a.w = 'in' AND b.w = 'the' AND c.w = 'in' AND a.i <> c.i
        AND greatest(a.i, b.i - 1, c.i - 2) - least(a.i, b.i - 1, c.i - 2) <= 4)""".format(
        f"(SELECT doc_id, unnest({TEXT_TOKENS}) AS w, generate_subscripts({TEXT_TOKENS}, 1) AS i FROM documents)"
    ),
)
search_query(
    "simple_gap",
    SimpleString('"thre of"~4 | "onheed"~1'),
    " OR ".join(f"doc_id IN ({sql_loose(['thre', 'of'], 4, field)}) OR {sql_any(['onheed'], field)}" for field in ("text", "lang", "source")),
)

COMMON_WORDS = """
WITH chosen AS (
  SELECT word FROM (
    SELECT word, rare, max(rare::INT) OVER () AS any_rare FROM (
      SELECT w.word,
             count(d.doc_id) <= ceil((SELECT count(*) FROM documents) * 0.01::DOUBLE) AS rare
      FROM (SELECT unnest([{words}]) AS word) w
      LEFT JOIN documents d ON list_contains({tokens}, w.word) GROUP BY w.word))
  WHERE any_rare = 0 OR rare)
SELECT * FROM documents WHERE list_has_any({tokens}, (SELECT list(word) FROM chosen))"""


def common_words(name: str, text: str) -> None:
    words = ", ".join(f"'{word}'" for word in text.split())
    search_query(name, CommonTerms("text", text), "")
    SQL[f"search_{name}"] = COMMON_WORDS.format(words=words, tokens=TEXT_TOKENS)


common_words("common_terms", "in the achach")
common_words("common_terms_all", "in the")
common_words("common_terms_many", "in the of anat ering ble by thre ouen achach achen nowhere else")

LIKE = [
    "achach achen in the of anat nteres onheed ering thre",
    "retitioning ouen the ble whst by thaner erenenst thre in the achach",
]
search_query("mlt", MoreLikeThis(["text"], LIKE), "")
SQL["search_mlt"] = f"""
WITH likes AS (
  SELECT word, count(*) AS tf
  FROM (SELECT unnest(string_split('{" ".join(LIKE)}', ' ')) AS word) GROUP BY word),
freq AS (
  SELECT word, tf, count(*) AS df FROM likes JOIN documents ON list_contains({TEXT_TOKENS}, word)
  GROUP BY word, tf HAVING count(*) >= 5),
best AS (
  SELECT word FROM freq
  ORDER BY round(tf * (1 + ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (df + 1))), 9) DESC, word LIMIT 12)
SELECT * FROM documents
WHERE len(list_intersect({TEXT_TOKENS}, (SELECT list(word) FROM best)))
      >= greatest(1, floor(0.3 * (SELECT count(*) FROM best)))"""

search_query("mlt_fields", MoreLikeThis(["text", "lang"], ["achach onheed thre en fr"], min_doc_freq=2), "")
SQL["search_mlt_fields"] = f"""
WITH likes AS (SELECT unnest(['achach', 'onheed', 'thre', 'en', 'fr']) AS word),
freq AS (
  SELECT 'text' AS field, word, count(*) AS df FROM likes JOIN documents ON list_contains({TEXT_TOKENS}, word)
  GROUP BY word HAVING count(*) >= 2
  UNION ALL
  SELECT 'lang', word, count(*) FROM likes JOIN documents ON list_contains({TOKENS.format("lang")}, word)
  GROUP BY word HAVING count(*) >= 2),
chosen AS (
  SELECT count(*) AS n, list(word) FILTER (field = 'text') AS texts, list(word) FILTER (field = 'lang') AS langs
  FROM freq)
SELECT documents.* FROM documents, chosen
WHERE len(list_intersect({TEXT_TOKENS}, texts)) + len(list_intersect({TOKENS.format("lang")}, langs))
      >= greatest(1, floor(0.3 * n))"""

search_query("multi", MultiMatch(["achach", "en", "thre"]), "")
SQL["search_multi"] = " UNION ALL ".join(
    f"SELECT * FROM documents WHERE {sql_everywhere(word)}" for word in ("achach", "en", "thre")
)
search_query(
    "multi_dedupe",
    MultiMatch(["achach", "en", "thre"], dedupe=True),
    " OR ".join(sql_everywhere(word) for word in ("achach", "en", "thre")),
)



def odd_ids(spark: SparkSession, folder: str) -> DataFrame:
    """As a frame of values: the ids of one event in ten, and some that are none."""
    return table(spark, folder, "events").where("event_id % 10 = 3").selectExpr("CAST(event_id - 5 AS string) AS id")


@query("search_ids_frame", "SELECT * FROM events WHERE event_id IN (SELECT event_id - 5 FROM events WHERE event_id % 10 = 3)")
def _ids_frame(spark, folder):
    return search(table(spark, folder, "events"), Ids(odd_ids(spark, folder)), id_column="event_id")


@query("search_terms_frame", "SELECT * FROM customer WHERE c_mktsegment IN (SELECT c_mktsegment FROM customer WHERE c_acctbal > 9950)")
def _terms_frame(spark, folder):
    customers = table(spark, folder, "customer")
    wanted = customers.where("c_acctbal > 9950").select("c_mktsegment")
    return search(customers, Terms("c_mktsegment", wanted), {"c_mktsegment": "keyword"}, "c_custkey")


search_query(
    "query_string_group",
    QueryString("text:(en OR fr) AND lang:(en)"),
    f"{sql_any(['en', 'fr'])} AND {sql_any(['en'], 'lang')}",
)
search_query(
    "simple_fuzzy",
    SimpleString("achach~7"),
    " OR ".join(sql_exists(f"damerau_levenshtein({ONE_BYTE}, 'achach') <= 2", field) for field in ("text", "lang", "source")),
)

# --- searches by a table of terms ---------------------------------------------


def in_parts(spark: SparkSession, folder: str, parts: int) -> tuple[DataFrame, TermTable]:
    """All documents, and a table of the terms of their texts that was appended to in some batches."""
    documents = table(spark, folder, "documents")
    terms = TermTable(f"{scratch_folder(spark, 'terms')}/documents", ["text"], "doc_id", buckets=16)
    for part in range(parts):
        append_terms(documents.where(F.pmod(F.hash("doc_id"), F.lit(parts)) == part) if parts > 1 else documents, terms)
    return documents, terms


def term_queries(name: str, parts: int, queries: dict[str, tuple[SearchQuery, str]]) -> None:
    """The hits of several queries that one table of terms answers, with the name of the query."""

    @query(f"terms_{name}", "\nUNION ALL\n".join(f"SELECT '{label}' AS query, * FROM ({sql})" for label, (_, sql) in queries.items()))
    def run(spark, folder):
        documents, terms = in_parts(spark, folder, parts)
        return search_terms_all(documents, {label: what for label, (what, _) in queries.items()}, terms)


def where(condition: str) -> str:
    return f"SELECT * FROM documents WHERE {condition}"


term_queries(
    "words",
    1,
    {
        "match": (Match("text", "achach Achen"), where(sql_any(["achach", "achen"]))),
        "term": (Term("text", "thre"), where(sql_any(["thre"]))),
        "terms": (Terms("text", ["achach", "achen", "in", "no such"]), where(sql_any(["achach", "achen", "in"]))),
        "phrase": (
            BoolMatchPhrase("must", [("text", "in the"), ("text", "of the")]),
            where(f"{sql_phrase('in the')} AND {sql_phrase('of the')}"),
        ),
    },
)
term_queries(
    "patterns",
    2,
    {
        "prefix": (Prefix("text", "achk"), where(sql_exists("starts_with(t, 'achk')"))),
        "wildcard": (Wildcard("text", "*rane*"), where(sql_exists("contains(t, 'rane')"))),
        "ends": (Wildcard("text", "ach*n"), where(sql_exists("t LIKE 'ach%n'"))),
        "single": (Wildcard("text", "?h?r"), where(sql_exists("t LIKE '_h_r'"))),
        "regex": (Regex("text", "ach[a-e]+n?"), where(sql_exists("regexp_full_match(t, 'ach[a-e]+n?')"))),
    },
)
term_queries(
    "fuzzy",
    2,
    {
        "long": (Fuzzy("text", "achach"), where(sql_exists(f"damerau_levenshtein({ONE_BYTE}, 'achach') <= 2"))),
        "short": (Fuzzy("text", "thre"), where(sql_exists(f"damerau_levenshtein({ONE_BYTE}, 'thre') <= 1"))),
    },
)
term_queries(
    "frequencies",
    3,
    {
        "some": (CommonTerms("text", "in the achach"), SQL["search_common_terms"]),
        "all": (CommonTerms("text", "in the"), SQL["search_common_terms_all"]),
        "alike": (MoreLikeThis(["text"], LIKE), SQL["search_mlt"]),
    },
)

LABELLED_SQL = "documents LEFT JOIN labels USING (doc_id)"


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their labels, NULL where there is none."""
    return table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")


@query("search_exists_partial", f"SELECT * FROM {LABELLED_SQL} WHERE quality IS NOT NULL")
def _exists_partial(spark, folder):
    return search(labelled(spark, folder), Exists("quality"), id_column="doc_id")


@query("search_not_null_safe", f"SELECT * FROM {LABELLED_SQL} WHERE (toxic = 1) IS NOT TRUE")
def _not_null_safe(spark, folder):
    return search(labelled(spark, folder), QueryString("-toxic:1"), id_column="doc_id")


@query(
    "sample_docs",
    "SELECT least(10, count(*))::BIGINT AS sampled, least(10, count(*))::BIGINT AS documents FROM documents",
)
def _sample_docs(spark, folder):
    """How many samples there are, and how many of them are whole documents of the table."""
    documents = table(spark, folder, "documents")
    known = documents.select([F.col(c).cast("string").alias(c) for c in documents.columns]).withColumn("known", F.lit(1))
    found = sample_documents(documents).join(known, documents.columns, "left")
    return found.agg(F.count(F.lit(1)).alias("sampled"), F.count("known").alias("documents"))


# --- file formats and save modes -------------------------------------------


def round_trip(name: str, fmt, source: str) -> None:
    @query(name, f"SELECT * FROM {source}")
    def run(spark, folder):
        rows = table(spark, folder, source)
        target = File(fmt, f"{scratch_folder(spark, name)}/out", schema=rows.schema)
        write(rows, target, "errorifexists")
        return read(spark, target)


for _name, _fmt, _source in [
    ("fmt_json", Json(), "orders"),
    ("fmt_csv", Csv(multiline=True), "documents"),
    ("fmt_csv_semicolon", Csv(separator=";"), "events"),
    ("fmt_parquet_snappy", Parquet("snappy"), "lineitem"),
    ("fmt_parquet_gzip", Parquet("gzip"), "lineitem"),
    ("fmt_parquet_none", Parquet(), "lineitem"),
    ("fmt_orc_snappy", Orc("snappy"), "lineitem"),
    ("fmt_orc_zlib", Orc("zlib"), "lineitem"),
    ("fmt_orc_lzo", Orc("lzo"), "lineitem"),
    ("fmt_orc_none", Orc(), "lineitem"),
    ("fmt_avro", Avro(), "lineitem"),
    ("fmt_xml", Xml("orders", "order"), "orders"),
    ("fmt_xml_text", Xml("documents", "document"), "documents"),
    ("fmt_xlsx", Xlsx(), "orders"),
]:
    round_trip(_name, _fmt, _source)


@query(
    "fmt_xlsx_inferred",
    "SELECT event_id::DOUBLE AS event_id, ts, user_id::DOUBLE AS user_id, event_type, value, props FROM events",
)
def _xlsx_inferred(spark, folder):
    target = File(Xlsx(), f"{scratch_folder(spark, 'xlsx')}/out")
    write(table(spark, folder, "events"), target, "errorifexists")
    return read(spark, target)


@query("fmt_csv_inferred", "SELECT * FROM orders")
def _csv_inferred(spark, folder):
    rows = table(spark, folder, "orders")
    target = File(Csv(infer_schema=True), f"{scratch_folder(spark, 'csv')}/out")
    write(rows, target, "errorifexists")
    found = read(spark, target)
    # Inference knows the least type that holds all values; the table's keys are wider.
    types = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderdate": "timestamp_ntz"}
    return found.withColumns({name: found[name].cast(kind) for name, kind in types.items()})


def two_writes(spark, folder, first: str, second: str, mode: str) -> DataFrame:
    target = File(Parquet("snappy"), f"{scratch_folder(spark, mode)}/out")
    write(table(spark, folder, first), target, "errorifexists")
    write(table(spark, folder, second), target, mode)
    return read(spark, target)


@query("mode_overwrite", "SELECT * FROM orders")
def _mode_overwrite(spark, folder):
    return two_writes(spark, folder, "customer", "orders", "overwrite")


@query("mode_append", "SELECT * FROM orders UNION ALL SELECT * FROM orders")
def _mode_append(spark, folder):
    return two_writes(spark, folder, "orders", "orders", "append")


@query("mode_ignore", "SELECT * FROM customer")
def _mode_ignore(spark, folder):
    return two_writes(spark, folder, "customer", "orders", "ignore")


@query("mode_error", "SELECT *, true AS refused FROM customer")
def _mode_error(spark, folder):
    target = File(Parquet("snappy"), f"{scratch_folder(spark, 'error')}/out")
    rows = table(spark, folder, "customer")
    write(rows, target, "errorifexists")
    try:
        write(table(spark, folder, "orders"), target, "errorifexists")
        refused = False
    except Exception as error:
        if "ALREADY_EXISTS" not in str(error):
            raise
        refused = True
    return read(spark, target).withColumn("refused", F.lit(refused))


def conversion(first_name: str, first, second_name: str, second) -> None:
    name = f"convert_{first_name}_to_{second_name}"

    @query(name, "SELECT * FROM orders")
    def run(spark, folder):
        rows = table(spark, folder, "orders")
        root = scratch_folder(spark, name)
        source = File(first, f"{root}/in", schema=rows.schema)
        target = File(second, f"{root}/out", schema=rows.schema)
        write(rows, source, "errorifexists")
        run_route(spark, Route(source, target, save_mode="overwrite"))
        return read(spark, target)


FORMATS = {
    "json": Json(),
    "csv": Csv(separator=";"),
    "parquet": Parquet("snappy"),
    "orc": Orc("zlib"),
    "avro": Avro(),
    "xml": Xml("orders", "order"),
    "xlsx": Xlsx(),
}
for _from, _to in permutations(FORMATS, 2):
    conversion(_from, FORMATS[_from], _to, FORMATS[_to])


# --- tables, topics, indexes -----------------------------------------------


@query("table_roundtrip", "SELECT * FROM customer")
def _table_roundtrip(spark, folder):
    target = RelationalTable("sales.customer", folder=scratch_folder(spark, "tables"))
    write(table(spark, folder, "customer"), target, "errorifexists")
    return read(spark, target)


@query(
    "keyed_upsert",
    """SELECT event_id, ts, user_id, event_type,
              CASE WHEN event_type = 'purchase' THEN -value ELSE value END AS value, props FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def _keyed_upsert(spark, folder):
    events = table(spark, folder, "events")
    target = KeyedTable(
        "shop",
        "last_event",
        folder=scratch_folder(spark, "keyed"),
        keys=("user_id", "event_type"),
        order_by=("ts", "event_id"),
    )
    write(events, target, "append")
    write(events.where("event_type = 'purchase'").withColumn("value", -F.col("value")), target, "append")
    return read(spark, target)


@query("keyed_after_empty", "SELECT * FROM orders")
def _keyed_after_empty(spark, folder):
    """A table whose first write has no rows, then the finished ones, changed, then all."""
    orders = table(spark, folder, "orders")
    target = KeyedTable("shop", "orders", folder=scratch_folder(spark, "keyed"), keys=("o_orderkey",))
    finished = orders.where("o_orderstatus = 'F'").withColumn("o_orderpriority", F.lower("o_orderpriority"))
    for rows in (orders.limit(0), finished, orders):
        write(rows, target, "append")
    return read(spark, target)


def written_twice(spark, folder) -> DataFrame:
    """All documents of an index that took every document two times."""
    documents = table(spark, folder, "documents")
    index = Index("documents", folder=scratch_folder(spark, "index"))
    write(documents, index)
    write(documents, index)
    return read(spark, index)


@query("index_bulk", "SELECT * FROM documents UNION ALL SELECT * FROM documents")
def _index_bulk(spark, folder):
    return written_twice(spark, folder).drop("_id")


@query("index_ids", "SELECT 2 * count(*) AS documents, 2 * count(*) AS ids FROM documents")
def _index_ids(spark, folder):
    counts = F.count(F.lit(1)).alias("documents"), F.count_distinct("_id").alias("ids")
    return written_twice(spark, folder).agg(*counts)


@query("index_by_id", "SELECT *, doc_id::VARCHAR AS _id FROM documents")
def _index_by_id(spark, folder):
    index = Index("documents", folder=scratch_folder(spark, "index"), id_column="doc_id")
    write(table(spark, folder, "documents"), index)
    return search(read(spark, index), MatchAll())


def events_topic(spark, folder, key: str | None = None) -> Topic:
    """The events as a topic."""
    events = table(spark, folder, "events")
    topic = Topic("events", folder=scratch_folder(spark, "topic"), schema=events.schema, key=key)
    write(events, topic)
    return topic


def with_keys(spark, topic: Topic) -> DataFrame:
    """Message values as columns, with the message key."""
    raw = topics.read_messages(spark, topic)
    parsed = F.from_json(F.col("value").cast("string"), topic.schema, messages.JSON_OPTIONS)
    return raw.select(F.col("key").cast("string").alias("key"), parsed.alias("row")).select("key", "row.*")


@query("topic_batch_read", "SELECT * FROM events")
def _topic_batch_read(spark, folder):
    return read(spark, events_topic(spark, folder))


@query(
    "topic_batch_inferred",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, user_id, event_type, value, props FROM events""",
)
def _topic_batch_inferred(spark, folder):
    # Without a schema a timestamp is a text.
    return read(spark, replace(events_topic(spark, folder), schema=None))


@query("topic_publish_json", "SELECT *, NULL::VARCHAR AS key FROM events")
def _topic_publish_json(spark, folder):
    return with_keys(spark, events_topic(spark, folder))


@query("topic_publish_column_key", "SELECT *, event_id::VARCHAR AS key FROM events")
def _topic_publish_column_key(spark, folder):
    return with_keys(spark, events_topic(spark, folder, "event_id"))


@query("topic_publish_keyed", "SELECT count(*) AS messages, count(*) AS keys, sum(event_id)::BIGINT AS ids FROM events")
def _topic_publish_keyed(spark, folder):
    rows = with_keys(spark, events_topic(spark, folder, "uuid"))
    return rows.agg(
        F.count(F.lit(1)).alias("messages"), F.count_distinct("key").alias("keys"), F.sum("event_id").alias("ids")
    )


@query(
    "row_json_keep_nulls",
    f"SELECT doc_id, text, quality, toxic, 7 AS n_fields FROM {LABELLED_SQL}",
)
def _row_json_keep_nulls(spark, folder):
    rows = labelled(spark, folder)
    texts = rows.select(messages.row_to_json(rows, keep_nulls=True).alias("value"))
    parsed = F.from_json("value", rows.schema, messages.JSON_OPTIONS)
    n_fields = F.size(F.json_object_keys("value")).alias("n_fields")
    return texts.select(parsed.alias("row"), n_fields).select(
        "row.doc_id", "row.text", "row.quality", "row.toxic", "n_fields"
    )


@query("json_parse", "SELECT (props::JSON ->> '$.k')::BIGINT AS k FROM events")
def _json_parse(spark, folder):
    props = table(spark, folder, "events").select(F.col("props").alias("value"))
    return messages.json_to_columns(props, messages.infer_json_schema(props), mode="FAILFAST")


def mixed_messages(spark, folder) -> DataFrame:
    """Events as JSON messages among conversation texts, which are no JSON objects."""
    events = table(spark, folder, "events")
    good = events.select(messages.row_to_json(events).alias("value"))
    bad = table(spark, folder, "conversations").select(F.col("text").alias("value"))
    return messages.json_to_columns(good.unionByName(bad), events.schema)


@query("json_quarantine", "SELECT text AS value FROM conversations")
def _json_quarantine(spark, folder):
    return messages.malformed(mixed_messages(spark, folder))


@query("json_well_formed", "SELECT * FROM events")
def _json_well_formed(spark, folder):
    return messages.well_formed(mixed_messages(spark, folder))


@query(
    "stringify",
    "SELECT conv_id::VARCHAR AS conv_id, turn::VARCHAR AS turn, role, text FROM conversations",
)
def _stringify(spark, folder):
    return stringify(table(spark, folder, "conversations"))


@query("apply_mapping", "SELECT * FROM orders")
def _apply_mapping(spark, folder):
    kinds = {
        "o_orderkey": {"type": "long"},
        "o_custkey": {"type": "long"},
        "o_totalprice": {"type": "double"},
        "o_orderdate": {"type": "date"},
        "o_orderstatus": {"type": "keyword"},
    }
    typed = apply_mapping(stringify(table(spark, folder, "orders")), {"properties": kinds})
    return typed.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


TURNS = "array<struct<turn:string,role:string,text:string>>"


def threads(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as documents with their turns inside, all values strings, and the title and language of a document."""
    turns = stringify(table(spark, folder, "conversations"))
    turns = turns.groupBy("conv_id").agg(F.collect_list(F.struct("turn", "role", "text")).cast(TURNS).alias("turns"))
    documents = stringify(table(spark, folder, "documents")).select("doc_id", F.struct("lang", "n_chars").alias("about"))
    return turns.join(documents, F.col("conv_id") == F.col("doc_id"), "left").drop("doc_id")


THREADS = "FROM conversations c LEFT JOIN documents d ON d.doc_id = c.conv_id GROUP BY c.conv_id"


@query(
    "apply_mapping_nested",
    """SELECT conv_id, turn, 2 * turn AS twice, c.role, c.text, n_chars + 1 AS n_chars
       FROM conversations c LEFT JOIN documents d ON d.doc_id = c.conv_id""",
)
def _apply_mapping_nested(spark, folder):
    about = {"properties": {"n_chars": {"type": "long"}, "lang": {"type": "keyword"}}}
    turns = {"type": "nested", "properties": {"turn": {"type": "long"}, "text": {"type": "text"}}}
    typed = apply_mapping(threads(spark, folder), {"properties": {"conv_id": {"type": "long"}, "about": about, "turns": turns}})
    rows = typed.select("conv_id", (F.col("about.n_chars") + 1).alias("n_chars"), F.inline("turns"))
    return rows.withColumn("twice", 2 * F.col("turn"))


def nested_search(name: str, what: SearchQuery, having: str, mapping=None) -> None:
    @query(f"search_nested_{name}", f"SELECT c.conv_id, count(*) AS n_turns {THREADS} HAVING {having}")
    def run(spark, folder):
        typed = apply_mapping(threads(spark, folder), {"conv_id": "long", "turns.turn": "long", "about.n_chars": "long"})
        found = search(typed, what, mapping, "conv_id")
        return found.select("conv_id", F.size("turns").cast("long").alias("n_turns"))


nested_search("path", Match("turns.text", "achach anat"), f"bool_or({sql_any(['achach', 'anat'], 'c.text')})")
nested_search("phrase", BoolMatchPhrase("must", [("turns.text", "of the")]), f"bool_or({sql_phrase('of the', 'c.text')})")
nested_search("keyword", Term("turns.role", "system"), "bool_or(c.role = 'system')", {"turns": {"properties": {"role": {"type": "keyword"}}}})
nested_search("range", Range("long", "turns.turn", gte="6"), "max(turn) >= 6")
nested_search("struct", Exists("about.lang"), "count(d.lang) > 0")
nested_search(
    "query_string",
    QueryString("turns.text:thre* AND -about.lang:en OR turns.role:(system)"),
    f"""NOT coalesce(any_value(d.lang) = 'en', false)
        AND bool_or({sql_exists("starts_with(t, 'thre')", 'c.text')})""",
)
nested_search("everywhere", QueryString("achach"), f"bool_or({sql_any(['achach'], 'c.text')})")


# --- files that a search need not read ----------------------------------------


def bitmap_query(name: str, what: SearchQuery, where: str) -> None:
    """Documents in several files, most of them with a bitmap of their tokens, the last ones written later."""

    @query(f"skipped_{name}", f"SELECT * FROM documents WHERE {where}")
    def run(spark, folder):
        documents = table(spark, folder, "documents")
        index = Index("documents", folder=scratch_folder(spark, "bitmaps"), id_column="doc_id")
        write(documents.where("doc_id % 5 > 0").repartitionByRange(12, "doc_id"), index)
        summarise_index(spark, index, ["text"])
        write(documents.where("doc_id % 5 = 0"), index)
        return search_index(spark, index, what).drop("_id")


bitmap_query("match", Match("text", "achach"), sql_any(["achach"]))
bitmap_query("phrase", BoolMatchPhrase("must", [("text", "anat of")]), sql_phrase("anat of"))


# --- datasets and streams --------------------------------------------------


def language_folders(spark, folder, root: str) -> File:
    """Documents as JSON, one sub-folder per language."""
    documents = table(spark, folder, "documents")
    documents.withColumn("folder", F.col("lang")).write.partitionBy("folder").json(f"{root}/in")
    return File(Json(), f"{root}/in", schema=documents.schema, datasets=True)


@query("ingest_datasets", "SELECT *, 'folder=' || lang AS dataset FROM documents")
def _ingest_datasets(spark, folder):
    root = scratch_folder(spark, "datasets")
    source = language_folders(spark, folder, root)
    target = File(Parquet(), f"{root}/out", schema=source.schema, datasets=True)
    run_route(spark, Route(source, target, save_mode="errorifexists"))
    return read(spark, target)


@query(
    "ingest_mixed_headers",
    """SELECT doc_id, text, CASE WHEN lang = 'en' THEN lang END AS lang, CASE WHEN lang <> 'en' THEN source END AS source, n_chars
       FROM documents WHERE lang IS NOT NULL""",
)
def _ingest_mixed_headers(spark, folder):
    """CSV folders with other columns in another order, read at once."""
    root, documents = scratch_folder(spark, "headers"), table(spark, folder, "documents")
    fmt = Csv(separator=";", multiline=True)
    write(documents.where("lang = 'en'").select("doc_id", "lang", "text", "n_chars"), File(fmt, f"{root}/in/english"), "errorifexists")
    write(documents.where("lang <> 'en'").select("text", "n_chars", "source", "doc_id"), File(fmt, f"{root}/in/others"), "errorifexists")
    target = File(Parquet(), f"{root}/out", schema=documents.schema)
    run_route(spark, Route(File(fmt, f"{root}/in", schema=documents.schema), target, save_mode="overwrite"))
    return read(spark, target)


@query("ingest_datasets_xlsx", "SELECT *, 'folder=' || event_type AS dataset FROM events")
def _ingest_datasets_xlsx(spark, folder):
    root = scratch_folder(spark, "datasets")
    events = table(spark, folder, "events")
    events.withColumn("folder", F.col("event_type")).write.partitionBy("folder").parquet(f"{root}/in")
    source = File(Parquet(), f"{root}/in", schema=events.schema, datasets=True)
    target = File(Xlsx(), f"{root}/out", schema=events.schema, datasets=True)
    run_route(spark, Route(source, target, save_mode="errorifexists"))
    return read(spark, target)


@query("ingest_to_table", "SELECT * FROM documents")
def _ingest_to_table(spark, folder):
    root = scratch_folder(spark, "datasets")
    source = replace(language_folders(spark, folder, root), datasets=False)
    target = RelationalTable("documents", folder=f"{root}/tables")
    run_route(spark, Route(source, target, save_mode="overwrite"))
    return read(spark, target)


@query("ingest_incremental", "SELECT * FROM orders")
def _ingest_incremental(spark, folder):
    root = scratch_folder(spark, "incremental")
    orders = table(spark, folder, "orders")
    source = File(Json(), f"{root}/in", schema=orders.schema, checkpoint=f"{root}/checkpoint")
    target = File(Parquet(), f"{root}/out", schema=orders.schema)
    route = Route(source, target, save_mode="append")
    orders.where("o_orderstatus = 'F'").write.json(f"{root}/in/finished")
    run_route(spark, route)
    run_route(spark, route)
    orders.where("o_orderstatus <> 'F'").write.json(f"{root}/in/others")
    run_route(spark, route)
    return read(spark, target)


def follow(topic: Topic, **changes) -> Topic:
    """The topic as a stream that stops when it has caught up."""
    return replace(topic, mode=AvailableNow(), checkpoint=f"{topic.folder}/checkpoint", **changes)


def mirrored(spark, folder, keep_key: bool) -> DataFrame:
    source = events_topic(spark, folder, "event_id")
    target = replace(source, name="copy")
    run_route(spark, Route(follow(source, keep_key=keep_key), target))
    return with_keys(spark, target)


@query("stream_mirror", "SELECT *, NULL::VARCHAR AS key FROM events")
def _stream_mirror(spark, folder):
    return mirrored(spark, folder, keep_key=False)


@query("stream_mirror_keyed", "SELECT *, event_id::VARCHAR AS key FROM events")
def _stream_mirror_keyed(spark, folder):
    return mirrored(spark, folder, keep_key=True)


@query("stream_topic_to_table", "SELECT * FROM events")
def _stream_topic_to_table(spark, folder):
    topic = events_topic(spark, folder)
    target = RelationalTable("events", folder=f"{topic.folder}/tables")
    run_route(spark, Route(follow(topic), target, save_mode="append"))
    return read(spark, target)


@query("stream_available_now", "SELECT * FROM events UNION ALL SELECT * FROM events")
def _stream_available_now(spark, folder):
    topic = events_topic(spark, folder)
    target = File(Parquet(), f"{topic.folder}/out", schema=topic.schema)
    route = Route(follow(topic), target, save_mode="append")
    run_route(spark, route)
    run_route(spark, route)
    write(table(spark, folder, "events"), topic)
    run_route(spark, route)
    return read(spark, target)


def followed_live(spark, folder, mode) -> DataFrame:
    """The events as a table that a running stream fills while they are published in two parts."""
    topic = events_topic(spark, folder)
    target = RelationalTable("events", folder=f"{topic.folder}/tables")
    source = replace(topic, mode=mode, checkpoint=f"{topic.folder}/checkpoint")
    running = run_route(spark, Route(source, target, save_mode="append")).query
    try:
        running.processAllAvailable()
        write(table(spark, folder, "events"), topic)
        running.processAllAvailable()
    finally:
        running.stop()
    return read(spark, target)


@query("stream_timed", "SELECT * FROM events UNION ALL SELECT * FROM events")
def _stream_timed(spark, folder):
    return followed_live(spark, folder, Timed(0.5))


@query("stream_continuous", "SELECT * FROM events UNION ALL SELECT * FROM events")
def _stream_continuous(spark, folder):
    return followed_live(spark, folder, Continuous())


@query("stream_latest", "SELECT * FROM events")
def _stream_latest(spark, folder):
    # Messages from before the first run are skipped, those published after it are not.
    topic = events_topic(spark, folder)
    target = RelationalTable("events", folder=f"{topic.folder}/tables")
    route = Route(follow(topic, offset="latest"), target, save_mode="append")
    run_route(spark, route)
    write(table(spark, folder, "events"), topic)
    run_route(spark, route)
    return read(spark, target)


@query(
    "stream_without_schema",
    """SELECT event_id, event_type, NULL::DOUBLE AS value, NULL::VARCHAR AS props FROM events WHERE event_id % 2 = 0
       UNION ALL SELECT event_id, NULL, value, props FROM events WHERE event_id % 2 = 1
       UNION ALL SELECT event_id, event_type, NULL, NULL FROM events WHERE event_type = 'purchase'""",
)
def _stream_without_schema(spark, folder):
    """Messages whose fields become more from one run of a stream to the next."""
    events = table(spark, folder, "events")
    topic = Topic("events", folder=scratch_folder(spark, "topic"))
    target = Index("events", folder=f"{topic.folder}/indexes")
    route = Route(follow(topic), target)
    few = events.select("event_id", "event_type")
    for rows in (few.where("event_id % 2 = 0"), events.where("event_id % 2 = 1").select("event_id", "value", "props"), few.where("event_type = 'purchase'")):
        write(rows, topic)
        run_route(spark, route)
    return read(spark, target).drop("_id")


@query("stream_quarantine", "SELECT text AS value FROM conversations")
def _stream_quarantine(spark, folder):
    topic = events_topic(spark, folder)
    no_key = F.lit(None).cast("string").alias("key")
    bad = table(spark, folder, "conversations").select(no_key, F.col("text").alias("value"))
    topics.publish(bad, topic)
    source = follow(topic, malformed=f"{topic.folder}/malformed")
    target = RelationalTable("events", folder=f"{topic.folder}/tables")
    run_route(spark, Route(source, target, save_mode="append"))
    return read(spark, File(Json(), source.malformed, schema=bad.select("value").schema))


# --- routes between all kinds of endpoints ---------------------------------

PURCHASES = Term("event_type", "purchase")


def endpoint(kind: str, root: str, schema) -> Endpoint:
    if kind == "file":
        return File(Json(), f"{root}/files", schema=schema)
    if kind == "relational":
        return RelationalTable("events", folder=f"{root}/relational")
    if kind == "keyed":
        return KeyedTable("shop", "events", folder=f"{root}/keyed", keys=("event_id",))
    if kind == "index":
        return Index("events", folder=f"{root}/indexes")
    return Topic("events", folder=f"{root}/topics", schema=schema)


def needs_mode(kind: str) -> str | None:
    return None if kind in ("index", "topic") else "overwrite"


def route_query(source_kind: str, target_kind: str) -> None:
    name = f"route_{source_kind}_to_{target_kind}"
    searched = source_kind == "index"

    @query(name, "SELECT * FROM events" + (" WHERE event_type = 'purchase'" if searched else ""))
    def run(spark, folder):
        events = table(spark, folder, "events")
        root = scratch_folder(spark, name)
        source = endpoint(source_kind, f"{root}/in", events.schema)
        target = endpoint(target_kind, f"{root}/out", events.schema)
        write(events, source, needs_mode(source_kind))
        chosen = {"search": PURCHASES, "mapping": {"event_type": "keyword"}} if searched else {}
        run_route(spark, Route(source, target, save_mode=needs_mode(target_kind), **chosen))
        return read(spark, target).drop("_id")


for _source_kind in ("file", "relational", "keyed", "index", "topic"):
    for _target_kind in ("file", "relational", "keyed", "index", "topic"):
        route_query(_source_kind, _target_kind)


def search_to_file(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that match a text, from an index to a JSON folder."""
    documents = table(spark, folder, "documents")
    root = scratch_folder(spark, "search")
    index = Index("documents", folder=f"{root}/in", id_column="doc_id")
    target = File(Json(), f"{root}/out", schema=documents.schema)
    write(documents, index)
    run_route(spark, Route(index, target, save_mode="overwrite", search=Match("text", "the achach")))
    return read(spark, target)


query("search_to_file", f"SELECT * FROM documents WHERE {sql_any(['the', 'achach'])}")(search_to_file)
