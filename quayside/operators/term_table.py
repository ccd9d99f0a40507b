"""A table of the terms of a collection, for searches that come again and again.

``append_terms`` cuts the text fields of a batch of documents into tokens once and
writes four Parquet tables, all bucketed by a hash:

``postings``  (field, term, id, positions): one row per document and term
``words``     (field, term, n_docs): the dictionary, one row per batch and term
``variants``  (field, term, variant): what is left of the start of a term after up to two deletions
``grams``     (field, term, gram): its runs of three characters, ends marked

A batch counts once its row in ``batches`` is written, which is the last thing that
happens; what an append that failed has left behind is never read.

``search_terms`` answers a query from these tables: it looks up the terms that meet the
query, reads the postings of their buckets, and keeps the documents with those ids. The
documents are not cut into tokens again, and the dictionary is scanned as a whole only
by a pattern in which no three characters are required. The rows are those of
``search``; a query that the tables cannot answer goes to ``search``. Document
frequencies are sums over the dictionary, so that common terms and more-like-this
count nothing in the documents.

Documents are cut once and their texts stay where they are: only postings are shuffled.
A frequent term is written by several tasks, as rows are dealt by bucket and, within it,
by a hash of their ids. Nothing but sums (two numbers a batch, one a word of the query)
reaches the driver.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType

from quayside.functions import tokens as tk
from quayside.operators.fields import Documents, wildcard_to_like
from quayside.operators.search import (
    BoolMatchPhrase,
    CommonTerms,
    Fuzzy,
    Match,
    MoreLikeThis,
    Prefix,
    Regex,
    SearchQuery,
    Term,
    Terms,
    Wildcard,
    search,
)
from quayside.sources.storage import exists

# Characters of a term that variants are made of: whole terms would have three times as many. The starts of two terms
# that are two edits apart have a common part that misses at most two characters of each.
VARIED = 5
# Parts that a bucket is dealt in, and documents whose tokens are grouped at once.
PARTS, DOCUMENTS = 64, 1_000
FIRST, LAST = "\x02", "\x03"


@dataclass(frozen=True)
class TermTable:
    """Where the terms of some text fields are kept, and how they are spread."""

    folder: str
    fields: Sequence[str]
    id_column: str = "_id"
    buckets: int = 64

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.hash(key), F.lit(self.buckets))


# --- writing -----------------------------------------------------------------


def _without_one(word: Column) -> Column:
    """All that deleting one character of a word can leave; an empty word leaves nothing."""
    cut = F.transform(
        F.sequence(F.lit(1), F.length(word)),
        lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))),
    )
    return F.when(F.length(word) > 0, cut).otherwise(F.array().cast("array<string>"))


def variants_of(term: Column) -> Column:
    """The term, and what is left of it after one and after two deletions."""
    one = F.array_distinct(_without_one(term))
    two = F.flatten(F.transform(one, _without_one))
    return F.array_distinct(F.concat(F.array(term), one, two))


def _variants(word: str, edits: int) -> list[str]:
    found = {word}
    for _ in range(edits):
        found |= {w[:i] + w[i + 1 :] for w in found for i in range(len(w))}
    return sorted(found)


def grams_of(term: Column) -> Column:
    """The runs of three characters of a term between its end marks."""
    marked = F.concat(F.lit(FIRST), term, F.lit(LAST))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(term)), lambda i: F.substring(marked, i, F.lit(3))))


def _write(rows: DataFrame, table: TermTable, name: str, batch: str, key: str, within: str, *order: str) -> None:
    """Rows by the bucket of their key, each bucket in parts by a hash of another column, and sorted in each part."""
    rows = rows.withColumn("bucket", table.bucket(F.col(key)))
    rows = rows.repartition("bucket", F.pmod(F.xxhash64(within), F.lit(PARTS))).sortWithinPartitions("bucket", *order)
    rows.write.partitionBy("bucket").parquet(f"{table.path(name)}/batch={batch}")


def _postings_of(texts: DataFrame) -> DataFrame:
    """One row per id, field and term with its places, of rows with the tokens of a field (id, field, tokens)."""

    def group(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, DOCUMENTS):
                part = batch.slice(start, DOCUMENTS)
                lists = part.column(2)
                sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                row = np.repeat(np.arange(len(sizes)), sizes)
                place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                terms = lists.flatten().dictionary_encode()
                key = row * len(terms.dictionary) + terms.indices.to_numpy()
                order = np.argsort(key, kind="stable")
                first = np.flatnonzero(np.diff(key[order], prepend=-1))
                rows = pa.array(row[order[first]])
                places = pa.ListArray.from_arrays(
                    pa.array(np.append(first, len(key)), pa.int32()), pa.array(place[order], pa.int32())
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(rows), part.column(1).take(rows), terms.take(pa.array(order[first])).dictionary_decode(), places],
                    names=["id", "field", "term", "positions"],
                )

    id_type = texts.schema["id"].dataType.simpleString()
    return texts.select("id", "field", "tokens").mapInArrow(group, f"id {id_type}, field string, term string, positions array<int>")


def append_terms(docs: DataFrame, table: TermTable, mapping: Mapping | None = None) -> str:
    """Add the terms of new documents and return the name of their batch. An id names one document."""
    spark, batch = docs.sparkSession, f"b{uuid.uuid4().hex}"
    described = Documents(docs, mapping, table.id_column)
    identity = F.col(f"`{table.id_column}`")
    counts = docs.groupBy(identity.alias("id")).count()
    if not counts.where("id is null or count > 1").isEmpty():
        raise ValueError(f"{table.id_column} must name every document, and only one")
    listed = []
    for name in table.fields:
        field = described.field(name)
        if not field.is_text:
            raise ValueError(f"{name} is no text field")
        listed.append(F.struct(F.lit(name).alias("field"), field.token_array().alias("tokens")))
    rows = docs.select(identity.alias("id"), F.explode(F.array(*listed)).alias("_f")).select("id", "_f.field", "_f.tokens")
    _write(_postings_of(rows), table, "postings", batch, "term", "id", "field", "term", "id")
    id_type = docs.schema[table.id_column].dataType
    own = _all(spark, table, "postings", id_type).where(F.col("batch") == batch)
    _write(own.groupBy("field", "term").agg(F.count("*").alias("n_docs")), table, "words", batch, "term", "term", "field", "term")
    own = _all(spark, table, "words").where(F.col("batch") == batch).select("field", "term")
    new = own.join(_read(spark, table, "words").select("field", "term"), ["field", "term"], "left_anti")
    varied = new.select("field", "term", F.explode(variants_of(F.substring("term", 1, VARIED))).alias("variant"))
    _write(varied, table, "variants", batch, "variant", "term", "variant")
    _write(new.select("field", "term", F.explode(grams_of(F.col("term"))).alias("gram")), table, "grams", batch, "gram", "term", "gram", "term")
    written = docs.agg(F.lit(batch).alias("batch"), F.count("*").alias("n_docs"))
    written.coalesce(1).write.mode("append").parquet(table.path("batches"))
    return batch


# --- reading -----------------------------------------------------------------


COLUMNS = {"postings": "positions array<int>", "words": "n_docs long", "variants": "variant string", "grams": "gram string"}


def _batches(spark: SparkSession, table: TermTable) -> dict[str, int]:
    """Names and sizes of the batches that are there."""
    if not exists(spark, table.path("batches")):
        return {}
    return {row.batch: row.n_docs for row in spark.read.schema("batch string, n_docs long").parquet(table.path("batches")).collect()}


def _all(spark: SparkSession, table: TermTable, name: str, id_type: DataType | None = None) -> DataFrame:
    columns = f"field string, term string, {COLUMNS[name]}, batch string, bucket int"
    if name == "postings":
        columns = f"id {id_type.simpleString()}, {columns}"
    return spark.read.schema(columns).parquet(table.path(name))


def _read(spark: SparkSession, table: TermTable, name: str, id_type: DataType | None = None) -> DataFrame:
    """One of the tables, without what failed appends have left."""
    return _all(spark, table, name, id_type).where(F.col("batch").isin(list(_batches(spark, table))))


def _required(runs: Sequence[str]) -> list[str]:
    return sorted({run[i : i + 3] for run in runs for i in range(len(run) - 2)})


def wildcard_grams(pattern: str) -> list[str]:
    """Runs of three characters that every term that meets the pattern has, with its end marks."""
    return _required(re.split(r"[*?]", f"{FIRST}{pattern}{LAST}"))


def regex_grams(pattern: str) -> list[str]:
    """The same of a regular expression, as far as it is plain: no alternatives, groups, flags or quotes.

    A character that may be missing is left out, and what is next to a class, a dot,
    an escape or a repetition is not taken to be next to anything.
    """
    if re.search(r"[|()]|\\", pattern):
        return []
    runs = [FIRST]
    for found in re.finditer(r"(?P<any>\[\^?\]?[^\]]*\]|\.)|(?P<end>[\^$])|(?P<char>[^*+?{}\[\].^$])", pattern):
        behind = re.match(r"[*+?]+|\{[^}]*\}[+?]?", pattern[found.end() :])
        if found["end"]:
            return []
        if found["any"]:
            runs.append("")
        elif not behind:
            runs[-1] += found["char"]
        elif behind[0][0] == "+":  # once at least
            runs[-1] += found["char"]
            runs.append("")
        else:
            runs.append("")
    if re.search(r"[][{}]", re.sub(r"\[\^?\]?[^\]\[]*\]", "", pattern)):
        return []  # counts and nested classes
    runs[-1] += LAST
    return _required(runs)


def fuzzy_terms(words: DataFrame, variants: DataFrame) -> DataFrame:
    """Pairs of a word (word, edits) and a term that share a variant; they may be up to two edits apart, and all that are share one."""
    wanted = words.select("word", "edits", F.explode(variants_of(F.col("word"))).alias("variant"))
    return wanted.join(variants, "variant").select("word", "edits", "field", "term").distinct()


class _Lookup:
    """The terms of one field that meet a condition, and the documents that hold them."""

    def __init__(self, spark: SparkSession, table: TermTable, field: str, id_type: DataType):
        self.spark, self.table, self.field, self.id_type = spark, table, field, id_type

    def rows(self, name: str) -> DataFrame:
        return _read(self.spark, self.table, name, self.id_type).where(F.col("field") == self.field)

    def _keyed(self, name: str, key: str, values: Sequence[str]) -> DataFrame:
        """Rows whose key is one of some values, from the buckets of these values."""
        buckets = [self.table.bucket(F.lit(value)) for value in values]
        return self.rows(name).where(F.col("bucket").isin(buckets) & F.col(key).isin(list(values)))

    def of_words(self, words: Sequence[str]) -> DataFrame:
        """Postings of some words."""
        return self._keyed("postings", "term", words)

    def frequencies(self, words: Sequence[str]) -> DataFrame:
        return self._keyed("words", "term", words).groupBy("term").agg(F.sum("n_docs").alias("n_docs"))

    def _of_terms(self, terms: DataFrame) -> DataFrame:
        terms = terms.select("term").distinct().withColumn("bucket", self.table.bucket(F.col("term")))
        return self.rows("postings").join(terms, ["bucket", "term"], "left_semi")

    def of_pattern(self, condition: Column, grams: Sequence[str]) -> DataFrame:
        """Postings of the terms that meet a condition and hold some grams."""
        if not grams:
            return self._of_terms(self.rows("words").where(condition))
        held = self._keyed("grams", "gram", grams).groupBy("term").agg(F.count_distinct("gram").alias("n"))
        return self._of_terms(held.where((F.col("n") == len(grams)) & condition))

    def of_prefix(self, start: str) -> DataFrame:
        return self._of_terms(self.rows("words").where(F.col("term").startswith(start)))

    def of_fuzzy(self, word: str, edits: int) -> DataFrame:
        found = self._keyed("variants", "variant", _variants(word[:VARIED], edits)).select("term")
        return self._of_terms(found.where(tk.within_edits(F.col("term"), word, edits)))

    def of_phrase(self, words: Sequence[str]) -> DataFrame:
        """Ids of the documents that hold words next to each other."""
        def starts(i: int, word: str) -> Column:  # where the phrase would start
            own = F.when(F.col("term") == word, F.transform("positions", lambda place: place - i))
            return F.flatten(F.collect_list(own)).alias(f"p{i}")

        places = [starts(i, word) for i, word in enumerate(words)]
        held = self.of_words(list(dict.fromkeys(words))).groupBy("id").agg(*places)
        common = reduce(F.array_intersect, [F.col(f"p{i}") for i in range(len(words))])
        return held.where(F.size(common) > 0)


def _postings(query: SearchQuery, lookup: _Lookup) -> DataFrame | None:
    """Rows with the ids that meet a query; None where nothing can."""
    if isinstance(query, (Match, Term, Terms)):
        words = {Match: lambda: tk.analyse(query.value), Term: lambda: [query.value], Terms: lambda: query.values}[type(query)]()
        words = [word for word in dict.fromkeys(words) if tk.is_token(word)]
        return lookup.of_words(words) if words else None
    if isinstance(query, Prefix):
        return lookup.of_prefix(query.value) if tk.is_token(query.value) else None
    if isinstance(query, Wildcard):
        literal = re.sub(r"[*?]", "", query.value)
        if not query.value or (literal and not tk.is_token(literal)):
            return None
        return lookup.of_pattern(F.col("term").like(wildcard_to_like(query.value)), wildcard_grams(query.value))
    if isinstance(query, Regex):
        return lookup.of_pattern(tk.full_match(F.col("term"), query.value), regex_grams(query.value))
    if isinstance(query, Fuzzy):
        edits = tk.auto_edits(query.value) if query.edits is None else query.edits
        if edits == 0:
            return lookup.of_words([query.value]) if tk.is_token(query.value) else None
        return lookup.of_fuzzy(query.value, edits)
    words = list(dict.fromkeys(tk.analyse(query.value)))  # CommonTerms
    if not words:
        return None
    counts = {row.term: row.n_docs for row in lookup.frequencies(words).collect()}
    limit = math.ceil(sum(_batches(lookup.spark, lookup.table).values()) * query.cutoff)
    rare = [word for word in words if counts.get(word, 0) <= limit]
    return lookup.of_words(rare or words)


def _alike(query: MoreLikeThis, lookups: Mapping[str, _Lookup], n_docs: int) -> DataFrame | None:
    """Ids of the documents that share enough telling words with the like texts."""
    wanted = query.like_counts({name: tk.analyse for name in lookups})
    if not wanted:
        return None
    counted = [
        lookups[name].frequencies(list(counts)).select(F.lit(i).alias("field"), F.col("term").alias("word"), F.col("n_docs").alias("n"))
        for i, (name, counts) in enumerate(wanted.items())
    ]
    frequent = reduce(DataFrame.union, counted).where(F.col("n") >= query.min_doc_freq)
    best = query.most_telling(frequent, list(wanted.values()), F.lit(n_docs)).collect()
    if not best:
        return None
    held = [lookups[name].of_words([b.word for b in best if b.field == i]).select("id") for i, name in enumerate(wanted)]
    needed = max(1, math.floor(len(best) * query.share))
    return reduce(DataFrame.union, held).groupBy("id").count().where(F.col("count") >= needed).select("id")


def _found(docs: DataFrame, query: SearchQuery, table: TermTable, mapping: Mapping | None) -> tuple[bool, DataFrame | None]:
    """Does the table answer a query, and rows with the ids that meet it; None where nothing can."""
    spark = docs.sparkSession
    described = Documents(docs, mapping, table.id_column)
    id_type = docs.schema[table.id_column].dataType

    def known(*names: str, arrays: bool = True) -> bool:
        fields = [described.field(name) for name in names if name in table.fields]
        return len(fields) == len(names) > 0 and all(f.is_text and (arrays or not isinstance(f.type, ArrayType)) for f in fields)

    def lookup(name: str) -> _Lookup:
        return _Lookup(spark, table, name, id_type)

    phrases = isinstance(query, BoolMatchPhrase) and query.filter == "must" and known(*[f for f, _ in query.phrases], arrays=False)
    alike = isinstance(query, MoreLikeThis) and known(*query.fields)
    single = isinstance(query, (Match, Term, Terms, Prefix, Wildcard, Regex, Fuzzy, CommonTerms)) and known(query.field)
    if not (phrases or alike or single) or isinstance(getattr(query, "values", None), DataFrame):
        return False, None
    batches = _batches(spark, table)
    found = None
    if not batches:
        pass
    elif alike:
        found = _alike(query, {name: lookup(name) for name in dict.fromkeys(query.fields)}, sum(batches.values()))
    elif single:
        found = _postings(query, lookup(query.field))
    else:
        parts = [(name, tk.analyse(text)) for name, text in query.phrases]
        if all(words for _, words in parts):
            ids = [lookup(name).of_phrase(words).select("id") for name, words in parts]
            found = reduce(lambda one, other: one.join(other, "id", "left_semi"), ids)
    return True, None if found is None else found.select(F.col("id").alias("__id"))


def search_terms(docs: DataFrame, query: SearchQuery, table: TermTable, mapping: Mapping | None = None) -> DataFrame:
    """The rows of ``search``, found by the terms of ``docs`` in the table."""
    answered, found = _found(docs, query, table, mapping)
    if not answered:
        return search(docs, query, mapping, table.id_column)
    if found is None:
        return docs.where(F.lit(False))
    return docs.join(found, F.col(f"`{table.id_column}`") == F.col("__id"), "left_semi")


def search_terms_all(
    docs: DataFrame, queries: Mapping[str, SearchQuery], table: TermTable, mapping: Mapping | None = None, label: str = "query"
) -> DataFrame:
    """The rows of ``search_terms`` for several queries, with the name of the query first; documents are read and joined once."""
    ids, scans = [], []
    for name, query in queries.items():
        answered, found = _found(docs, query, table, mapping)
        if not answered:
            scans.append(search(docs, query, mapping, table.id_column).select(F.lit(name).alias(label), "*"))
        elif found is not None:
            ids.append(found.select(F.lit(name).alias("__label"), "__id").distinct())
    if ids:
        hits = docs.join(reduce(DataFrame.union, ids), F.col(f"`{table.id_column}`") == F.col("__id"))
        scans.append(hits.select(F.col("__label").alias(label), *[docs[f"`{name}`"] for name in docs.columns]))
    return reduce(DataFrame.union, scans) if scans else docs.where(F.lit(False)).select(F.lit("").alias(label), "*")
