"""The search queries, each a condition on the rows of a document frame.

Only membership counts, there is no scoring. Every query is one ``Column``
over built-in functions, so that filters on keyword, numeric and id fields
reach the file scan. The two queries that depend on document frequencies
bring them in as a scalar subquery: one aggregate over the same frame whose
single row is as long as the query text.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from quayside.functions import tokens as tk
from quayside.operators import query_text
from quayside.operators.fields import Documents, Field


@dataclass(frozen=True)
class MatchAll:
    def condition(self, docs: Documents) -> Column:
        return F.lit(True)


@dataclass(frozen=True)
class Match:
    """The field shares at least one token with the value."""

    field: str
    value: str

    def condition(self, docs: Documents) -> Column:
        return docs.field(self.field).match(self.value)


@dataclass(frozen=True)
class Term:
    """The field holds exactly this term; the value is not cut into tokens."""

    field: str
    value: str

    def condition(self, docs: Documents) -> Column:
        return docs.field(self.field).any_term([self.value])


@dataclass(frozen=True)
class Terms:
    """Any of several terms; a frame of terms, in its first column, is joined instead of listed."""

    field: str
    values: Sequence[str] | DataFrame

    def condition(self, docs: Documents) -> Column:
        return docs.field(self.field).any_term(list(self.values))


@dataclass(frozen=True)
class CommonTerms:
    """Match on the rare words of the value, or on the common ones if all are common.

    A word is common when more than ``cutoff`` of all documents hold it.
    """

    field: str
    value: str
    cutoff: float = 0.01

    def condition(self, docs: Documents) -> Column:
        field = docs.field(self.field)
        words = list(dict.fromkeys(field.analysed(self.value)))
        if field.type is None or not words:
            return F.lit(False)
        chosen = self._chosen(docs, field, words)
        return tk.any_of([F.array_contains(chosen, F.lit(w)) & field.any_term([w]) for w in words])

    def _chosen(self, docs: Documents, field: Field, words: list[str]) -> Column:
        """One-row subquery: the words to match on, each counted by its own test."""
        limit = F.ceil(F.count(F.lit(1)) * F.lit(self.cutoff))
        held = [F.count_if(field.any_term([word])) for word in words]
        rare = F.array_compact(F.array(*[F.when(n <= limit, F.lit(w)) for n, w in zip(held, words)]))
        return docs.frame.agg(F.when(F.size(rare) > 0, rare).otherwise(tk.string_array(words))).scalar()


@dataclass(frozen=True)
class QueryString:
    """Boolean query text over all fields; see :mod:`quayside.operators.query_text`."""

    query: str

    def condition(self, docs: Documents) -> Column:
        return query_text.query_string(self.query, docs)


@dataclass(frozen=True)
class SimpleString:
    """Boolean query text that never fails on bad syntax."""

    query: str

    def condition(self, docs: Documents) -> Column:
        return query_text.simple_string(self.query, docs)


@dataclass(frozen=True)
class MultiMatch:
    """One query text per value; a document is returned once per value it meets.

    ``dedupe`` returns it once.
    """

    values: Sequence[str]
    dedupe: bool = False

    def condition(self, docs: Documents) -> Column:
        return tk.any_of([QueryString(value).condition(docs) for value in self.values])

    def apply(self, docs: Documents) -> DataFrame:
        if not self.values or self.dedupe:
            return docs.frame.where(self.condition(docs))
        conditions = [QueryString(value).condition(docs) for value in self.values]
        # One scan: every row is repeated as often as values match it.
        met = [F.when(c, F.lit(i)) for i, c in enumerate(conditions)]
        copies = F.explode(F.array_compact(F.array(*met))).alias("__value")
        return docs.frame.select("*", copies).drop("__value")


@dataclass(frozen=True)
class Prefix:
    field: str
    value: str

    def condition(self, docs: Documents) -> Column:
        return docs.field(self.field).prefix(self.value)


@dataclass(frozen=True)
class MoreLikeThis:
    """Documents that share enough of the most telling words of the like texts.

    Words are weighted by their count in the like texts times one plus the log
    of their rarity; the ``max_terms`` best (ties by word) are kept, and a
    document must hold ``share`` of them, rounded down but at least one.
    """

    fields: Sequence[str]
    like: Sequence[str]
    min_term_freq: int = 1
    min_doc_freq: int = 5
    max_terms: int = 12
    share: float = 0.3

    def like_counts(self, cut: Mapping[str, Callable[[str], list[str]]]) -> dict[str, dict[str, int]]:
        """Of every field, how often the like texts have each word, as they are cut for it."""
        found = {}
        for name, analysed in cut.items():
            counts = Counter(word for text in self.like for word in analysed(text))
            counts = {w: n for w, n in counts.items() if n >= self.min_term_freq}
            if counts:
                found[name] = counts
        return found

    def condition(self, docs: Documents) -> Column:
        fields = {name: docs.field(name) for name in self.fields}
        counts = self.like_counts({name: field.analysed for name, field in fields.items() if field.type is not None})
        wanted = {name: (fields[name], of_field) for name, of_field in counts.items()}
        if not wanted:
            return F.lit(False)
        best = self._best_terms(docs, wanted)

        shared = []
        for i, (field, _) in enumerate(wanted.values()):
            held = F.array_intersect(field.token_array(), best.getField(f"words_{i}"))
            shared.append(F.coalesce(F.size(held), F.lit(0)))
        return sum(shared[1:], shared[0]) >= best.getField("needed")

    def most_telling(self, frequencies: DataFrame, counts: Sequence[Mapping[str, int]], n_docs: Column) -> DataFrame:
        """The best of words (field, word, n) that n documents hold; ``counts`` are those of the like texts by field."""
        in_like = F.lit(None).cast("int")
        for i, of_field in enumerate(counts):
            table = F.from_json(F.lit(json.dumps(of_field)), "map<string,int>")
            in_like = F.when(F.col("field") == i, F.element_at(table, F.col("word"))).otherwise(in_like)
        weight = F.round(in_like * (1 + F.log((n_docs + 1) / (F.col("n") + 1))), 9)
        weighted = frequencies.select("field", "word", weight.alias("weight"))
        return weighted.orderBy(F.desc("weight"), "word", "field").limit(self.max_terms)

    def _best_terms(self, docs: Documents, wanted: Mapping) -> Column:
        """One-row subquery: the chosen words of each field and how many must be shared."""
        term_type = "array<struct<field:int,word:string>>"
        held = []
        for i, (field, counts) in enumerate(wanted.values()):
            words = F.array_intersect(field.token_array(), tk.string_array(list(counts)))
            held.append(F.coalesce(_numbered(words, i), F.array().cast(term_type)))
        frequencies = (
            docs.frame.select(F.explode(F.concat(*held)).alias("term"))
            .groupBy("term.field", "term.word")
            .agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= self.min_doc_freq)
        )
        n_docs = docs.frame.agg(F.count(F.lit(1))).scalar()
        best = self.most_telling(frequencies, [counts for _, counts in wanted.values()], n_docs)
        per_field = [
            F.collect_list(F.when(F.col("field") == i, F.col("word"))).alias(f"words_{i}") for i in range(len(wanted))
        ]
        n_terms = F.count(F.lit(1))
        needed = F.greatest(F.lit(1), F.floor(n_terms * self.share))
        return best.agg(F.struct(*per_field, needed.alias("needed"))).scalar()


def _numbered(words: Column, number: int) -> Column:
    return F.transform(words, lambda word: F.struct(F.lit(number).alias("field"), word.alias("word")))


# Spark type of each kind of range bound.
RANGE_TYPES = {"integer": "int", "long": "bigint", "float": "double", "string": "string"}


@dataclass(frozen=True)
class Range:
    """Inclusive range; the bounds are texts of the given type."""

    type: str
    field: str
    lte: str | None = None
    gte: str | None = None

    def condition(self, docs: Documents) -> Column:
        def bound(text):
            return None if text is None else F.lit(text).cast(RANGE_TYPES[self.type])

        return docs.field(self.field).between(bound(self.gte), bound(self.lte))


@dataclass(frozen=True)
class Exists:
    field: str

    def condition(self, docs: Documents) -> Column:
        return docs.field(self.field).exists()


@dataclass(frozen=True)
class Wildcard:
    field: str
    value: str

    def condition(self, docs: Documents) -> Column:
        return docs.field(self.field).wildcard(self.value)


@dataclass(frozen=True)
class Regex:
    """A whole term matches the regular expression (Java syntax); meant for keywords."""

    field: str
    value: str

    def condition(self, docs: Documents) -> Column:
        return docs.field(self.field).regex(self.value)


@dataclass(frozen=True)
class Fuzzy:
    """A term is within ``edits`` changes of the value (by its length when unset)."""

    field: str
    value: str
    edits: int | None = None

    def condition(self, docs: Documents) -> Column:
        return docs.field(self.field).fuzzy(self.value, self.edits)


@dataclass(frozen=True)
class Ids:
    """Documents by id; a frame of ids, in its first column, is joined instead of listed."""

    ids: Sequence[str] | DataFrame

    def condition(self, docs: Documents) -> Column:
        return docs.field(docs.id_column).any_value(list(self.ids))


@dataclass(frozen=True)
class BoolMatchPhrase:
    """Phrases on fields, combined by ``must`` (all), ``must-not`` (none) or ``should`` (any)."""

    filter: str
    phrases: Sequence[tuple[str, str]]

    def condition(self, docs: Documents) -> Column:
        held = [docs.field(name).phrase(value) for name, value in self.phrases]
        if not held:
            return F.lit(True)
        if self.filter == "must":
            return tk.all_of(held)
        if self.filter == "must-not":
            return tk.negate(tk.any_of(held))
        if self.filter == "should":
            return tk.any_of(held)
        raise ValueError("filter must be 'must', 'must-not' or 'should'")


SearchQuery = (
    MatchAll | Match | MultiMatch | Term | Terms | CommonTerms | QueryString | SimpleString | Prefix
    | MoreLikeThis | Range | Exists | Wildcard | Regex | Fuzzy | Ids | BoolMatchPhrase
)


def _semi_join(docs: Documents, name: str, values: DataFrame) -> DataFrame:
    """Rows whose field is one of the values of a frame; Spark picks the join by what it knows of their sizes."""
    field = docs.field(name)
    if field.type is None:
        return docs.frame.where(F.lit(False))
    listed = values.select(F.col(f"`{values.columns[0]}`").cast("string").try_cast(field.value_type).alias("__listed"))
    if isinstance(field.type, ArrayType):
        raise TypeError(f"{name} is an array; list the values instead")
    return docs.frame.join(listed, field.column == F.col("__listed"), "left_semi")


def search(frame: DataFrame, query: SearchQuery, mapping: Mapping | None = None, id_column: str = "_id") -> DataFrame:
    """Rows of a document frame selected by a search query."""
    docs = Documents(frame, mapping, id_column)
    if isinstance(query, MultiMatch):
        return query.apply(docs)
    if isinstance(query, Ids) and isinstance(query.ids, DataFrame):
        return _semi_join(docs, id_column, query.ids)
    if isinstance(query, Terms) and isinstance(query.values, DataFrame):
        if docs.field(query.field).is_text:
            raise TypeError(f"{query.field} is text; a frame of terms needs a field that is compared whole")
        return _semi_join(docs, query.field, query.values)
    return frame.where(query.condition(docs))


def sample_documents(frame: DataFrame, n: int = 10) -> DataFrame:
    """Any ``n`` documents with all values as strings."""
    return frame.limit(n).select([F.col(f"`{c}`").cast("string").alias(c) for c in frame.columns])
