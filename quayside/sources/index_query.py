"""Search queries in the request language of a search cluster.

A cluster evaluates its own searches: its connector takes the request as an
option and delivers only the hits. Frames are searched by
:mod:`quayside.operators.search` instead.
"""

from __future__ import annotations

import json

from quayside.operators.search import (
    BoolMatchPhrase,
    CommonTerms,
    Exists,
    Fuzzy,
    Ids,
    Match,
    MatchAll,
    MoreLikeThis,
    Prefix,
    QueryString,
    Range,
    Regex,
    SearchQuery,
    SimpleString,
    Term,
    Terms,
    Wildcard,
)

RANGE_VALUES = {"integer": int, "long": int, "float": float, "string": str}


def clause(query: SearchQuery) -> dict:
    """The request clause of a query; a MultiMatch is one request per value and has none."""
    match query:
        case MatchAll():
            return {"match_all": {}}
        case Match(field, value):
            return {"match": {field: value}}
        case Term(field, value):
            return {"term": {field: value}}
        case Terms(field, values):
            return {"terms": {field: list(values)}}
        case CommonTerms(field, value, cutoff):
            return {"common": {field: {"query": value, "cutoff_frequency": cutoff}}}
        case QueryString(text):
            return {"query_string": {"query": text}}
        case SimpleString(text):
            return {"simple_query_string": {"query": text}}
        case Prefix(field, value):
            return {"prefix": {field: value}}
        case Wildcard(field, value):
            return {"wildcard": {field: value}}
        case Regex(field, value):
            return {"regexp": {field: value}}
        case Fuzzy(field, value, edits):
            return {"fuzzy": {field: {"value": value, "fuzziness": "AUTO" if edits is None else edits}}}
        case Exists(field):
            return {"exists": {"field": field}}
        case Ids(ids):
            return {"ids": {"values": list(ids)}}
        case Range(kind, field, lte, gte):
            bounds = {"lte": lte, "gte": gte}
            return {"range": {field: {k: RANGE_VALUES[kind](v) for k, v in bounds.items() if v is not None}}}
        case MoreLikeThis():
            return {
                "more_like_this": {
                    "fields": list(query.fields),
                    "like": list(query.like),
                    "min_term_freq": query.min_term_freq,
                    "min_doc_freq": query.min_doc_freq,
                    "max_query_terms": query.max_terms,
                    "minimum_should_match": f"{query.share:.0%}",
                }
            }
        case BoolMatchPhrase(kind, phrases):
            return {"bool": {kind.replace("-", "_"): [{"match_phrase": {field: text}} for field, text in phrases]}}
    raise TypeError(f"no request clause for {query!r}")


def request(query: SearchQuery) -> str:
    return json.dumps({"query": clause(query)})
