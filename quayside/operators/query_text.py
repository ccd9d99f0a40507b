"""Boolean query texts as conditions.

Two small notations, both over all searchable fields unless a field is named:

``query_string``
    words, ``"phrases"``, ``"loose phrases"~2`` (moved by two places in all, at
    most), ``field:word``, ``field:(several words)``,
    ``wild*c?rd``, ``fuzzy~`` and ``fuzzy~1`` (two edits at most),
    ``[a TO b]`` / ``{a TO b}``, ``field:>=a``, ``/regex/``,
    ``_exists_:field``, joined by AND/OR/NOT (``&&``, ``||``, ``!``), ``+``,
    ``-`` and parentheses. Within one pair of parentheses every part is
    required, prohibited or optional: AND requires both its sides, ``+``
    requires, ``-`` and NOT prohibit, the rest is optional, and one optional
    part must hold only where nothing is required. Unbalanced parentheses
    raise ``ValueError``.

``simple_string``
    words, ``"phrases"``, ``prefix*``, ``fuzzy~1``, ``+`` (and), ``|`` (or),
    ``-`` (not) and parentheses, taken from left to right, or by default; it
    never raises. Phrases may be loose (``"a b"~2``), as above.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions import tokens as tk
from quayside.operators.fields import Documents, Field

_QUERY_PART = re.compile(
    r"""
    (?:(?P<of>[\w.]+):)?(?P<open>\() | (?P<close>\)) | \^[\d.]+
    | (?P<operator>(?:AND|OR|NOT)(?=[\s()]|$) | && | \|\| | [+!-])
    | (?:(?P<field>[\w.]+):)?
      (?: "(?P<phrase>[^"]*)"(?:~(?P<slop>\d+))?
        | /(?P<regex>(?:\\.|[^/\\])+)/
        | (?P<left>[\[{])\s*(?P<low>\S+)\s+TO\s+(?P<high>[^\s\]}]+)\s*(?P<right>[\]}])
        | (?P<compare>[<>]=?)(?P<bound>[^\s()]+)
        | (?P<word>(?:\\.|[^\s()"^\\])+) )
    """,
    re.VERBOSE,
)

_SIMPLE_PART = re.compile(
    r"""
    (?P<open>\() | (?P<close>\)) | (?P<operator>[+|-])
    | "(?P<phrase>[^"]*)"(?:~(?P<slop>\d+))?
    | (?P<word>(?:\\.|[^\s()"|+\\])+)
    """,
    re.VERBOSE,
)

# More than the places of any text: the words may be anywhere.
MOST_SLOP = 1 << 20

_SAME_OPERATOR = {"&&": "AND", "||": "OR", "!": "-", "NOT": "-"}


def _fold(pattern: re.Pattern, text: str, part: Callable, combine: Callable, strict: bool) -> Column:
    """Turn the parts of a text into conditions, joining each parenthesis when it closes."""
    levels: list[list] = [[]]
    fields: list[str | None] = [None]  # of each parenthesis, the field it is about
    for found in pattern.finditer(text):
        if found["open"]:
            levels.append([])
            fields.append(found.groupdict().get("of") or fields[-1])
        elif found["close"]:
            if len(levels) == 1:
                if strict:
                    raise ValueError(f"unexpected ')' in query {text!r}")
                continue
            fields.pop()
            group = combine(levels.pop())
            levels[-1].append(group)
        elif found["operator"]:
            levels[-1].append(found["operator"])
        elif found.lastgroup:
            levels[-1].append(part(found, fields[-1]))
    if strict and len(levels) > 1:
        raise ValueError(f"missing ')' in query {text!r}")
    while len(levels) > 1:
        group = combine(levels.pop())
        levels[-1].append(group)
    return combine(levels[0])


def _unescaped(word: str) -> str:
    return re.sub(r"\\(.)", r"\1", word)


def _slop(found: re.Match) -> int:
    """By how many places the words of a phrase may be moved; a number behind MOST_SLOP means the same."""
    return min(MOST_SLOP, int(found["slop"] or 0))


def _word(field: Field, word: str) -> Column:
    """A bare word on one field: plain, with wildcards or with ``~``."""
    fuzzy = re.fullmatch(r"(.+?)~(\d*)", word)
    plain = _unescaped(fuzzy[1] if fuzzy else word)
    term = plain.lower() if field.is_text else plain
    if fuzzy:
        return field.fuzzy(term, min(2, int(fuzzy[2])) if fuzzy[2] else None)
    if re.search(r"(?<!\\)[*?]", word):
        return field.wildcard(term)
    return field.match(plain)


# --- query_string ----------------------------------------------------------


def _range(field: Field, low: str, high: str, open_low: bool, open_high: bool) -> Column:
    if field.type is None:
        return F.lit(False)

    def bound(text: str) -> Column | None:
        return None if text == "*" else F.lit(text).try_cast(field.value_type)

    return field.between(bound(low), bound(high), open_low, open_high)


@dataclass(frozen=True)
class PlainWord:
    """A word to be found in any field, kept as a word so that many can be looked up at once."""

    text: str


def _query_part(found: re.Match, docs: Documents, group: str | None) -> Column | PlainWord:
    name = found["field"] or group
    if found["field"] == "_exists_" and found["word"]:
        return docs.field(found["word"]).exists()
    if found["word"] == "*" and name is None or found[0] == "*:*":
        return F.lit(True)
    fields = [docs.field(name)] if name else docs.searchable()
    if found["word"] == "*":
        return fields[0].exists()
    if found["phrase"] is not None:
        return tk.any_of([f.phrase(found["phrase"], _slop(found)) for f in fields])
    if found["regex"] is not None:
        return tk.any_of([f.regex(found["regex"]) for f in fields])
    if found["low"] is not None:
        edges = found["left"] == "{", found["right"] == "}"
        return tk.any_of([_range(f, found["low"], found["high"], *edges) for f in fields])
    if found["compare"] is not None:
        is_open = len(found["compare"]) == 1
        ends = (found["bound"], "*") if found["compare"][0] == ">" else ("*", found["bound"])
        return tk.any_of([_range(f, *ends, is_open, is_open) for f in fields])
    if name is None and not re.search(r"(?<!\\)[*?~]", found["word"]):
        return PlainWord(_unescaped(found["word"]))
    return tk.any_of([_word(f, found["word"]) for f in fields])


def _any_word(words: list[PlainWord], docs: Documents) -> Column:
    return tk.any_of([f.match(*[word.text for word in words]) for f in docs.searchable()])


def _join_clauses(parts: list, docs: Documents) -> Column:
    """Required, prohibited and optional parts of one level."""
    clauses: list[tuple[str, Column | PlainWord]] = []
    mark = joined = ""
    for part in parts:
        if not isinstance(part, str):
            clauses.append((mark or joined, part))
            mark = joined = ""
            continue
        operator = _SAME_OPERATOR.get(part, part)
        if operator == "AND":
            joined = "+"
            if clauses and clauses[-1][0] == "":
                clauses[-1] = ("+", clauses[-1][1])
        elif operator in "+-":
            mark = operator
    if not clauses:
        return F.lit(False)
    words = [c for m, c in clauses if m == "" and isinstance(c, PlainWord)]
    optional = [c for m, c in clauses if m == "" and not isinstance(c, PlainWord)]
    if words:
        optional.append(_any_word(words, docs))
    whole = [(m, _any_word([c], docs) if isinstance(c, PlainWord) else c) for m, c in clauses if m]
    required = [c for m, c in whole if m == "+"]
    prohibited = [tk.negate(c) for m, c in whole if m == "-"]
    if optional and not required:
        required = [tk.any_of(optional)]
    return tk.all_of(required + prohibited)


def query_string(text: str, docs: Documents) -> Column:
    return _fold(
        _QUERY_PART, text, lambda found, group: _query_part(found, docs, group), lambda parts: _join_clauses(parts, docs), strict=True
    )


# --- simple_string ---------------------------------------------------------


def _simple_part(found: re.Match, docs: Documents) -> Column:
    fields = docs.searchable()
    if found["phrase"] is not None:
        return tk.any_of([f.phrase(found["phrase"], _slop(found)) for f in fields])
    word = found["word"]
    if word.endswith("*") and len(word) > 1:
        start = word[:-1]
        return tk.any_of([f.prefix(start.lower() if f.is_text else start) for f in fields])
    return tk.any_of([f.match(word) if "*" in word or "?" in word else _word(f, word) for f in fields])


def _join_left_to_right(parts: list) -> Column:
    result, both, negated = None, False, False
    for part in parts:
        if isinstance(part, str):
            negated = negated ^ (part == "-")
            both = part == "+" or (both and part == "-")
            continue
        part = tk.negate(part) if negated else part
        result = part if result is None else (result & part if both else result | part)
        both = negated = False
    return F.lit(False) if result is None else result


def simple_string(text: str, docs: Documents) -> Column:
    return _fold(_SIMPLE_PART, text, lambda found, _: _simple_part(found, docs), _join_left_to_right, strict=False)
