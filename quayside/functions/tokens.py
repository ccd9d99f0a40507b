"""Word-level predicates on text columns.

A token is a run of letters, digits and underscores in the lower-cased text.
Whole-token tests are regular expressions that start with the literal word, so
that Java searches for it as a plain string, and check its borders only where
it occurs. The text is lower-cased once per test, and cut into an array of
tokens only where a predicate must look at each one.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Sequence
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN_CHAR = r"[\p{L}\p{N}_]"
NOT_BEFORE = rf"(?<!{TOKEN_CHAR})"
NOT_AFTER = rf"(?!{TOKEN_CHAR})"

# Up to this many words are looked up one by one; more go through a hash set.
FEW_WORDS = 12


def _is_token_char(char: str) -> bool:
    return char == "_" or unicodedata.category(char)[0] in "LN"


def is_token(text: str) -> bool:
    """Could ``text`` be (part of) a token?"""
    return bool(text) and all(map(_is_token_char, text))


def analyse(text: str) -> list[str]:
    """Tokens of a query text, in order."""
    spaced = "".join(c if _is_token_char(c) else " " for c in text.lower())
    return spaced.split()


def tokens(text: Column, shortest: int = 1, longest: int | None = None) -> Column:
    """Array of the tokens of a text column, optionally of some lengths only."""
    pattern = f"{TOKEN_CHAR}+"
    if shortest > 1 or longest is not None:
        pattern = f"{NOT_BEFORE}{TOKEN_CHAR}{{{max(shortest, 1)},{longest or ''}}}{NOT_AFTER}"
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def _joined(conditions: Sequence[Column], join: Callable) -> Column:
    """Conditions joined pairwise, so that many of them do not make a deep expression."""
    while len(conditions) > 1:
        pairs = [join(*conditions[i : i + 2]) for i in range(0, len(conditions) - 1, 2)]
        conditions = pairs + list(conditions[len(pairs) * 2 :])
    return conditions[0]


def any_of(conditions: Sequence[Column]) -> Column:
    return _joined(conditions, or_) if conditions else F.lit(False)


def all_of(conditions: Sequence[Column]) -> Column:
    return _joined(conditions, and_) if conditions else F.lit(True)


def negate(condition: Column) -> Column:
    """NOT that also holds where the condition is NULL (field absent)."""
    return ~F.coalesce(condition, F.lit(False))


def string_array(values: Sequence[str]) -> Column:
    """A constant array, one literal however many values there are."""
    return F.from_json(F.lit(json.dumps(list(values))), "array<string>")


def _starting(word: str) -> str:
    """Pattern of a word at the start of a token: the word, then a look back at what precedes it."""
    return f"{word}(?<!{TOKEN_CHAR}{word})"


def _whole(words: Sequence[str]) -> str:
    """Pattern of whole tokens next to each other."""
    gap = rf"[^{TOKEN_CHAR[1:-1]}]+"
    return gap.join([_starting(words[0]), *words[1:]]) + NOT_AFTER


def has_phrase(text: Column, words: Sequence[str]) -> Column:
    """The words occur next to each other in this order."""
    if not words or not all(map(is_token, words)):
        return F.lit(False)
    return F.lower(text).rlike(_whole(words))


def _named(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is made once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _narrowest(held: Column, words: Sequence[str]) -> Column:
    """Over all choices of one place for each of different words, the least spread of place less offset in the phrase.

    One pass over the sorted starts of all words, which remembers the last start of each.
    """
    never = -(1 << 40)
    number = lambda token: F.array_position(string_array(words), token)
    starts = F.transform(held, lambda token, i: F.struct((i - number(token)).alias("at"), number(token).alias("no")))
    starts = F.array_sort(F.filter(starts, lambda start: start["no"] > 0))
    zero = F.struct(F.array_repeat(F.lit(never), len(words)).alias("last"), F.lit(-never).alias("best"))

    def step(state: Column, start: Column) -> Column:
        last = F.transform(state["last"], lambda x, i: F.when(i + 1 == start["no"], start["at"]).otherwise(x))
        return _named(last, lambda x: F.struct(x.alias("last"), F.least(state["best"], start["at"] - F.array_min(x)).alias("best")))

    return F.aggregate(starts, zero, step, lambda state: state["best"])


def _within(held: Column, word: str, offsets: Sequence[int], start: Column, slop: int) -> Column:
    """A word has as many places as it has offsets, in their order, each at most ``slop`` behind start plus offset.

    The first place that will do is always the best, so one look from left to right is enough.
    """

    def rest(i: int, after: Column | None) -> Column:
        least = F.greatest(start + offsets[i], F.lit(1) if after is None else after + 1, F.lit(1))
        room = F.greatest(start + offsets[i] + slop - least + 1, F.lit(0))
        if i + 1 == len(offsets):
            return F.array_contains(F.slice(held, least, room), word)
        place = F.array_position(F.slice(held, least, room), word).cast("int")
        return _named(F.when(place > 0, least + place - 1), lambda found: found.isNotNull() & F.coalesce(rest(i + 1, found), F.lit(False)))

    return rest(0, None)


def has_loose_phrase(text: Column, words: Sequence[str], slop: int) -> Column:
    """The words occur close to each other: moving them by ``slop`` places in all, at most, gives the phrase.

    Every word takes a place of its own. If a word's place less its offset in the phrase is
    its start, the greatest start may exceed the least by ``slop``. Where a word is in the
    phrase more than once, every start around its places is tried; else one pass finds the
    narrowest choice. Texts that lack one of the words are not cut into tokens.
    """
    if not words or not all(map(is_token, words)):
        return F.lit(False)
    if not slop or len(words) == 1:
        return has_phrase(text, words)
    offsets: dict[str, list[int]] = {}
    for i, word in enumerate(words):
        offsets.setdefault(word, []).append(i)
    together = all_of([has_phrase(text, [word]) for word in offsets])
    if len(offsets) == len(words):
        return together & (_narrowest(tokens(text), words) <= slop)
    repeated = max(offsets, key=lambda word: len(offsets[word]))

    def tried(held: Column) -> Column:
        places = F.filter(F.sequence(F.lit(1), F.size(held)), lambda i: F.element_at(held, i) == repeated)

        def starts(place: Column) -> Column:
            first = F.greatest(place - offsets[repeated][0] - slop, F.lit(1 - len(words)))
            return F.exists(
                F.sequence(first, place - offsets[repeated][0]),
                lambda start: all_of([_within(held, w, at, start, slop) for w, at in offsets.items()]),
            )

        return F.when(F.size(held) > 0, F.exists(places, starts)).otherwise(False)

    return together & _named(tokens(text), tried)


def has_any_token(text: Column, words: Sequence[str]) -> Column:
    """At least one of the words is a token of the text."""
    usable = [word for word in dict.fromkeys(words) if is_token(word)]
    if len(usable) > FEW_WORDS:
        return F.arrays_overlap(tokens(text), string_array(usable))
    if len(usable) < 2:
        return has_phrase(text, usable)
    # A one-element array gives the lower-cased text a name, so that it is made once.
    return F.exists(F.array(F.lower(text)), lambda low: any_of([low.rlike(_whole([word])) for word in usable]))


def has_token_prefix(text: Column, prefix: str) -> Column:
    return F.lower(text).rlike(_starting(prefix)) if is_token(prefix) else F.lit(False)


def has_token_like(text: Column, wildcard: str) -> Column:
    """A token matches a pattern of ``*`` (any run) and ``?`` (one character)."""
    literal = wildcard.replace("*", "").replace("?", "")
    if not wildcard or (literal and not is_token(literal)):
        return F.lit(False)
    if not wildcard.strip("*"):
        return F.lower(text).rlike(TOKEN_CHAR)
    first = re.match(r"[^*?]*", wildcard)[0]
    rest = wildcard[len(first) :].replace("*", f"{TOKEN_CHAR}*").replace("?", TOKEN_CHAR)
    return F.lower(text).rlike((_starting(first) if first else NOT_BEFORE) + rest + NOT_AFTER)


def full_match(value: Column, regex: str) -> Column:
    """The regular expression (Java syntax) matches the whole value."""
    return value.rlike(rf"(?s)\A(?:{regex})\z")


def has_token_matching(text: Column, regex: str) -> Column:
    return F.exists(tokens(text), lambda token: full_match(token, regex))


def auto_edits(word: str) -> int:
    """Edits allowed for a word by its length: none, one or two."""
    return 0 if len(word) <= 2 else 1 if len(word) <= 5 else 2


def _swap(word: str, i: int) -> str:
    return word[:i] + word[i + 1] + word[i] + word[i + 2 :]


def within_edits(value: Column, word: str, edits: int) -> Column:
    """At most ``edits`` (0, 1 or 2) changes turn ``word`` into the value.

    A change inserts, deletes or replaces one character or swaps two
    neighbours, and no character is changed twice. ``levenshtein`` covers all
    but the swaps, which are spelled out: one swap alone, two separate swaps,
    and one swap with the other change wholly before or after it.
    """
    if edits not in (0, 1, 2):
        raise ValueError("edits must be 0, 1 or 2")
    if edits == 0:
        return value == word
    swaps = range(len(word) - 1)
    plain = F.levenshtein(value, F.lit(word), edits) >= 0
    if edits == 1:
        return value.isin([_swap(word, i) for i in swaps]) | plain
    two_swaps = {_swap(_swap(word, i), j) for i in swaps for j in range(i + 2, len(word) - 1)}
    mixed = []
    for i in swaps:
        before, pair, after = word[:i], word[i + 1] + word[i], word[i + 2 :]
        head = F.substr(value, F.lit(1), F.length(value) - len(pair + after))
        mixed.append(value.endswith(pair + after) & (F.levenshtein(head, F.lit(before), 1) >= 0))
        tail = F.substr(value, F.lit(len(before + pair) + 1))
        mixed.append(value.startswith(before + pair) & (F.levenshtein(tail, F.lit(after), 1) >= 0))
    # A swap and a change are at most three plain edits: few tokens get past this test.
    close = F.levenshtein(value, F.lit(word), 3) >= 0
    return value.isin(sorted(two_swaps)) | (close & any_of([plain, *mixed]))


def has_token_within(text: Column, word: str, edits: int) -> Column:
    if edits == 0:
        return has_any_token(text, [word])
    candidates = tokens(text, len(word) - edits, len(word) + edits)
    return F.exists(candidates, lambda token: within_edits(token, word, edits))
