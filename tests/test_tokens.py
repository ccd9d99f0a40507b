"""Word predicates against plain Python over the same rules."""

import itertools
import random

import regex
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.functions import tokens as tk

TOKEN = regex.compile(r"[\p{L}\p{N}_]+")
TEXTS = [
    None,
    "",
    "  ",
    "The quick brown-fox, jumped_over 2 lazy dogs.",
    "the",
    "THE END",
    "breathe then other",
    "naïve café Straße über",
    "日本語 テキスト и кириллица",
    "a.b c-d e_f 3.14 x1",
    "quick\nbrown\tfox",
    "foxes fox. fox, (fox)",
    "ab ba abc acb cab bca abcd abdc badc",
]


def frame(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, text string")


def found(rows, condition):
    return {r["id"] for r in rows.where(condition).collect()}


def expected(test):
    return {i for i, t in enumerate(TEXTS) if t is not None and test(TOKEN.findall(t.lower()))}


def test_analyse_agrees_with_spark(spark):
    rows = frame(spark).select("text", tk.tokens(F.col("text")).alias("tokens")).collect()
    for row in rows:
        if row["text"] is not None:
            assert row["tokens"] == tk.analyse(row["text"]) == TOKEN.findall(row["text"].lower())


def test_any_token_few_and_many(spark):
    rows = frame(spark)
    few = ["fox", "café", "日本語", "not there", "e_f"]
    many = few + ["a", "b", "c", "d", "x1", "14", "end", "lazy", "2", "jumped_over", "zzz"]
    for words in (few, many, [], ["THE"], ["brown-fox"]):
        assert found(rows, tk.has_any_token(F.col("text"), words)) == expected(lambda t: set(words) & set(t))


def test_phrase(spark):
    for phrase in (["quick", "brown", "fox"], ["brown", "fox"], ["fox", "brown"], ["fox", "fox"], ["the"], []):
        n = len(phrase)
        want = expected(lambda t: n and any(t[i : i + n] == phrase for i in range(len(t))))
        assert found(frame(spark), tk.has_phrase(F.col("text"), phrase)) == want


def loosely(tokens, phrase, slop):
    """All choices of different places."""
    places = [[i for i, t in enumerate(tokens) if t == word] for word in phrase]
    for choice in itertools.product(*places):
        starts = [p - i for i, p in enumerate(choice)]
        if len({*choice}) == len(choice) and max(starts) - min(starts) <= slop:
            return True
    return False


def test_loose_phrase(spark):
    random_ = random.Random(3)
    texts = [" ".join(random_.choices("abcd", k=random_.randint(0, 12))) for _ in range(120)] + TEXTS
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    phrases = ["a b", "b a", "a a", "a b c", "c a b", "a b a", "a a b b", "a b a b a", "a x b", "d", "quick fox", "the other"]
    conditions = {
        (phrase, slop): tk.has_loose_phrase(F.col("text"), phrase.split(), slop) for phrase in phrases for slop in (0, 1, 2, 3, 7, 1 << 20)
    }
    names = {f"c{i}": key for i, key in enumerate(conditions)}
    found = rows.select("id", *[F.coalesce(c, F.lit(False)).alias(n) for n, c in zip(names, conditions.values(), strict=True)]).collect()
    for name, (phrase, slop) in names.items():
        want = {i for i, t in enumerate(texts) if t and loosely(TOKEN.findall(t.lower()), phrase.split(), slop)}
        assert {r["id"] for r in found if r[name]} == want, (phrase, slop)


def test_prefix_and_wildcard(spark):
    rows = frame(spark)
    for prefix in ("fo", "the", "ü", "x", "", "a.b"):
        want = expected(lambda t: prefix and any(w.startswith(prefix) for w in t))
        assert found(rows, tk.has_token_prefix(F.col("text"), prefix)) == want
    for pattern in ("f*", "*x", "f?x", "*o*e*", "????", "*", "**", "caf?", "a.b", "th?", ""):
        as_regex = regex.compile(regex.escape(pattern).replace(r"\*", ".*").replace(r"\?", "."))
        want = expected(lambda t: pattern and any(as_regex.fullmatch(w) for w in t))
        assert found(rows, tk.has_token_like(F.col("text"), pattern)) == want, pattern


def test_regex_matches_whole_tokens(spark):
    for pattern in ("fo.", "f.*", "the|end", "[a-c]+"):
        want = expected(lambda t: any(regex.fullmatch(pattern, w) for w in t))
        assert found(frame(spark), tk.has_token_matching(F.col("text"), pattern)) == want


def aligned_distance(a: str, b: str) -> int:
    """Edits with swaps of neighbours, no character edited twice."""
    d = [[i + j if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    word=st.text("abcé", min_size=1, max_size=7),
    others=st.lists(st.text("abcé", max_size=8), min_size=40, max_size=80),
)
def test_within_edits_is_aligned_distance(spark, word, others):
    swapped = [word[:i] + word[i : i + 2][::-1] + word[i + 2 :] for i in range(len(word))]
    values = sorted({*others, word, *swapped, *(s[1:] for s in swapped), *(s[::-1] for s in swapped)})
    rows = spark.createDataFrame([(v,) for v in values], "value string")
    for edits in (0, 1, 2):
        got = {r["value"] for r in rows.where(tk.within_edits(F.col("value"), word, edits)).collect()}
        assert got == {v for v in values if aligned_distance(word, v) <= edits}


def test_fuzzy_token_lengths(spark):
    text = "ab ba abc acb cab bca abcd abdc badc"
    assert tk.auto_edits("ab") == 0 and tk.auto_edits("abcde") == 1 and tk.auto_edits("abcdef") == 2
    for word, edits in (("abcd", 1), ("abcd", 2), ("x", 1), ("zzzz", 2)):
        want = expected(lambda t: any(aligned_distance(word, w) <= edits for w in t))
        assert found(frame(spark), tk.has_token_within(F.col("text"), word, edits)) == want, (text, word)
