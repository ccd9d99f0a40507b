"""Quality rules by divergence from what a language usually looks like.

For every language the corpus names, a reference holds the shares of character
classes and of the most common words over all its documents. A document is
compared with every reference by the Jensen-Shannon distance (base 2, 0 to 1)
and kept if, against the nearest one, neither histogram is too far off. How far
words can be off depends on how much of a language its common words make up, so
their bound is a share of the distance of a text that has none of them. A reference
speaks for a text where it lets some common words be expected in so many words. A
text is rejected if no reference that speaks for it is near, but for a text whose
nearest reference by characters does not speak: its words are not judged, as where
words are not set apart. What other languages the table holds, and how much of them,
is nothing to a text. Texts below a minimum length are not judged by a histogram,
since few characters or words prove nothing. Plain base rules come first.

Defined results: a null or empty text has no words and fails the base rules.
Without any reference (no named language) only the base rules decide. Repeated
rows get equal answers; references are sums, so the order of rows is nothing to
them. Texts are read whole. Result columns replace columns of the same name.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import free_name, window_hashes, word_hashes

#: Common words of a reference.
WORDS = 150
#: Different words that a task counts before it sends their counts on.
TASK_WORDS = 200_000
#: Greatest distances from the nearest reference, and the lengths from which they are applied.
FARTHEST_CLASSES, LEAST_CHARS = 0.3, 250
#: Of words, the distance as a share of that of a text without a common word of the reference.
FARTHEST_WORDS, LEAST_WORDS = 0.98, 100
#: Where a reference lets fewer common words be expected, one is enough to be near it; where fewer still, it does not speak.
EXPECTED, LEAST_EXPECTED = 40, 5

#: The symbols that the base rules count.
SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "blank", "stop", "mark", "symbol", "other")
WORD = re.compile(r"[^\W\d_]+")


def _class_table() -> np.ndarray:
    table = np.full(0x110000, CLASSES.index("other"), np.uint8)
    for code in range(0x20000):
        char = chr(code)
        if char.isalpha():
            table[code] = CLASSES.index("upper" if char.isupper() else "lower")
        elif char.isdigit():
            table[code] = CLASSES.index("digit")
        elif char.isspace():
            table[code] = CLASSES.index("blank")
        elif char in ".,":
            table[code] = CLASSES.index("stop")
        elif char in SYMBOLS:
            table[code] = CLASSES.index("symbol")
        elif code < 128:
            table[code] = CLASSES.index("mark")
    return table


_TABLE: np.ndarray | None = None


def class_counts(text: str) -> np.ndarray:
    global _TABLE
    if _TABLE is None:
        _TABLE = _class_table()
    counts = np.zeros(len(CLASSES))
    for start in range(0, len(text), 1 << 20):
        codes = np.frombuffer(text[start : start + (1 << 20)].encode("utf-32-le", "surrogatepass"), np.uint32)
        counts += np.bincount(_TABLE[codes], minlength=len(CLASSES))
    return counts


def distances(counts: np.ndarray, models: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distances, base 2, of histograms from models, row by row."""
    p = counts / np.maximum(counts.sum(-1, keepdims=True), 1e-12)
    q = models / np.maximum(models.sum(-1, keepdims=True), 1e-12)
    middle = np.maximum((p + q) / 2, 1e-300)
    parts = p * np.log2(np.maximum(p, 1e-300) / middle) + q * np.log2(np.maximum(q, 1e-300) / middle)
    return np.sqrt(np.maximum(parts.sum(-1) / 2, 0.0))


class References:
    """Of every language: the character classes, and the common words with their counts, all other words together last."""

    def __init__(self, classes: dict[str, np.ndarray], words: dict[str, list[tuple[str, int]]], totals: dict[str, int]):
        self.languages = sorted(classes)
        self.classes = np.array([classes[x] for x in self.languages])
        self.words = np.zeros((len(self.languages), WORDS + 1))
        self.places: dict[str, int] = {}  # of every common word, from 1 on
        self.columns = np.zeros((len(self.languages), WORDS), np.int64)
        for row, name in enumerate(self.languages):
            for column, (word, n) in enumerate(words.get(name, [])):
                self.words[row, column] = n
                self.columns[row, column] = self.places.setdefault(word, len(self.places) + 1)
            self.words[row, -1] = max(0, totals[name] - self.words[row].sum())
        self.share = self.words[:, :-1].sum(1) / np.maximum(self.words.sum(1), 1)
        self.farthest = FARTHEST_WORDS * distances(np.eye(WORDS + 1)[-1], self.words)

    def divergences(self, text: str) -> tuple[float | None, float | None]:
        """The least distances of character classes and of words from any language; null below the minimum lengths."""
        return self.verdict(text)[:2]

    def verdict(self, text: str) -> tuple[float | None, float | None, bool]:
        """The two distances, and whether the words may be of any of the languages."""
        classes = words = None
        usual = True
        if self.languages and len(text) >= LEAST_CHARS:
            of_classes = distances(class_counts(text)[None], self.classes)
            classes = float(of_classes.min())
            found = WORD.findall(text.lower())
            if len(found) >= LEAST_WORDS:
                common = np.bincount(list(filter(None, map(self.places.get, found))), minlength=len(self.places) + 1)
                counts = np.zeros(self.words.shape)
                counts[:, :-1] = np.where(self.columns > 0, common[self.columns], 0)
                counts[:, -1] = len(found) - counts.sum(1)
                each = distances(counts, self.words)
                words = float(each.min())
                expected, some = len(found) * self.share, counts[:, :-1].any(1)
                speaks = expected >= LEAST_EXPECTED
                near = speaks & ((each <= self.farthest) | (expected < EXPECTED) & some)
                usual = bool(near.any() or not speaks[of_classes.argmin()])
        return classes, words, usual


def references(docs: DataFrame, text: str = "text", lang: str = "lang") -> References:
    """Counts over all documents with a language; each task sums its words, and all sums are added up."""

    def rows_of(classes: dict, words: dict) -> pa.RecordBatch:
        rows = [(name, i, None, int(n)) for name, counts in classes.items() for i, n in enumerate(counts)]
        rows += [(name, -1, None, counts.total()) for name, counts in words.items()]
        rows += [(name, -2, w, n) for name, counts in words.items() for w, n in counts.items()]
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        types = (pa.string(), pa.int32(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["lang", "slot", "word", "n"]
        )

    def summed(batches):
        classes, words, size = defaultdict(lambda: np.zeros(len(CLASSES))), defaultdict(Counter), 0
        for batch in batches:
            for value, name in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                if value := value.as_py():
                    classes[name] += class_counts(value)
                    size -= len(words[name])
                    words[name].update(WORD.findall(value.lower()))
                    size += len(words[name])
                    if size > TASK_WORDS:
                        yield rows_of(classes, words)
                        classes.clear()
                        words.clear()
                        size = 0
        yield rows_of(classes, words)

    named = docs.select(F.col(text), F.col(lang).cast("string")).where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    sums = named.mapInArrow(summed, "lang string, slot int, word string, n long").groupBy("lang", "slot", "word").agg(F.sum("n").alias("n"))
    # only words have more than one row a slot; the limit on the row number lets each task pass on its first ones alone
    order = Window.partitionBy("lang", "slot").orderBy(F.desc("n"), "word")
    rows = sums.withColumn("place", F.row_number().over(order)).where(F.col("place") <= WORDS).collect()
    totals = {r.lang: r.n for r in rows if r.slot == -1}
    classes, words = {x: np.zeros(len(CLASSES)) for x in totals}, defaultdict(list)
    for r in sorted(rows, key=lambda r: r.place):
        if r.slot >= 0:
            classes[r.lang][r.slot] = r.n
        elif r.slot == -2:
            words[r.lang].append((r.word, r.n))
    return References(classes, words, totals)


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, characters in words, symbols, repeated lines, and words inside a window of five that occurs twice."""
    if not text:
        return 0, 0, 0, 0, 0
    hashes = word_hashes(text)
    blanks = sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    lines = [line for line in text.split("\n") if line.strip(" \t\x0b\x0c\r")]
    repeated = 0
    if len(hashes) > 5:
        windows = window_hashes(hashes)
        _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
        first = np.flatnonzero(times[which] > 1)
        cover = np.zeros(len(hashes) + 1, np.int64)
        cover[: len(windows)] += np.bincount(first, minlength=len(windows))
        cover[5 : 5 + len(windows)] -= np.bincount(first, minlength=len(windows))[: len(cover) - 5]
        repeated = int((np.cumsum(cover) > 0).sum())
    return len(hashes), len(text) - blanks, sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeated


def judged(docs: DataFrame, models: References, text: str = "text") -> DataFrame:
    """The rows with the base counts, the two distances, base_failed and kept."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance", "_usual_words")
    kinds = ["long"] * 5 + ["double"] * 2 + ["boolean"]

    @F.arrow_udf(", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True)))
    def judge(texts: pa.Array) -> pa.Array:
        rows = [base_counts(t) + (models.verdict(t) if t else (None, None, True)) for t in (x.as_py() for x in texts)]
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        types = [pa.int64()] * 5 + [pa.float64()] * 2 + [pa.bool_()]
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=list(names))

    result = free_name(docs, "found")
    found = docs.withColumn(result, judge.asNondeterministic()(F.col(text)))
    of = F.col(result).getField
    failed = (of("n_words") < 10) | (100 * of("n_repeat_words") > 20 * of("n_words"))
    near = F.coalesce(of("class_distance") <= FARTHEST_CLASSES, F.lit(True)) & of("_usual_words")
    columns = {name: of(name) for name in names[:-1]} | {"base_failed": failed, "kept": ~failed & near}
    return found.withColumns(columns).drop(result)


def op8_quality_rules(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged(docs.select("doc_id", "text"), references(docs)).select("doc_id", *columns, "class_distance", "word_distance")
