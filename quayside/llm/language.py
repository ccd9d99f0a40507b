"""Language ID by error-correcting output codes.

Every learned language has a codeword. One binary classifier per bit, a logistic
regression on hashed character n-grams, says how likely the bit is set. A text
gets the language whose codeword has the least weighted log loss against those
answers; where the two best codewords are nearly as close, it is flagged.

Defined results: a text that is null or has no letter is ``und`` with score 0,
and so is every text when no row is labelled. One learned language wins every
text with a letter. Equal losses go to the language that sorts first. Repeated
rows get equal answers. Texts are read whole, in pieces of a million characters.
Other columns are passed through; prediction columns replace columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import free_name, held_out, learnable, sample_per_class

BUCKETS = 4096
#: Labelled rows that the classifiers are fitted on, per language.
SAMPLE = 400
#: The two best codewords are too close below this difference of the mean loss per bit.
AMBIGUOUS = 0.02
_PIECE = 1 << 20


def _letter_codes() -> np.ndarray:
    """The lower-case code of every letter, 0 for any other character."""
    out = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            out[code] = ord(char.lower()[0])
    return out


_LETTERS: np.ndarray | None = None


def gram_counts(text: str) -> np.ndarray:
    """Counts of the hashed characters and 3-grams, other characters than letters as one; all zero for a text without letters."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = _letter_codes()
    counts = np.zeros(BUCKETS, np.int64)
    for start in range(0, len(text), _PIECE):
        piece = text[max(0, start - 2) : start + _PIECE]
        codes = _LETTERS[np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)]
        if not codes.any():
            continue
        codes = np.concatenate(([0], codes, [0])).astype(np.uint32)
        gram = codes * np.uint32(0x9E3779B1)
        for width in (1, 2, 3):
            if width > 1:
                gram = (gram[:-1] * np.uint32(0x85EBCA6B)) ^ (codes[width - 1 :] * np.uint32(0xC2B2AE35))
            if width != 2:
                counts += np.bincount(gram[1 if width == 1 else 0 :] >> np.uint32(20), minlength=BUCKETS)
    return counts


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """One row of unit length per text, and whether the text has a letter."""
    out = np.zeros((len(texts), BUCKETS), np.float32)
    for i, text in enumerate(texts):
        if text:
            out[i] = np.sqrt(gram_counts(text))
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.maximum(norm, 1e-9), norm[:, 0] > 0


def codewords(classes: int) -> np.ndarray:
    """A row of -1 and 1 per class: every split of up to five classes, else the best of many random codes."""
    if classes < 2:
        return np.ones((classes, 1))
    if classes <= 5:
        bits = 2 ** (classes - 1) - 1
        return np.array([[1 if c == 0 or not (b + 1) >> (c - 1) & 1 else -1 for b in range(bits)] for c in range(classes)])
    random, best, score = np.random.default_rng(7), None, -1
    bits = int(np.ceil(6 * np.log2(classes)))
    for _ in range(200):
        code = random.choice([-1, 1], (classes, bits))
        distance = (bits - code @ code.T) / 2 + bits * np.eye(classes)
        mixed_bits = np.abs(code.sum(0)).max() < classes
        if mixed_bits and distance.min() > score:
            best, score = code, distance.min()
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray
    weight: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def losses(self, rows: np.ndarray) -> np.ndarray:
        margin = rows @ self.weight + self.bias
        loss = np.log1p(np.exp(-np.clip(margin[:, None, :] * self.code[None], -30, 30)))
        return (loss * self.trust).sum(2) / self.trust.sum()


def train(rows: np.ndarray, labels: list[str], steps: int = 120) -> LanguageModel:
    """All bits at once by gradient descent with momentum; a bit is trusted as far as its training log loss is small."""
    languages = sorted(set(labels))
    code = codewords(len(languages)).astype(np.float32)
    target = code[[languages.index(x) for x in labels]] if labels else np.zeros((0, code.shape[1]))
    weight, bias = np.zeros((BUCKETS, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    speed, speed_bias = np.zeros_like(weight), np.zeros_like(bias)
    size = np.array([labels.count(x) for x in languages])
    share = np.array([1 / (len(languages) * size[languages.index(x)]) for x in labels], np.float32)[:, None]
    for _ in range(steps if len(languages) > 1 else 0):
        pull = -target * share / (1 + np.exp(np.clip(target * (rows @ weight + bias), -30, 30)))
        speed = 0.9 * speed - 8 * (rows.T @ pull + 1e-5 * weight)
        speed_bias = 0.9 * speed_bias - 8 * pull.sum(0)
        weight, bias = weight + speed, bias + speed_bias
    loss = (np.log1p(np.exp(-np.clip(target * (rows @ weight + bias), -30, 30))) * share).sum(0) if len(labels) else 0
    return LanguageModel(languages, code, weight, bias, 1 / (0.02 + loss) + np.zeros(code.shape[1]))


def fit(docs: DataFrame, text: str = "text", label: str = "lang", identity: str = "doc_id", rows: int = SAMPLE) -> LanguageModel:
    """Fit on about ``rows`` labelled rows per language outside the held-out third; features are computed by the executors."""
    known = docs.select(F.col(identity).alias("doc_id"), F.col(text).alias("text"), F.col(label).cast("string").alias("label"))
    chosen = sample_per_class(known.where(learnable() & F.col("label").isNotNull()), "label", rows, "doc_id")

    def vectors(batches):
        for batch in batches:
            row, letters = features(batch.column("text").to_pylist())
            seen = np.flatnonzero(letters)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").take(pa.array(seen)), pa.array([row[i].astype(np.float16).tobytes() for i in seen], pa.binary())],
                names=["label", "row"],
            )

    found = chosen.select("label", "text").mapInArrow(vectors, "label string, row binary").toPandas()
    found = found.sort_values(["label", "row"])
    rows_of = [np.frombuffer(x, np.float16) for x in found["row"]]
    return train(np.array(rows_of, np.float32).reshape(-1, BUCKETS), found["label"].tolist())


def prediction(model: LanguageModel, text: Column) -> Column:
    """A struct (lang_pred, score, ambiguous); kept apart from filters above it, so that it runs once per row."""

    @F.arrow_udf("lang_pred string, score double, ambiguous boolean")
    def predict(texts: pa.Array) -> pa.Array:
        names, scores, flags = [], [], []
        for start in range(0, len(texts), 256):
            rows, letters = features(texts.slice(start, 256).to_pylist())
            letters &= bool(model.languages)
            if not model.languages:
                loss = np.zeros((len(rows), 1))
            else:
                loss = model.losses(rows) if len(model.languages) > 1 else np.zeros((len(rows), 1))
            best = loss.argmin(1)
            close = np.sort(loss, 1)[:, :2]
            odds = np.exp(-8 * (loss - loss.min(1, keepdims=True)))
            names += [model.languages[b] if ok else "und" for b, ok in zip(best, letters, strict=True)]
            scores += np.where(letters, 1 / odds.sum(1), 0.0).tolist()
            flags += (letters & (loss.shape[1] > 1) & (close[:, -1] - close[:, 0] < AMBIGUOUS)).tolist()
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(flags, pa.bool_())],
            names=["lang_pred", "score", "ambiguous"],
        )

    return predict.asNondeterministic()(text)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows with lang_pred, score and ambiguous."""
    result = free_name(docs, "found")
    found = docs.drop("lang_pred", "score", "ambiguous").withColumn(result, prediction(model, F.col(text)))
    return found.select("*", f"{result}.*").drop(result)


def accepted(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows whose language is clear; texts without letters and ambiguous texts go."""
    result = free_name(docs, "found")
    found = docs.withColumn(result, prediction(model, F.col(text)))
    return found.where((F.col(f"{result}.lang_pred") != "und") & ~F.col(f"{result}.ambiguous")).drop(result)


def op5_language_id(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = identify(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")
