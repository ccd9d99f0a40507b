"""Resampling of documents by their importance for a target distribution.

A text's features are all its runs of one to ``LONGEST`` words, hashed into ``BUCKETS``
buckets. Two counts, over all documents and over all texts of the target, give every
bucket a gain, the log ratio of its smoothed shares. The gains are one array; a task
looks the features of a text up in it and sums. Adding the noise of a Gumbel
distribution, made from a hash of the id, turns the highest scores into a sample
without replacement by weight.

The scores are written once. The cutoff of the highest ones is found by narrowing a
range of whole numbers: every step is one exact count of all rows at ``POINTS`` values
between its ends, first of the score and then, among the rows that tie there, of the
id. Only the chosen rows are sorted, in ranges, and a rank is a place in a range after
the sizes of those before it. Nothing of the documents reaches the driver but counts.

Defined results: null and empty texts have no features and weight 0. Rows without an id
have no noise: their score and rank are null, and they are not among the documents
drawn from. Rows that repeat count each, and those that tie in score and id are ranked
in any order. An empty table has no ranks; an empty target smooths to equal shares.
Only the id and the text are read, whatever other columns there are. Texts are read whole.
"""

from __future__ import annotations

import hashlib
import math
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import kept

#: Words of a feature at most, and buckets.
LONGEST, BUCKETS = 3, 10_000
#: Documents with fewer words are not drawn; the share, in percent, of the others that is; the seed of the noise.
LEAST_WORDS, PERCENT, SEED = 20, 5, 42
#: Values that one count looks at, and rows of a range that is ranked, about.
POINTS, RANGE = 15, 1 << 18

# a-z, digits and all bytes beyond ASCII stay, A-Z become small, anything else ends a word
_KEEP = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def feature_buckets(text: bytes | None) -> tuple[int, np.ndarray]:
    """The number of words of a text and the buckets of its features, repeats included.

    The checksum of a longer run goes on from that of the run without its last word.
    """
    words = (text or b"").translate(_KEEP).split()
    if not words:
        return 0, np.empty(0, np.int64)
    after = [b" " + word for word in words]
    sums = list(map(crc32, words))
    found = [np.array(sums, np.int64)]
    for length in range(2, min(LONGEST, len(words)) + 1):
        sums = list(map(crc32, after[length - 1 :], sums))
        found.append(np.array(sums, np.int64))
    return len(words), np.concatenate(found) % BUCKETS


def _texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def feature_counts(texts: DataFrame, text: str = "text") -> np.ndarray:
    """How many features of all the texts are in each bucket."""

    def counted(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for each in _texts(batch.column(0)):
                total += np.bincount(feature_buckets(each)[1], minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    counts = texts.select(F.col(text).alias("text")).mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in counts.collect():  # one row a bucket
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of every bucket, in thousandths, the log of its share in the target by its share in the source."""
    all_s, all_t = float(source.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    pairs = zip(source.tolist(), target.tolist(), strict=True)
    return np.array([math.floor(1000 * math.log((t + 1) * all_s / ((s + 1) * all_t))) for s, t in pairs], np.int64)


def noise(key: int) -> int:
    """A draw of the Gumbel distribution in thousandths, the same for the same id."""
    h = int(hashlib.sha256(f"{SEED}:{key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, text: str = "text", identity: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_features, weight, score."""
    table = docs.sparkSession.sparkContext.broadcast(gain)

    def score(batches):
        for batch in batches:
            rows = []
            for key, each in zip(batch.column(0).to_pylist(), _texts(batch.column(1)), strict=True):
                words, buckets = feature_buckets(each)
                weight = int(table.value[buckets].sum())
                rows.append((key, words, len(buckets), weight, None if key is None else weight + noise(key)))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            names = ["doc_id", "n_words", "n_features", "weight", "score"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    docs = docs.select(F.col(identity).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return docs.mapInArrow(score, "doc_id long, n_words long, n_features long, weight long, score long")


def cutoff(rows: DataFrame, value: Column, wanted: int) -> tuple[int, int] | None:
    """The greatest whole number that at least ``wanted`` values reach, and how many values are beyond it.

    None where there are fewer values. Every step counts all rows.
    """
    low, high, n = rows.agg(F.min(value), F.max(value), F.count(value)).first()
    if n < wanted or not wanted:
        return None
    beyond = 0  # at least ``wanted`` values are >= low, and ``beyond``, fewer than wanted, > high
    while low < high:
        points = sorted({low + (high - low) * i // (POINTS + 1) + 1 for i in range(POINTS + 1)})
        counts = list(rows.agg(*(F.count_if(value >= point) for point in points)).first())
        reached = [p for p, c in zip(points, counts, strict=True) if c >= wanted]
        short = [(p, c) for p, c in zip(points, counts, strict=True) if c < wanted]
        low = reached[-1] if reached else low
        if short:
            high, beyond = short[0][0] - 1, short[0][1]
    return low, beyond


def drawn(scores: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``scores``, a written table, with ``rank``: 1, 2, 3 ... for the highest scores, ties to smaller ids; null if not drawn."""
    rows = scores.where((F.col("n_words") >= LEAST_WORDS) & F.col("doc_id").isNotNull())
    wanted = percent * rows.count() // 100
    unranked = F.lit(None).cast("long")
    found = cutoff(rows, F.col("score"), wanted)
    if found is None:
        return scores.withColumn("rank", unranked)
    least, beyond = found
    tied = rows.where(F.col("score") == least)
    last = -cutoff(tied, -F.col("doc_id"), wanted - beyond)[0]
    chosen = (F.col("score") > least) | ((F.col("score") == least) & (F.col("doc_id") <= last))
    chosen = F.coalesce((F.col("n_words") >= LEAST_WORDS) & chosen, F.lit(False))
    order = F.desc("score"), F.asc("doc_id")
    dealt = scores.where(chosen).repartitionByRange(wanted // RANGE + 1, *order).withColumn("_range", F.spark_partition_id())
    dealt = kept(dealt, "importance-chosen")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    ahead = dealt.groupBy("_range").count().select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_ahead"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    rank = (F.col("_ahead") + F.col("_place")).cast("long")
    ranked = dealt.withColumn("_place", place).join(ahead, "_range").withColumn("rank", F.when(rank <= wanted, rank))
    return ranked.select(*scores.columns, "rank").union(scores.where(~chosen).withColumn("rank", unranked))


def resampled(docs: DataFrame, target: DataFrame, text: str = "text", identity: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of ``docs``, drawn to resemble ``target``."""
    gain = gains(feature_counts(docs, text), feature_counts(target, text))
    return drawn(kept(scored(docs, gain, text, identity), "importance-scores"))


def op12_importance_resampling(spark, folder: str) -> DataFrame:
    docs, target = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "benchmark"))
    return resampled(docs, target).drop("n_words")
