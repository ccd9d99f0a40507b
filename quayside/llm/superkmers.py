"""Removal of repeated word windows by super-k-mers.

A window is ``WIDTH`` consecutive words. Its minimiser is the least hash of its runs
of ``MINIMISER`` words, those that very many texts hold counted last. Consecutive
windows with one minimiser travel as one packed string to the minimiser's bucket, so
that a word is sent about three times and not ``WIDTH`` times. Equal windows have
equal minimisers and meet in their bucket, where the distinct strings are split and
sorted: the first entry of a run of equal windows has the least document. In a string,
the most frequent words are short codes and all others are spelled out, so that equal
strings are equal words; no hash stands for a window, but for the last way below.

Three things keep a bucket small, none of them drops a window. A string that a task has
seen in a smaller document is repeated there whole: its span is an answer already and
the string stays (this takes exact copies and shared passages out of the shuffle, for
at most ``SEEN`` strings at a time). A window all of whose runs are frequent travels
alone, to a bucket of its own. And a bucket that still gets more than ``BUCKET`` rows
sends its windows on by a hash of 128 bits, to be counted by Spark's aggregation.

Defined results: null and empty texts have no words; a text with fewer words than a
window loses none. Only a smaller id takes a word away, so repeats inside a document
and rows that repeat with one id stay. Rows without an id neither take nor lose.
Rows with one id and different texts are told apart by a checksum of their words.
Words that stay are joined by one blank. Texts are read whole. Whatever other columns
the documents have, only the text and the id are read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from itertools import accumulate, chain, groupby, product
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import discard, kept, window_hashes, word_hashes

#: Words of a window and of the runs that its minimiser is chosen from.
WIDTH, MINIMISER = 13, 2
#: Windows in one packed string at most.
PACKED = 64
#: Runs that count as frequent, and words that have a code: at most so many, each held at least so often, and so often
#: in one batch to be counted; and how long such a word is at most.
FREQUENT, OFTEN, OFTEN_IN_BATCH, LONGEST_CODED = 1 << 16, 1000, 8, 64
#: Strings a task remembers at a time, and rows of a bucket that are held at once.
SEEN, BUCKET = 1 << 18, 1 << 17
#: So many different strings of a bucket are first compared by what all their windows have in common.
FEW = 12

_LATE = np.uint64(1 << 63)
_PLAIN = b"\x01"  # before a word that is spelled out
_SPANS = "bucket int, doc_id long, part int, start int, n int, words binary"


def _texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def _part(words: list[bytes]) -> int:
    """A checksum that tells texts of one id apart."""
    return zlib.crc32(b" ".join(words)) - (1 << 31)


def _run_hashes(text: bytes, width: int) -> np.ndarray:
    return window_hashes(word_hashes(text), width)


def frequent(docs: DataFrame) -> tuple[list[int], list[bytes]]:
    """Hashes of the runs, and the words, that the texts hold most, as far as they are many in some batch of texts.

    They only decide which way a window travels and how it is spelled; any lists give the same result.
    """

    def often(column: str, values: pa.Array, times: pa.Array) -> pa.RecordBatch:
        none = {"run": pa.nulls(len(times), pa.int64()), "word": pa.nulls(len(times), pa.binary())}
        arrays = none | {column: values, "times": times.cast(pa.int64())}
        return pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays)).filter(pc.greater_equal(times, OFTEN_IN_BATCH))

    def counted_runs(runs: list) -> pa.RecordBatch:
        run, times = np.unique(np.concatenate(runs), return_counts=True)
        return often("run", pa.array(run.view(np.int64)), pa.array(times))

    def counted(batches):
        for batch in batches:
            column = batch.column(1).cast(pa.binary())
            words = pc.value_counts(pc.ascii_split_whitespace(column.cast(pa.string())).flatten().cast(pa.binary()))
            length = pc.binary_length(words.field(0))
            words = words.filter(pc.and_(pc.greater(length, 0), pc.less_equal(length, LONGEST_CODED)))
            yield often("word", words.field(0), words.field(1))
            runs, size = [], 0
            for text in column.to_pylist():
                found = _run_hashes(text or b"", MINIMISER)
                if len(found) + MINIMISER > WIDTH:
                    runs.append(found >> np.uint64(1))
                    size += len(found)
                if size > 1 << 22:
                    yield counted_runs(runs)
                    runs, size = [], 0
            if runs:
                yield counted_runs(runs)

    counts = docs.mapInArrow(counted, "run long, word binary, times long").groupBy("run", "word").agg(F.sum("times").alias("times"))
    counts = kept(counts, "superkmer-frequent")
    runs = counts.where((F.col("times") >= OFTEN) & F.col("run").isNotNull()).orderBy(F.desc("times"), "run").limit(FREQUENT).collect()
    words = counts.where("word is not null").orderBy(F.desc("times"), "word").limit(FREQUENT).collect()
    discard(counts)
    return [row.run for row in runs], [bytes(row.word) for row in words]


class _Codes(dict):
    """Short codes of words; all other words are spelled out."""

    def __missing__(self, word: bytes) -> bytes:
        return _PLAIN + word


def codes(words: list[bytes]) -> _Codes:
    """A code of one to three bytes for every word, the shortest for the first; none is a separator or ``_PLAIN``."""
    letters = [bytes([b]) for b in range(33, 256)]
    spelled = chain.from_iterable((b"".join(c) for c in product(letters, repeat=n)) for n in (1, 2, 3))
    return _Codes(zip(words, spelled, strict=False))


def split_at_minimisers(text: bytes, late: np.ndarray):
    """Columns (bucket, start, n) of rows that cover every window of a text once; n windows from the word at start."""
    runs = _run_hashes(text, MINIMISER) >> np.uint64(1)
    count = len(runs) + MINIMISER - WIDTH
    if len(late):
        place = np.minimum(np.searchsorted(late, runs), len(late) - 1)
        runs = np.where(late[place] == runs, runs | _LATE, runs)
    least = np.lib.stride_tricks.sliding_window_view(runs, WIDTH - MINIMISER + 1).min(axis=1)
    alone = least >= _LATE
    if alone.any():
        least = np.where(alone, _run_hashes(text, WIDTH), least)
    first = np.ones(count, bool)
    first[1:] = (least[1:] != least[:-1]) | alone[1:] | alone[:-1]
    start = np.flatnonzero(first)
    inside = np.arange(count) - np.repeat(start, np.diff(np.append(start, count)))
    start = np.flatnonzero(inside % PACKED == 0)
    return (least[start] >> np.uint64(8)).astype(np.uint32).view(np.int32), start, np.diff(np.append(start, count))


def packed(docs: DataFrame) -> DataFrame:
    """The windows of all texts as packed strings; rows without words are spans that a smaller document of the task repeats."""
    listed = docs.sparkSession.sparkContext.broadcast(frequent(docs))

    def pack(batches):
        runs, often = listed.value
        late, code, seen = np.sort(np.array(runs, np.int64).view(np.uint64)), codes(often), {}
        for batch in batches:
            rows, size = _Rows(), 0
            for key, text in zip(batch.column(0).to_pylist(), _texts(batch.column(1)), strict=True):
                words = (text or b"").split()  # of bytes: at x20 and x09 to x0D, as wanted
                if len(words) < WIDTH:
                    continue
                part = _part(words)
                bucket, start, n = split_at_minimisers(text, late)
                words = list(map(code.__getitem__, words))
                coded = b" ".join(words)
                at = np.zeros(len(words) + 1, np.int64)
                np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=at[1:])
                first, last = at[start].tolist(), (at[start + n + WIDTH - 1] - 1).tolist()
                strings = [coded[i:j] for i, j in zip(first, last, strict=True)]
                known = np.array([least is not None and least < key for least in map(seen.get, strings)])
                if known.any():
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]])))
                    rows.answers += [(key, part, int(start[i]), int(n[i:j].sum())) for i, j in edge.reshape(-1, 2).tolist()]
                    new = np.flatnonzero(~known)
                    bucket, start, n, strings = bucket[new], start[new], n[new], [strings[i] for i in new.tolist()]
                seen.update(dict.fromkeys(strings, key))
                rows.add(key, part, bucket, start, n, strings)
                size += len(coded)
                if len(seen) > SEEN:
                    seen.clear()
                if size > 1 << 23:
                    yield rows.batch()
                    rows, size = _Rows(), 0
            yield rows.batch()

    return docs.mapInArrow(pack, _SPANS)


class _Rows:
    """Packed strings of some documents, and spans that are answers already, whose rows have no words and may go anywhere."""

    def __init__(self):
        self.documents, self.columns, self.strings, self.answers = [], ([], [], []), [], []

    def add(self, key: int, part: int, bucket: np.ndarray, start: np.ndarray, n: np.ndarray, strings: list[bytes]) -> None:
        self.documents.append((key, part, len(strings)))
        for column, values in zip(self.columns, (bucket, start, n), strict=True):
            column.append(values)
        self.strings += strings

    def batch(self) -> pa.RecordBatch:
        answers = np.array(self.answers, np.int64).reshape(-1, 4)
        key, part, count = np.array(self.documents, np.int64).reshape(-1, 3).T
        bucket, start, n = (np.concatenate([*column, np.empty(0, np.int64)]) for column in self.columns)
        anywhere = (np.arange(len(answers)) * 0x9E3779B1 + answers[:, 0]) % (1 << 31)
        columns = [
            np.concatenate([bucket, anywhere]).astype(np.int32),
            np.concatenate([np.repeat(key, count), answers[:, 0]]),
            np.concatenate([np.repeat(part, count), answers[:, 1]]).astype(np.int32),
            np.concatenate([start, answers[:, 2]]).astype(np.int32),
            np.concatenate([n, answers[:, 3]]).astype(np.int32),
        ]
        words = pa.array(self.strings + [None] * len(answers), pa.binary())
        return pa.RecordBatch.from_arrays([*map(pa.array, columns), words], names=["bucket", "doc_id", "part", "start", "n", "words"])


def _windows(string: bytes) -> list[bytes]:
    at = [0, *accumulate(len(word) + 1 for word in string.split(b" "))]
    return [string[i : j - 1] for i, j in zip(at, at[WIDTH:], strict=False)]


def _core(string: bytes) -> bytes:
    """The words that all windows of a string have in common; none if there are many windows."""
    words = string.split(b" ")
    return b" ".join(words[len(words) - WIDTH : WIDTH])


def _alone(strings: list[bytes]) -> set[bytes]:
    """Strings that share no window with another of a few: one that did would hold the core of the other."""
    if len(strings) > FEW:
        return set()
    cores, met = list(map(_core, strings)), set()
    for i, one in enumerate(strings):
        for j in range(i):
            if cores[j] in one and cores[i] in strings[j]:
                met.update((i, j))
    return {one for i, one in enumerate(strings) if i not in met}


def _repeated_in(rows: list[tuple]) -> list[tuple]:
    """Spans (doc_id, part, start, n) of the windows of a bucket that a smaller document of the bucket has."""
    if all(row[1] == rows[0][1] for row in rows):
        return []
    places = defaultdict(list)
    for _, key, part, start, n, string in rows:
        places[string].append((key, part, start, n))
    alone = _alone(list(places))
    least = {string: min(own)[0] for string, own in places.items()}
    spans = [(key, part, start, n) for s in alone for key, part, start, n in places[s] if key > least[s]]
    met = [s for s in places if s not in alone]
    entries = [(window, least[s], i, j) for i, s in enumerate(met) for j, window in enumerate(_windows(s))]
    entries.sort()
    first = [{} for _ in met]  # of every window of a string, the least document that has it
    before = None
    for window, key, i, j in entries:
        if window != before:
            before, smallest = window, key
        first[i][j] = smallest
    for string, found in zip(met, first, strict=True):
        for key, part, start, _ in places[string]:
            for taken, group in groupby(range(len(found)), lambda j: found[j] < key):  # noqa: B023
                if taken:
                    js = list(group)
                    spans.append((key, part, start + js[0], len(js)))
    return spans


def _sent_on(rows) -> list[tuple]:
    """Every window of some rows alone, named by a hash of 128 bits."""
    out = []
    for _, key, part, start, _, string in rows:
        for j, window in enumerate(_windows(string)):
            name = hashlib.blake2b(window, digest_size=16).digest()
            out.append((key, part, start + j, 1, name))
    return out


def _span_batch(spans: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*spans, strict=True)) or [[]] * 5
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    names = ["doc_id", "part", "start", "n", "window"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _resolve(most: int):
    """Spans of every bucket, for rows in order of their buckets; windows of buckets of more than ``most`` rows are sent on."""

    def resolve(batches):
        held, over = [], False  # rows of the bucket that is being read, and whether it is overfull
        for batch in batches:
            bucket = batch.column(0).to_numpy()
            answer = np.asarray(batch.column(5).is_null())
            if answer.any():
                given = batch.select(["doc_id", "part", "start", "n"]).filter(pa.array(answer))
                yield given.append_column("window", pa.nulls(given.num_rows, pa.binary()))
            spans = []
            same = np.zeros(len(bucket) + 1, bool)
            same[1:-1] = bucket[1:] == bucket[:-1]
            same[[0, -1]] = True  # the batch before or behind may have more of the bucket
            rows = batch.filter(pa.array((same[1:] | same[:-1]) & ~answer))  # a bucket of one row has no answers
            for name, group in groupby(zip(*(c.to_pylist() for c in rows.columns), strict=True), key=itemgetter(0)):
                if held and held[0][0] != name:
                    spans += [(*s, None) for s in _repeated_in(held)] if not over else []
                    held, over = [], False
                for row in group:
                    if over:
                        spans += _sent_on([row])
                    else:
                        held.append(row)
                    if len(held) > most:
                        spans += _sent_on(held)
                        held, over = held[:1], True
                    if len(spans) > 1 << 16:
                        yield _span_batch(spans)
                        spans = []
            if spans:
                yield _span_batch(spans)
        if held and not over:
            yield _span_batch([(*s, None) for s in _repeated_in(held)])

    return resolve


def repeated(docs: DataFrame, text: str = "text", identity: str = "doc_id", bucket: int = BUCKET) -> DataFrame:
    """Spans (doc_id, part, start, n): n windows from the word ``start`` that a smaller document has; they may overlap."""
    docs = docs.select(F.col(identity).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null")
    buckets = packed(docs).repartition("bucket").sortWithinPartitions("bucket")
    found = kept(buckets.mapInArrow(_resolve(bucket), "doc_id long, part int, start int, n int, window binary"), "superkmer-spans")
    sent = found.where("window is not null")
    firsts = sent.groupBy("window").agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last")).where("_first < _last")
    late = sent.join(firsts, "window").where("_first < doc_id")
    return found.where("window is null").drop("window").union(late.select("doc_id", "part", "start", "n"))


def _without(batches):
    """The words that stay of rows (doc_id, text, spans)."""
    for batch in batches:
        out = []
        for key, text, spans in zip(batch.column(0).to_pylist(), _texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            words = (text or b"").split()
            kept_words, removed = words, 0
            if spans:
                part = _part(words)
                edge = np.zeros(len(words) + 1, np.int64)
                for span in spans:
                    if span["part"] == part:
                        edge[span["start"]] += 1
                        edge[span["start"] + span["n"] + WIDTH - 1] -= 1
                stays = np.cumsum(edge[:-1]) == 0
                removed = int(len(words) - stays.sum())
                kept_words = [words[i] for i in np.flatnonzero(stays)] if removed else words
            out.append((key, len(words), removed, b" ".join(kept_words)))
        columns = list(zip(*out, strict=True)) or [[]] * 4
        arrays = [pa.array(c, pa.int64()) for c in columns[:3]] + [pa.array(columns[3], pa.binary()).cast(pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_removed", "text"])


def without_repeats(docs: DataFrame, text: str = "text", identity: str = "doc_id", bucket: int = BUCKET) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, and ``text``, the words that stay."""
    spans = repeated(docs, text, identity, bucket).groupBy("doc_id").agg(F.collect_set(F.struct("part", "start", "n")).alias("spans"))
    docs = docs.select(F.col(identity).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return docs.join(spans, "doc_id", "left").mapInArrow(_without, "doc_id long, n_words long, n_removed long, text string")


def op11_substring_dedup(spark, folder: str) -> DataFrame:
    found = without_repeats(spark.read.parquet(f"{folder}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))
