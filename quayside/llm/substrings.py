"""Removal of repeated substrings by a distributed merge sort of suffixes that knows common prefixes.

A byte goes if a string of 100 bytes that covers it also starts earlier, in a smaller
doc_id or before it in the same document. Not every suffix is sorted: anchors are the
positions whose 32 bytes have the least hash within some string of 100 bytes, so two
equal strings have the same anchor at the same distance, and the suffixes of anchors
stand for all. Only anchors whose 32 bytes occur elsewhere go on.

A task sorts the suffixes of its anchors, each with the bytes before it turned round,
and sends them on front-coded, as the length shared with the one before and the rest.
The receiving task merges the runs by a loser tree that compares first the lengths
shared with the last winner, and characters only from there on, so that no known
prefix is compared again. The merged order and its common prefixes say, for every
distance of an anchor from the start of a string, which strings are equal, and the
first of each keeps its bytes.

Whole copies of a document of 100 bytes or more are found by their digest; a task
sends on one of its copies of a text. Suffixes that repeat inside a text, or in a run,
are sent once.

Defined results: a null text is empty, and empty and shorter texts keep all. A row
without an id keeps all and removes nothing elsewhere. Rows that share an id are one
document if they share the text; otherwise each loses the bytes found for the id.
Texts are read whole; anchors of long ones are found in parts that overlap.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import discard, kept, mixed

LENGTH, GRAM = 100, 32
BEFORE = LENGTH - GRAM
WIDTH = LENGTH + BEFORE
#: Anchors that a task sorts at a time, and that a merging task gets, about.
RUN, GROUP = 100_000, 16_384
#: No UTF-8 text has these bytes: they stand for what is behind its end and before its beginning.
END, BEGINNING = b"\xff", b"\xfe"
_PART = 1 << 19


def _slid(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (least or greatest) of every ``width`` neighbours, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = pick(values[:-step], values[step:])
        done += step
    return values


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of a text, in order."""
    places, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for start in range(0, max(0, len(data) - LENGTH + 1), _PART):
        part = data[start : start + _PART + LENGTH - 1].astype(np.uint64) + np.uint64(1)
        size, step = 1, 1
        while size < GRAM:
            part = part[:-size] * np.uint64(pow(0x9E3779B97F4A7C15, step, 1 << 64)) + part[size:]
            size, step = size * 2, step * 2
        part = mixed(part)
        key = (part >> np.uint64(32)).astype(np.uint32)
        window = BEFORE + 1
        least = _slid(key, window, np.minimum)
        # the greatest of the minima of all strings around a position is its own hash if it is the least of one
        edge = np.zeros(window - 1, np.uint32)
        found = np.flatnonzero(_slid(np.concatenate([edge, least, edge]), window, np.maximum) == key)
        places.append(found + start)
        hashes.append(part[found])
    place, first = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(hashes)[first]


def repeated_inside(data: bytes, places: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which anchors of a text have the same suffix as an earlier one, and the spans that repeat there."""
    again, spans = np.zeros(len(places), bool), []
    _, which, times = np.unique(hashes, return_inverse=True, return_counts=True)
    seen: set[bytes] = set()
    for i in np.flatnonzero(times[which] > 1).tolist():
        place = int(places[i])
        around = data[max(0, place - BEFORE) : place + LENGTH]
        if place >= BEFORE and len(around) == WIDTH:
            if around in seen:
                again[i] = True
                spans.append((place - BEFORE, place + LENGTH))
            seen.add(around)
    return again, spans


def _bytes(text: pa.StringScalar) -> bytes:
    return text.as_buffer().to_pybytes() if text.is_valid else b""


def _found(batches):
    """Of every text its digest; of one copy of each text of a task, the first, its anchors and what repeats inside it."""
    least: dict[bytes, int] = {}
    for batch in batches:
        rows = [[np.empty(0, np.int64)] * 3]
        digests, spans = [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            data = _bytes(text)
            if len(data) < LENGTH:
                continue
            digest = hashlib.blake2b(data, digest_size=16).digest()
            digests.append((key, digest, len(data)))
            if least.get(digest, key + 1) > key:
                least[digest] = key
                place, value = anchors(np.frombuffer(data, np.uint8))
                again, inside = repeated_inside(data, place, value)
                rows.append([np.full(len(place) - len(inside), key), place[~again], value[~again].view(np.int64)])
                spans += [(key, start, end) for start, end in inside]
        columns = [np.concatenate(c) for c in zip(*rows, strict=True)]
        many = len(columns[0])
        others = [(d, None, None, digest, n) for d, digest, n in digests] + [(d, start, None, None, end) for d, start, end in spans]
        doc, place, _, digest, size = zip(*others, strict=True) if others else [()] * 5
        few = len(others)
        yield pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([pa.array(columns[0]), pa.array(doc, pa.int64())]),
                pa.concat_arrays([pa.array(columns[1].astype(np.int32)), pa.array(place, pa.int32())]),
                pa.concat_arrays([pa.array(columns[2]), pa.nulls(few, pa.int64())]),
                pa.concat_arrays([pa.nulls(many, pa.binary()), pa.array(digest, pa.binary())]),
                pa.concat_arrays([pa.nulls(many, pa.int64()), pa.array(size, pa.int64())]),
            ],
            names=["doc_id", "place", "gram", "digest", "end"],
        )


def suffix(data: bytes, place: int) -> bytes:
    """The bytes from an anchor on, and those before it turned round, both padded to their greatest length."""
    behind, before = data[place : place + LENGTH], data[max(0, place - BEFORE) : place]
    return behind.ljust(LENGTH, END) + before[::-1].ljust(BEFORE, BEGINNING)


def shared(one: bytes, other: bytes, start: int = 0) -> int:
    """How many bytes two suffixes share, given that they share the first ``start``."""
    differ = int.from_bytes(one[start:], "big") ^ int.from_bytes(other[start:], "big")
    return len(one) - (differ.bit_length() + 7) // 8


def front_coded(keys: list[bytes]) -> tuple[bytes, bytes]:
    """The lengths that sorted suffixes share with the one before, and what remains of each."""
    lengths = [0] + [shared(a, b) for a, b in zip(keys, keys[1:], strict=False)]
    return bytes(lengths), b"".join(k[n:] for k, n in zip(keys, lengths, strict=True))


def decoded(lengths: bytes, rest: bytes) -> list[bytes]:
    keys, last, at = [], b"", 0
    for n in lengths:
        last = last[:n] + rest[at : at + WIDTH - n]
        at += WIDTH - n
        keys.append(last)
    return keys


def merged(runs: list[tuple[list[bytes], bytes]]) -> tuple[list[tuple[int, int]], list[int]]:
    """The order of sorted runs as (run, place in it), and the length each suffix shares with the one before.

    A loser tree: every contender knows what it shares with the last winner, so the
    one that shares more is the smaller, and only equals are compared, from there on.
    """
    size = 1
    while size < len(runs):
        size *= 2
    runs = runs + [([], b"")] * (size - len(runs))
    key = [r[0][0] if r[0] else b"" for r in runs]
    known = [0 if r[0] else -1 for r in runs]
    at = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        if known[a] < 0:
            return a, b
        n = shared(key[a], key[b], known[a])
        if n == WIDTH or key[a][n] < key[b][n]:
            known[b] = n
            return a, b
        known[a] = n
        return b, a

    losers, winners = [0] * size, [0] * (2 * size)
    winners[size:] = range(size)
    for node in range(size - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    winner = winners[1]
    order, lengths = [], []
    while known[winner] >= 0:
        order.append((winner, at[winner]))
        lengths.append(known[winner])
        at[winner] += 1
        keys, own = runs[winner]
        if at[winner] < len(keys):
            key[winner], known[winner] = keys[at[winner]], own[at[winner]]
        else:
            known[winner] = -1
        node = (winner + size) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2
    return order, lengths


def covered(rows: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted distinct suffixes, the least and greatest distance of their anchor from the start of a repeated string.

    ``lengths`` are the common prefixes and ``first`` the ranks of the places in the
    text. The greatest is -1 where no string around the anchor starts earlier.
    """
    count = len(rows)
    least, most = np.full(count, LENGTH), np.full(count, -1)
    behind = (rows[:, :LENGTH] != END[0]).sum(1)
    before = (rows[:, LENGTH:] != BEGINNING[0]).sum(1)
    turned = np.ascontiguousarray(rows[:, LENGTH:])
    order = np.lexsort(turned.T[::-1])
    differ = turned[order[1:]] != turned[order[:-1]]
    shared_before = np.concatenate([[0], np.where(differ.any(1), differ.argmax(1), BEFORE)])
    by_place = np.argsort(first)
    for distance in range(BEFORE + 1):
        same_behind = np.cumsum(lengths < LENGTH - distance)
        same_before = np.empty(count, np.int64)
        same_before[order] = np.cumsum(shared_before < distance)
        string = same_behind * (count + 1) + same_before
        earliest = np.zeros(count, bool)
        earliest[by_place[np.unique(string[by_place], return_index=True)[1]]] = True
        again = ~earliest & (behind >= LENGTH - distance) & (before >= distance)
        least = np.where(again, np.minimum(least, distance), least)
        most = np.where(again, distance, most)
    return least, most


def _spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Table:
    return pa.table({"doc_id": doc.astype(np.int64), "start": start.astype(np.int64), "end": end.astype(np.int64)})


def _merge(table: pa.Table) -> pa.Table:
    docs = [np.array(x, np.int64) for x in table.column("docs").to_pylist()]
    places = [np.array(x, np.int64) for x in table.column("places").to_pylist()]
    lengths = table.column("lengths").to_pylist()
    runs = [(decoded(n, rest), n) for n, rest in zip(lengths, table.column("rest").to_pylist(), strict=True)]
    order, known = merged(runs)
    known = np.array(known, np.int64)
    start = np.concatenate([[0], np.cumsum([len(d) for d in docs])[:-1]])
    pick = np.array([start[r] + i for r, i in order], np.int64)
    doc, place = np.concatenate(docs)[pick], np.concatenate(places)[pick]
    # equal suffixes follow each other: the first place of each class stays, the others are repeats as a whole
    which = np.cumsum(known < WIDTH) - 1
    by_place = np.lexsort((place, doc))
    rank = np.empty(len(doc), np.int64)
    rank[by_place] = np.arange(len(doc))
    begins = np.flatnonzero(known < WIDTH)
    least_rank = np.minimum.reduceat(rank, begins)
    first = by_place[least_rank][which]
    repeat = (doc != doc[first]) | (place != place[first])
    rows = np.frombuffer(b"".join(runs[order[i][0]][0][order[i][1]] for i in begins), np.uint8).reshape(-1, WIDTH)
    behind = (rows[:, :LENGTH] != END[0]).sum(1)
    before = (rows[:, LENGTH:] != BEGINNING[0]).sum(1)
    repeat &= (behind + before)[which] >= LENGTH
    shared_behind = known[begins].copy()
    least, most = covered(rows, shared_behind, least_rank)
    own = np.flatnonzero(most >= 0)
    where = by_place[least_rank[own]]
    return _spans(
        np.concatenate([doc[repeat], doc[where]]),
        np.concatenate([(place - before[which])[repeat], place[where] - most[own]]),
        np.concatenate([(place + behind[which])[repeat], place[where] - least[own] + LENGTH]),
    )


def _runs(groups: int):
    def made(batches):
        waiting: list[tuple[bytes, int, int, int]] = []

        def rows():
            """The sorted run, cut by group; of equal suffixes the first goes on, the others are spans."""
            waiting.sort()
            by_group: dict[int, list] = {}
            spans = []
            last, at = None, None
            for key, doc, place, group in waiting:
                if key == last:
                    if (doc, place) == at:  # the row itself, repeated
                        continue
                    behind, before = LENGTH - key[:LENGTH].count(END), BEFORE - key[LENGTH:].count(BEGINNING)
                    if behind + before >= LENGTH:
                        spans.append((doc, place - before, place + behind))
                    continue
                last, at = key, (doc, place)
                by_group.setdefault(group, []).append((key, doc, place))
            waiting.clear()
            out = []
            for group, own in by_group.items():
                lengths, rest = front_coded([k for k, _, _ in own])
                out.append((group, [d for _, d, _ in own], [p for _, _, p in own], None, lengths, rest))
            if spans:
                doc, start, end = zip(*spans, strict=True)
                out.append((-1, doc, start, end, None, None))
            kinds = [pa.int32(), pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 2, pa.binary(), pa.binary()]
            columns = list(zip(*out, strict=True)) or [[]] * 6
            names = ["group", "docs", "places", "ends", "lengths", "rest"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for key, text, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                data = _bytes(text)
                places = found.values.field("place").to_pylist()
                grams = found.values.field("gram").to_pylist()
                for place, gram in zip(places, grams, strict=True):
                    waiting.append((suffix(data, place), key, place, gram % groups))
                if len(waiting) >= RUN:
                    yield rows()
        yield rows()

    return made


def repeated_spans(docs: DataFrame) -> DataFrame:
    """One row per doc_id with ``spans`` that cover what is repeated; ``docs`` has doc_id, not null, and text."""
    found = kept(docs.mapInArrow(_found, "doc_id long, place int, gram long, digest binary, `end` long"), "substring-anchors")
    texts = found.where("digest is not null").select("doc_id", "digest", "end")
    first = texts.groupBy("digest").agg(F.min("doc_id").alias("first_id"))
    copies = texts.join(first, "digest").where("doc_id > first_id").select("doc_id", F.lit(0).cast("long").alias("start"), "end")
    inside = found.where("digest is null and gram is null")
    alone = kept(copies.union(inside.select("doc_id", F.col("place").cast("long").alias("start"), "end")), "substring-copies")

    same = Window.partitionBy("gram").orderBy("doc_id", "place")
    grams = found.where("gram is not null").select("doc_id", "place", "gram")
    grams = grams.withColumns({"_last": F.lag("place").over(same), "_next": F.lead("place").over(same)})
    grams = grams.where("_last is not null or _next is not null").drop("_last", "_next")
    grams = kept(grams, "substring-grams")
    discard(found)
    groups = max(1, -(-grams.count() // GROUP))
    own = grams.groupBy("doc_id").agg(F.collect_list(F.struct("place", "gram")).alias("found"))
    own = docs.join(own, "doc_id").select("doc_id", "text", "found")
    schema = "group int, docs array<long>, places array<int>, ends array<int>, lengths binary, rest binary"
    runs = kept(own.mapInArrow(_runs(groups), schema), "substring-runs")
    discard(grams)
    inside = runs.where("group < 0").select(F.explode(F.arrays_zip("docs", "places", "ends")).alias("s"))
    inside = inside.select(F.col("s.docs").alias("doc_id"), F.col("s.places").cast("long").alias("start"), F.col("s.ends").cast("long").alias("end"))
    between = runs.where("group >= 0").groupBy("group").applyInArrow(_merge, "doc_id long, start long, end long")
    spans = inside.union(between).union(alone).groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    spans = kept(spans, "substring-spans")
    discard(runs, alone)
    return spans


def _left(data: bytes, own: pa.StructScalar) -> tuple[bytes, int, int]:
    """What spans leave of a text, how many bytes they take, and in how many runs."""
    if not own.is_valid:
        return data, 0, 0
    start = np.minimum(own.values.field("start").to_numpy(zero_copy_only=False), len(data))
    end = np.minimum(own.values.field("end").to_numpy(zero_copy_only=False), len(data))
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    breaks = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
    ends = np.concatenate([reach[breaks[1:] - 1], reach[-1:]])
    parts, done, removed, count = [], 0, 0, 0
    for a, b in zip(start[breaks].tolist(), ends.tolist(), strict=True):
        if b > a:
            parts.append(data[done:a])
            done, removed, count = b, removed + b - a, count + 1
    return b"".join([*parts, data[done:]]), removed, count


def without_repeats(docs: DataFrame, text: str = "text", identity: str = "doc_id", with_text: bool = True) -> DataFrame:
    """One row per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if wanted, kept_text.

    A character that loses some of its bytes shows as a replacement character in ``kept_text``; the digest is of the bytes.
    """
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept_text"] * with_text
    kinds = [pa.int64()] * 3 + [pa.string()] * (1 + with_text)

    @F.arrow_udf("n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * with_text)
    def rest(texts: pa.Array, spans: pa.Array) -> pa.Array:
        rows = []
        for value, own in zip(texts, spans, strict=True):
            data = _bytes(value)
            left, removed, count = _left(data, own)
            row = (len(data), removed, count, hashlib.sha256(left).hexdigest())
            rows.append((*row, left.decode("utf-8", "replace")) if with_text else row)
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    docs = docs.select(F.col(identity).cast("long").alias("doc_id"), F.col(text).alias("text"))
    spans = repeated_spans(docs.where("doc_id is not null"))
    found = docs.join(spans, "doc_id", "left").select("doc_id", rest.asNondeterministic()("text", "spans").alias("_rest"))
    return found.select("doc_id", "_rest.*")


def op7_substring_dedup(spark, folder: str) -> DataFrame:
    return without_repeats(spark.read.parquet(f"{folder}/documents.parquet"), with_text=False)
