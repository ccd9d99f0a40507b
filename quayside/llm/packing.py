"""Packing token sequences by multiway differencing (Karmarkar and Karp).

Documents become ids with an end id, and are cut into pieces: whole windows of a
long document stand alone, the rest becomes pieces of at most a quarter window.
Each task collects pieces for some windows and shares them out: every piece
begins as a partition with one filled window; the two partitions with the
greatest imbalance are merged, fullest windows with emptiest, until one is left,
whose windows are nearly equal. If one exceeds the capacity, the same pieces are
shared out among one window more.

Tasks pack what they read, so nothing is shuffled, no group grows with the data,
and a lost task is redone with the same result. At most one window a task stays
partly empty for want of pieces.

Defined results: a null or empty text has the end id alone. Rows that repeat are
packed each. Windows are never longer than the capacity; ``sequence_id`` is
unique and made of the task's number and a counter. Texts are read whole; very
long ones are encoded in parts that begin where the tokenizer begins a word anyway.
"""

from __future__ import annotations

import base64
import heapq
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY, END_ID = 2048, 1
#: Pieces are at most this long, but for whole windows; windows that are shared out at a time, and tokens
#: that each leaves free, so that small imbalances seldom ask for a window more.
PIECE, WINDOWS, SLACK = 512, 128, 12
#: The vocabulary as byte strings and ranks.
VOCABULARY = "byte_bpe_50k.tiktoken"
_PART = 1 << 20
#: A single blank between two other characters always begins a token.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_ENCODINGS: dict = {}
_ADDED: dict = {}


def encoder(path: str | None = None):
    """The byte-level BPE of a rank file, made once per process; strings of special tokens are ordinary text."""
    if path not in _ENCODINGS:
        import public_tokenizers
        import tiktoken

        with open(path or public_tokenizers.path(VOCABULARY), "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        _ENCODINGS[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def token_ids(text: str | None, path: str | None = None) -> np.ndarray:
    """The ids of a text and the end id."""
    text, parts, start = text or "", [], 0
    while start < len(text):
        stop = len(text)
        if stop - start > _PART and (cut := _CUT.search(text, start + _PART)):
            stop = cut.start()
        parts.append(np.array(encoder(path).encode_ordinary(text[start:stop]), np.uint32))
        start = stop
    return np.concatenate([*parts, np.array([END_ID], np.uint32)])


def added_tokens(path: str | None = None) -> dict[str, int]:
    """The ids of the strings that the tokenizer of a rank file, described beside it, reads as one token wherever they stand."""
    if path not in _ADDED:
        import public_tokenizers

        described = os.path.splitext(path or public_tokenizers.path(VOCABULARY))[0] + ".json"
        tokens = []
        if os.path.exists(described):
            with open(described, encoding="utf-8") as file:
                tokens = json.load(file).get("added_tokens", [])
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in tokens):
            raise ValueError(f"{described}: added tokens that depend on what stands around them are not understood")
        _ADDED[path] = {t["content"]: t["id"] for t in tokens}
    return _ADDED[path]


def document_ids(text: str | None, path: str | None = None) -> np.ndarray:
    """The ids of a document as the public tokenizer reads it, added tokens included, and the end id."""
    added = added_tokens(path)
    if not text or not any(token in text for token in added):
        return token_ids(text, path)
    pattern = "|".join(map(re.escape, sorted(added, key=len, reverse=True)))
    parts = []
    for part in re.split(f"({pattern})", text):
        parts.append(np.array([added[part]], np.uint32) if part in added else token_ids(part, path)[:-1])
    return np.concatenate([*parts, np.array([END_ID], np.uint32)])


def differencing(sizes: list[int], windows: int) -> list[tuple[int, list[int]]]:
    """The pieces of every filled window, with its sum, fullest first.

    A partition is the list of its filled windows, fullest first; the others of its
    ``windows`` are empty. A window is its sum and a binary tree of pieces.
    """
    heap = [(-size, i, [(size, i)]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    count = len(heap)
    while len(heap) > 1:
        one, other = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        free = windows - len(other)  # of the second partition, which is turned round
        turned = other[::-1]
        merged = one[:free]
        merged += [(a[0] + b[0], (a[1], b[1])) for a, b in zip(one[free:], turned, strict=False)]
        merged += turned[max(0, len(one) - free) :]
        merged.sort(key=lambda w: -w[0])
        least = merged[-1][0] if len(merged) == windows else 0
        heapq.heappush(heap, (least - merged[0][0], count, merged))
        count += 1
    return [(total, _leaves(tree)) for total, tree in heap[0][2]] if heap else []


def _leaves(tree) -> list[int]:
    out, stack = [], [tree]
    while stack:
        node = stack.pop()
        if isinstance(node, tuple):
            stack += node
        else:
            out.append(node)
    return sorted(out)


def shared_out(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """The pieces of every window; as few windows as differencing can keep within the capacity."""
    windows = -(-sum(sizes) // capacity)
    while True:
        found = differencing(sizes, windows)
        if not found or found[0][0] <= capacity:
            return [pieces for _, pieces in found]
        windows += 1


def pieces_of(length: int, capacity: int, piece: int) -> Iterator[tuple[int, int]]:
    """Start and length of the pieces of a document: whole windows, then even pieces."""
    whole = length - length % capacity
    for start in range(0, whole, capacity):
        yield start, capacity
    rest = length - whole
    count = -(-rest // piece)
    for i in range(count):
        first, last = rest * i // count, rest * (i + 1) // count
        yield whole + first, last - first


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(
    docs: DataFrame,
    text: str = "text",
    identity: str = "doc_id",
    capacity: int = CAPACITY,
    piece: int = PIECE,
    vocabulary: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece, where it lies, and with ``with_ids`` its ids."""
    kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())] * with_ids
    names = [c.split()[0] for c in SCHEMA.split(", ")] + ["ids"] * with_ids

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 32
        waiting: list[tuple] = []
        filled, rows = 0, []

        def place(window: list[tuple]) -> None:
            nonlocal sequence
            offset = 0
            for key, start, total, ids in window:
                row = (key, start, len(ids), zlib.crc32(ids.tobytes()), total, sequence, offset)
                rows.append((*row, ids.astype(np.int32)) if with_ids else row)
                offset += len(ids)
            sequence += 1

        def share() -> None:
            nonlocal filled
            for window in shared_out([len(w[3]) for w in waiting], capacity):
                place([waiting[i] for i in window])
            waiting.clear()
            filled = 0

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = document_ids(value.as_py(), vocabulary)
                for start, length in pieces_of(len(ids), capacity, piece):
                    own = (key, start, len(ids), ids[start : start + length])
                    if length == capacity:
                        place([own])
                        continue
                    if filled + length > WINDOWS * (capacity - min(SLACK, capacity // 8)):
                        share()
                    waiting.append(own)
                    filled += length
                if len(rows) >= 5_000:
                    yield flushed()
        share()
        yield flushed()

    schema = SCHEMA + ", ids array<int>" * with_ids
    return docs.select(F.col(identity).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(packed, schema)


def op3_packing(spark, folder: str) -> DataFrame:
    return pack(spark.read.parquet(f"{folder}/documents.parquet"))
