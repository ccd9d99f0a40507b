"""What the operators share: scratch tables, folds, bounded samples and word hashes."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import quayside
from quayside.sources.storage import delete, scratch_folder

#: The characters that separate words, x20 and x09 to x0D.
SEPARATORS = " \t\n\x0b\x0c\r"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per context; those that join later get it too."""
    name = "quayside-package.zip"
    if any(path.endswith(name) for path in spark.sparkContext.listFiles):
        return
    root = Path(quayside.__file__).parent
    package = Path(tempfile.mkdtemp()) / name  # of the driver, which serves it
    with zipfile.ZipFile(package, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(package))


def kept(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a written table in the shared scratch folder: computed once, read by every executor.

    Its shuffle files go when it is written, not when the driver happens to collect its garbage.
    """
    spark = frame.sparkSession
    folder = scratch_folder(spark, name)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        frame.write.parquet(folder)
    finally:
        spark.conf.set(CLEANUP, before)
    table = spark.read.schema(frame.schema).parquet(folder)
    table.scratch_folder = folder
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``kept`` that nothing reads any more, not even a plan that is still to run."""
    for table in tables:
        delete(table.sparkSession, table.scratch_folder)


def free_name(frame: DataFrame, wanted: str, *others: str) -> str:
    """A name like the wanted one that no column of the frame and none of the others has, whatever its case."""
    taken = {name.lower() for name in (*frame.columns, *others)}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def held_out(key: str = "doc_id") -> Column:
    """True for the third of the ids that no model learns from; a null id is in neither part."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def learnable(key: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 != 1, F.lit(False))


def sample_per_class(frame: DataFrame, label: str, rows: int, *identity: str) -> DataFrame:
    """About ``rows`` rows of every non-null label, chosen by a hash of ``identity``.

    A class with fewer rows is taken whole. The sizes come from one count per
    label, so the sample is bounded by ``rows`` times the number of labels, up
    to chance (hashes are uniform).
    """
    sizes = frame.where(F.col(label).isNotNull()).groupBy(label).count().collect()
    if not sizes:
        return frame.where(F.lit(False))
    share = (F.xxhash64(*identity, F.lit("sample")) % 1_000_003 + 1_000_003) % 1_000_003 / 1_000_003
    wanted = F.lit(False)
    for size in sizes:
        wanted = wanted | ((F.col(label) == F.lit(size[0])) & (share < min(1.0, rows / size[1])))
    return frame.where(wanted)


_IS_SEPARATOR = np.zeros(256, bool)
_IS_SEPARATOR[list(SEPARATORS.encode())] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_PIECE = 1 << 18


def _powers(base: int, size: int) -> np.ndarray:
    out = np.empty(size, np.uint64)
    out[0] = 1
    done = 1
    while done < size:
        step = min(done, size - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


_POWER = _powers(_BASE, 1 << 16)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), 1 << 16)


def mixed(x: np.ndarray) -> np.ndarray:
    """A public 64-bit finaliser, so that all bits of a hash depend on all bits of its input."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _hashes_of_piece(data: np.ndarray) -> np.ndarray:
    global _POWER, _INVERSE
    if len(data) >= len(_POWER):
        size = 1 << (len(data) + 1).bit_length()
        _POWER, _INVERSE = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
    blank = np.ones(len(data) + 2, bool)
    _IS_SEPARATOR.take(data, out=blank[1:-1])
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    first, last = edge[::2], edge[1::2]
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _POWER[: len(data)], out=total[1:])
    return mixed((total[last] - total[first]) * _INVERSE[first] + (last - first).astype(np.uint64))


def word_hashes(text: str | bytes, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of every word of a text, in order, without a Python step per word.

    Each hash is a difference of prefix sums of a polynomial over the bytes. Long
    texts are cut at separators, so memory beyond the text itself is bounded by
    the longest word.
    """
    data = np.frombuffer(text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass"), np.uint8)
    if lower:
        data = _LOWER[data]
    out, start = [], 0
    while start < len(data):
        stop = min(len(data), start + _PIECE)
        while stop < len(data) and not _IS_SEPARATOR[data[stop]]:
            stop += 1
        out.append(_hashes_of_piece(data[start:stop]))
        start = stop
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def window_hashes(words: np.ndarray, width: int = 5) -> np.ndarray:
    """A hash of every run of ``width`` words; of the whole sequence if it is shorter, none if it is empty."""
    width = min(width, len(words))
    if not width:
        return words
    out = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        out = out * np.uint64(0xD1342543DE82EF95) + words[i : len(words) - width + 1 + i]
    return mixed(out + np.uint64(width))
