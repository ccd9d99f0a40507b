"""Bitmaps of the tokens of files, kept beside them, so that a search for rare words reads few files.

``summarise`` writes, into the hidden folder ``_tokens`` of a Parquet folder, rows of a
file's path, time and size, a field, a number of a bitmap, and the bitmap: one bit for
every hash of a token that some row of the file holds in that field. Files that have a
summary of the field already are not read again.

``worth_reading`` asks the summaries which files can hold what a query needs. A file
that was added or changed since has no summary of its own and is always read, so the
rows are those of the whole scan, whatever the summaries say of it. Only the paths of
the chosen files reach the driver, which has listed them for the scan anyway.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import tokens as tk
from quayside.operators.fields import Documents
from quayside.operators.search import BoolMatchPhrase, Match, SearchQuery, Term, Terms
from quayside.sources.storage import exists

# Bits of a file; a bitmap of Spark's has 32,768 of them.
BITS, BITMAP = 1 << 20, 1 << 15
SUMMARY = "file string, time timestamp, size long, field string, number int, bitmap binary"
FILE = ["file", "time", "size"]


def _summaries(folder: str) -> str:
    return f"{folder.rstrip('/')}/_tokens"


def _bit(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(BITS))


def _of_file() -> list[Column]:
    named = {"file": "file_path", "time": "file_modification_time", "size": "file_size"}
    return [F.col(f"_metadata.{source}").alias(name) for name, source in named.items()]


def _present(spark: SparkSession, folder: str) -> DataFrame:
    """Path, time and size of the files that are there; none of them is opened."""
    options = {"recursiveFileLookup": True, "pathGlobFilter": "*.parquet"}
    return spark.read.format("binaryFile").options(**options).load(folder).select(*_of_file())


def _known(spark: SparkSession, folder: str) -> DataFrame:
    if not exists(spark, _summaries(folder)):
        return spark.createDataFrame([], SUMMARY)
    return spark.read.schema(SUMMARY).parquet(_summaries(folder))


def summarise(documents: DataFrame, folder: str, fields: Sequence[str], mapping: Mapping | None = None) -> None:
    """Write bitmaps for the files of a folder that have none of a field; ``documents`` is what is read from the folder."""
    spark = documents.sparkSession
    described = Documents(documents, mapping)
    for name in fields:
        field = described.field(name)
        if not field.is_text:
            raise ValueError(f"{name} is no text field")
        new = _present(spark, folder).join(_known(spark, folder).where(F.col("field") == name), FILE, "left_anti")
        new = new.collect()
        if not new:
            continue
        bits = F.transform(F.array_distinct(field.token_array()), _bit)
        rows = documents.where(F.col("_metadata.file_path").isin([row.file for row in new]))
        rows = rows.select(*_of_file(), F.explode(bits).alias("bit")).distinct()  # reduced in each task
        number = F.expr(f"int(bit div {BITMAP})").alias("number")
        rows = rows.select(*FILE, F.lit(name).alias("field"), number, (F.col("bit") % BITMAP).alias("place"))
        found = rows.groupBy(*FILE, "field", "number").agg(F.bitmap_construct_agg("place").alias("bitmap"))
        # A file without tokens, or without rows, is known, too.
        read = spark.createDataFrame([(*row, name, -1, None) for row in new], SUMMARY)
        found.union(read).write.mode("append").parquet(_summaries(folder))


def needed_words(query: SearchQuery, described: Documents) -> list[tuple[str, list[str]]] | None:
    """What a file must hold for a query to find something in it: of every pair, one of the words in the field.

    None where that is not known.
    """
    if isinstance(query, (Match, Term, Terms)):
        if not described.field(query.field).is_text or isinstance(getattr(query, "values", None), DataFrame):
            return None
        words = {Match: lambda: tk.analyse(query.value), Term: lambda: [query.value], Terms: lambda: list(query.values)}[type(query)]()
        return [(query.field, [word for word in words if tk.is_token(word)])]
    if isinstance(query, BoolMatchPhrase) and query.filter in ("must", "should") and query.phrases:
        parts = [(name, tk.analyse(text)) for name, text in query.phrases]
        if not all(described.field(name).is_text for name, _ in parts):
            return None
        if query.filter == "must":
            return [(name, [word]) for name, words in parts for word in words]
        if len({name for name, _ in parts}) == 1 and all(words for _, words in parts):
            return [(parts[0][0], [max(words, key=len) for _, words in parts])]
    return None


def _holds(field: str, words: Sequence[str]) -> Column:
    """Does a row of the summaries show one of the words?"""

    def shown(word: str) -> Column:
        bit = _bit(F.lit(word))
        place = bit % BITMAP
        byte = F.conv(F.hex(F.substring("bitmap", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return (F.col("number") == F.floor(bit / BITMAP)) & (F.floor(byte / F.pow(F.lit(2), place % 8)) % 2 == 1)

    return (F.col("field") == field) & tk.any_of([shown(word) for word in words])


def worth_reading(documents: DataFrame, folder: str, query: SearchQuery, mapping: Mapping | None = None) -> DataFrame:
    """The documents of a folder without those files in which the query finds nothing."""
    spark = documents.sparkSession
    needed = needed_words(query, Documents(documents, mapping))
    if not needed or not exists(spark, _summaries(folder)):
        return documents
    fields = sorted({field for field, _ in needed})
    known = _known(spark, folder).where(F.col("field").isin(fields))
    covered = F.count_distinct("field") == len(fields)
    groups = [F.bool_or(_holds(field, words)).alias(f"g{i}") for i, (field, words) in enumerate(needed)]
    files = known.groupBy(*FILE).agg(covered.alias("covered"), *groups)
    useless = files.where(F.col("covered") & ~tk.all_of([F.col(f"g{i}") for i in range(len(groups))]))
    chosen = _present(spark, folder).join(useless, FILE, "left_anti").select("file").collect()
    return documents.where(F.col("_metadata.file_path").isin([row.file for row in chosen]))
