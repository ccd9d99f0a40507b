"""Rows as JSON texts and JSON texts as rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Timestamps keep their microseconds, in both directions.
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}
CORRUPT = "_corrupt_record"


def row_to_json(frame: DataFrame, keep_nulls: bool = False) -> Column:
    """One JSON object per row; NULL fields are left out unless kept."""
    columns = [F.col(f"`{name}`") for name in frame.columns]
    return F.to_json(F.struct(*columns), JSON_OPTIONS | {"ignoreNullFields": str(not keep_nulls).lower()})


def infer_json_schema(frame: DataFrame, value: str = "value") -> T.StructType:
    """Schema of JSON texts, by one aggregate over all of them.

    Only the merged schema text reaches the driver. Numbers with a fraction
    are double; fields of several kinds, or never set, are strings.
    """
    found = _merged_schema(frame, value)
    if not isinstance(found, T.StructType):
        raise ValueError(f"messages are not JSON objects but {found}")
    return found


def _merged_schema(frame: DataFrame, value: str) -> T.StructType | str:
    """The type of all texts that are JSON, as variants; its name where that is no object."""
    merged = frame.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(value).cast("string"))).alias("s")).first()["s"]

    def spark_type(found: re.Match) -> str:
        if found["kind"] is None:
            return found[0]
        kind = "DOUBLE" if found["kind"].startswith("DECIMAL") else found["kind"]
        return found["before"] + {"OBJECT": "STRUCT", "VOID": "STRING", "VARIANT": "STRING"}.get(kind, kind)

    pattern = r"`(?:[^`]|``)*`|(?P<before>^|: |ARRAY<)(?P<kind>OBJECT|VOID|VARIANT|DECIMAL\(\d+, ?\d+\))"
    ddl = re.sub(pattern, spark_type, merged or "VOID")
    if not ddl.startswith("STRUCT<"):
        return merged or "VOID"
    return frame.sparkSession.sql(f"SELECT CAST(NULL AS {ddl}) AS s").schema["s"].dataType


def widened(known: T.DataType, other: T.DataType) -> T.DataType:
    """A type that holds the values of both: fields of either, in the order they came, double for numbers, else strings."""
    if known == other:
        return known
    if isinstance(known, T.StructType) and isinstance(other, T.StructType):
        fields = {f.name: f.dataType for f in known.fields}
        for field in other.fields:
            fields[field.name] = widened(fields[field.name], field.dataType) if field.name in fields else field.dataType
        return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])
    if isinstance(known, T.ArrayType) and isinstance(other, T.ArrayType):
        return T.ArrayType(widened(known.elementType, other.elementType))
    if isinstance(known, T.NumericType) and isinstance(other, T.NumericType):
        return T.DoubleType()
    return T.StringType()


def widen_json_schema(known: T.StructType, frame: DataFrame, value: str = "value") -> T.StructType:
    """The known schema with what more texts hold; texts that are no JSON objects add nothing.

    A field that was only ever null before counts as a string, and stays one.
    """
    objects = frame.where(F.schema_of_variant(F.try_parse_json(F.col(value).cast("string"))).startswith("OBJECT"))
    found = _merged_schema(objects, value)
    return widened(known, found) if isinstance(found, T.StructType) else known


def json_to_columns(
    frame: DataFrame, schema: T.StructType, value: str = "value", mode: str = "PERMISSIVE"
) -> DataFrame:
    """JSON texts as typed columns.

    ``PERMISSIVE`` adds a ``_corrupt_record`` column that holds the text of
    every malformed message; ``FAILFAST`` raises on the first one.
    """
    fields = schema.fields if mode == "FAILFAST" else [*schema.fields, T.StructField(CORRUPT, T.StringType())]
    options = JSON_OPTIONS | {"mode": mode, "columnNameOfCorruptRecord": CORRUPT}
    text = F.col(value).cast("string")
    return frame.select(F.from_json(text, T.StructType(fields), options).alias("row")).select("row.*")


def well_formed(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def malformed(parsed: DataFrame) -> DataFrame:
    """The texts of the messages that could not be parsed."""
    return parsed.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))
