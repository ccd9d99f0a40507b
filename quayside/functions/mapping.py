"""Column types: a mapping applied to a frame, or all values as strings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from quayside.operators.fields import field_kinds

# Spark type of each mapping type; the rest keeps its type.
MAPPING_TYPES = {
    "text": "string",
    "keyword": "string",
    "byte": "tinyint",
    "short": "smallint",
    "integer": "int",
    "long": "bigint",
    "float": "float",
    "double": "double",
    "boolean": "boolean",
    "date": "timestamp",
}


def _typed(column: Column, data_type: DataType, path: str, kinds: Mapping[str, str]) -> Column:
    """The value with its mapped types, also inside structs and arrays; what is not mapped stays as it is."""
    if not any(kind in MAPPING_TYPES and f"{name}.".startswith(f"{path}.") for name, kind in kinds.items()):
        return column
    if isinstance(data_type, ArrayType):
        return F.transform(column, lambda element: _typed(element, data_type.elementType, path, kinds))
    if isinstance(data_type, StructType):
        fields = [_typed(column.getField(f.name), f.dataType, f"{path}.{f.name}", kinds).alias(f.name) for f in data_type.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    target = MAPPING_TYPES.get(kinds.get(path))
    return column.cast(target) if target else column


def apply_mapping(frame: DataFrame, mapping: Mapping) -> DataFrame:
    """Cast the mapped fields, those of objects and of arrays of objects included; other fields stay as they are."""
    kinds = field_kinds(mapping)
    return frame.select([_typed(F.col(f"`{f.name}`"), f.dataType, f.name, kinds).alias(f.name) for f in frame.schema.fields])


def stringify(frame: DataFrame) -> DataFrame:
    """Every value as a string."""
    return frame.select([F.col(f"`{name}`").cast("string").alias(name) for name in frame.columns])
