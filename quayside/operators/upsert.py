"""Keeping one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def _has_order(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _has_order(kind.elementType)
    if isinstance(kind, StructType):
        return all(_has_order(f.dataType) for f in kind.fields)
    return not isinstance(kind, (MapType, VariantType))


def latest_per_key(frame: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the one with the greatest ``order_by`` values.

    Ties go to the greatest remaining values, those of types without an order
    left out. Only the first row of a key is asked for, so every task drops all
    others before the shuffle, and a key that holds a large part of the data is
    shuffled as one row per task.
    """
    rest = [f.name for f in frame.schema.fields if f.name not in (*keys, *order_by) and _has_order(f.dataType)]
    order = [F.col(f"`{name}`").desc() for name in [*order_by, *rest]] or [F.lit(0)]
    best = Window.partitionBy(*[F.col(f"`{key}`") for key in keys]).orderBy(*order)
    return frame.withColumn("__place", F.row_number().over(best)).where("__place = 1").drop("__place")
