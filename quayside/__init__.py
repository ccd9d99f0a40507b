"""Quayside: routes between files, tables, topics and document indexes on Spark.

A *route* names an input, an optional search filter, an optional type
mapping, an output and a save mode, and runs as one Spark plan, in batch or
as a stream.
"""

from quayside.endpoints import (
    AvailableNow,
    Avro,
    Batch,
    Continuous,
    Csv,
    File,
    Index,
    Json,
    KeyedTable,
    Orc,
    Parquet,
    RelationalTable,
    Timed,
    Topic,
    Xlsx,
    Xml,
)
from quayside.operators.search import search
from quayside.plans.route import Route, RouteResult
from quayside.plans.run import run_route
from quayside.sources.registry import read, write

__all__ = [
    "AvailableNow",
    "Avro",
    "Batch",
    "Continuous",
    "Csv",
    "File",
    "Index",
    "Json",
    "KeyedTable",
    "Orc",
    "Parquet",
    "RelationalTable",
    "Route",
    "RouteResult",
    "Timed",
    "Topic",
    "Xlsx",
    "Xml",
    "read",
    "run_route",
    "search",
    "write",
]
