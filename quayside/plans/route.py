"""Routes: what they may be, and the rows they move."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quayside.endpoints import SAVE_MODES, End, Endpoint, File, Index, KeyedTable, RelationalTable, Topic
from quayside.functions import messages
from quayside.functions.mapping import apply_mapping, stringify
from quayside.operators.search import SearchQuery, search
from quayside.sources.indexes import ID, search_index
from quayside.sources.registry import read, sets_aside


@dataclass(frozen=True)
class Route:
    """Where rows come from, which of them, as what types, and where they go.

    Files and tables need a save mode; topics and indexes must not have one,
    they only take more rows. An index as input needs a search query.
    """

    input: Endpoint
    output: Endpoint
    save_mode: str | None = None
    search: SearchQuery | None = None
    mapping: Mapping | None = field(default=None, compare=False)
    stringify: bool = False

    def __post_init__(self):
        if isinstance(self.output, (File, RelationalTable, KeyedTable)):
            if self.save_mode not in SAVE_MODES:
                raise ValueError(f"an output file or table needs a save mode, one of {', '.join(SAVE_MODES)}")
        elif self.save_mode is not None:
            raise ValueError("an output topic or index must not have a save mode")
        if isinstance(self.input, Index) and self.search is None:
            raise ValueError("an input index needs a search query")
        if self.streaming:
            if self.search is not None:
                raise ValueError("a stream cannot be searched")
            if self.save_mode not in (None, "append"):
                raise ValueError("a stream can only append")
            if not self.input.checkpoint:
                raise ValueError("a stream needs a checkpoint folder")
        if isinstance(self.output, Topic) and self.output.streaming:
            raise ValueError("an output topic has no consumer mode")

    @property
    def streaming(self) -> bool:
        if isinstance(self.input, File):
            return self.input.checkpoint is not None
        return isinstance(self.input, Topic) and self.input.streaming

    @property
    def is_mirror(self) -> bool:
        return isinstance(self.input, Topic) and isinstance(self.output, Topic)


@dataclass(frozen=True)
class RouteResult:
    """What a route did; ``rows`` is unknown while a stream runs or a save mode may skip the write."""

    input: End
    output: End
    rows: int | None = None
    query: StreamingQuery | None = field(default=None, compare=False)


def source_rows(spark: SparkSession, route: Route) -> DataFrame:
    """All rows of a batch route's input; of an index those that its search selects."""
    if isinstance(route.input, Index):
        return search_index(spark, route.input, route.search, route.mapping).drop(ID)
    return read(spark, route.input)


def selected(frame: DataFrame, route: Route) -> DataFrame:
    """The rows of a batch route to be moved: well-formed ones that its search selects."""
    if sets_aside(route.input):
        frame = messages.well_formed(frame)
    return frame if route.search is None or isinstance(route.input, Index) else search(frame, route.search, route.mapping)


def mirror_pairs(raw: DataFrame, route: Route) -> DataFrame:
    """Keys and values of the input topic, keys only where they are to be kept."""
    key = F.col("key") if route.input.keep_key else F.lit(None).cast("binary").alias("key")
    return raw.select(key, "value")


def shape(frame: DataFrame, route: Route) -> DataFrame:
    """The mapping and string options of a route, applied to its rows."""
    if route.mapping is not None:
        frame = apply_mapping(frame, route.mapping)
    return stringify(frame) if route.stringify else frame
