"""Running routes: read, filter, type, write, as one Spark plan."""

from __future__ import annotations

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quayside.endpoints import AvailableNow, Endpoint, File, KeyedTable, RelationalTable
from quayside.plans.route import Route, RouteResult, mirror_pairs, selected, shape, source_rows
from quayside.sources import storage, topics
from quayside.sources.registry import set_aside_malformed, sets_aside, write
from quayside.streaming.routes import start_stream


def _location(spark: SparkSession, endpoint: Endpoint) -> str | None:
    """Folder that an overwrite of the endpoint would delete, or that reading it needs."""
    if isinstance(endpoint, File):
        return storage.qualified(spark, endpoint.path)
    if isinstance(endpoint, RelationalTable):
        where = endpoint.url or storage.qualified(spark, endpoint.folder)
        return f"{where}/{endpoint.table}"
    if isinstance(endpoint, KeyedTable):
        where = endpoint.hosts or storage.qualified(spark, endpoint.folder)
        return f"{where}/{endpoint.keyspace}.{endpoint.table}"
    where = getattr(endpoint, "folder", None)
    return None if where is None else f"{storage.qualified(spark, where)}/{endpoint.name}"


def _check_overwrite(spark: SparkSession, route: Route) -> None:
    source, target = _location(spark, route.input), _location(spark, route.output)
    if route.save_mode == "overwrite" and source and target:
        if f"{source}/".startswith(f"{target}/") or f"{target}/".startswith(f"{source}/"):
            raise ValueError("a route cannot overwrite what it reads")


def _rows_read(query: StreamingQuery) -> int | None:
    """Rows of all batches; unknown once Spark has dropped the progress of early ones."""
    progress = query.recentProgress
    kept = int(SparkSession.active().conf.get("spark.sql.streaming.numRecentProgressUpdates"))
    return sum(p["numInputRows"] for p in progress) if len(progress) < kept else None


def run_route(spark: SparkSession, route: Route) -> RouteResult:
    """Run a route. Streams that end by themselves are waited for, others are returned running."""
    ends = {"input": route.input.end(), "output": route.output.end()}
    if route.streaming:
        query = start_stream(spark, route)
        if isinstance(route.input, File) or isinstance(route.input.mode, AvailableNow):
            query.awaitTermination()
            return RouteResult(**ends, rows=_rows_read(query), query=query)
        return RouteResult(**ends, query=query)

    _check_overwrite(spark, route)
    source = None
    if route.is_mirror:
        frame = mirror_pairs(topics.read_messages(spark, route.input), route)
    else:
        source = source_rows(spark, route)
        if sets_aside(route.input):
            source.persist()  # parsed once for both writes
        frame = shape(selected(source, route), route)
    # Rows are counted while they are written; a skipped write counts nothing.
    counted = route.save_mode != "ignore"
    observation = Observation()
    if counted:
        frame = frame.observe(observation, F.count(F.lit(1)).alias("rows"))
    try:
        if route.is_mirror:
            topics.publish(frame, route.output)
        else:
            write(frame, route.output, route.save_mode)
        if sets_aside(route.input) and source is not None:  # only once the target has taken the rest
            set_aside_malformed(source, route.input)
    finally:
        if source is not None:
            source.unpersist()
    return RouteResult(**ends, rows=observation.get["rows"] if counted else None)
