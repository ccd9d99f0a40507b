"""Routes that follow a topic or a folder.

Each micro-batch goes to a folder named after the query and the batch, written
with ``overwrite``: a batch that is run again after a failure replaces itself.
Keyed tables take repeated rows by key. A broker takes the stream directly. A
JDBC table or a search cluster without document ids may see a repeated batch
twice.

A topic without a schema is typed batch by batch, by a schema that grows and is kept
beside the checkpoint: fields that appear later arrive from then on.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from quayside.endpoints import AvailableNow, Endpoint, File, Index, KeyedTable, RelationalTable, Timed, Topic
from quayside.functions import messages
from quayside.plans.route import Route, mirror_pairs, shape
from quayside.sources import indexes, tables, topics
from quayside.sources.registry import read_stream, set_aside_malformed, sets_aside, write


def _triggered(writer: DataStreamWriter, source: File | Topic) -> DataStreamWriter:
    if isinstance(source, File) or isinstance(source.mode, AvailableNow):
        return writer.trigger(availableNow=True)
    if isinstance(source.mode, Timed):
        return writer.trigger(processingTime=f"{source.mode.seconds} seconds")
    return writer


def _batch_folder(frame: DataFrame, batch_id: int) -> str:
    # Spark sets this on the thread of the query; it stays the same after a restart from the checkpoint.
    query_id = frame.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query_id:
        raise RuntimeError("not in the thread of a streaming query")
    return f"/batch-{query_id}-{batch_id:010d}"


def write_batch(frame: DataFrame, output: Endpoint, folder: str) -> None:
    """Write one micro-batch so that writing it again does not repeat its rows."""
    if isinstance(output, File):
        write(frame, replace(output, path=output.path.rstrip("/") + folder), "overwrite")
    elif isinstance(output, KeyedTable):
        tables.write_keyed(frame, output, "append")
    elif isinstance(output, RelationalTable) and output.folder is not None:
        frame.write.mode("overwrite").parquet(tables.table_path(output) + folder)
    elif isinstance(output, Index) and output.folder is not None:
        indexes.with_ids(frame, output).write.mode("overwrite").parquet(indexes.index_path(output) + folder)
    elif isinstance(output, Topic):
        pairs = topics.as_log(frame)
        pairs.write.mode("overwrite").parquet(topics.log_path(output) + folder)
    else:
        write(frame, output, "append" if isinstance(output, RelationalTable) else None)


def start_stream(spark: SparkSession, route: Route) -> StreamingQuery:
    source, output = route.input, route.output
    learns = isinstance(source, Topic) and source.schema is None and not route.is_mirror
    if route.is_mirror:
        rows = mirror_pairs(topics.stream_messages(spark, source), route)
    elif learns:
        rows = topics.stream_messages(spark, source)
    else:
        rows = read_stream(spark, source)
        if not sets_aside(source):
            rows = shape(rows, route)
    to_pairs = isinstance(output, Topic) and not route.is_mirror

    if isinstance(output, Topic) and output.brokers is not None and not learns:
        pairs = topics.to_messages(rows, output) if to_pairs else rows
        writer = pairs.writeStream.format("kafka").options(**topics.write_options(output))
        return _triggered(writer, source).option("checkpointLocation", source.checkpoint).start()

    def handle(frame: DataFrame, batch_id: int) -> None:
        folder = _batch_folder(frame, batch_id)
        parsed = raw = None
        try:
            if learns:
                raw = frame.persist()  # read once for the schema and the rows
                schema = topics.learned_schema(raw, source)
                if not schema.fields and raw.isEmpty():
                    return
                frame = topics.decode(raw, replace(source, schema=schema))
                if not sets_aside(source):
                    frame = shape(frame, route)
            if sets_aside(source) and not route.is_mirror:
                parsed = frame.persist()  # parsed once for both writes
                frame = shape(messages.well_formed(parsed), route)
            if to_pairs:
                frame = topics.to_messages(frame, output)
            if frame.columns:  # none as long as every message was malformed
                write_batch(frame, output, folder)
            if parsed is not None:
                set_aside_malformed(parsed, source, folder)
        finally:
            for kept in (parsed, raw):
                if kept is not None:
                    kept.unpersist()

    writer = rows.writeStream.foreachBatch(handle).option("checkpointLocation", source.checkpoint)
    return _triggered(writer, source).start()
