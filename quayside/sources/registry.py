"""One ``read`` and one ``write`` for every kind of endpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.endpoints import Endpoint, File, Index, KeyedTable, RelationalTable, Topic
from quayside.functions import messages
from quayside.sources import files, indexes, tables, topics


def read(spark: SparkSession, endpoint: Endpoint) -> DataFrame:
    """The endpoint's rows as a batch."""
    if isinstance(endpoint, File):
        return files.load(spark, endpoint)
    if isinstance(endpoint, RelationalTable):
        return tables.read_relational(spark, endpoint)
    if isinstance(endpoint, KeyedTable):
        return tables.read_keyed(spark, endpoint)
    if isinstance(endpoint, Index):
        return indexes.read_index(spark, endpoint)
    if isinstance(endpoint, Topic):
        return topics.decode(topics.read_messages(spark, endpoint), endpoint)
    raise TypeError(f"not an endpoint: {endpoint!r}")


def read_stream(spark: SparkSession, endpoint: File | Topic) -> DataFrame:
    """The endpoint's rows as a stream of new files or messages."""
    if isinstance(endpoint, File):
        return files.load(spark, endpoint, stream=True)
    return topics.decode(topics.stream_messages(spark, endpoint), endpoint)


def write(frame: DataFrame, endpoint: Endpoint, mode: str | None = None) -> None:
    """Write a batch. Files and tables need a save mode, topics and indexes only take more rows."""
    if isinstance(endpoint, File):
        files.write(frame, endpoint, mode)
    elif isinstance(endpoint, RelationalTable):
        tables.write_relational(frame, endpoint, mode)
    elif isinstance(endpoint, KeyedTable):
        tables.write_keyed(frame, endpoint, mode)
    elif isinstance(endpoint, Index):
        indexes.write_index(frame, endpoint)
    elif isinstance(endpoint, Topic):
        topics.publish(topics.to_messages(frame, endpoint), endpoint)
    else:
        raise TypeError(f"not an endpoint: {endpoint!r}")


def sets_aside(endpoint: Endpoint) -> bool:
    """Does the endpoint name a folder for its malformed messages?"""
    return isinstance(endpoint, Topic) and endpoint.malformed not in ("fail", "keep")


def set_aside_malformed(parsed: DataFrame, topic: Topic, folder: str = "") -> None:
    """Write the malformed messages to the topic's folder for them, in place of what is there."""
    messages.malformed(parsed).write.mode("overwrite").json(topic.malformed + folder)
