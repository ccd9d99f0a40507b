"""Message topics: a broker's, or their messages kept as Parquet with key, value and time."""

from __future__ import annotations

import json
import logging
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.endpoints import Topic
from quayside.functions import messages
from quayside.sources import storage

log = logging.getLogger(__name__)

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def log_path(topic: Topic) -> str:
    return f"{topic.folder.rstrip('/')}/{topic.name}"


def broker_options(topic: Topic) -> dict:
    return {"kafka.bootstrap.servers": topic.brokers, **topic.options}


def batch_read_options(topic: Topic) -> dict:
    return broker_options(topic) | {
        "subscribe": topic.name,
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
    }


def stream_read_options(topic: Topic) -> dict:
    return broker_options(topic) | {"subscribe": topic.name, "startingOffsets": topic.offset}


def write_options(topic: Topic) -> dict:
    return broker_options(topic) | {"topic": topic.name}


# --- reading ---------------------------------------------------------------


def read_messages(spark: SparkSession, topic: Topic) -> DataFrame:
    """The whole topic; a batch read always starts at the earliest message."""
    if topic.offset == "latest":
        log.warning("a batch read of topic %s starts at 'earliest', not 'latest'", topic.name)
    if topic.folder is not None:
        return spark.read.schema(MESSAGE_SCHEMA).option("recursiveFileLookup", True).parquet(log_path(topic))
    return spark.read.format("kafka").options(**batch_read_options(topic)).load()


def stream_messages(spark: SparkSession, topic: Topic) -> DataFrame:
    """New messages as they arrive, from the offset on when there is no checkpoint yet."""
    if topic.folder is None:
        return spark.readStream.format("kafka").options(**stream_read_options(topic)).load()
    reader = spark.readStream.schema(MESSAGE_SCHEMA).option("recursiveFileLookup", True)
    arriving = reader.parquet(log_path(topic))
    if topic.offset == "latest":
        return arriving.where(F.col("_metadata.file_modification_time") >= F.lit(_started(spark, topic)))
    return arriving


def _started(spark: SparkSession, topic: Topic) -> datetime:
    """When the stream was first started; written beside its checkpoint, so that a restart goes on from there."""
    now = datetime.now(timezone.utc)
    if topic.checkpoint is None:
        return now
    path = f"{topic.checkpoint.rstrip('/')}/first-start"
    if not storage.exists(spark, path):
        storage.write_text(spark, path, now.isoformat())
    return datetime.fromisoformat(storage.read_text(spark, path))


def texts(raw: DataFrame) -> DataFrame:
    """Keys and values as strings."""
    return raw.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def decode(raw: DataFrame, topic: Topic) -> DataFrame:
    """Values as typed columns; malformed ones are in ``_corrupt_record`` unless they fail."""
    schema = topic.schema
    if schema is None:
        if raw.isStreaming:
            raise ValueError("a stream without a schema is decoded batch by batch")
        schema = messages.infer_json_schema(raw)
    mode = "FAILFAST" if topic.malformed == "fail" else "PERMISSIVE"
    return messages.json_to_columns(raw, schema, mode=mode)


def learned_schema(raw: DataFrame, topic: Topic) -> T.StructType:
    """The schema of the messages of all batches of a stream up to this one, kept beside its checkpoint.

    It only ever grows: a new field is added, a type is widened. Each change is a file of
    its own, written before the batch is, so that a batch which is run again after a
    failure, and a stream which is started again, know at least what was known before.
    """
    spark, folder = raw.sparkSession, f"{topic.checkpoint.rstrip('/')}/schemas"
    versions = [name for name in storage.files_in(spark, folder) if name.endswith(".json")]
    known = T.StructType()
    if versions:
        known = T.StructType.fromJson(json.loads(storage.read_text(spark, f"{folder}/{versions[-1]}")))
    schema = messages.widen_json_schema(known, raw)
    if schema != known:
        storage.make_folder(spark, folder)
        storage.write_text(spark, f"{folder}/{len(versions) + 1:08d}.json", schema.json())
    return schema


# --- writing ---------------------------------------------------------------


def _key_column(key: str | None) -> Column:
    if key is None:
        return F.lit(None).cast("string")
    return F.uuid() if key == "uuid" else F.col(f"`{key}`").cast("string")


def to_messages(frame: DataFrame, topic: Topic) -> DataFrame:
    """One message per row, its value the row as JSON."""
    return frame.select(_key_column(topic.key).alias("key"), messages.row_to_json(frame).alias("value"))


def as_log(pairs: DataFrame) -> DataFrame:
    """Key and value with the time of the write."""
    return pairs.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.current_timestamp().alias("timestamp"),
    )


def publish(pairs: DataFrame, topic: Topic) -> None:
    """Append key/value pairs to the topic."""
    if topic.folder is not None:
        as_log(pairs).write.mode("append").parquet(log_path(topic))
        return
    pairs.write.format("kafka").options(**write_options(topic)).save()
