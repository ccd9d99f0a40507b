"""Relational tables and keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.endpoints import KeyedTable, RelationalTable
from quayside.operators.upsert import latest_per_key
from quayside.sources import storage

WIDE_COLUMN_SOURCE = "org.apache.spark.sql.cassandra"
VERSION = "row_version"


# --- relational ------------------------------------------------------------


def table_path(endpoint: RelationalTable) -> str:
    return f"{endpoint.folder.rstrip('/')}/{endpoint.table}"


def jdbc_options(endpoint: RelationalTable) -> dict:
    # Rows are fetched and sent in batches; drivers may otherwise hold a whole result in memory.
    sizes = {"batchsize": endpoint.batch_size, "fetchsize": endpoint.batch_size}
    return {"url": endpoint.url, "dbtable": endpoint.table, **sizes, **endpoint.properties}


def jdbc_bounds_options(endpoint: RelationalTable) -> dict:
    """Options of a read whose one row, made by the database, has the ends of the partition column."""
    column = endpoint.partition_column
    query = f"SELECT min({column}) AS low, max({column}) AS high FROM {endpoint.table}"
    return {k: v for k, v in jdbc_options(endpoint).items() if k != "dbtable"} | {"query": query}


def jdbc_partition_options(endpoint: RelationalTable, low, high) -> dict:
    """Options that split a read into ranges of the partition column."""
    if endpoint.partition_column is None or low is None:
        return {}
    return {
        "partitionColumn": endpoint.partition_column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": endpoint.num_partitions,
    }


def read_relational(spark: SparkSession, endpoint: RelationalTable) -> DataFrame:
    if endpoint.folder is not None:
        return spark.read.options(recursiveFileLookup=True, mergeSchema=True).parquet(table_path(endpoint))
    reader = spark.read.format("jdbc").options(**jdbc_options(endpoint))
    if endpoint.partition_column is not None:
        low, high = endpoint.bounds or spark.read.format("jdbc").options(**jdbc_bounds_options(endpoint)).load().first()
        reader = reader.options(**jdbc_partition_options(endpoint, low, high))
    return reader.load()


def write_relational(frame: DataFrame, endpoint: RelationalTable, mode: str) -> None:
    if endpoint.folder is not None:
        frame.write.mode(mode).parquet(table_path(endpoint))
        return
    # At most this many connections write at a time.
    options = jdbc_options(endpoint) | {"numPartitions": endpoint.num_partitions}
    frame.write.format("jdbc").options(**options).mode(mode).save()


# --- keyed -----------------------------------------------------------------
#
# In a folder, every write is one numbered version: rows with distinct keys. A
# write never reads older versions. A read scans the base, the last version that
# replaced the whole table, without the keys that later versions hold, and adds
# the latest row of each of those: one scan, plus one shuffle of the later
# versions and of the keys. ``compact_keyed`` makes one base of all versions.
# Versions are numbered by what the folder holds: a table takes one write at a time.


def keyed_path(endpoint: KeyedTable) -> str:
    return f"{endpoint.folder.rstrip('/')}/{endpoint.keyspace}.{endpoint.table}"


def connector_options(endpoint: KeyedTable) -> dict:
    return {
        "keyspace": endpoint.keyspace,
        "table": endpoint.table,
        "spark.cassandra.connection.host": endpoint.hosts,
    }


def read_keyed(spark: SparkSession, endpoint: KeyedTable) -> DataFrame:
    if endpoint.folder is None:
        return spark.read.format(WIDE_COLUMN_SOURCE).options(**connector_options(endpoint)).load()
    versions = _versions(spark, endpoint)
    if not versions:
        raise FileNotFoundError(f"no keyed table at {keyed_path(endpoint)}")
    base = max((n for n, is_base in versions if is_base), default=versions[0][0])
    live = [_version_path(endpoint, n, is_base) for n, is_base in versions if n >= base]
    # Read together, so that all have the columns of all.
    reader = spark.read.option("mergeSchema", True).option("basePath", keyed_path(endpoint))
    rows = reader.parquet(*live).withColumn(VERSION, F.regexp_extract(VERSION, "^[0-9]+", 0))
    first = rows.where(F.col(VERSION) == _number(base)).drop(VERSION)
    if len(live) == 1:
        return first
    latest = latest_per_key(rows.where(F.col(VERSION) > _number(base)), endpoint.keys, [VERSION]).drop(VERSION)
    replaced = latest.select([F.col(f"`{key}`").alias(f"__{key}") for key in endpoint.keys])
    same_key = [F.col(f"`{key}`").eqNullSafe(F.col(f"`__{key}`")) for key in endpoint.keys]
    return first.join(replaced, same_key, "left_anti").unionByName(latest)


def _number(version: int) -> str:
    return f"{version:010d}"


def _version_path(endpoint: KeyedTable, version: int, is_base: bool) -> str:
    return f"{keyed_path(endpoint)}/{VERSION}={_number(version)}{'b' if is_base else 'v'}"


def _versions(spark: SparkSession, endpoint: KeyedTable) -> list[tuple[int, bool]]:
    """Numbers of the versions that were written to the end, and whether each is a base."""
    path = keyed_path(endpoint)
    if not storage.exists(spark, path):
        return []
    names = [n.removeprefix(f"{VERSION}=") for n in storage.sub_folders(spark, path) if n.startswith(f"{VERSION}=")]
    done = [n for n in names if storage.exists(spark, f"{path}/{VERSION}={n}/_SUCCESS")]
    return sorted((int(n[:-1]), n.endswith("b")) for n in done)


def compact_keyed(spark: SparkSession, endpoint: KeyedTable) -> None:
    """Replace all versions of a folder by one."""
    write_keyed(read_keyed(spark, endpoint), endpoint, "overwrite")


def write_keyed(frame: DataFrame, endpoint: KeyedTable, mode: str) -> None:
    if endpoint.folder is None:
        writer = frame.write.format(WIDE_COLUMN_SOURCE).options(**connector_options(endpoint))
        if mode == "overwrite":
            writer = writer.option("confirm.truncate", True)
        writer.mode(mode).save()
        return
    spark = frame.sparkSession
    older = _versions(spark, endpoint)
    if older and mode == "ignore":
        return
    if older and mode == "errorifexists":
        raise FileExistsError(f"keyed table {keyed_path(endpoint)} already exists")
    version = older[-1][0] + 1 if older else 0
    is_base = mode == "overwrite" or not older
    rows = latest_per_key(frame, endpoint.keys, endpoint.order_by)
    # A version of its own folder: what a failed write left there is replaced, and zero rows keep their columns.
    rows.write.option("partitionOverwriteMode", "static").mode("overwrite").parquet(_version_path(endpoint, version, is_base))
    if is_base:
        for n, was_base in older:
            storage.delete(spark, _version_path(endpoint, n, was_base))
