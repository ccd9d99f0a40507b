"""Document indexes: a search cluster's, or Parquet with an ``_id`` per row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.endpoints import Index
from quayside.operators.search import MultiMatch, QueryString, SearchQuery, search
from quayside.sources.file_bitmaps import summarise, worth_reading
from quayside.sources.index_query import request

INDEX_SOURCE = "org.elasticsearch.spark.sql"
ID = "_id"


def index_path(index: Index) -> str:
    return f"{index.folder.rstrip('/')}/{index.name}"


def read_options(index: Index, query: SearchQuery | None = None) -> dict:
    options = {"es.nodes": index.nodes, "es.resource": index.name, "es.read.metadata": "true"}
    return options if query is None else options | {"es.query": request(query)}


def write_options(index: Index) -> dict:
    options = {"es.nodes": index.nodes, "es.resource": index.name, "es.batch.size.entries": str(index.bulk_size)}
    return options if index.id_column is None else options | {"es.mapping.id": index.id_column}


def _read_cluster(spark: SparkSession, index: Index, query: SearchQuery | None) -> DataFrame:
    documents = spark.read.format(INDEX_SOURCE).options(**read_options(index, query)).load()
    return documents.withColumn(ID, F.element_at("_metadata", ID)).drop("_metadata")


def read_index(spark: SparkSession, index: Index) -> DataFrame:
    """All documents of the index, each with its ``_id``; fields that only some of them have are NULL in the rest."""
    if index.folder is not None:
        return spark.read.options(recursiveFileLookup=True, mergeSchema=True).parquet(index_path(index))
    return _read_cluster(spark, index, None)


def search_index(spark: SparkSession, index: Index, query: SearchQuery, mapping: Mapping | None = None) -> DataFrame:
    """Documents that meet the query; a cluster evaluates it itself."""
    if index.folder is not None:
        documents = worth_reading(read_index(spark, index), index_path(index), query, mapping)
        return search(documents, query, mapping, ID)
    if isinstance(getattr(query, "ids", getattr(query, "values", None)), DataFrame):
        return search(_read_cluster(spark, index, None), query, mapping, ID)
    if not isinstance(query, MultiMatch):
        return _read_cluster(spark, index, query)
    hits = [_read_cluster(spark, index, QueryString(value)) for value in query.values]
    every = reduce(DataFrame.unionByName, hits)
    return every.dropDuplicates([ID]) if query.dedupe else every


def summarise_index(spark: SparkSession, index: Index, fields: Sequence[str], mapping: Mapping | None = None) -> None:
    """Keep bitmaps of the tokens of the files that have none yet, so that searches for rare words skip files."""
    if index.folder is None:
        raise ValueError("a cluster keeps its own")
    summarise(read_index(spark, index), index_path(index), fields, mapping)


def with_ids(frame: DataFrame, index: Index) -> DataFrame:
    """Documents with their ids: taken from a column, kept, or made up."""
    if index.id_column is not None:
        return frame.withColumn(ID, F.col(f"`{index.id_column}`").cast("string"))
    return frame if ID in frame.columns else frame.withColumn(ID, F.uuid())


def write_index(frame: DataFrame, index: Index) -> None:
    """Add the rows as documents."""
    if index.folder is not None:
        with_ids(frame, index).write.mode("append").parquet(index_path(index))
        return
    frame.write.format(INDEX_SOURCE).options(**write_options(index)).mode("append").save()
