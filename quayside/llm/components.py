"""Connected components of links, as joins and grouped minima.

Large and small stars in turn: every node's larger neighbours, then its smaller
ones, are linked to the least node known around it, until every component is one
star around its least node. A hub may have any share of the links: its minimum is
taken before the shuffle, and the join that hands it out may be split by Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import discard, kept


def _star(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v) with ``least``, the smallest node around u or u itself."""
    least = pairs.groupBy("u").agg(F.min("v").alias("least"))
    return pairs.join(least.select("u", F.least("u", "least").alias("least")), "u")


def _mark(edges: DataFrame):
    """The number of links and a sum over them, to see whether they change."""
    return edges.agg(F.count("*"), F.expr("sum(cast(xxhash64(u, v) as decimal(38, 0)))")).first()


def components(links: DataFrame, one: str, other: str) -> DataFrame:
    """Rows of node and component, its least node, for every node that has a link to another one.

    A link with a null end, or to itself, is none. Directions and repeats do not matter.
    The result reads a written table, which may be discarded like that of ``kept``.
    """
    links = links.select(F.greatest(one, other).alias("u"), F.least(one, other).alias("v"))
    edges = kept(links.where("u is not null and v is not null and u > v").distinct(), "links")
    last, mark = None, _mark(edges)
    while mark != last and mark[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        small = _star(large.distinct())
        moved = small.select(F.col("v").alias("u"), F.col("least").alias("v")).where("u > v")
        before, edges = edges, kept(small.select("u", F.col("least").alias("v")).union(moved).distinct(), "links")
        discard(before)
        last, mark = mark, _mark(edges)
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v"), F.col("v")).distinct())
    found.scratch_folder = edges.scratch_folder
    return found
