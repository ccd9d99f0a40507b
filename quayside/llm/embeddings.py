"""Near-duplicate embeddings by int8 tile products with rigorous error bounds.

Vectors of one label are dealt into tiles by a hash, and every pair of tiles is one
task. A task quantises its vectors to int8, multiplies the tiles, and knows for
every vector how far quantisation moved it, so each product has an error bound.
A pair whose product is below the threshold by more than the bound is no link;
above by more than the bound it is one; only pairs in between are computed in
double precision. A task gives out, per vector, how many it links with and the
least vector it is connected to there, never the pairs.

Equal vectors are one vector with a multiplicity, so that a group of copies, of
any size, is compared once. All pairs of distinct vectors of a label are covered:
the work grows with the square of a label's distinct vectors, the memory of a task
with the tile.

Defined results: rows whose label or id is null, and vectors that are null, empty,
zero, or hold a null or a non-finite number, link with nothing. Vectors of
different lengths do not link. Rows that repeat are vectors of their own, linked
with each other. Result columns are new; others are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import kept
from quayside.llm.components import components

THRESHOLD = 0.93
#: Distinct vectors per tile, about.
TILE = 2048


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors in double precision, their int8 values, scales, and how far off scaled int8 values are."""
    unit = vectors.astype(np.float64)
    unit /= np.abs(unit).max(axis=1, keepdims=True)
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1) / 127
    values = np.rint(unit / scale[:, None])
    error = np.sqrt(np.square(unit - values * scale[:, None]).sum(axis=1)) * (1 + 1e-9)
    return unit, values.astype(np.int8), scale, error


def cosines(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Row by row in double precision, from the vectors as they are given."""
    one, other = one.astype(np.float64), other.astype(np.float64)
    return (one * other).sum(1) / (np.sqrt((one * one).sum(1)) * np.sqrt((other * other).sum(1)))


def links_of(left: np.ndarray, right: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """Which rows of two tiles link, as a matrix."""
    _, a, scale_a, off_a = quantised(left)
    _, b, scale_b, off_b = quantised(right)
    exact = np.float32 if left.shape[1] <= 1000 else np.float64  # sums of int8 products are whole numbers below 2**24
    product = (a.astype(exact) @ b.astype(exact).T) * (scale_a[:, None] * scale_b[None])
    bound = off_a[:, None] + off_b[None] + 3 * off_a[:, None] * off_b[None] + 1e-9
    sure = product - bound >= threshold
    rows, columns = np.nonzero(~sure & (product + bound >= threshold))
    for start in range(0, len(rows), 1 << 16):
        i, j = rows[start : start + (1 << 16)], columns[start : start + (1 << 16)]
        sure[i, j] = cosines(left[i], right[j]) >= threshold
    return sure


def least_connected(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every row and column of a link matrix, the least id connected to it."""
    least_left, least_right = left.copy(), right.copy()
    done = ~links.any(1)
    for start in np.argsort(left, kind="stable"):
        if done[start]:
            continue
        rows, columns = np.zeros(len(left), bool), np.zeros(len(right), bool)
        fresh = np.array([start])
        while len(fresh):
            rows[fresh] = True
            new = links[fresh].any(0) & ~columns
            columns |= new
            fresh = np.flatnonzero(links[:, new].any(1) & ~rows)
        done |= rows
        least = min(left[rows].min(), right[columns].min())
        least_left[rows], least_right[columns] = least, least
    return least_left, least_right


def _tile_pair(table: pa.Table) -> pa.Table:
    own = table.column("own").to_numpy()
    ids, times = table.column("first_id").to_numpy(), table.column("times").to_numpy()
    flat = table.column("embedding").combine_chunks()
    vectors = flat.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
    if (own == 1).all():
        found = links_of(vectors, vectors)
        np.fill_diagonal(found, False)
        counts = found.astype(np.float64) @ times
        least, _ = least_connected(found, ids, ids)
    else:
        left, right = np.flatnonzero(own == 0), np.flatnonzero(own == 2)
        counts, least = np.zeros(len(ids)), ids.copy()
        if len(left) and len(right):
            found = links_of(vectors[left], vectors[right])
            weights = found.astype(np.float64)
            counts[left], counts[right] = weights @ times[right], weights.T @ times[left]
            least[left], least[right] = least_connected(found, ids[left], ids[right])
    seen = np.flatnonzero(counts)
    part = table.select(["label", "first_id", "mark"]).take(pa.array(seen))
    return part.append_column("links", pa.array(counts[seen].astype(np.int64))).append_column("least", pa.array(least[seen]))


def near_duplicates(
    rows: DataFrame, identity: str = "vec_id", embedding: str = "embedding", label: str = "label", tile: int = TILE
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id and kept."""
    rows = rows.select(F.col(identity).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(embedding).alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    rows = rows.withColumn("embedding", F.when(F.coalesce(usable, F.lit(False)), F.col("embedding")))
    classes = rows.where(F.col("embedding").isNotNull()).groupBy("label", "embedding")
    classes = classes.agg(F.min("vec_id").alias("first_id"), F.count("*").alias("times"))
    classes = kept(classes.withColumns({"mark": F.xxhash64("label", "embedding"), "length": F.size("embedding")}), "vector-classes")
    counts = classes.groupBy("label", "length").agg(F.ceil(F.count("*") / tile).alias("n_tiles"))
    dealt = classes.join(counts, ["label", "length"]).withColumn("at", F.pmod("mark", "n_tiles"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_tiles") - 1)))
    own = F.when(F.col("at") == F.col("with"), 1).when(F.col("at") < F.col("with"), 0).otherwise(2)
    dealt = dealt.select(
        "label", "length", F.least("at", "with").alias("low"), F.greatest("at", "with").alias("high"), own.alias("own"), "first_id", "times", "mark", "embedding"
    )
    kind = dict(classes.dtypes)["label"]
    found = dealt.groupBy("label", "length", "low", "high").applyInArrow(
        _tile_pair, f"label {kind}, first_id long, mark long, links long, least long"
    )
    found = kept(found, "vector-links")
    links = found.groupBy("label", "first_id", "mark").agg(F.sum("links").alias("links"))
    groups = components(found, "first_id", "least")
    classes = classes.join(links, ["label", "first_id", "mark"], "left")
    classes = classes.join(groups.withColumnRenamed("node", "first_id"), "first_id", "left").select(
        "label",
        "embedding",
        (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"),
        F.coalesce("component", "first_id").alias("component_id"),
    )
    rows = rows.join(classes, ["label", "embedding"], "left")
    component = F.coalesce("component_id", "vec_id")
    return rows.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def op6_embedding_dedup(spark, folder: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{folder}/embeddings.parquet"))
