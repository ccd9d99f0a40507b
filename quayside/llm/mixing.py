"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source gets a target in words: its weight's share of the whole, at most
three times its size, the excess reshared. A source's documents are dealt into
blocks by a hash. The mix takes every document as often as the target exceeds
the source's size, and once more those of a quota of blocks, in a permuted order,
so that each source's words are exact to half a document.

The quotas are then split among output shards by a tree: a node holds how many
blocks of each source it is to give out, and its left child gets a draw from the
multivariate hypergeometric distribution, so that the leaves are distributed as
if all blocks had been shuffled, without a shuffle of all blocks. A leaf's blocks
are the next ones of each source's permuted order, disjoint from all others.
Inside a shard, documents are ordered by a hash.

Only DataFrame functions are used, and a hash stands for every random number:
reruns agree. Sources are the only thing whose number must stay small enough for
one row per tree node; a source may hold any share of the rows.

Defined results: a null or empty text has size 0 and is never taken. A null
source is a source of its own, sorted last. A source without words has target 0,
as has every source of an empty table. Rows that repeat count each: those with equal
ids (or none), sources and texts are numbered, and their numbers tell them apart in
every hash, so that they are spread over blocks like any others and the last block
takes as many of them as it has room for. Which of them is which does not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import kept

#: Weights of the sources by code point, repeating; how often a document may be taken.
WEIGHTS, MOST = (1, 2, 3), 3
#: Documents per block and blocks per shard, about.
BLOCK, SHARD = 64, 64
SEED = 17


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) that depends on the seed and the parts alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *parts), 11) / F.lit(float(1 << 53))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """One row per source: source, n_docs, source_size, weight, target. ``sizes`` has source and size.

    The level at which the bounded sources stop and the others share the rest by
    weight is found by one sort of the sources by the level that would fill them.
    """
    sources = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.get(F.array(*map(F.lit, WEIGHTS)), (rank - 1) % len(WEIGHTS))
    sources = sources.withColumn("weight", weight).withColumn("_full", MOST * F.col("source_size"))
    by_level = Window.orderBy(F.col("_full") / F.col("weight"), F.col("source").asc_nulls_last())
    before, every = by_level.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    rest = F.sum("source_size").over(every) - F.coalesce(F.sum("_full").over(before), F.lit(0))
    weights = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    # the level if this source and all that fill up later shared the rest; below its own it is filled, and so are all before
    sources = sources.withColumn("_level", rest / weights)
    sources = sources.withColumn("_open", F.col("_full") >= F.col("_level") * F.col("weight"))
    level = F.min(F.when(F.col("_open"), F.struct(F.col("_full") / F.col("weight"), F.col("_level")))).over(every)
    target = F.when(F.col("_open"), level["_level"] * F.col("weight")).otherwise(F.col("_full").cast("double"))
    sources = sources.withColumn("target", target.cast("double")).drop("_full", "_level", "_open")
    return sources.withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)


CLASS = ["source", "doc_id", "size", "tie"]


def repeats(sizes: DataFrame) -> DataFrame:
    """What rows with equal ids, sources and texts have in common, as a written table."""
    found = sizes.groupBy(*CLASS).count().where("count > 1")
    return kept(found.select(*(F.col(c).alias(f"_{c}") for c in CLASS)), "mix-repeats")


def numbered(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """The rows with ``no``, their number among those that are equal, from 0 on.

    Equal rows are numbered in each task that has read some, and then after those of
    the tasks before it, so no task gets all rows of a class. Others do not move.
    """
    if repeated.isEmpty():
        return rows.withColumn("no", F.lit(0).cast("long"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in CLASS]
    rows = rows.withColumn("_task", F.spark_partition_id())
    once = rows.join(repeated, same, "left_anti").drop("_task").withColumn("no", F.lit(0).cast("long"))
    again = rows.join(repeated, same, "left_semi")
    counts = again.groupBy(*CLASS, "_task").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*CLASS).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*(F.col(c).alias(f"_{c}") for c in CLASS), F.col("_task").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    here = F.row_number().over(Window.partitionBy(*CLASS, "_task").orderBy(F.lit(0))) - 1
    again = again.withColumn("_here", here).join(counts, [*same, F.col("_task") == F.col("_of")])
    return once.unionByName(again.withColumn("no", F.col("_ahead") + F.col("_here")).select(once.columns))


def _with_block(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Sizes with their source's columns, their block, and their place in the permuted order of the block."""
    own = sources.withColumnRenamed("source", "_source")
    found = sizes.join(own, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    own = "doc_id", "size", "tie", "no"
    block = F.floor(uniform(F.lit("block"), *own) * F.col("n_blocks")).cast("long")
    return found.withColumn("block", block).withColumn("place", uniform(F.lit("place"), *own))


def quotas(sizes: DataFrame) -> DataFrame:
    """The targets with what the mix takes of each source.

    Every document is taken ``passes`` times, and once more if its block is below
    ``edge``, or is ``edge`` and its place there is at most ``cut``. ``units`` is how
    many blocks that makes, repeats counted. Sums along the blocks go over runs of
    blocks first, so that no task gets all blocks of a source.
    """
    sources = targets(sizes)
    passes = F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0)).cast("int")
    sources = sources.withColumn("passes", passes).withColumn("n_blocks", F.ceil(F.col("n_docs") / BLOCK))
    sources = sources.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    sources = kept(sources, "mix-sources")
    dealt = _with_block(sizes, sources)
    blocks = dealt.groupBy("source_no", "block", "rest").agg(F.sum("size").alias("words"))
    blocks = kept(blocks.withColumn("run", F.expr("block div 1024")), "mix-blocks")
    before = Window.unboundedPreceding, -1
    runs = blocks.groupBy("source_no", "run").agg(F.sum("words").alias("_run_words"))
    runs = runs.withColumn("_before", F.sum("_run_words").over(Window.partitionBy("source_no").orderBy("run").rowsBetween(*before)))
    inside = F.sum("words").over(Window.partitionBy("source_no", "run").orderBy("block").rowsBetween(*before))
    blocks = blocks.withColumn("_inside", inside).join(runs, ["source_no", "run"])
    start = F.coalesce("_before", F.lit(0)) + F.coalesce("_inside", F.lit(0))
    edges = blocks.withColumn("_start", start).where(F.col("_start") + F.col("words") > F.col("rest"))
    edges = edges.groupBy("source_no").agg(F.min(F.struct("block", "_start")).alias("_edge"))
    edges = edges.select("source_no", F.col("_edge.block").alias("edge"), F.col("_edge._start").alias("_start"))
    last = dealt.join(edges.withColumnRenamed("edge", "block"), ["source_no", "block"])
    in_order = Window.partitionBy("source_no").orderBy("place", "doc_id", "size", "tie", "no").rowsBetween(*before)
    middle = F.col("_start") + F.coalesce(F.sum("size").over(in_order), F.lit(0)) + F.col("size") / 2
    cuts = last.withColumn("_taken", middle <= F.col("rest")).where("_taken and size > 0")
    cuts = cuts.groupBy("source_no").agg(F.max("place").alias("cut"))
    found = sources.join(edges.drop("_start"), "source_no", "left").join(cuts, "source_no", "left")
    found = found.na.fill(0, ["edge"]).na.fill(-1.0, ["cut"])
    units = F.col("passes") * F.col("n_blocks") + F.col("edge") + (F.col("cut") >= 0).cast("int")
    return kept(found.withColumn("units", units), "mix-quotas")


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _log_factorial(n: Column) -> Column:
    """By Stirling's series at n + 8, brought back by a product; exact to about 1e-13."""
    x = n + F.lit(8.0)
    product = n + F.lit(1.0)
    for i in range(2, 9):
        product = product * (n + F.lit(float(i)))
    series = F.lit(1.0) / (12.0 * x) - F.lit(1.0) / (360.0 * F.pow(x, F.lit(3.0))) + F.lit(1.0) / (1260.0 * F.pow(x, F.lit(5.0)))
    return x * F.log(x) - x + 0.5 * F.log(F.lit(6.283185307179586) * x) + series - F.log(product)


def hypergeometric(good: Column, total: Column, draws: Column, chance: Column) -> Column:
    """How many of ``draws`` from ``total`` are among ``good``: the quantile of the exact distribution at ``chance``.

    Values more than ten standard deviations off have no probability in doubles and are left out.
    """
    good, total, draws = (x.cast("double") for x in (good, total, draws))
    bounds = F.struct(
        good.alias("k"),
        total.alias("m"),
        draws.alias("n"),
        F.greatest(F.lit(0.0), draws - (total - good)).alias("least"),
        F.least(good, draws).alias("most"),
        (draws * good / F.greatest(total, F.lit(1.0))).alias("mean"),
    )

    def within(b: Column) -> Column:
        k, m, n = b["k"], b["m"], b["n"]
        spread = F.sqrt(F.greatest(F.lit(0.0), b["mean"] * (1 - k / F.greatest(m, F.lit(1.0))))) * 10 + 3
        low = F.greatest(b["least"], F.floor(b["mean"] - spread).cast("double"))
        high = F.least(b["most"], F.ceil(b["mean"] + spread).cast("double"))

        def from_low(x: Column) -> Column:
            log_p = F.lit(0.0)
            for top, bottom in ((k, x), (m - k, n - x), (m, n)):
                sign = -1.0 if top is m else 1.0
                log_p = log_p + sign * (_log_factorial(top) - _log_factorial(bottom) - _log_factorial(top - bottom))
            zero = F.struct(F.lit(0.0).alias("sum"), F.exp(log_p).alias("p"), F.lit(-1.0).alias("pick"))

            def step(s: Column, i: Column) -> Column:
                at = i.cast("double")
                after = s["sum"] + s["p"]
                ratio = (k - at) * (n - at) / ((at + 1) * F.greatest(m - k - n + at + 1, F.lit(1.0)))
                pick = F.when((s["pick"] < 0) & (chance < after), at).otherwise(s["pick"])
                return F.struct(after.alias("sum"), (s["p"] * ratio).alias("p"), pick.alias("pick"))

            return F.aggregate(
                F.sequence(x.cast("long"), high.cast("long")), zero, step, lambda s: F.when(s["pick"] < 0, high).otherwise(s["pick"])
            )

        return F.when(low >= high, high).otherwise(_let(low, from_low))

    return _let(bounds, within).cast("long")


def splitting_tree(found: DataFrame) -> DataFrame:
    """Rows of source_no, unit, shard: every unit of every quota in exactly one shard.

    A node is a range of shards with the first unit and the number of units it has
    of every source. It draws for its left half and leaves the rest to its right.
    """
    units, sources = found.agg(F.sum("units"), F.count("*")).first()
    shards = max(1, -(-(units or 0) // SHARD))
    up_to = lambda shard: F.floor(shard * F.lit(units or 0) / F.lit(shards))
    own = F.struct("source_no", F.lit(0).cast("long").alias("start"), F.col("units").cast("long").alias("n"))
    nodes = found.agg(F.sort_array(F.collect_list(own)).alias("quota"))
    nodes = nodes.select(F.lit(0).cast("long").alias("first"), F.lit(shards).cast("long").alias("last"), "quota")
    for level in range((shards - 1).bit_length()):
        middle = F.expr("(first + last + 1) div 2")
        nodes = nodes.withColumn("middle", middle)
        zero = F.struct(
            (up_to(F.col("middle")) - up_to(F.col("first"))).cast("long").alias("draws"),
            F.aggregate("quota", F.lit(0).cast("long"), lambda s, q: s + q["n"]).alias("total"),
            F.array().cast("array<bigint>").alias("left"),
        )

        def draw(s: Column, q: Column) -> Column:
            chance = uniform(F.lit("tree"), F.col("first"), F.col("last"), q["source_no"])
            return _let(
                hypergeometric(q["n"], s["total"], s["draws"], chance),
                lambda x: F.struct(
                    (s["draws"] - x).alias("draws"), (s["total"] - q["n"]).alias("total"), F.concat(s["left"], F.array(x)).alias("left")
                ),
            )

        nodes = nodes.withColumn("left", F.aggregate("quota", zero, draw, lambda s: s["left"]))
        pair = F.zip_with("quota", "left", lambda q, x: F.struct(q["source_no"], q["start"].alias("start"), x.alias("n")))
        rest = F.zip_with("quota", "left", lambda q, x: F.struct(q["source_no"], (q["start"] + x).alias("start"), (q["n"] - x).alias("n")))
        children = F.when(
            F.col("last") - F.col("first") > 1,
            F.array(
                F.struct("first", F.col("middle").alias("last"), pair.alias("quota")),
                F.struct(F.col("middle").alias("first"), "last", rest.alias("quota")),
            ),
        ).otherwise(F.array(F.struct("first", "last", "quota")))
        nodes = nodes.select(F.explode(children).alias("node")).select("node.*")
        if level % 6 == 5:
            nodes = nodes.repartition("first")
    leaves = nodes.select(F.col("first").alias("shard"), F.explode("quota").alias("own")).where("own.n > 0")
    unit = F.explode(F.sequence(F.col("own.start"), F.col("own.start") + F.col("own.n") - 1)).alias("unit")
    return leaves.select("shard", F.col("own.source_no").alias("source_no"), unit)


def planned(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """The rows with source_size, target, copies, taken, and ``shards``, one per copy.

    ``sizes`` are the doc_id, source, size, tie and no of the rows as a table of its own; the rows may have more columns.
    """
    found = quotas(sizes)
    n = F.col("n_blocks")
    tree = splitting_tree(found).join(found.select("source_no", "n_blocks"), "source_no")
    tree = tree.withColumn("block", F.col("unit") % n).groupBy("source_no", "block")
    tree = kept(tree.agg(F.transform(F.sort_array(F.collect_list(F.struct("unit", "shard"))), lambda x: x["shard"]).alias("_shards")), "mix-tree")
    dealt = _with_block(rows, found)
    more = (F.col("block") < F.col("edge")) | ((F.col("block") == F.col("edge")) & (F.col("place") <= F.col("cut")))
    copies = F.when(F.col("size") > 0, F.col("passes") + more.cast("int")).otherwise(0)
    dealt = dealt.withColumn("copies", copies).join(tree, ["source_no", "block"], "left")
    shards = F.when(F.col("copies") > 0, F.slice("_shards", F.lit(1), F.col("copies"))).otherwise(F.array().cast("array<bigint>"))
    dealt = dealt.withColumn("shards", shards).withColumn("taken", F.col("copies") * F.col("size"))
    return dealt.select(*rows.columns, "source_size", "target", "copies", F.col("taken").cast("long").alias("taken"), "shards")


def sized(docs: DataFrame, text: str = "text", source: str = "source", identity: str = "doc_id") -> DataFrame:
    """The doc_id, source and size of the rows, ``tie``, a hash of the text, and ``row``, all their columns as one."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    field = lambda name: F.col("row").getField(name)
    return rows.select(
        field(identity).alias("doc_id"),
        field(source).cast("string").alias("source"),
        word_count(field(text)).alias("size"),
        F.xxhash64(field(text)).alias("tie"),
        "row",
    )


def mixed(docs: DataFrame, text: str = "text", source: str = "source", identity: str = "doc_id") -> DataFrame:
    """The mix: the rows of ``docs``, each as often as it is taken, with ``shard`` and ``shard_order``."""
    rows = sized(docs, text, source, identity)
    sizes = kept(rows.drop("row"), "mix-sizes")
    repeated = repeats(sizes)
    rows, sizes = numbered(rows, repeated), kept(numbered(sizes, repeated), "mix-numbered")
    taken = planned(rows, sizes).select("row", "doc_id", "tie", "no", F.posexplode("shards").alias("_copy", "shard"))
    order = uniform(F.lit("shard"), "doc_id", "tie", "no", "_copy")
    return taken.withColumn("shard_order", order).select("row.*", "shard", "shard_order")


def op1_mixing(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source")
    sizes = kept(sized(docs).drop("row"), "mix-sizes")
    sizes = kept(numbered(sizes, repeats(sizes)), "mix-numbered")
    return planned(sizes, sizes).select("doc_id", "size", "source_size", "target", "taken", "shards")
