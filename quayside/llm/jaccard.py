"""N-gram Jaccard join with set-relation skipping.

A document's set holds its five-word shingles. Equal sets are one set. Sets are
ordered with rare shingles first, and two sets as similar as asked share a
shingle in a short prefix of both; the prefixes make the index lists.

Skipping in the index: an entry stays in its list only if the entry of the nearest
size before or behind it could be similar in size. Lists are cut into blocks by
position, and whole blocks of pairs are skipped that cannot reach the wanted overlap
with what stands behind their positions.

Skipping in the answers: every set is first compared with a few neighbours in lists
sorted by a sketch. Sets that link become clusters around a leader, with the number of shingles by
which a member exceeds its leader. What a member has in common with any other set
is at most what the leaders have in common plus these excesses, so for two clusters
that are not connected yet only the leaders are compared, and members only where
that bound leaves a link possible. Pairs within a connected component are never
looked at again. Before sets are fetched, parities of hashed shingles bound how far
two sets differ: each bit that differs is a shingle that only one of them has. No
link between components is lost.

Defined results: texts that are null or without words have no set, and are a
component of their own; a row without an id is in none. Fewer words than five
make one shingle. Equal texts link. Rows that repeat are joined by their equal
sets. A hash of 64 bits stands for a shingle and one for a set. Texts are read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import discard, kept, mixed, window_hashes, word_hashes
from quayside.llm.components import components

#: Shingles whose order is by their frequency; all others come before them, by hash. Any order gives the same links.
FREQUENT = 1 << 16
#: Neighbours that a set is compared with first.
NEIGHBOURS = 3
#: Long numbers of parities per set.
PARITIES = 16
#: Sets of one batch that must share a shingle before it is counted as frequent.
LEAST_SHARED = 4


def shingles(text: str | None) -> np.ndarray:
    """The distinct shingles of a text, as sorted numbers of 63 bits."""
    if not text:
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(word_hashes(text, lower=True)) >> np.uint64(1))


def set_hash(tokens: np.ndarray) -> int:
    total = (tokens * np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64) + np.uint64(len(tokens))
    return int(mixed(np.array([total ^ (np.bitwise_xor.reduce(tokens) << np.uint64(1))])).view(np.int64)[0])


def parities(tokens: np.ndarray) -> list[int]:
    """Of hashed shingles, whether the number of those with each hash is odd."""
    odd = np.bincount((tokens % np.uint64(64 * PARITIES)).astype(np.int64), minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64).tolist()


def wide_parities(tokens: np.ndarray) -> bytes:
    """The same, with two to four bits a shingle, a thousand at least; a power of two, so that it folds."""
    bits = 1 << max(10, len(tokens).bit_length() + 1)
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _differ(one: pa.Array, other: pa.Array) -> pa.Array:
    """How many wide parities of two sets differ; the longer vector is folded to the length of the shorter."""
    out = []
    for a, b in zip(one, other, strict=True):
        x, y = (np.frombuffer(s.as_buffer(), np.uint8) for s in (a, b))
        size = min(len(x), len(y))
        x, y = (np.bitwise_xor.reduce(v.reshape(-1, size)) for v in (x, y))
        out.append(int(np.bitwise_count(x ^ y).sum()))
    return pa.array(out, pa.int64())


_BINS = np.arange(16, dtype=np.uint64) << np.uint64(59)


def sketches(tokens: np.ndarray, of: np.ndarray) -> np.ndarray:
    """For the lists of some shingles, numbers that are close for similar sets: the least shingles of eight of 16 ranges."""
    place = np.searchsorted(tokens, _BINS)
    least = tokens[np.minimum(place, len(tokens) - 1)] & np.uint64(255)
    ring = np.concatenate([least, least])
    shifts = np.uint64(8) * np.arange(8, dtype=np.uint64)[::-1]
    packed = np.array([(ring[i : i + 8] << shifts).sum(dtype=np.uint64) for i in range(16)], np.uint64)
    return packed[(of % np.uint64(16)).astype(np.int64)]


def _described(batches):
    """Of every document its set's size and hash; of every batch the shingles that several of its sets share."""
    for batch in batches:
        rows, seen, held, size = [], set(), [], 0
        frequent = []

        def count():
            if held:
                token, times = np.unique(np.concatenate(held), return_counts=True)
                often = times >= LEAST_SHARED
                frequent.extend(zip(token[often].view(np.int64).tolist(), times[often].tolist(), strict=True))
                held.clear()

        for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            tokens = shingles(text.as_py())
            name = set_hash(tokens) if len(tokens) else None
            bits = (parities(tokens), wide_parities(tokens)) if len(tokens) else (None, None)
            rows.append((key, len(tokens), name, *bits, None, None))
            if name is not None and name not in seen:
                seen.add(name)
                held.append(tokens)
                size += len(tokens)
                if size > 1 << 22:
                    count()
                    size = 0
        count()
        rows += [(None, None, None, None, None, token, times) for token, times in frequent]
        columns = list(zip(*rows, strict=True)) or [[]] * 7
        names = ["doc_id", "n", "set_id", "parities", "wide", "token", "times"]
        kinds = [{"parities": pa.list_(pa.int64()), "wide": pa.binary()}.get(name, pa.int64()) for name in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


class Order:
    """Shingles in index order: rare ones by hash, then the frequent ones, the most frequent last."""

    def __init__(self, frequent: list[int]):
        tokens = np.array(frequent, np.int64).view(np.uint64)
        self.tokens = np.sort(tokens)
        self.rank = np.empty(len(tokens), np.uint64)
        self.rank[np.searchsorted(self.tokens, tokens)] = np.arange(len(tokens), 0, -1, dtype=np.uint64)

    def sorted(self, tokens: np.ndarray) -> np.ndarray:
        if len(self.tokens):
            place = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
            frequent = self.tokens[place] == tokens
            tokens = np.where(frequent, self.rank[place] + np.uint64(1 << 63), tokens)
        return np.sort(tokens)


def index_lists(docs: DataFrame, frequent) -> DataFrame:
    """Entries (token, set_id, n, position, sketch) of the prefixes that have a neighbour of a similar size in their list."""

    def prefixes(batches):
        order, seen = Order(frequent.value), set()
        for batch in batches:
            parts = []
            for text in batch.column(0):
                tokens = shingles(text.as_py())
                if not len(tokens) or (name := set_hash(tokens)) in seen:
                    continue
                seen.add(name)
                first = order.sorted(tokens)[: len(tokens) // 4 + 1]
                parts.append((first, name, len(tokens), sketches(tokens, first)))
            if parts:
                count = [len(p[0]) for p in parts]
                columns = [
                    np.concatenate([p[0] for p in parts]).view(np.int64),
                    np.repeat(np.array([p[1] for p in parts], np.int64), count),
                    np.repeat(np.array([p[2] for p in parts], np.int32), count),
                    np.concatenate([np.arange(c, dtype=np.int32) for c in count]),
                    np.concatenate([p[3] for p in parts]).view(np.int64),
                ]
                names = ["token", "set_id", "n", "position", "sketch"]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    entries = docs.select("text").mapInArrow(prefixes, "token long, set_id long, n int, position int, sketch long")
    by_size = Window.partitionBy("token").orderBy("n", "set_id")
    entries = entries.withColumn("_same", F.lag("set_id").over(by_size)).where("_same is null or _same != set_id").drop("_same")
    near = entries.withColumns({"_before": F.lag("n").over(by_size), "_behind": F.lead("n").over(by_size)})
    near = near.where((F.col("_before") * 4 >= F.col("n") * 3) | (F.col("n") * 4 >= F.col("_behind") * 3))
    return near.drop("_before", "_behind")


def _sided(frame: DataFrame, side: str, *but: str) -> DataFrame:
    """The frame with a prefix to all columns but some."""
    return frame.toDF(*(c if c in but else f"{side}_{c}" for c in frame.columns))


#: How many parities of a set a and a set b differ.
DIFFER = " + ".join(f"bit_count(a_p{i} ^ b_p{i})" for i in range(PARITIES))


def neighbours(entries: DataFrame, first: DataFrame) -> DataFrame:
    """Pairs (x, y) of every set with those it stands next to in most lists, as far as they are not too different."""
    by_sketch = Window.partitionBy("token").orderBy("sketch", "set_id")
    near = entries.select(F.col("set_id").alias("x"), F.lag("set_id").over(by_sketch).alias("y"), "n", F.lag("n").over(by_sketch).alias("_n"))
    near = near.where("n * 4 >= _n * 3 and _n * 4 >= n * 3").select("x", "y")
    near = near.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).groupBy("x", "y").count()
    sets = first.drop("first_id", "wide")
    near = near.join(_sided(sets, "a"), F.col("x") == F.col("a_set_id")).join(_sided(sets, "b"), F.col("y") == F.col("b_set_id"))
    near = near.where(f"a_n + b_n >= 7 * ({DIFFER})").select("x", "y", "count")
    both = near.union(near.select("y", "x", "count"))
    place = F.row_number().over(Window.partitionBy("x").orderBy(F.desc("count"), "y"))
    both = both.withColumn("_place", place).where(F.col("_place") <= NEIGHBOURS)
    return both.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def _overlap(one: pa.Array, other: pa.Array) -> pa.Array:
    out = []
    for a, b in zip(one, other, strict=True):
        x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (a, b))
        if len(x) > len(y):
            x, y = y, x
        place = np.minimum(np.searchsorted(y, x), len(y) - 1)
        out.append(int((y[place] == x).sum()))
    return pa.array(out, pa.int64())


def compared(pairs: DataFrame, docs: DataFrame, first: DataFrame, name: str) -> DataFrame:
    """Pairs (x, y) with their sizes nx and ny and their overlap; ``first`` has a document of every set."""

    def tokens(batches):  # an id that several texts have is looked up by the set
        for batch in batches:
            found = [shingles(t.as_py()) for t in batch.column(2)]
            right = [len(t) > 0 and set_hash(t) == name.as_py() for t, name in zip(found, batch.column(0), strict=True)]
            columns = [batch.column(0), batch.column(1), pa.array([t.tobytes() for t in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["set_id", "n", "tokens"]).filter(pa.array(right))

    pairs = kept(pairs, f"{name}-pairs")
    wanted = pairs.select(F.col("x").alias("set_id")).union(pairs.select("y")).distinct()
    wanted = wanted.join(first.select("set_id", "first_id", "n"), "set_id")
    own = docs.join(wanted.withColumnRenamed("first_id", "doc_id"), "doc_id").select("set_id", "n", "text")
    sets = kept(own.mapInArrow(tokens, "set_id long, n int, tokens binary"), f"{name}-sets")
    left = sets.select(F.col("set_id").alias("x"), F.col("n").alias("nx"), F.col("tokens").alias("_x"))
    right = sets.select(F.col("set_id").alias("y"), F.col("n").alias("ny"), F.col("tokens").alias("_y"))
    overlap = F.arrow_udf(_overlap, "long")
    both = pairs.join(left, "x").join(right, "y").withColumn("overlap", overlap("_x", "_y")).drop("_x", "_y")
    found = kept(both.distinct(), name)
    discard(pairs, sets)
    return found


def linked(pairs: DataFrame) -> DataFrame:
    return pairs.where("100 * overlap >= 75 * (nx + ny - overlap)")


def clusters(links: DataFrame, sizes: DataFrame, groups: DataFrame) -> DataFrame:
    """Of every set in an index list its leader, by how much it exceeds it, and its component so far."""
    both = links.select("x", "y", "nx", "overlap").union(links.select("y", "x", "ny", "overlap"))
    least = both.groupBy("x").agg(F.min(F.struct("y", "overlap")).alias("_least"), F.min("nx").alias("nx"))
    leaders = least.where(F.col("x") < F.col("_least.y")).select(F.col("x").alias("leader"))
    members = least.where(F.col("x") > F.col("_least.y"))
    members = members.select(F.col("x").alias("set_id"), F.col("_least.y").alias("leader"), (F.col("nx") - F.col("_least.overlap")).alias("excess"))
    members = members.join(leaders, "leader", "left_semi")
    found = sizes.join(members, "set_id", "left").join(groups, "set_id", "left")
    found = found.select(
        "set_id",
        "n",
        F.coalesce("leader", "set_id").alias("leader"),
        F.coalesce("excess", F.lit(0)).cast("long").alias("excess"),
        F.coalesce("component", "set_id").alias("component"),
    )
    spans = found.groupBy("leader").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max("excess").alias("most_excess"), F.count("*").alias("members")
    )
    return kept(found.join(spans, "leader"), "jaccard-clusters")


def listed(entries: DataFrame, groups: DataFrame, first: DataFrame) -> DataFrame:
    """The index lists of clusters, as far as they hold several components: of every token and leader, the least size
    of a member that has the token in its prefix, and the most tokens that one has from there on."""
    own = entries.join(groups.drop("n"), "set_id").groupBy("token", "leader", "component", "least", "most", "most_excess")
    own = own.agg(F.min("n").alias("here"), F.max(F.col("n") - F.col("position")).alias("rest"))
    meeting = own.groupBy("token").agg(F.min("component").alias("_a"), F.max("component").alias("_b")).where("_a < _b")
    own = own.join(meeting.select("token"), "token", "left_semi")
    return kept(own.join(first.drop("first_id", "wide").withColumnRenamed("set_id", "leader"), "leader"), "jaccard-lists")


def candidates(own: DataFrame, first: DataFrame) -> DataFrame:
    """Pairs of leaders of different components whose clusters could hold a link.

    They meet in index lists, which are cut into blocks by position and size. An entry
    is far where what stands from there on would not suffice for a partner of its own
    size; of two far entries, the one of the greater set lacks even more, so far blocks
    are never joined with each other. Families of sets that share a common part but not
    enough of it meet only there. Of what is left, sizes must be similar, what stands
    from both positions on must suffice, and by their parities the leaders must not
    differ by more than a link and the excesses allow: first by those that the lists
    carry, then, for each pair once, by as many as long sets need.
    """
    near = F.expr("7 * rest >= 6 * here")
    one = own.withColumn("zone", F.when(near, 0).otherwise(1))
    other = own.withColumn("zone", F.explode(F.when(near, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    one, other = _sided(one, "a"), _sided(other, "b")
    same = [F.col(f"a_{c}") == F.col(f"b_{c}") for c in ("token", "zone")]
    most = "7 * (a_n + b_n - ({}) + 2 * (a_most_excess + b_most_excess)) >= 6 * (a_least + b_least)"
    could = f"""a_component < b_component and a_most * 4 >= b_least * 3 and b_most * 4 >= a_least * 3
        and least(a_rest, b_rest) * 7 >= (a_here + b_here) * 3 and {most.format(DIFFER)}"""
    sides = [f"{side}_{c}" for side in "ab" for c in ("leader", "n", "least", "most_excess")]
    pairs = one.join(other, [*same, F.expr(could)]).select(*sides).distinct()
    wide = first.select("set_id", "wide")
    pairs = pairs.join(wide.toDF("a_leader", "a_wide"), "a_leader").join(wide.toDF("b_leader", "b_wide"), "b_leader")
    pairs = pairs.withColumn("differ", F.arrow_udf(_differ, "long")("a_wide", "b_wide")).where(most.format("differ"))
    return pairs.select(F.col("a_leader").alias("x"), F.col("b_leader").alias("y"))


def members_of(leaders: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs of members, not both leaders, that could link by what their leaders have in common."""
    spans = groups.where("set_id = leader").select("leader", "least", "most_excess", "members")
    a, b = (_sided(spans, side) for side in "ab")
    open_pairs = leaders.join(a, F.col("x") == F.col("a_leader")).join(b, F.col("y") == F.col("b_leader"))
    open_pairs = open_pairs.where("a_members + b_members > 2 and 7 * (overlap + a_most_excess + b_most_excess) >= 3 * (a_least + b_least)")
    open_pairs = open_pairs.select("x", "y", "overlap")
    a, b = (_sided(groups.select("leader", "set_id", "n", "excess"), side) for side in "ab")
    pairs = open_pairs.join(a, F.col("x") == F.col("a_leader")).join(b, F.col("y") == F.col("b_leader"))
    pairs = pairs.where(
        "a_n * 4 >= b_n * 3 and b_n * 4 >= a_n * 3 and 7 * (overlap + a_excess + b_excess) >= 3 * (a_n + b_n)"
        " and not (a_set_id = x and b_set_id = y)"
    )
    return pairs.select(F.col("a_set_id").alias("x"), F.col("b_set_id").alias("y"))


def join(docs: DataFrame, text: str = "text", identity: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id."""
    docs = docs.select(F.col(identity).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, n long, set_id long, parities array<long>, wide binary, token long, times long"
    described = kept(docs.mapInArrow(_described, schema), "jaccard-sets")
    often = described.where("token is not null").groupBy("token").agg(F.sum("times").alias("times"))
    often = [r.token for r in often.orderBy(F.desc("times"), "token").limit(FREQUENT).collect()]
    frequent = docs.sparkSession.sparkContext.broadcast(often)
    described = described.where("n is not null")

    named = docs.where("doc_id is not null")
    entries = kept(index_lists(named, frequent), "jaccard-index")
    bits = [F.max(F.get("parities", F.lit(i))).alias(f"p{i}") for i in range(PARITIES)]
    first = described.where("set_id is not null").groupBy("set_id")
    first = first.agg(F.min("doc_id").alias("first_id"), F.min("n").cast("int").alias("n"), *bits, F.first("wide").alias("wide"))
    first = kept(first.where("first_id is not null"), "jaccard-first")

    frequent.destroy()  # the index is written
    near = compared(neighbours(entries, first), named, first, "jaccard-near")
    links = linked(near)
    stars = components(links, "x", "y")
    groups = clusters(links, entries.select("set_id", "n").distinct(), stars.withColumnRenamed("node", "set_id"))
    discard(stars)
    lists = listed(entries, groups, first)
    discard(entries)
    leaders = compared(candidates(lists, first), named, first, "jaccard-leaders")
    discard(lists)
    members = compared(members_of(leaders, groups), named, first, "jaccard-members")
    discard(groups)
    every = links.select("x", "y").union(linked(leaders).select("x", "y")).union(linked(members).select("x", "y"))

    name = first.select("set_id", "first_id")
    every = kept(every.join(name.toDF("x", "one"), "x").join(name.toDF("y", "other"), "y"), "jaccard-links")
    discard(near, leaders, members)
    found = components(every, "one", "other")
    discard(every)
    first = first.join(found.withColumnRenamed("node", "first_id"), "first_id", "left")
    first = first.select("set_id", F.coalesce("component", "first_id").alias("component_id"))
    rows = described.select("doc_id", "n", "set_id").join(first, "set_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def op9_jaccard_join(spark, folder: str) -> DataFrame:
    return join(spark.read.parquet(f"{folder}/documents.parquet"))
