"""The prefix trie of conversations, by vertical bitmaps.

A conversation is the path of its turns, each a code of role and text. Paths are dealt
in ranges of their order, so that a subtree lies in one range or in a few next to each
other, however many conversations share a first turn or are equal. A shard is a run of
at most ``SHARD`` paths of a range. Its index holds, for every position and turn, the
set of its conversations as bits, in order of their ids. Descending from the root, a
node's set is intersected with the postings of the next position: each result that is
not empty is a child, its population count the members, its lowest bit the least id,
and what ends here the bits of the paths of this length.

Only nodes on the way to a shard's first or last path can have members elsewhere; all
others are whole. Those few are put together by a digest of their path: the first
shard that has one counts what it is worth once, sums along the two ways of a shard
give what is below, and sums over the shards the whole.

Defined results: turns are ordered by their number, null first, and by code where that
ties; null roles and texts are empty; rows that repeat are turns of their own. Rows
without a conversation id belong to none. A conversation without turns is a member of
the root and ends there. Without conversations there are no nodes, not even a root. A
code is 128 bits of a SHA-256, and stands for its turn. A conversation's codes, 40 bytes
a turn, are one row. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import kept

#: Conversations of a shard at most, and turns, as far as one conversation does not have more.
SHARD, TURNS = 1024, 1 << 16
#: Conversations that share a beginning, and one more than the turns it has at most.
FAMILY, HEADS = 5, 9

_CODE = 32  # hexadecimal digits
_NODE = """is_open boolean, shard long, side int, key string, parent_key string, conv_id long, depth long, parent_conv_id long,
    n_convs long, n_children long, n_leaves long, saved_tokens long, size long, inner boolean, ends string, ends_sha256 string"""


def paths(conversations: DataFrame) -> DataFrame:
    """conv_id and ``turns``, the code and the bytes of the text of each turn in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    code = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, _CODE)
    turns = conversations.where("conv_id is not null")
    turns = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", code.alias("code"), F.octet_length(text).cast("long").alias("size"))
    found = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "code", "size"))).alias("turns"))
    return found.withColumn("turns", F.transform("turns", lambda t: F.struct(t["code"].alias("code"), t["size"].alias("size"))))


def forked(own: DataFrame) -> DataFrame:
    """Paths that begin like that of the first of their family, as long as a checksum of the id says."""
    none = F.array().cast(own.schema["turns"].dataType)
    heads = own.select(F.col("conv_id").alias("_base"), F.slice("turns", 1, HEADS - 1).alias("_head"))
    length = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    found = own.withColumn("_base", F.col("conv_id") - F.col("conv_id") % FAMILY).withColumn("_h", length)
    found = found.join(heads, "_base", "left")
    head = F.slice(F.coalesce("_head", none), F.lit(1), F.col("_h"))
    rest = F.slice("turns", F.col("_h") + 1, F.greatest(F.size("turns") - F.col("_h"), F.lit(0)))
    return found.select("conv_id", F.concat(head, rest).alias("turns"))


class _Node:
    __slots__ = ("ends", "is_open", "key", "leaves", "depth", "members", "parent", "saved", "size", "children", "inner", "conv_id")

    def __init__(self, depth: int, members: int, parent: _Node | None, size: int, key: bytes):
        self.depth, self.members, self.parent, self.size, self.key = depth, members, parent, size, key
        self.leaves = self.saved = self.children = 0
        self.inner = False


def _bits(members: int):
    while members:
        low = members & -members
        yield low.bit_length() - 1
        members ^= low


def _shard(rows: list[tuple], shard: int):
    """The nodes of some paths (conv_id, path, sizes), which are in order, as rows of ``_NODE``."""
    first, last = rows[0][0], rows[-1][0]
    rows = sorted(rows)  # bits in order of the ids
    ids = [row[0] for row in rows]
    ways = 1 << ids.index(first), 1 << ids.index(last)
    postings, ended = {}, {}
    for i, (_, path, sizes) in enumerate(rows):
        bit = 1 << i
        for position in range(len(sizes)):
            at = position, path[position * _CODE : position * _CODE + _CODE]
            postings[at] = postings.get(at, 0) | bit
        ended[len(sizes)] = ended.get(len(sizes), 0) | bit

    nodes, stack = [], [_Node(0, (1 << len(rows)) - 1, None, 0, b"")]
    while stack:
        node = stack.pop()
        nodes.append(node)
        node.conv_id = ids[(node.members & -node.members).bit_length() - 1]
        node.is_open = bool(node.members & (ways[0] | ways[1]))
        node.ends = node.members & ended.get(node.depth, 0)
        rest = node.members ^ node.ends
        while rest:
            _, path, sizes = rows[(rest & -rest).bit_length() - 1]
            code = path[node.depth * _CODE : node.depth * _CODE + _CODE]
            members = rest & postings[node.depth, code]
            rest ^= members
            key = hashlib.sha256(node.key + code.encode()).digest()[:16]
            stack.append(_Node(node.depth + 1, members, node, sizes[node.depth], key))
            node.inner = True
    for node in reversed(nodes):  # children come after their parent
        if not node.is_open:
            node.leaves += not node.inner
            node.saved += (node.members.bit_count() - 1) * node.size
            node.parent.children += 1
            node.parent.leaves += node.leaves
            node.parent.saved += node.saved
    for node in nodes:
        parent = node.parent
        ends = ",".join(str(ids[i]) for i in _bits(node.ends))
        on = [bool(node.members & way) for way in ways]
        yield (
            node.is_open,
            shard,
            0 if all(on) else 1 if on[0] else 2,
            node.key.hex() if node.is_open else None,
            parent.key.hex() if parent and parent.is_open else None,
            node.conv_id,
            node.depth,
            parent.conv_id if parent and not parent.is_open else None,
            node.members.bit_count(),
            node.children,
            node.leaves,
            node.saved,
            node.size,
            node.inner,
            ends if node.is_open else None,
            None if node.is_open else hashlib.sha256(ends.encode()).hexdigest(),
        )


_KINDS = {"boolean": pa.bool_(), "long": pa.int64(), "int": pa.int32(), "string": pa.string()}
_COLUMNS = {name: _KINDS[kind] for name, kind in (column.split() for column in _NODE.split(","))}


def _batch(rows) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(_COLUMNS)
    arrays = [pa.array(c, kind) for c, kind in zip(columns, _COLUMNS.values(), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=list(_COLUMNS))


def _tries(most: int, most_turns: int):
    """The nodes of every shard of a range, whose paths come in order."""

    def tries(batches):
        number = TaskContext.get().partitionId() << 32
        rows, turns = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and (len(rows) >= most or turns + len(row[2]) > most_turns):
                    yield _batch(_shard(rows, number))
                    rows, turns, number = [], 0, number + 1
                rows.append(row)
                turns += len(row[2])
        if rows:
            yield _batch(_shard(rows, number))

    return tries


def _end_digests(batches):
    """Of every key the digest of its lists of ids, which come in order and are joined by commas."""
    key, digest = None, None
    for batch in batches:
        out = []
        for name, group in groupby(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True), lambda r: r[0]):
            for _, ends in group:
                if name != key:
                    if key is not None:
                        out.append((key, digest.hexdigest()))
                    key, digest = name, hashlib.sha256(ends.encode())
                else:
                    digest.update(f",{ends}".encode())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.string()) for i in (0, 1)], names=["key", "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], names=["key", "ends_sha256"])


def _put_together(opened: DataFrame) -> DataFrame:
    """One row per node that shards share, from what each has of it."""
    whole = opened.groupBy("key").agg(
        F.min("shard").alias("_owner"),
        F.min("conv_id").alias("conv_id"),
        F.min("depth").alias("depth"),
        F.min("parent_key").alias("parent_key"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("_whole_children"),
        F.max("size").alias("size"),
        F.max("inner").alias("inner"),
    )
    whole = kept(whole, "trie-shared")
    own = whole.select("key", "_owner", F.col("n_convs").alias("_n"), F.col("inner").alias("_inner"))
    parts = opened.join(own, "key")
    once = F.col("shard") == F.col("_owner")
    parts = parts.withColumn("_leaves", F.col("n_leaves") + F.when(once & ~F.col("_inner"), 1).otherwise(0))
    parts = parts.withColumn("_saved", F.col("saved_tokens") + F.when(once, (F.col("_n") - 1) * F.col("size")).otherwise(0))
    below = Window.partitionBy("shard").orderBy(F.desc("depth"))  # all that is as deep, on both ways
    way = Window.partitionBy("shard", "side").orderBy(F.desc("depth"))
    sums = [F.when(F.col("side") == 0, F.sum(c).over(below)).otherwise(F.sum(c).over(way)).alias(c) for c in ("_leaves", "_saved")]
    sums = parts.select("key", *sums).groupBy("key").agg(F.sum("_leaves").alias("n_leaves"), F.sum("_saved").alias("saved_tokens"))
    shared = whole.where("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("_shared_children"))
    lists = opened.where("ends != ''").select("key", "shard", "ends").repartition("key").sortWithinPartitions("key", "shard")
    digests = lists.mapInArrow(_end_digests, "key string, ends_sha256 string")
    parent = whole.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    found = whole.join(sums, "key").join(shared, "key", "left").join(digests, "key", "left").join(parent, "parent_key", "left")
    children = F.col("_whole_children") + F.coalesce("_shared_children", F.lit(0))
    nothing = F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256))
    return found.withColumn("n_children", children).withColumn("ends_sha256", nothing)


def trie(rows: DataFrame, shard: int = SHARD, shard_turns: int = TURNS) -> DataFrame:
    """One row per node of the trie of paths (conv_id, turns), as ``paths`` gives them."""
    path = F.array_join(F.transform("turns", lambda t: t["code"]), "").alias("path")
    rows = kept(rows.select("conv_id", path, F.transform("turns", lambda t: t["size"]).alias("sizes")), "trie-paths")
    ranges = rows.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    nodes = kept(ranges.mapInArrow(_tries(shard, shard_turns), _NODE), "trie-nodes")
    shared = kept(_put_together(nodes.where("is_open")), "trie-top")
    top = shared.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    closed = nodes.where("not is_open")
    inner = closed.where("parent_key is null")
    outer = closed.where("parent_key is not null").join(top, "parent_key").withColumn("parent_conv_id", F.col("_parent"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return inner.select(columns).union(outer.select(columns)).union(shared.select(columns))


def op13_prefix_trie(spark, folder: str) -> DataFrame:
    return trie(forked(paths(spark.read.parquet(f"{folder}/conversations.parquet"))))
