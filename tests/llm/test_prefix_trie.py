"""The trie of conversations, against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from quayside.llm import prefix_trie
from tests.llm import cases

SCHEMA = "conv_id long, turn long, role string, text string"


def sequences(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [t[1:] for t in sorted(turns, key=lambda t: t[0])] for c, turns in own.items()}


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = own.get(c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5)), [])
        out[c] = tuple(base[:h] + turns[h:])
    return out


def brute(paths):
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, convs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(convs) - 1) * len(path[-1][1].encode()) if path else 0
    out = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if paths[c] == path)
        parent = min(members[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(path), parent, len(convs), children[path], leaves[path], saved[path], digest))
    return sorted(out, key=repr)


def check(spark, rows, **options):
    found = prefix_trie.trie(prefix_trie.forked(prefix_trie.paths(spark.createDataFrame(rows, SCHEMA))), **options)
    expected = brute(rebuilt(sequences(rows)))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected
    return expected


def talks(seed, n, kinds, longest):
    random_ = random.Random(seed)
    ids = random_.sample(range(n * 2), n)
    turns = [(random_.choice(("user", "assistant", None)), random_.choice(("", None, "é" * 9, f"t{i}"))) for i in range(kinds)]
    rows = [(c, t, *random_.choice(turns)) for c in ids for t in range(random_.randint(1, longest))]
    random_.shuffle(rows)
    return rows


def test_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{cases.TABLES}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = check(spark, rows)
    query = prefix_trie.op13_prefix_trie(spark, cases.TABLES)
    assert sorted((tuple(r) for r in query.collect()), key=repr) == expected


@pytest.mark.parametrize("shard", [1, 2, 7, 1024])
def test_few_turns_over_many_shards(spark, shard):
    """Subtrees and equal conversations that lie in many shards."""
    check(spark, talks(shard, 150, 2, 12), shard=shard)
    check(spark, talks(shard + 50, 60, 5, 4), shard=shard)


def test_one_first_turn_and_equal_conversations(spark):
    rows = [(c, 0, "system", "be kind") for c in range(200)]
    rows += [(c, 1, "user", f"q{c % 3}") for c in range(100)] + [(c, 2, "user", f"only {c}") for c in range(0, 100, 7)]
    expected = check(spark, rows, shard=16)
    assert max(row[3] for row in expected if row[1] == 1) > 60


def test_long_conversation_and_wide_ids(spark):
    rows = [(5 * 10**15, t, "user", f"t{t % 7}") for t in range(700)] + [(5 * 10**15 + 1, t, "user", f"t{t % 7}") for t in range(300)]
    rows += [(-3, 0, "user", "a"), (-5, 0, "user", "a"), (0, 1, "user", "a"), (0, 0, "user", "b")]
    check(spark, rows, shard_turns=40)


def test_nulls_repeats_and_turnless_conversations(spark):
    rows = [(None, 0, "user", "lost"), (1, None, None, None), (1, 0, "", ""), (1, 0, "", ""), (2, 0, "user", "x"), (10, 3, "user", "x")]
    expected = check(spark, rows)
    assert len([row for row in expected if row[2] is None]) == 1


def test_role_and_text_are_kept_apart(spark):
    rows = [(10, 0, "ab", "c"), (15, 0, "a", "bc"), (20, 0, "", "abc"), (25, 0, "1:a", "b"), (30, 0, "1", ":ab")]
    expected = check(spark, rows)
    assert len(expected) == 6


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA + ", size int, code string, path int")
    assert prefix_trie.trie(prefix_trie.forked(prefix_trie.paths(empty))).collect() == []
    one = spark.createDataFrame([(5, 0, "u", "t", 1, "x", 2)], SCHEMA + ", size int, code string, path int")
    assert prefix_trie.trie(prefix_trie.paths(one)).count() == 2
