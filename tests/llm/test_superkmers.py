"""Repeated word windows, against brute force."""

import hashlib
import random

import pytest

from quayside.llm import superkmers
from tests.llm import cases

WIDTH = 13


def brute(rows):
    """Per row: n_words, n_removed and the words that stay."""
    texts = [(key, cases.words(text)) for key, text in rows]
    least = {}
    for key, words in texts:
        for i in range(len(words) - WIDTH + 1):
            window = tuple(words[i : i + WIDTH])
            if key is not None:
                least[window] = min(key, least.get(window, key))
    out = []
    for key, words in texts:
        gone = set()
        for i in range(len(words) - WIDTH + 1):
            if key is not None and least[tuple(words[i : i + WIDTH])] < key:
                gone.update(range(i, i + WIDTH))
        out.append((key, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=repr)


def check(spark, rows, parts=3, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    found = [tuple(r) for r in superkmers.without_repeats(docs, **options).collect()]
    expected = brute(rows)
    assert sorted(found, key=repr) == expected
    return expected


def passages():
    """Texts that share passages of many lengths, at their start, in their middle and at their end."""
    random_ = random.Random(5)
    shared = [cases.prose(900 + i, n).split() for i, n in enumerate((12, 13, 14, 30, 90))]
    rows = []
    for i in range(60):
        own = cases.prose(i, random_.randint(0, 60)).split()
        at = random_.randint(0, len(own))
        rows.append((i, " ".join(own[:at] + random_.choice(shared) + own[at:])))
    random_.shuffle(rows)
    return rows


def test_shared_passages(spark):
    found = check(spark, passages())
    assert any(0 < removed < n for _, n, removed, _ in found)


def test_few_words_and_repeats_inside_a_text(spark):
    rows = [(1, "a " * 40), (2, "a " * 12), (3, "b " + "a " * 13 + "c"), (4, "a\n" * 300), (5, "a  b\t" * 50), (6, "b a " * 50)]
    rows += [(7, "a b " * 30), (8, "a b " * 30)]
    check(spark, rows)


def test_edge_documents(spark):
    rows = [(r.doc_id, r.text) for r in cases.edge_documents(spark).collect()]
    check(spark, rows)
    table = superkmers.without_repeats(cases.edge_documents(spark))
    assert table.columns == ["doc_id", "n_words", "n_removed", "text"]


def test_one_id_with_two_texts(spark):
    a, b = cases.prose(1, 40), cases.prose(2, 40)
    check(spark, [(1, a), (9, a), (9, b), (9, a + " " + b), (None, a), (10, b)])


@pytest.mark.parametrize("seed", range(3))
def test_every_way_a_window_travels(spark, monkeypatch, seed):
    """Frequent runs, overfull buckets and a forgetful task change nothing."""
    random_ = random.Random(seed)
    passage = cases.prose(77, 60).split()
    rows = []
    for i in range(80):
        words = list(passage)
        for _ in range(random_.randint(0, 3)):
            words[random_.randrange(len(words))] = random_.choice(("x", "y", "z"))
        rows.append((i, " ".join(words + cases.prose(i, random_.randint(0, 9)).split())))
    random_.shuffle(rows)
    monkeypatch.setattr(superkmers, "OFTEN", 20 if seed else 10**9)
    monkeypatch.setattr(superkmers, "SEEN", 30)
    check(spark, rows, bucket=(7, 7, 1 << 17)[seed])


def test_overfull_buckets_send_their_windows_on(spark):
    rows = [(i, cases.prose(i, 5) + " " + cases.prose(600, 20)) for i in range(30)]
    sent = []
    for bucket in (3, 1000):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        buckets = superkmers.packed(docs).coalesce(1).sortWithinPartitions("bucket")
        found = buckets.mapInArrow(superkmers._resolve(bucket), "doc_id long, part int, start int, n int, window binary")
        sent.append(found.where("window is not null").count())
    assert sent[0] > 0 == sent[1]


def test_super_kmers_cover_every_window_once():
    import numpy as np

    for n in (13, 14, 40, 300):
        joined = cases.prose(n, n).encode()
        for late in (np.empty(0, np.uint64), np.sort(superkmers._run_hashes(joined, superkmers.MINIMISER) >> np.uint64(1))[::2]):
            bucket, start, count = superkmers.split_at_minimisers(joined, late)
            assert [w for s, c in zip(start, count, strict=True) for w in range(s, s + c)] == list(range(n - WIDTH + 1))
            assert count.max() <= superkmers.PACKED
    same = b" ".join([b"a"] * 1000)
    assert len({*superkmers.split_at_minimisers(same, np.empty(0, np.uint64))[0].tolist()}) == 1


def test_codes_are_told_apart():
    words = [str(i).encode() for i in range(60_000)]
    code = superkmers.codes(words)
    assert len({*code.values()}) == len(words) and max(map(len, code.values())) == 3
    assert all(len(c.split()) == 1 and c[:1] != superkmers._PLAIN for c in code.values())


def test_words_that_look_like_codes(spark):
    """Frequent words have codes; texts of what is a code, or spelled out, of other words stay different."""
    often = " ".join(["aa bb cc dd"] * 40)
    odd = ["! " * 20, '" ' * 20, "\x01! " * 20, "\x01aa " * 20, "\x01 " * 20, "aa " * 20, "é " * 20]
    check(spark, [(i, text) for i, text in enumerate([often, *odd, *odd, often])])


def test_query(spark):
    found = superkmers.op11_substring_dedup(spark, cases.TABLES).collect()
    rows = [(r.doc_id, r.text) for r in cases.documents(spark).collect()]
    expected = {(k, n, gone, hashlib.sha256(text.encode()).hexdigest()) for k, n, gone, text in brute(rows)}
    assert {tuple(r) for r in found} == expected
    assert sum(r.n_removed for r in found)


def test_empty_table(spark):
    assert superkmers.without_repeats(spark.createDataFrame([], cases.TEXT_SCHEMA)).collect() == []
