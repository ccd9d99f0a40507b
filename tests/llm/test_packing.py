import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quayside.llm import packing
from tests.llm import cases


@pytest.fixture(scope="module")
def public():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return lambda text: [*found.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


ODD = ["<|endoftext|> a", "I'll we've  \t\n x", "a b c", "日本語 テキスト", "\x00\x01 ﻿", "  lead", "trail  ", "١٢٣ ½"]


def test_ids_are_the_public_tokenizers(public):
    for text in [*cases.texts(), *ODD]:
        assert packing.token_ids(text).tolist() == public(text)


def test_long_texts_are_encoded_in_parts(monkeypatch):
    text = cases.prose(9, 500) + "  double  blanks \n\n lines\n" + "x" * 300 + " " + cases.prose(8, 300)
    whole = packing.token_ids(text)
    monkeypatch.setattr(packing, "_PART", 40)
    assert np.array_equal(packing.token_ids(text), whole)


@pytest.mark.parametrize("seed", range(6))
def test_differencing(seed):
    random_ = random.Random(seed)
    sizes = [random_.randint(1, 400) for _ in range(random_.randint(1, 300))]
    windows = packing.shared_out(sizes, 1000)
    assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
    totals = [sum(sizes[i] for i in w) for w in windows]
    assert max(totals) <= 1000 and len(windows) <= 1.15 * -(-sum(sizes) // 1000) + 1
    assert packing.shared_out([], 1000) == []


def test_windows_rise_where_differencing_exceeds_the_capacity():
    assert len(packing.shared_out([600, 600, 600], 1000)) == 3
    assert [len(w) for w in packing.shared_out([700, 300, 700, 300], 1000)] == [2, 2]


def check(rows, ids, capacity=packing.CAPACITY):
    """Every id of every document is in one piece, and every sequence is filled from 0 on without gaps."""
    sequences, documents = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        documents.setdefault(r.doc_id, []).append(r)
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    assert {*documents} == {*ids}
    for key, pieces in documents.items():
        expected, copies = ids[key]
        assert sum(p.length for p in pieces) == copies * len(expected)
        for p in pieces:
            part = np.array(expected[p.start : p.start + p.length], "<u4")
            assert p.ids_crc32 == zlib.crc32(part.tobytes()) and p.doc_tokens == len(expected)
    return sequences


def test_documents(spark, public):
    rows = packing.op3_packing(spark, cases.TABLES).collect()
    ids = {r.doc_id: (public(r.text), 1) for r in cases.documents(spark).collect()}
    sequences = check(rows, ids)
    assert len(sequences) <= 1.05 * sum(len(i) for i, _ in ids.values()) / packing.CAPACITY + 1
    again = packing.op3_packing(spark, cases.TABLES).collect()
    assert sorted(rows) == sorted(again)


def test_edges(spark, public):
    rows = packing.pack(cases.edge_documents(spark).coalesce(1), with_ids=True).collect()
    ids = {i: (public(t), 1) for i, t in enumerate(cases.texts())}
    ids[3] = (ids[3][0], 2)
    ids[None] = (public(cases.texts()[0]), 1)
    check(rows, ids)
    assert all(r.ids == ids[r.doc_id][0][r.start : r.start + r.length] for r in rows)
    assert packing.pack(cases.no_documents(spark)).count() == 0
    assert [(r.length, r.doc_tokens) for r in packing.pack(cases.null_documents(spark)).collect()] == [(1, 1)] * 3
    small = packing.pack(cases.edge_documents(spark), capacity=64, piece=16).collect()
    check(small, ids, capacity=64)


def test_added_tokens_have_their_ids(spark):
    loaded = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = ["a <|endoftext|> b", end, end * 3, f"  x \n{end}\n\n y{end}", f"<{end}>", "<|endoftext|", f"{cases.prose(4, 900)} {end}{cases.prose(5, 900)}"]
    ids = {i: ([*loaded.encode(t, add_special_tokens=False).ids, packing.END_ID], 1) for i, t in enumerate(texts)}
    assert ids[0][0] == [64, 220, 50256, 275, packing.END_ID]
    check(packing.pack(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")).collect(), ids)
    for text in [*cases.texts(), *ODD]:
        assert packing.document_ids(text).tolist() == [*loaded.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
