import pytest

import corpus_pipeline as pipeline
from quayside.llm import jaccard, packing, secrets
from tests.llm import cases


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into every stage, and what the last one gives."""
    docs, inputs = cases.documents(spark), []
    for _, stage in pipeline.STAGES:
        inputs.append(docs)
        docs = stage(spark, docs, cases.TABLES).persist()
    return inputs, docs


def test_stages_keep_the_columns_of_documents(spark, stages):
    columns = cases.documents(spark).columns
    assert all(frame.columns == columns for frame in stages[0])
    assert [name for name, _ in pipeline.STAGES] == ["language_id", "near_duplicates", "secret_scans", "mixing", "packing"]


def test_language_keeps_clean_documents(stages):
    before, after = stages[0][0].count(), stages[0][1].count()
    assert after >= 0.98 * before


def test_one_of_each_group_stays(spark, stages):
    before, after = stages[0][1], stages[0][2]
    groups = {r.doc_id: r.component_id for r in jaccard.join(before).collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted({*groups.values()})


def test_secrets_go_and_other_texts_stay(stages):
    before = {r.doc_id: r.text for r in stages[0][2].collect()}
    after = {r.doc_id: r for r in stages[0][3].collect()}
    assert {*before} == {*after}
    for key, text in before.items():
        found = secrets.base_spans(text)
        assert (after[key].text == text) == (not found)
        assert not secrets.base_spans(after[key].text) and after[key].n_chars == len(after[key].text)


def test_the_mix_repeats_whole_documents(stages):
    before = {r.doc_id: r for r in stages[0][3].collect()}
    after = stages[0][4].collect()
    assert after and all(r == before[r.doc_id] for r in after)
    times = [sum(r.doc_id == key for r in after) for key in before]
    assert max(times) <= 3 and min(times) == 0


def test_sequences_hold_the_mix(stages):
    pieces = stages[1].collect()
    expected = sum(len(packing.token_ids(r.text)) for r in stages[0][4].collect())
    assert sum(p.length for p in pieces) == expected


def test_run_gives_what_the_stages_give(spark, stages):
    found = pipeline.run(spark, cases.TABLES)
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
    assert sorted(map(key, found.collect())) == sorted(map(key, stages[1].collect()))


@pytest.mark.parametrize("make", [cases.edge_documents, cases.no_documents, cases.null_documents])
def test_edges(spark, make):
    docs = make(spark)
    columns = docs.columns
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, cases.TABLES).persist()
        assert docs.columns == columns
        docs.count()
    rows = docs.collect()
    named = [r for r in rows if r.doc_id is not None]
    assert len({(r.doc_id, r.text) for r in named}) == len({r.text for r in named})
    assert pipeline.STAGES[-1][1](spark, docs, cases.TABLES).count() >= len(rows)
