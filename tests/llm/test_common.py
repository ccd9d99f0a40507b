import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quayside.llm import common
from quayside.llm.components import components
from tests.llm import cases


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAbB \t\n\x0b\x1cé"))
def test_equal_words_have_equal_hashes(text):
    words = cases.words(text)
    hashes = common.word_hashes(text)
    assert len(hashes) == len(words)
    assert len({*hashes.tolist()}) == len({*words})
    lowered = [w.translate({65: "a", 66: "b"}) for w in words]
    assert len({*common.word_hashes(text, lower=True).tolist()}) == len({*lowered})


def test_long_texts_are_cut_between_words(monkeypatch):
    text = cases.prose(5, 3000)
    whole = common.word_hashes(text)
    monkeypatch.setattr(common, "_PIECE", 50)
    assert np.array_equal(common.word_hashes(text), whole)


def test_windows():
    words = common.word_hashes("a b c d e f a b c d e")
    windows = common.window_hashes(words)
    assert len(windows) == 7 and windows[0] == windows[6] and len({*windows.tolist()}) == 6
    assert len(common.window_hashes(words[:3])) == 1
    assert len(common.window_hashes(words[:0])) == 0
    assert common.window_hashes(words[:3])[0] != common.window_hashes(words[:4])[0]


def test_components_of_chains_stars_and_repeats(spark):
    links = [(i, i + 1) for i in range(10, 40)] + [(100, i) for i in range(101, 150)] + [(7, 7), (None, 3), (40, 149), (200, 201), (201, 200)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert found == cases.components({n for link in real for n in link}, real)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_sample_per_class_takes_small_classes_whole(spark):
    frame = spark.range(5000).selectExpr("id", "if(id % 100 = 0, 'rare', if(id % 7 = 0, null, 'often')) as label")
    counts = {r["label"]: r["count"] for r in common.sample_per_class(frame, "label", 300, "id").groupBy("label").count().collect()}
    assert counts["rare"] == 50 and 230 < counts["often"] < 370 and None not in counts
