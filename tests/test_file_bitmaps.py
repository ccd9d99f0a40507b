"""Searches that skip files by the bitmaps of their tokens."""

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from quayside import Index
from quayside.operators.search import BoolMatchPhrase, Fuzzy, Match, MatchAll, Term, Terms, search
from quayside.sources import file_bitmaps, indexes
from tests.conftest import plan_of, same_rows

WORDS = [f"word{i}" for i in range(200)]


@pytest.fixture
def index(spark, tmp_path):
    """Ten files; ``wordN`` is in file N mod 10, ``common`` in all; one has no tokens, one no rows."""
    index = Index("docs", folder=str(tmp_path), id_column="id")
    for part in range(10):
        rows = [(i, f"Common, {WORDS[i]} and {WORDS[(i + 10) % 200]}", "a b" if i == 7 else None) for i in range(part, 200, 10)]
        indexes.write_index(spark.createDataFrame(rows, "id int, text string, title string").coalesce(1), index)
    indexes.write_index(spark.createDataFrame([(900, " ..", None), (901, None, None)], "id int, text string, title string").coalesce(1), index)
    indexes.write_index(spark.createDataFrame([], "id int, text string, title string"), index)
    return index


def files_read(frame) -> int:
    """How many files the scan of a plan has read."""
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    metrics = [leaves.apply(i).metrics() for i in range(leaves.size())]
    return sum(m.apply("numFiles").value() for m in metrics if m.contains("numFiles"))


QUERIES = {
    Match("text", "word7"): 1,
    Match("text", "word7 nowhere WORD17"): 1,
    Match("text", "word7 word8"): 2,
    Match("text", "nowhere"): 0,
    Match("text", "..."): 0,
    Match("text", "common"): 10,
    Match("title", "a"): 1,
    Term("text", "word3"): 1,
    Term("text", "no token"): 0,
    Terms("text", ("word3", "word4", "word13")): 2,
    BoolMatchPhrase("must", (("text", "common word3 and"),)): 1,
    BoolMatchPhrase("must", (("text", "word3"), ("text", "word4"))): 0,
    BoolMatchPhrase("should", (("text", "word3 and"), ("text", "and word14"))): 2,
}


def test_rare_words_read_few_files(spark, index):
    everything = indexes.read_index(spark, index)
    indexes.summarise_index(spark, index, ["text", "title"])
    for query, most in QUERIES.items():
        found = indexes.search_index(spark, index, query)
        assert same_rows(found, search(everything, query, None, "_id")), query
        assert files_read(found) <= most, query


def test_other_queries_read_all(spark, index):
    indexes.summarise_index(spark, index, ["text"])
    for query in (MatchAll(), Fuzzy("text", "word7"), BoolMatchPhrase("must-not", (("text", "word3"),)), Match("nothing", "a")):
        found = indexes.search_index(spark, index, query)
        assert same_rows(found, search(indexes.read_index(spark, index), query, None, "_id")), query


def test_new_and_changed_files_are_read(spark, index, tmp_path):
    indexes.summarise_index(spark, index, ["text"])
    more = spark.createDataFrame([(1000, "word7 again", None)], "id int, text string, title string").coalesce(1)
    indexes.write_index(more, index)
    found = indexes.search_index(spark, index, Match("text", "word7"))
    assert {r.id for r in found.collect()} == {7, 197, 1000}
    # a file that is written anew under its old name is another file
    paths = sorted(glob.glob(f"{tmp_path}/docs/*.parquet"))
    source = spark.createDataFrame([(2000, "word7 too", None, "2000")], "id int, text string, title string, _id string")
    source.coalesce(1).write.parquet(f"{tmp_path}/other")
    shutil.copyfile(glob.glob(f"{tmp_path}/other/*.parquet")[0], paths[0])
    os.remove(f"{os.path.dirname(paths[0])}/.{os.path.basename(paths[0])}.crc")
    found = {r.id for r in indexes.search_index(spark, index, Match("text", "word7")).collect()}
    assert 2000 in found and found == {r.id for r in search(indexes.read_index(spark, index), Match("text", "word7")).collect()}
    indexes.summarise_index(spark, index, ["text"])
    assert {r.id for r in indexes.search_index(spark, index, Match("text", "word7")).collect()} == found


def test_summaries_are_made_once(spark, index, tmp_path):
    indexes.summarise_index(spark, index, ["text"])
    folder = f"{tmp_path}/docs/_tokens"
    before = sorted(os.listdir(folder))
    indexes.summarise_index(spark, index, ["text"])
    assert sorted(os.listdir(folder)) == before
    assert spark.read.parquet(folder).groupBy("file", "field", "number").count().where("count > 1").isEmpty()


def test_fields_without_a_summary(spark, index):
    indexes.summarise_index(spark, index, ["text"])
    assert [r.id for r in indexes.search_index(spark, index, Match("title", "a")).collect()] == [7]
    both = BoolMatchPhrase("must", (("title", "a b"), ("text", "word17")))
    assert [r.id for r in indexes.search_index(spark, index, both).collect()] == [7]
    indexes.summarise_index(spark, index, ["text", "title"])
    found = indexes.search_index(spark, index, both)
    assert [r.id for r in found.collect()] == [7] and files_read(found) <= 2


def test_the_choice_reaches_the_scan(spark, index):
    indexes.summarise_index(spark, index, ["text"])
    plan = plan_of(indexes.search_index(spark, index, Match("text", "word7")))
    assert "file_path" in plan and plan.count("Scan parquet") == 1 and "Exchange" not in plan


def test_fields_must_be_texts_and_clusters_keep_their_own(spark, index):
    with pytest.raises(ValueError, match="no text"):
        indexes.summarise_index(spark, index, ["id"])
    with pytest.raises(ValueError, match="cluster"):
        indexes.summarise_index(spark, Index("docs", nodes="n:9200"), ["text"])


def test_without_summaries_nothing_changes(spark, index):
    documents = indexes.read_index(spark, index)
    assert file_bitmaps.worth_reading(documents, indexes.index_path(index), Match("text", "word7")) is documents
    assert documents.where(F.col("id") == 7).count() == 1
