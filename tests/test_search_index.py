"""Searches by the index against searches of the whole store."""

from __future__ import annotations

import random

import pytest

from threadloom.operators import search_index, store

SCHEMA = "knowledge_id string, revision int, canonical_status string, title string, summary string, content string"
WORDS = ["cat", "concat", "sat", "saturn", "the", "on", "mat", "a-b", "x", "Cat", "é"]


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    rnd = random.Random(7)
    text = lambda n: None if rnd.random() < 0.1 else "".join(rnd.choice(WORDS) + rnd.choice([" ", " ", ", ", "\n"]) for _ in range(rnd.randint(0, n)))
    rows = [(f"K{i % 50}", 1 + i // 50, "CURRENT" if i >= 100 else "SUPERSEDED", text(4), text(8), text(30)) for i in range(150)]
    rows += [("K9", 3, "CURRENT", "the the the", "", ""), ("K9", 3, "CURRENT", "the the the", "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    path = str(tmp_path_factory.mktemp("index") / "i")
    search_index.build(df, path, buckets=5)
    return df, path


@pytest.mark.parametrize("at,query", [*enumerate(["cat", "the cat sat", "CAT, sat", "ncat sat", "the the", "-b x", ",", "é", "nothing here"])])
def test_equals_a_search_of_the_store(spark, indexed, at, query):
    df, path = indexed
    for history, limit in ((bool(at % 2), 3), (bool((at + 1) % 2), 100)):
        want = store.search(df, query, history, limit)
        got = search_index.search(spark, path, query, history, limit)
        rank = lambda found: [(r.score, r.revision, r.knowledge_id) for r in found.collect()]
        assert rank(got) == rank(want) and sorted(got.columns) == sorted(want.columns)


def test_reads_the_words_lists_alone(spark, indexed):
    _, path = indexed
    plan = search_index.lists(spark, path, ["cat"], 5)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "EqualTo(word,cat)" in plan
    with pytest.raises(ValueError):
        search_index.search(spark, path, " ")


def test_an_empty_store(spark, tmp_path):
    search_index.build(spark.createDataFrame([], SCHEMA), str(tmp_path / "i"))
    assert search_index.search(spark, str(tmp_path / "i"), "cat").collect() == []


def test_places_are_not_shuffled(spark):
    df = spark.createDataFrame([(1, "CURRENT", "a b a", "", "b"), (2, "RETIRED", None, "", "a")], "doc bigint, canonical_status string, title string, summary string, content string")
    got = search_index.postings_of(df)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("Exchange hashpartitioning(doc#") == 1 and plan.index("Exchange") > plan.index("Generate")
    assert {(r.doc, r.current, r.word): r.places for r in got.collect()} == {(1, True, "a"): [0, 2], (1, True, "b"): [1, 3], (2, False, "a"): [0]}
