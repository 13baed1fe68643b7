from __future__ import annotations

import hashlib
import sys
from pathlib import Path

import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from test_jaccard_join import brute as components  # noqa: E402
from test_secret_scan import brute as secret_spans  # noqa: E402

from threadloom.llm.queries import op4_quality  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_stages_on_the_test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), "test")
        seen[name] = before, docs.collect()
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    before, after = seen["quality"]
    assert {r.doc_id for r in after} == {r.doc_id for r in op4_quality(spark, SF).collect() if r.predicted == 1} and len(after) < len(before)
    before, after = seen["near_duplicates"]
    found = components([(d, r.text) for d, r in before.items()])
    assert {r.doc_id for r in after} == {d for d in before if found[d][1] == d} and len(after) < len(before)
    before, after = seen["decontaminate"]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaking = {d for d, r in before.items() if any(q in r.text for q in items)}
    assert leaking and not leaking & {r.doc_id for r in after} and len(before) - len(after) <= 2 * len(leaking)
    before, after = seen["secrets"]
    assert len(after) == len(before) and not any(secret_spans(r.text) for r in after)
    changed = {r.doc_id for r in after if r.text != before[r.doc_id].text}
    assert changed == {d for d, r in before.items() if secret_spans(r.text)} and changed
    assert all(r.n_chars == len(r.text) for r in after if r.doc_id in changed)
    before, after = seen["tokens"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in after:
        ids = library.encode(before[r.doc_id].text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert all(set(rows[0].__fields__) == set(columns) for name, (_, rows) in seen.items() if name != "tokens")


def write(spark, folder, docs):
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, None)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, "x y z"), (1, None)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_nulls_repeats_and_ties(spark, tmp_path):
    text = "some clean words that stand here in a row and say nothing"
    docs = [(1, text, None, None, None), (1, text, "en", "s", 5), (2, text, "en", "s", 5), (None, "token=abcdefgh", None, None, None), (3, None, None, None, None), (4, "", "en", "s", 0), (5, "see x y z there", "en", "s", 9)]
    write(spark, str(tmp_path), docs)
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = corpus_pipeline.near_duplicates(spark, df, str(tmp_path)).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "1", "3", "4", "5", "None"]
    assert sorted(str(r.doc_id) for r in corpus_pipeline.decontaminate(spark, df, str(tmp_path)).collect()) == ["1", "1", "2", "3", "4", "None"]
    assert {r.text for r in corpus_pipeline.secrets(spark, df, str(tmp_path)).where("doc_id IS NULL").collect()} == {"[secret]"}
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} <= {1, 2, 3, 4, None}


def test_empty_table(spark, tmp_path):
    write(spark, str(tmp_path), [])
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_rows_without_id_are_worked_on_too(spark, tmp_path):
    text = "some clean words that stand here in a row and say nothing"
    docs = [(1, text, "en", "s", 5), (None, text, None, None, None), (None, "only this one has words of its own today", None, None, None), (None, "see x y z there", None, None, None), (None, "only this one has words of its own today", "en", None, None)]
    write(spark, str(tmp_path), docs)
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = corpus_pipeline.near_duplicates(spark, df, str(tmp_path))
    assert kept.schema == df.schema and sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted([("1", text), ("None", docs[2][1]), ("None", docs[3][1])])
    kept = corpus_pipeline.decontaminate(spark, df, str(tmp_path))
    assert kept.schema == df.schema and sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted([("1", text), ("None", text), ("None", docs[2][1]), ("None", docs[2][1])])


def test_columns_of_the_stages_own_names(spark, tmp_path):
    write(spark, str(tmp_path), [(1, "token=abcdefgh and some words", "en", "s", 5), (2, "see x y z there", "en", "s", 9), (3, "some words", None, None, None)])
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = ("score", "has_secret", "id", "row", "item", "spans", "n_shingles", "component_id", "key", "data", "share", "n_tokens", "ids_text", "root", "Score_")
    for name in names:
        df = df.selectExpr("*", f"'{name}' AS `{name}`")
    for stage, f in corpus_pipeline.STAGES[:-1]:
        df = corpus_pipeline.materialize(f(spark, df, str(tmp_path)), "test")
        assert {*names} < {*df.columns}, stage
        assert all(r[c] == c for r in df.collect() for c in names)
    assert corpus_pipeline.tokens(spark, df, str(tmp_path)).count() == df.count()
