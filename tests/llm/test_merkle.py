from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from threadloom.llm.merkle import fold, leaf, manifest, siblings
from threadloom.llm.ordering import at_most, numbered, radix_select
from threadloom.llm.queries import op11_merkle

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, lang string, text string, g string, idx int, proof int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def digest(*values):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values]
    return sha("".join(parts))


def tree(nodes, fanout):
    """(root, siblings of each node): by plain lists."""
    proofs, at = [[] for _ in nodes], [*range(len(nodes))]
    while len(nodes) > 1:
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        for leaf_at, place in enumerate(at):
            run = runs[place // fanout]
            proofs[leaf_at] += [d for i, d in enumerate(run) if i != place % fanout]
            at[leaf_at] = place // fanout
        nodes = [sha("".join(run)) for run in runs]
    return (nodes[0] if nodes else None), proofs


def brute(rows, fanout):
    """(doc_id, leaf, subroot, root, digests of the proof) of rows (doc_id, lang, text), sorted."""
    langs = sorted({r[1] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    subroots, found = [], []
    for lang in langs:
        own = sorted(((r[0], digest(*r)) for r in rows if r[1] == lang), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        top, proofs = tree([d for _, d in own], fanout)
        subroots.append(top)
        found.append((own, proofs))
    root, upper = tree(subroots, fanout)
    return sorted(((d, x, sub, root, "".join(p + u)) for (own, proofs), sub, u in zip(found, subroots, upper, strict=True) for (d, x), p in zip(own, proofs, strict=True)), key=str)


def built(spark, rows, fanout):
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).withColumn("leaf", leaf(F.col("doc_id"), F.col("lang"), F.col("text")))
    made = manifest(docs, "lang", ["doc_id"], fanout=fanout)
    return made, made.leaves.select("doc_id", "leaf", "subroot", siblings(F.col("proof")).alias("s"), fold(F.col("leaf"), F.col("proof")).alias("folded"), fold(F.sha2("leaf", 256), F.col("proof")).alias("wrong")).collect()


ROWS = [(i, ["en", "de", None, "日"][i % 4 if i % 3 else 0], f"text {i}") for i in range(41)] + [(7, "de", "again"), (7, "de", "again"), (None, "en", None), (None, "en", ""), (5, None, "é"), (-3, "alone", "long " * 5000)]


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_equals_plain_lists(spark, fanout):
    made, rows = built(spark, ROWS, fanout)
    want = brute(ROWS, fanout)
    assert sorted(((r.doc_id, r.leaf, r.subroot, made.root, r.s) for r in rows), key=str) == want
    assert all(r.folded == made.root and r.wrong != made.root for r in rows)
    assert {(r.lang, r.n_leaves) for r in made.groups.collect()} == {(lang, sum(x[1] == lang for x in ROWS)) for lang in {x[1] for x in ROWS}}


def test_one_row_and_none(spark):
    made, rows = built(spark, [(1, None, None)], 2)
    assert [(r.leaf, r.s, r.folded) for r in rows] == [(made.root, "", made.root)] and made.root == digest(1, None, None)
    made, rows = built(spark, [], 2)
    assert rows == [] and made.root is None


def test_null_and_the_mark_of_null_differ(spark):
    r = spark.sql("SELECT CAST(NULL AS STRING) a, '-' b, '' c").select(*(leaf(F.col(c)).alias(c) for c in "abc")).first()
    assert [*r] == [sha("-"), sha("1:-"), sha("0:")]


def test_given_columns_of_the_results_names_are_replaced(spark):
    made, _ = built(spark, ROWS[:3], 2)
    assert sorted(made.leaves.columns) == sorted(["doc_id", "lang", "text", "g", "leaf", "idx", "subroot", "proof"])


def test_query_over_the_test_table(spark):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    leaves = {r[0]: digest(*r) for r in rows}
    got = {r.doc_id: r for r in op11_merkle(spark, SF).collect()}
    assert got.keys() == leaves.keys() and all(got[d].leaf == x for d, x in leaves.items())
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {lang: sorted(r[0] for r in rows if r[2] == lang) for lang in langs}
    made = {lang: tree([leaves[d] for d in own[lang]], 2) for lang in langs}
    root, upper = tree([made[lang][0] for lang in langs], 2)
    for lang, u in zip(langs, upper, strict=True):
        for d, p in zip(own[lang], made[lang][1], strict=True):
            r = got[d]
            assert (r.subroot, r.root, r.proof_sha256) == (made[lang][0], root, sha("".join(p + u)))
            hit = zlib.crc32(str(d).encode()) % 7 == 0
            assert r.verified == (not hit) and (r.folded_root == root) == (not hit)


def test_numbers_and_selection(spark):
    rows = [(i % 5 if i % 7 else None, i * 37 % 101 - 50, 3) for i in range(300)] + [(1, 9, 3)] * 50
    df = spark.createDataFrame(rows, "g int, x bigint, one int").repartition(7)
    got = sorted((r.g is not None, r.g or 0, r.n, r.x) for r in numbered(df, [F.col("x").asc()], "g", "n").collect())
    want = []
    for g in {r[0] for r in rows}:
        want += [(g is not None, g or 0, i, x) for i, x in enumerate(sorted(r[1] for r in rows if r[0] == g))]
    assert got == sorted(want)
    wide = spark.createDataFrame([(v,) for v in (-(2**63), 2**63 - 1, 0, -1, 5)], "x bigint")
    assert [radix_select(wide, ["x"], k) for k in range(7)] == [None, *((v,) for v in sorted((-(2**63), 2**63 - 1, 0, -1, 5))), None]
    keys = sorted((r[1], r[2]) for r in rows)
    for k in (1, 2, 77, 300, 350):
        found = radix_select(df, ["x", "one"], k, bits=3)
        assert found == keys[k - 1] and df.where(at_most(["x", "one"], found)).count() == sum(key <= found for key in keys)
