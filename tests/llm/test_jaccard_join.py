from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from threadloom.llm.jaccard_join import difference_at_least, jaccard_components, shingle_sets, signatures, sketch


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute(rows):
    """Components by comparing all pairs that share a shingle."""
    sets = {d: shingles(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    posting = defaultdict(list)
    for d in sets:
        for s in sets[d]:
            posting[s].append(d)
    seen = set()
    for docs in posting.values():
        for i, a in enumerate(docs):
            for b in docs[i + 1 :]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                        x, y = sorted((find(a), find(b)))
                        root[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


def made_rows(seed=3):
    rnd = random.Random(seed)
    word = lambda: "w%d" % rnd.randrange(4000)
    rows, boiler = [], [word() for _ in range(40)]
    for size in (1, 2, 4, 5, 6, 8, 12, 20, 30, 33, 36, 45, 60, 90, 140, 220, 420):
        base = [word() for _ in range(size)]
        if size % 3 == 0:
            base[: len(boiler)] = boiler[: size // 2] + base[: size - size // 2]
        for _ in range(7):
            copy = list(base)
            for _ in range(rnd.randrange(0, 1 + max(1, size // 30))):
                at = rnd.randrange(len(copy))
                copy[at : at + rnd.randrange(2)] = [word()] * rnd.randrange(1, 3)
            rows.append(" ".join(copy))
    rows += ["", "   \t\n", None, "Same words HERE again and so on", "same WORDS here\tagain and so on"]
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [3, 4])
def test_components_equal_brute_force(spark, seed):
    rows = made_rows(seed)
    got = {r[0]: (r[1], r[2]) for r in jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == brute(rows)


def test_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r[0]: (r[1], r[2]) for r in jaccard_components(docs).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_each_similar_pair_shares_a_signature():
    rnd = random.Random(5)
    for _ in range(400):
        n = rnd.randrange(1, 500)
        common = [rnd.getrandbits(64) for _ in range(n)]
        extra = rnd.randrange(0, n // 3 + 1)
        cut = rnd.randrange(0, extra + 1)
        a = np.array(sorted({*common, *(rnd.getrandbits(64) for _ in range(cut))}), np.uint64)
        b = np.array(sorted({*common, *(rnd.getrandbits(64) for _ in range(extra - cut))}), np.uint64)
        if 100 * n >= 75 * (len(a) + len(b) - n):
            sig, owner = signatures([a, b], 0.75)
            assert {*sig[owner == 0].tolist()} & {*sig[owner == 1].tolist()}, (n, len(a), len(b))


def test_all_similar_pairs_of_small_sets_share_a_signature():
    """All pairs of many sets over few elements, with as many differences as there may be."""
    rnd = random.Random(6)
    for size in (*range(1, 16), 22, 31, 40):
        pool = [rnd.getrandbits(64) for _ in range(size + size // 3 + 2)]
        sets = [np.array(sorted(rnd.sample(pool, rnd.randrange(max(1, size - size // 5), size + 1))), np.uint64) for _ in range(60)]
        sig, owner = signatures(sets, 0.75)
        own = [{*sig[owner == i].tolist()} for i in range(len(sets))]
        for i, a in enumerate(sets):
            for j in range(i):
                common = len(np.intersect1d(a, sets[j]))
                if 100 * common >= 75 * (len(a) + len(sets[j]) - common):
                    assert own[i] & own[j], (size, i, j)


def test_repeated_ids_with_different_texts(spark):
    base, other = [f"w{i}" for i in range(40)], [f"v{i}" for i in range(40)]
    rows = [(7, " ".join(base)), (7, " ".join(other)), (9, " ".join([*base, "x"])), (11, " ".join([*other, "x"])), (3, " ".join(f"u{i}" for i in range(40)))]
    got = sorted(map(tuple, jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()))
    assert got == [(3, 36, 3), (7, 36, 7), (7, 36, 7), (9, 37, 7), (11, 37, 7)]


def test_groups_that_slices_send_by_themselves(spark):
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*base[: rnd.randrange(54, 60)], f"x{i}"])) for i in range(60)] + [(100 + i, " ".join(rnd.choice(base) for _ in range(30))) for i in range(40)]
    got = {r[0]: (r[1], r[2]) for r in jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()}
    assert got == brute(rows)


def test_sketches_bound_the_difference():
    rnd = np.random.default_rng(2)
    for _ in range(200):
        common = rnd.integers(0, 2**63, rnd.integers(1, 300)).astype(np.uint64)
        a, b = (np.unique(np.concatenate([common, rnd.integers(0, 2**63, rnd.integers(0, 200)).astype(np.uint64)])) for _ in range(2))
        assert difference_at_least(sketch(a), sketch(b)) <= len(np.setxor1d(a, b))


def test_short_sequences_differ_from_longer_ones():
    a, b, c = shingle_sets(pa.array(["x y", "x y z", None]), 5)
    assert len(a) == len(b) == 1 and a[0] != b[0] and len(c) == 0


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "y"), (None, "a b c d e f", None), (None, None, None), (2, "A B C D E F", "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, id string").withColumnRenamed("id", "key")
    got = sorted((tuple(r) for r in jaccard_components(df).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (2, 2, 1), (None, 2, None), (None, 0, None)], key=str)


def test_empty_table(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
