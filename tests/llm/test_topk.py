from __future__ import annotations

import math

import numpy as np

from threadloom.llm.topk import top_k

SCHEMA = "vec_id bigint, embedding array<float>, rank int"


def brute(rows, k, every):
    ints = {}
    for i, x in rows:
        if i is not None and x is not None and all(c is not None and math.isfinite(c) for c in x):
            ints.setdefault(i, []).append([math.floor(1024 * float(np.float32(c))) for c in x])
    out = []
    for q in sorted(ints):
        for mine in ints[q] if q % every == 0 else ():
            scored = sorted((-sum(a * b for a, b in zip(mine, v)), i) for i in ints if i != q for v in ints[i])
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def got(spark, rows, k=10, every=100, **more):
    df = spark.createDataFrame([(i, x, 0) for i, x in rows], SCHEMA)
    return sorted(map(tuple, top_k(df, lambda c: c % every == 0, k=k, **more).collect()))


def test_equals_brute_force_in_small_blocks(spark):
    rnd = np.random.default_rng(1)
    base = rnd.normal(size=(700, 12)) * np.exp(rnd.normal(size=(700, 1)))
    base[300:330] = base[0]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    assert got(spark, rows, every=20, block_rows=64, lead=3) == brute(rows, 10, 20)


def test_nulls_repeats_short_and_few(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [0.5]), (6, []), (None, [1.0, 1.0]), (7, [3.0, -1.0]), (7, [3.0, -1.0]), (100, [0.0, 0.0])]
    assert got(spark, rows) == brute(rows, 10, 100)


def test_beyond_doubles(spark):
    rows = [(i, [float(2.0**21 + i), float(2.0**20 - i), 3.0]) for i in range(40)]
    assert got(spark, rows, k=3, every=10) == brute(rows, 3, 10)


def test_test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert sorted(map(tuple, top_k(df, lambda c: c % 100 == 0, block_rows=100).collect())) == brute(rows, 10, 100)


def test_empty_table(spark):
    assert got(spark, []) == []


def test_finite_vectors_take_part_however_long(spark):
    rows = [(i, [float(i), 1.0, -2.0]) for i in range(30)] + [(30, [1e10, 0.0, 0.0])]
    endless = [(31, [1e308, 0.0, 0.0]), (40, [0.0, -1e300, 1.0])]  # infinite as floats
    assert got(spark, rows + endless, k=3, every=10) == [(q, r, v, min(s, 2**63 - 1)) for q, r, v, s in brute(rows, 3, 10)]


def test_blocks_of_many_lengths(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rnd.normal(size=4) * 10.0 ** (i % 5 - 2)]) for i in range(400)]
    assert got(spark, rows, every=7, block_rows=16, lead=2) == brute(rows, 10, 7)


def test_long_vectors_take_part_and_scores_beyond_64_bits_are_the_nearest(spark):
    def nearest(rows, k):
        found = {}
        for q, _, v, s in brute(rows, len(rows), 100):
            found.setdefault(q, []).append((-max(-(2**63), min(2**63 - 1, s)), v))
        return sorted((q, r + 1, v, -s) for q, scored in found.items() for r, (s, v) in enumerate(sorted(scored)[:k]))

    rows = [(0, [0.5, 0.25]), (100, [4e6, 0.1]), (2, [1.0, 1.0]), (3, [-4e6, 7.0]), (4, [3e9, -1e9]), (200, [2.5e9, 1.5e9]), (5, [1e15, -1e15]), (300, [1.0, 1.0]), (7, [1e5, 3.0])]
    want = brute(rows, 10, 100)
    assert any(abs(r[3]) >= 2**53 and abs(r[3]) < 2**63 for r in want) and any(abs(r[3]) > 2**63 for r in want)
    assert got(spark, rows) == nearest(rows, 10)
    rows += [(6, [3e38, 3e38]), (400, [3e38, -3e38])]
    assert got(spark, rows, k=4) == nearest(rows, 4)


def test_one_vector_of_many_components(spark):
    rnd = np.random.default_rng(4)
    rows = [(i, [float(c) for c in rnd.normal(size=int(rnd.integers(0, 9)))]) for i in range(300)] + [(1000, [float(c) for c in rnd.normal(size=5000)]), (1001, [float(c) for c in rnd.normal(size=3000)])]
    assert got(spark, rows, block_rows=50) == brute(rows, 10, 100)
