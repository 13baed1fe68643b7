from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from threadloom.llm.importance import features, resample, spaced
from threadloom.llm.queries import op13_importance

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, longest=2):
    w = WORD.findall((text or "").translate(LOWER))
    return w, [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def bucket(gram, buckets):
    return zlib.crc32(gram.encode()) % buckets


def brute(docs, target, percent=25, least=20, longest=2, buckets=10_000, seed=7):
    s = Counter(bucket(g, buckets) for _, t in docs for g in grams(t, longest)[1])
    t = Counter(bucket(g, buckets) for x in target for g in grams(x, longest)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    rows = []
    for d, text in docs:
        w, f = grams(text, longest)
        weight = sum(gain[bucket(g, buckets)] for g in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(w)])
    long = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(long[: len(long) * percent // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def test_query_over_the_test_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = brute(docs, target)
    assert sorted((tuple(r) for r in op13_importance(spark, SF).collect()), key=str) == want
    assert len({r[4] for r in want}) > 10


@pytest.mark.parametrize("longest", [1, 2, 4])
def test_features_equal_plain_loops(longest):
    rnd = random.Random(longest)
    kinds = ["a", "B2", "éa", "日本", "x" * 47, "y" * 48, "z" * 49, "w" * 300, "Straße", "İ"]
    texts = [None, "", " .,", "one", *("".join(rnd.choice(kinds) + rnd.choice([" ", "-", "\n\t", "\x7f", "_"]) for _ in range(rnd.randint(0, 60))) for _ in range(40))]
    bins, owner, sizes = features(pa.array(texts, pa.string()).slice(0), longest, 9973)
    assert sizes.tolist() == [len(grams(t)[0]) for t in texts]
    for i, t in enumerate(texts):
        assert sorted(bins[owner == i].tolist()) == sorted(bucket(g, 9973) for g in grams(t, longest)[1])


def test_a_space_behind():
    words = [b"a", b"xyz", "é".encode() * 9]
    assert spaced(np.array([zlib.crc32(w) for w in words], np.uint32)).tolist() == [zlib.crc32(w + b" ") for w in words]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, 0, 0) for r in rows], "doc_id bigint, text string, rank int, own int, n_words int").repartition(3)


def drawn(spark, docs, target, **more):
    items = spark.createDataFrame([(t, 1) for t in target], "text string, rank int")
    return sorted((tuple(r) for r in resample(frame(spark, docs), items, **more).collect()), key=str)


def test_nulls_ties_and_repeats(spark):
    rnd = random.Random(3)
    kinds = [f"w{i}" for i in range(50)]
    docs = [(i, " ".join(rnd.choices(kinds, k=rnd.randint(0, 40)))) for i in range(120)]
    docs += [(500 + i, "same words again " * 7) for i in range(5)] + [(None, "no id here " * 9), (None, None), (-4, "long text " * 20_000), (7, "w1 " * 30)]
    target = ["w1 w2 w3 " * 5, None, ""]
    assert drawn(spark, docs, target) == brute(docs, target)
    assert drawn(spark, docs, [], percent=100, least_words=0, longest=3, buckets=64, seed=1) == brute(docs, [], 100, 0, 3, 64, 1)


def test_rows_that_repeat_id_and_score_are_drawn_one_by_one(spark):
    docs = [(1, "a b c " * 10)] * 40 + [(2, "d e f " * 10)] * 20
    ranks = [r[4] for r in drawn(spark, docs, ["a b"])]
    assert sorted(r for r in ranks if r) == [*range(1, 16)] and len(ranks) == 60


def test_no_rows_and_none_long_enough(spark):
    assert drawn(spark, [], ["a"]) == []
    assert drawn(spark, [(1, "a b"), (2, "")], ["a"]) == brute([(1, "a b"), (2, "")], ["a"])
