from __future__ import annotations

import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from threadloom.llm.lz_fingerprint import SIZE, common_start, edited, likeness, lz_fingerprints, neighbours, phrase_sets
from threadloom.llm.queries import op12_fingerprint

SF = "/root/testdata/sf0.001"
MASK = 2**64 - 1


def mix(x):
    x &= MASK
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def phrases(text):
    """By slices of growing length, as in the definition."""
    seen, at, end = set(), 0, 1
    while end <= len(text):
        if text[at:end] not in seen:
            seen.add(text[at:end])
            at = end
        end += 1
    return seen


def fingerprint(text):
    hashes = set()
    for p in phrases(text):
        data = p.encode()
        total = sum((b + 1) * mix((i + 1) * 0xD6E8FEB86659FD93) for i, b in enumerate(data))
        hashes.add(mix(total & MASK ^ len(data) * 0x9E3779B97F4A7C15 & MASK) >> 32)
    return base64.b64encode(b"".join(h.to_bytes(4, "big") for h in sorted(hashes)[:SIZE])).decode()


def near(a, b):
    if not a or not b:
        return float(a == b)
    x, y = ({base64.b64decode(f)[i : i + 4] for i in range(0, len(base64.b64decode(f)), 4)} for f in (a, b))
    least = sorted(x | y)[:SIZE]
    return sum(h in x and h in y for h in least) / len(least)


def brute(ordered):
    """Of (key, text) in the order of neighbours."""
    out = []
    for i, (key, text) in enumerate(ordered):
        other = ordered[(i + 1) % len(ordered)][1]
        half = len(text) // 2
        new = text[: len(text) - half] + other[:half]
        a, b = fingerprint(text), fingerprint(new)
        out.append((key, len(text), hashlib.sha256(new.encode()).hexdigest(), a, b, near(a, b), near(a, fingerprint(other))))
    return sorted(out, key=str)


def test_query_over_the_test_table(spark):
    rows = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()), reverse=True)
    got = [tuple(r) for r in op12_fingerprint(spark, SF).collect()]
    assert sorted(got, key=str) == brute(rows)
    assert sum(r[5] > r[6] for r in got) > 0.9 * len(got)


def test_likeness_estimates_the_sets_similarity():
    rnd = random.Random(1)
    words = ["".join(rnd.choices("abcdefghij", k=rnd.randint(2, 8))) for _ in range(400)]
    gaps = []
    for _ in range(30):
        a = " ".join(rnd.choices(words, k=600))
        b = edited(a, " ".join(rnd.choices(words, k=600)))
        x, y = phrases(a), phrases(b)
        gaps.append(likeness(fingerprint(a), fingerprint(b)) - len(x & y) / len(x | y))
    assert abs(sum(gaps)) / len(gaps) < 0.03 and max(map(abs, gaps)) < 0.2


@pytest.mark.parametrize("texts", [["abcabcabc", "abcabcxyz", "", "abcabcabc"], ["", "a"], ["a" * 50, "a" * 30, "a" * 80], ["xyz", "abc"]])
def test_shared_beginnings_are_parsed_alike(texts):
    assert [set(s) for s in phrase_sets(texts)] == [phrases(t) for t in texts]
    assert all(len(s) == len(set(s)) for s in phrase_sets(texts))


def test_common_start():
    rnd = random.Random(2)
    for _ in range(200):
        a, b = ("".join(rnd.choices("ab", k=rnd.randint(0, 9))) for _ in range(2))
        assert common_start(a, b) == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def test_nulls_repeats_ends_and_long_texts(spark):
    rows = [(i, f"text number {i % 7} " * (i % 5)) for i in range(40)] + [(3, None), (3, "other"), (None, "no id"), (None, None), (40, "long text " * 40_000), (41, "日本語 é" * 30)]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id bigint, text string, part int, first string").repartition(5)
    got = [tuple(r) for r in neighbours(df).collect()]
    texts = [(k, t or "") for k, t in rows]
    ties = {r.text: r.h for r in spark.createDataFrame([(t,) for _, t in texts], "text string").select("text", F.xxhash64("text").alias("h")).collect()}
    ordered = sorted(texts, key=lambda r: (r[0] is None, -(r[0] or 0), ties[r[1]]))
    assert sorted(got, key=str) == brute(ordered)


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(1, "abcd")], "doc_id bigint, text string")
    assert [tuple(r) for r in neighbours(one).collect()] == brute([(1, "abcd")])
    assert neighbours(one.limit(0)).collect() == []
    assert [tuple(r) for r in neighbours(one.withColumn("text", F.lit(None).cast("string"))).collect()] == brute([(1, "")])


def test_several_columns_and_equal_texts(spark):
    df = spark.createDataFrame([(1, "abcabc", None), (2, "abcabc", "abcabc"), (3, "", "x" * 100)], "i int, a string, b string").withColumn("fa", F.lit("old"))
    rows = lz_fingerprints(df, {"a": "fa", "b": "fb"}).orderBy("i").collect()
    assert rows[0].fa == rows[1].fa == rows[1].fb == fingerprint("abcabc") and rows[0].fb == rows[2].fa == "" and rows[2].fb == fingerprint("x" * 100)
