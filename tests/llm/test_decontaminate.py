from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from threadloom.llm import decontaminate as dc


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_common_subsequence_equals_the_table():
    rnd = random.Random(1)
    for _ in range(300):
        a, b = ([rnd.randrange(6) for _ in range(rnd.randrange(1, 90))] for _ in range(2))
        assert dc.common_subsequence(dc.masks_of(np.array(a)), len(a), b) == longest(a, b)


def words(text):
    return [w for w in dc.plain(dc.split_words(pa.array([text], pa.string()))[0]).to_pylist() if w]


def brute(docs, items, share=0.6, answer=0.5, verbatim=0.8, least=8):
    """All items against all windows of 1.5 times their length."""
    out = set()
    for d, text in docs:
        t = words(text)
        for i, item in items:
            q = words(item)
            for at in range(0, max(1, len(t)), 4) if q else ():
                part = t[at : at + len(q) + len(q) // 2]
                s = longest(q, part) / len(q)
                if s == 1 or len(q) >= least and (s >= verbatim or s >= share and longest(q[-dc.ANSWER :], part) >= answer * min(len(q), dc.ANSWER)):
                    out.add((d, i))
                    break
    return out


def made(seed=1):
    rnd = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(600)]
    pick = lambda n: [rnd.choice(vocabulary[: rnd.choice([30, 600])]) for _ in range(n)]
    items = [(i, " ".join(pick(rnd.randrange(12, 60)))) for i in range(30)] + [(30, "zz yy xx"), (31, ""), (32, None)]
    docs = []
    for d in range(150):
        text = pick(rnd.randrange(20, 400))
        if d % 3 == 0:
            leak = items[rnd.randrange(30)][1].split()
            if d % 2:  # a paraphrase: some words change, some go
                leak = [w if rnd.random() > 0.12 else rnd.choice(vocabulary) for w in leak if rnd.random() > 0.08]
            at = rnd.randrange(len(text))
            text[at:at] = [w.capitalize() + rnd.choice(["", ",", "."]) for w in leak]
        docs.append((d, " ".join(text)))
    return docs + [(200, "a zz yy xx b"), (201, "a zz b yy"), (202, None), (203, ""), (None, items[0][1])], items


def test_finds_what_brute_force_finds(spark):
    docs, items = made()
    df, bench = spark.createDataFrame([(*d, 1) for d in docs], "doc_id bigint, text string, item int"), spark.createDataFrame(items, "item_id bigint, text string")
    want = brute(docs, items)
    for block in (2_000, 10):
        got = {(r.doc_id, r.item_id) for r in dc.contaminated(df, bench, block_items=block).collect()}
        assert len(want - got) <= 0.03 * len(want) and got <= want, (want - got, got - want)


def test_whole_test_table(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in dc.contaminated(docs, bench).collect()}
    rows, items = ([tuple(r) for r in t.collect()] for t in (docs.select("doc_id", "text"), bench.select("item_id", "text")))
    verbatim = {(d, i) for d, t in rows for i, q in items if q in t}
    assert len(verbatim) > 20 and verbatim <= got


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"), spark.createDataFrame([(1, "c d")], "item_id bigint, text string")
    assert dc.contaminated(docs, items.limit(0)).collect() == [] and dc.contaminated(docs.limit(0), items).collect() == [] and dc.contaminated(docs, items).collect() == []


def test_no_accepted_window_is_missed(spark):
    rnd = random.Random(5)
    vocabulary = ["w%d" % i for i in range(3000)]
    pick = lambda n: [rnd.choice(vocabulary[: rnd.choice([40, 3000])]) for _ in range(n)]
    items = [(i, " ".join(pick(rnd.randrange(9, 60)))) for i in range(40)] + [(40, "short item here"), (41, "the the the the the the the the the")]
    docs, planted = [], {}
    for rate in (0.0, 0.1, 0.2, 0.3, 0.35):
        for kind in ("dropped", "replaced"):
            for _ in range(30):
                d, (i, text) = len(docs), items[rnd.randrange(40)]
                kept = [w if rnd.random() >= rate else rnd.choice(vocabulary) if kind == "replaced" else None for w in text.split()]
                docs.append((d, " ".join([*pick(rnd.randrange(100)), *filter(None, kept), *pick(rnd.randrange(100))])))
                planted[d] = i, rate, kind
    docs += [(900, "a the b the " * 9), (901, " ".join(pick(15000) + items[3][1].split())), (902, "x short item here")]
    got = {(r.doc_id, r.item_id) for r in dc.contaminated(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()}

    def accepted(text, item):
        t, q = words(text), words(item)
        for at in range(len(t)):
            part = t[at : at + len(q) + len(q) // 2]
            s = longest(q, part) / len(q) if t[at] in q else 0
            if s >= 0.8 or s >= 0.6 and longest(q[-dc.ANSWER :], part) >= 0.5 * min(len(q), dc.ANSWER):
                return True
        return False

    want = {(d, i) for d, (i, _, _) in planted.items() if accepted(docs[d][1], items[i][1])}
    rates = {(r, k): [len(s & {(d, i) for d, (i, *x) in planted.items() if x == [r, k]}) for s in (want & got, want)] for _, r, k in planted.values()}
    assert want <= got and {(901, 3), (902, 40)} <= got, rates
