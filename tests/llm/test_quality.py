from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa

from threadloom.llm import quality


def test_gradients_equal_differences():
    rnd = np.random.default_rng(0)
    firsts = np.array([0, 1, 4, 9])
    x, y = rnd.normal(size=(9, quality.FEATURES)), np.array([1.0, 0.0, 1.0])
    model = quality.fit(x, firsts, y, steps=3)
    loss = lambda: -np.mean(y * np.log(model.forward(x, firsts)["p"]) + (1 - y) * np.log(1 - model.forward(x, firsts)["p"]))
    grads = model.gradients(model.forward(x, firsts), y, firsts[:-1])
    for k, g in grads.items():
        for at in [*np.ndindex(g.shape)][:5]:
            kept = model.w[k][at]
            model.w[k][at] = kept + 1e-6
            up = loss()
            model.w[k][at] = kept - 1e-6
            down = loss()
            model.w[k][at] = kept
            assert abs((up - down) / 2e-6 - g[at]) < 1e-6, k


def test_passages_of_one_text_don_t_depend_on_others():
    texts = ["a b c a a b", None, "", "X!! Y!! " * 100, "é | è | 12"]
    x, firsts = quality.passages(pa.array(texts))
    assert np.diff(firsts).tolist() == [1, 1, 1, 4, 1]
    for i, t in enumerate(texts):
        alone, _ = quality.passages(pa.array([t], pa.string()))
        assert np.allclose(alone, x[firsts[i] : firsts[i + 1]])


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F

    model = quality.train(docs, labels, learnable=~quality.held_out(F.col("id")))
    rows = quality.score(docs.select("doc_id", "text"), model).join(labels, "doc_id").where(quality.held_out(F.col("doc_id"))).select("doc_id", "score", "quality").collect()
    assert len(rows) > 500 and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    right = np.mean([(r.score >= 0.3) == (r.quality == 1) for r in rows])
    kept = np.mean([r.score >= 0.3 for r in rows if r.quality == 1])
    print("held-out accuracy", right, "clean kept", kept)
    assert right > 0.95 and kept > 0.97


def test_nulls_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (1, "a b", 0.5), (None, "", None), (2, "X!! " * 50, 0.1)], "doc_id bigint, text string, y double")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id bigint, quality int")
    got = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    empty = quality.train(docs, labels.limit(0))
    assert quality.score(docs.limit(0), empty).collect() == [] and len(quality.score(docs, empty).collect()) == 4


def test_repeated_ids_long_texts_and_a_column_of_the_scores_name(spark):
    docs = spark.createDataFrame([(1, "good clean words " * 50, 9.0), (2, "BAD $$$ | " * 50, 9.0), *[(1, "good clean words " * 50, 9.0)] * 50, (1, "word " * 100_000, None), (None, None, None)], "doc_id bigint, text string, score double")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (2, None)], "doc_id bigint, quality int")
    model = quality.train(docs, labels)
    rows = quality.score(docs, model).collect()
    assert len(rows) == 54 and rows[0].__fields__ == ["doc_id", "text", "score"] and all(0 <= r.score <= 1 for r in rows)
    kept = quality.score(docs, model, score_col="other").collect()
    assert [r.other for r in kept] == [r.score for r in rows] and kept[0].score == 9.0


def test_scores_equal_plain_loops():
    """The query's score of a text, word by word and passage by passage."""
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(7, quality.FEATURES))
    model = quality.fit(x, np.array([0, 3, 4, 7]), np.array([1.0, 0.0, 1.0]), steps=5)
    w = model.w
    for lo, hi in ((0, 3), (3, 4), (4, 7)):
        weights, hidden = [], []
        for row in x[lo:hi]:
            h = [np.tanh(sum((row[f] - model.mean[f]) / model.scale[f] * w["W"][f, j] for f in range(quality.FEATURES)) + w["b"][j]) for j in range(len(w["b"]))]
            gate = [np.tanh(sum(h[j] * w["V"][j, a] for j in range(len(h)))) / (1 + np.exp(-sum(h[j] * w["U"][j, a] for j in range(len(h))))) for a in range(len(w["w"]))]
            weights.append(np.exp(sum(g * c for g, c in zip(gate, w["w"], strict=True))))
            hidden.append(h)
        z = [sum(a * h[j] for a, h in zip(weights, hidden, strict=True)) / sum(weights) for j in range(len(w["b"]))]
        p = 1 / (1 + np.exp(-(sum(c * v for c, v in zip(w["c"], z, strict=True)) + w["d"][0])))
        assert np.isclose(model.forward(x[lo:hi], np.array([0, hi - lo]))["p"][0], p)
