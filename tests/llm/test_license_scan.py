from __future__ import annotations

import re
import time

from threadloom.llm.license_scan import NOTICES, PHRASES, license_scan


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [(i, label) for phrase, label in PHRASES.items() for n in [len(phrase.split())] for i in range(len(words)) if words[i : i + n] == phrase.split()]
    labels, best = {x for _, x in places}, 1.0 if places else 0.0
    for label, notices in NOTICES.items():
        for notice in notices:
            plain = notice.replace("[", "").replace("]", "").split()
            before = notice[: notice.index("[")].split()
            must = range(len(before), len(before) + len(notice[notice.index("[") : notice.index("]")].split()))
            for at in range(-len(plain), len(words)):
                same = [0 <= at + i < len(words) and words[at + i] == w for i, w in enumerate(plain)]
                if all(same[i] for i in must) and sum(same) / len(plain) >= 0.8:
                    labels.add(label)
                    best = max(best, sum(same) / len(plain))
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})), ",".join(sorted(labels)), round(best, 9)


def got(spark, rows):
    df = spark.createDataFrame([(i, t, 0, "") for i, t in enumerate(rows)], "doc_id bigint, text string, w int, top string")
    return {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9)) for r in license_scan(df).collect()}


def test_equals_brute_force(spark):
    rows = [None, "", "...", "plain words only é中文", "Licensed under CC BY-NC 4.0.", "x ALL rights reserved y all RIGHTS, reserved.", "cc by cc by cc by", "This work is licensed under the GNU General Public License, version 3.", "general public", "the mit license", "Released under the MIT License."]
    rows += ["you may not use this document except in compliance with the Apache License today", "cc " * 3000 + "by", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation", "licence free text " * 50]
    rows += ["filler number %d" % i for i in range(300)]
    want = {i: brute(t) for i, t in enumerate(rows)}
    assert got(spark, rows) == want
    assert want[10][5] == "mit" and want[8][5] == ""


def test_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9)) for r in license_scan(docs).collect()}
    assert rows == {r.doc_id: brute(r.text) for r in docs.collect()}


def test_repeats_and_empty_table(spark):
    df = spark.createDataFrame([(None, "cc by"), (1, "cc by"), (1, "cc by")], "doc_id bigint, text string")
    assert license_scan(df).count() == 3 and license_scan(df.limit(0)).collect() == []


NOTICE = "This work is licensed under the GNU General Public License, version 3."


def test_notices_whatever_their_words_frequency(spark):
    everything = " ".join(x.replace("[", "").replace("]", "") + " and" for v in NOTICES.values() for x in v)
    in_a_third = [NOTICE if i % 3 == 0 else f"other text {i}" for i in range(60)]
    for rows in ([NOTICE], ["Released under the MIT License."] * 5, in_a_third, [everything], [everything, *in_a_third]):
        want = {i: brute(t) for i, t in enumerate(rows)}
        assert got(spark, rows) == want
        assert want[0][5] in {"gpl,gpl-family", "mit"} or set(NOTICES) <= set(want[0][5].split(","))


def test_long_texts_in_linear_time(spark):
    began = time.time()
    many = "cc by " * 32_000
    got_ = got(spark, [many])
    assert got_[0][:6] == (64_000, 32_000, 0, 63_998, "cc-by", "cc-by") and time.time() - began < 20
