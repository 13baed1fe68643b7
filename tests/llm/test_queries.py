"""Queries over a whole test table against plain loops."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from threadloom.llm.line_dedup import units_of
from threadloom.llm.queries import op6_bpe, op7_repeats, op8_rans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def encoded(texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return library, {d: library.encode(t, add_special_tokens=False).ids for d, t in texts.items()}


def test_op6(spark, encoded):
    library, ids = encoded
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = {(d, len(i), sha(" ".join(map(str, i))), sha(library.decode(i, skip_special_tokens=False))) for d, i in ids.items()}
    assert {tuple(r) for r in op6_bpe(spark, SF).collect()} == want


def test_op8(spark, encoded):
    want, at = set(), 0
    for d, i in sorted(encoded[1].items()):
        want.add((d, at, len(i) + 1, zlib.crc32(np.array([*i, 1], "<u4").tobytes())))
        at += len(i) + 1
    assert {tuple(r) for r in op8_rans(spark, SF).collect()} == want


def test_op7(spark, texts):
    """Later occurrences of sentences that make up a whole line, or stand in a run of twenty words."""
    first, want = {}, set()
    for d in sorted(texts):
        units = [*units_of(texts[d], "sentence")]
        again = []
        for start, _, words in units:
            again.append(words in first)
            first.setdefault(words, (d, start))
        lines = [texts[d].count("\n", 0, start) for start, _, _ in units]
        for i, (start, end, _) in enumerate(units):
            lo = hi = i
            while again[i] and lo and again[lo - 1]:
                lo -= 1
            while again[i] and hi + 1 < len(units) and again[hi + 1]:
                hi += 1
            whole = all(a for a, line in zip(again, lines, strict=True) if line == lines[i])
            if again[i] and (whole or sum(len(u[2].split()) for u in units[lo : hi + 1]) >= 20):
                want |= {(d, start), (d, end - 1)}
    covered = {(r.doc_id, p) for r in op7_repeats(spark, SF).collect() for p in range(r.start, r.end)}
    starts = {(d, s) for d in texts for s, e, _ in units_of(texts[d], "sentence")} | {(d, e - 1) for d in texts for _, e, _ in units_of(texts[d], "sentence")}
    assert want and covered & starts == want
