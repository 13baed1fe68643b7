"""Importance resampling: draws documents whose word n-grams look like a target's.

Features are runs of 1 to ``longest`` consecutive words; each has a bucket, the crc32 of
its bytes modulo ``buckets``. A bucket's gain is the logarithm of how much more
frequent it is in the target than in the corpus; a document's weight is its features'
mean gain, and noise of a fixed seed makes the largest scores a sample without
replacement. Gains are one array of ``buckets`` numbers, all that the driver and the tasks
hold of the counts. Which documents are drawn follows from the exact k-th key of
(score, id), found by radix selection; only drawn rows are sorted.

A feature's crc32 is put together from its words' (each distinct one of a slice is
hashed once), as the crc of joined strings is a linear function of theirs.

Defined results: a null or empty text has no features and the weight 0; an empty
target or corpus gives gains from the added ones alone; rows without id take part, their
noise that of an empty id, and lose ties; rows that repeat id and score are told apart
by a number of their own, so that as many are drawn as the share asks for; extra
columns take no part; no rows give no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, materialize, raw, slices, split_words
from .ordering import at_most, numbered, radix_select

LONG_WORD = 48  # bytes; longer words' crc32 is continued byte by byte


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


BYTE = _byte_table()


def _shift_tables() -> np.ndarray:
    """[n, j, v]: what n zero bytes make of a remainder whose j-th byte is v and whose others are 0."""
    out = np.zeros((LONG_WORD + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(LONG_WORD):
        out[n + 1] = (out[n] >> 8) ^ BYTE[out[n] & 255]
    return out


SHIFT = _shift_tables()


def _classes() -> np.ndarray:
    """Each byte as it counts in words: A-Z in lower case, other ASCII but digits and letters as a space."""
    table = np.arange(256, dtype=np.uint8)
    table[:128] = 32
    for first, last, low in (("0", "9", "0"), ("a", "z", "a"), ("A", "Z", "a")):
        span = np.arange(ord(first), ord(last) + 1)
        table[span] = span - ord(first) + ord(low)
    return table


CLASSES = _classes()


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts in one array, and each text's first word's place (with the end)."""
    data, at = raw(pc.fill_null(texts, "").cast(pa.large_string()))
    plain = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(CLASSES[data].tobytes()))
    return split_words(plain)


def spaced(crc: np.ndarray) -> np.ndarray:
    """crc32 of each string with a space behind it."""
    inner = ~crc
    return ~((inner >> np.uint32(8)) ^ BYTE[(inner ^ np.uint32(32)) & np.uint32(255)])


def features(texts: pa.Array, longest: int = 2, buckets: int = 10_000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each feature, text it belongs to, words of each text); features of one word first, then of two, and so on."""
    words, bounds = words_of(texts)
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    if not len(words):
        return np.zeros(0, np.int64), owner, sizes
    coded = words.dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    kinds = [k.encode() for k in coded.dictionary.to_pylist()]
    crcs, lengths = np.array([zlib.crc32(k) for k in kinds], np.uint32), np.array([len(k) for k in kinds])
    crc, length = crcs[code], lengths[code]
    made, owners, grams = [crc], [owner], crc
    for n in range(2, longest + 1):
        # Runs of n words that begin at each place, where they stay within the text.
        head, tail = spaced(grams[:-1]), crc[n - 1 :]
        size = np.minimum(length[n - 1 :], LONG_WORD)
        grams = tail.copy()
        for j in range(4):
            grams ^= SHIFT[size, j, (head >> np.uint32(8 * j)) & np.uint32(255)]
        for i in np.flatnonzero(length[n - 1 :] > LONG_WORD).tolist():
            grams[i] = zlib.crc32(kinds[code[i + n - 1]], int(head[i]))
        inside = owner[: len(grams)] == owner[n - 1 :]
        made.append(grams[inside])
        owners.append(owner[: len(grams)][inside])
    return (np.concatenate(made) % np.uint32(buckets)).astype(np.int64), np.concatenate(owners), sizes


def bucket_counts(texts: DataFrame, text_col: str = "text", longest: int = 2, buckets: int = 10_000) -> np.ndarray:
    """How many features of all texts each bucket holds. Tasks add up theirs, so a common feature is a number a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches, text_col):
            total += np.bincount(features(batch.column(0), longest, buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    found = bound_batches(texts).select(text_col).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, np.int64)
    for row in found.collect():  # a row a bucket at most
        counts[row["bucket"]] = row["n"]
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(((t + 1) / (T + buckets)) / ((s + 1) / (S + buckets)))) of each bucket."""
    all_s, all_t, n = float(corpus.sum()), float(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (all_s + n) / ((float(s) + 1) * (all_t + n)))) for s, t in zip(corpus, target, strict=True)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", longest: int = 2) -> DataFrame:
    """(id, n_words, n_features, weight): the floored mean gain of each row's features."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            bucket, owner, n_words = features(batch.column(1), longest, len(gain))
            n = np.bincount(owner, minlength=len(n_words))
            # Whole numbers that add up exactly in doubles.
            total = np.bincount(owner, weights=gain[bucket].astype(np.float64), minlength=len(n_words)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c.astype(np.int64)) for c in (n_words, n, total // np.maximum(n, 1)))], names=["id", "n_words", "n_features", "weight"])

    return bound_batches(docs).select(id_col, text_col).mapInArrow(run, f"id {kind}, n_words bigint, n_features bigint, weight bigint")


def noise(id_, seed: int):
    """Gumbel noise of an id in thousandths, from the first 32 bits of its digest."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, longest: int = 2, buckets: int = 10_000, seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_features, weight, score, rank): each row's score, and its rank (from 1) among the ``percent`` of rows with ``least_words`` words that are drawn; else null."""
    gain = gains(bucket_counts(docs, text_col, longest, buckets), bucket_counts(target, text_col, longest, buckets))
    weighed = weigh(docs, gain, id_col, text_col, longest)
    scored = materialize(weighed.withColumn("score", F.col("weight") + noise(F.col("id"), seed)).withColumn("own", F.monotonically_increasing_id()), "scored")
    enough = scored.where(F.col("n_words") >= least_words)
    # Larger scores first; rows without id after all others of their score.
    columns = ["down", "unnamed", "by_id", "own"]
    keyed = lambda df: df.withColumns({"down": -F.col("score"), "unnamed": F.col("id").isNull().cast("int"), "by_id": F.coalesce(F.col("id"), F.lit(0))})
    bound = radix_select(keyed(enough), columns, percent * enough.count() // 100)
    if bound is None:
        return scored.select(F.col("id").alias(id_col), "n_features", "weight", "score", F.lit(None).cast("bigint").alias("rank"))
    drawn = (F.col("n_words") >= least_words) & at_most(columns, bound)
    marked = keyed(scored).withColumn("drawn", drawn)
    ranked = numbered(marked.where("drawn"), [F.col(c).asc() for c in columns], name="rank")
    rest = marked.where("NOT drawn").withColumn("rank", F.lit(None).cast("bigint"))
    both = ranked.withColumn("rank", (F.col("rank") + 1).cast("bigint")).unionByName(rest)
    return both.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
