"""Fingerprints of documents by their Lempel-Ziv phrases.

A text is parsed from its start: the next phrase is the shortest run of characters
that isn't in the dictionary yet, and goes into it. Texts that share long passages
share phrases, as one compresses well with the other's dictionary. The phrases'
hashes make a set, whose ``SIZE`` least ones are the fingerprint (in base64); the share
of common ones among the least of both estimates the sets' Jaccard similarity.

Defined results: a null text counts as an empty one, whose fingerprint is the empty
string; two empty fingerprints are alike (1), an empty one is like no other (0); equal
texts have equal fingerprints; sets smaller than ``SIZE`` are compared exactly.
Neighbours: rows stand in descending order of their keys, rows without key last, rows
that repeat a key in the order of their texts' hashes; the last one's next is the
first, and a single row is its own next. Extra columns take no part. A text is parsed
whole in one task, whose memory grows with the longest text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import bound_batches, slices, word_hashes

SIZE = 128


def parse(text: str, seen: set[str], begun: str = "") -> tuple[list[str], str]:
    """New phrases of ``text`` after a parse that knows ``seen`` (phrases are added) and stopped inside the phrase ``begun``; and where this one stops."""
    made, phrase = [], begun
    for c in text:
        phrase += c
        if phrase not in seen:
            seen.add(phrase)
            made.append(phrase)
            phrase = ""
    return made, phrase


def common_start(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def phrase_sets(texts: list[str]) -> list[list[str]]:
    """Phrases of each of a row's texts. The first one's beginning that another shares is parsed once."""
    first, out = texts[0], []
    shared = [common_start(first, t) for t in texts[1:]]
    seen: set[str] = set()
    pieces, marks, at, begun = [], {}, 0, ""
    for stop in sorted({*shared, len(first)}):
        more, begun = parse(first[at:stop], seen, begun)
        pieces += more
        at = stop
        marks[stop] = len(pieces), begun
    out.append(pieces)
    for text, stop in zip(texts[1:], shared, strict=True):
        known, begun = marks[stop]
        later = pieces[known:]
        seen.difference_update(later)
        more, _ = parse(text[stop:], seen, begun)
        seen.difference_update(more)
        seen.update(later)
        out.append(pieces[:known] + more)
    return out


def fingerprints(sets: list[list[str]], size: int = SIZE) -> list[str]:
    """Each phrase set's least hashes, as text."""
    flat = pa.array([p for s in sets for p in s], pa.string())
    hashes = (word_hashes(flat) >> np.uint64(32)).astype(">u4")
    out, at = [], 0
    for s in sets:
        out.append(base64.b64encode(np.unique(hashes[at : at + len(s)])[:size].tobytes()).decode())
        at += len(s)
    return out


def likeness(a: str, b: str, size: int = SIZE) -> float:
    """Estimated Jaccard similarity of the sets behind two fingerprints."""
    if not a or not b:
        return float(a == b)
    x, y = (np.frombuffer(base64.b64decode(f), ">u4") for f in (a, b))
    least = np.union1d(x, y)[:size]
    return float(np.isin(least, np.intersect1d(x, y)).sum() / len(least))


def lz_fingerprints(docs: DataFrame, texts: dict[str, str], size: int = SIZE) -> DataFrame:
    """``docs`` with a fingerprint column (value; in place of one of that name) for each text column (key); texts of one row that begin alike are parsed once so far."""
    names = [*texts]
    docs = docs.drop(*texts.values())
    schema = StructType([*docs.schema.fields, *(StructField(c, StringType()) for c in texts.values())])
    places = [docs.columns.index(c) for c in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, names[0]):
            rows = zip(*(batch.column(p).to_pylist() for p in places), strict=True)
            sets = [s for row in rows for s in phrase_sets([t or "" for t in row])]
            made = fingerprints(sets, size)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(made[i :: len(names)], pa.string()) for i in range(len(names)))], names=[*batch.schema.names, *texts.values()])

    return bound_batches(docs).mapInArrow(run, schema)


def edited(text: str, other: str) -> str:
    """``text`` with its last half replaced by as much of ``other``'s beginning."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


RESULT = {"n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"}


def beside(pairs: list[tuple[str, str]], size: int = SIZE) -> list[dict]:
    """For each text and its next one all of RESULT but near_next."""
    changed = [edited(text, other) for text, other in pairs]
    prints = fingerprints([s for (text, _), new in zip(pairs, changed, strict=True) for s in phrase_sets([text, new])], size)
    return [
        {"n_chars": len(text), "edited_sha256": hashlib.sha256(new.encode()).hexdigest(), "fingerprint": a, "edited_fingerprint": b, "near_edited": likeness(a, b, size)}
        for (text, _), new, a, b in zip(pairs, changed, prints[::2], prints[1::2], strict=True)
    ]


def neighbours(docs: DataFrame, key: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next): each text beside its edited form and the next text in descending order of keys.

    Texts are cut into sorted ranges, and each task walks along its range. What follows a
    range's last row only the next range knows: the rows at the ranges' ends, two a range,
    come from the same shuffle and are joined.
    """
    kind = docs.schema[key].dataType
    rows = bound_batches(docs).select(F.col(key).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.col("key").desc_nulls_last(), F.xxhash64("text").asc()]
    # A number of ranges of its own, so that both readers of the shuffle see the same ones.
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.rdd.getNumPartitions())
    ranges = rows.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id())
    fields = {"key": kind.simpleString(), **RESULT}
    schema = ", ".join(f"{c} {t}" for c, t in fields.items())

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far, whose next text isn't known
        waiting = None  # the record before it, which lacks near_next
        as_arrow = None
        for batch in slices(batches, "text"):
            as_arrow = as_arrow or pa.schema([batch.schema.field("key"), *((c, {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}[t]) for c, t in RESULT.items())])
            seen = [*zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            if held is not None:
                seen.insert(0, held)
            out = []
            for (k, _), found in zip(seen, beside([(a[1], b[1]) for a, b in zip(seen, seen[1:], strict=False)], size), strict=False):
                if waiting is not None:
                    out.append({**waiting, "near_next": likeness(waiting["fingerprint"], found["fingerprint"], size)})
                waiting = {"key": k, **found}
            held = seen[-1]
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=as_arrow)
        if waiting is not None:
            last = fingerprints(phrase_sets([held[1]]), size)[0]
            yield pa.RecordBatch.from_pylist([{**waiting, "near_next": likeness(waiting["fingerprint"], last, size)}], schema=as_arrow)

    def join_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "last"):
            texts, nexts = (batch.column(c).to_pylist() for c in (1, 2))
            found = beside([*zip(texts, nexts, strict=True)], size)
            for record, other in zip(found, fingerprints([phrase_sets([t])[0] for t in nexts], size), strict=True):
                record["near_next"] = likeness(record["fingerprint"], other, size)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[c] for r in found]) for c in RESULT)], names=["key", *RESULT])

    walked = ranges.sortWithinPartitions(*order).select("key", "text").mapInArrow(walk, schema)
    # The order's largest is the first: null keys are the least, and equal keys go by the hash turned round.
    place = F.struct("key", F.bitwise_not(F.xxhash64("text")))
    ends = ranges.groupBy("part").agg(F.max_by("text", place).alias("first"), F.min_by(F.struct("key", "text"), place).alias("last"))
    parts = ends.select("part", F.lead("part").over(Window.orderBy("part")).alias("next"), F.min("part").over(Window.partitionBy()).alias("least"))  # a row a range
    follows = parts.select("part", F.coalesce("next", "least").alias("next"))
    firsts = ends.select(F.col("part").alias("next"), F.col("first").alias("other"))
    met = ends.join(follows, "part").join(firsts, "next").select("last.key", F.col("last.text").alias("last"), "other")
    return walked.unionByName(met.mapInArrow(join_ends, schema)).withColumnRenamed("key", key)
