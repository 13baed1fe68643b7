"""Substring dedup by hashing units of text: lines, cut into sentences.

Units are normalised (lower case, single spaces) and grouped by a 128-bit digest over
the whole corpus. The earliest occurrence in the order of id, row and place is
kept. All others are removed, neighbouring units as one run, with their offsets in the
original text. Sentences of few words are alike by chance, so ``least_piece`` may ask for
a run of so many words where a line isn't repeated as a whole; ``least_words`` is for
callers who want to keep short runs of any kind.

Digests are counted with partial sums before the shuffle; occurrences meet the
table of repeated digests in a join with one row a digest on one side, so that
adaptive execution may split a line that a third of all rows carry.

Defined results: null and empty texts have no units; rows without id come first in
the order; repeated rows are later occurrences of the first; ties of id follow the
rows' order in the input files; extra columns are dropped.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, materialize, slices

ENDS = {"sentence": re.compile(r"(?<=[.!?])\s+|\n+"), "line": re.compile(r"\n+"), "paragraph": re.compile(r"\n\s*\n")}


def units_of(text: str, unit: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, normalised text) of each unit that has words."""
    at = 0
    for m in ENDS[unit].finditer(text):
        if m.start() > at and (words := " ".join(text[at : m.start()].lower().split())):
            yield at, m.start(), words
        at = m.end()
    if at < len(text) and (words := " ".join(text[at:].lower().split())):
        yield at, len(text), words


def lines_of(text: str, found: list[tuple[int, int, str]]) -> list[int]:
    """Of each unit, where its line begins."""
    out, at, end = [], 0, -1
    for start, _, _ in found:
        if start > end:
            at = text.rfind("\n", 0, start) + 1
            end = text.find("\n", start)
            end = len(text) if end < 0 else end
        out.append(at)
    return out


def units(docs: DataFrame, unit: str = "sentence") -> DataFrame:
    """(id, row, idx, start, end, words, line, of_line, h, g): one row a unit; h and g are its digest. ``line`` is where its line begins, ``of_line`` how many units that has. ``docs`` has id, row and text."""
    names = ["id", "row", "idx", "start", "end", "words", "line", "of_line", "h", "g"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in slices(batches, "text"):
            made = []
            for i, row, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = [*units_of(text or "", unit)]
                lines = lines_of(text or "", found) if unit == "sentence" else [start for start, _, _ in found]
                count = Counter(lines)
                for idx, ((start, end, words), line) in enumerate(zip(found, lines, strict=True)):
                    d = xxhash.xxh3_128_intdigest(words)
                    made.append((i, row, idx, start, end, words.count(" ") + 1, line, count[line], (d >> 64) - 2**63, (d & (2**64 - 1)) - 2**63))
            for at in range(0, len(made), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*made[at : at + 50_000], strict=True)], names=names)

    return bound_batches(docs).select("id", "row", "text").mapInArrow(run, ", ".join(f"{c} bigint" for c in names))


def repeated_spans(docs: DataFrame, unit: str = "sentence", least_words: int = 1, least_piece: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, start, end, n_units, n_words, kept_id, kept_start): spans to remove, code points with the end exclusive, and where the earliest occurrence of the first unit stands."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))
    every = units(rows, unit)
    where = F.struct("id", "row", "idx", "start")
    again = materialize(every.groupBy("h", "g").agg(F.min(where).alias("first"), F.count("*").alias("n")).where("n > 1").select("h", "g", "first"), "repeats")
    later = every.join(again, ["h", "g"]).where(~(F.col("first.row").eqNullSafe(F.col("row")) & (F.col("first.idx") == F.col("idx"))))
    # Of one document's units, so bounded by its text.
    order = Window.partitionBy("row").orderBy("idx")
    if least_piece > 1:
        pieces = later.withColumn("run", F.col("idx") - F.row_number().over(order)).withColumn("piece", F.sum("words").over(Window.partitionBy("row", "run"))).withColumn("found", F.count("*").over(Window.partitionBy("row", "line")))
        later = pieces.where((F.col("found") == F.col("of_line")) | (F.col("piece") >= least_piece))
    runs = later.select("id", "row", "idx", "start", "end", "words", "first", (F.col("idx") - F.row_number().over(order)).alias("run"))
    spans = runs.groupBy("row", "run").agg(F.first("id").alias("id"), F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_units"), F.sum("words").alias("n_words"), F.min(F.struct("idx", "first")).alias("head"))
    return spans.where(F.col("n_words") >= least_words).select(F.col("id").alias(id_col), "row", "start", "end", "n_units", "n_words", F.col("head.first.id").alias("kept_id"), F.col("head.first.start").alias("kept_start"))


def without_repeats(docs: DataFrame, unit: str = "sentence", least_words: int = 1, least_piece: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, removed): each row's text without its repeated spans, and the spans with their original offsets."""
    rows = docs.select(F.col(id_col).alias(id_col), F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias(text_col))
    cut = repeated_spans(docs, unit, least_words, least_piece, id_col, text_col).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("removed"))
    zero = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def step(acc, x):
        return F.struct(x["end"].alias("at"), F.concat(acc["out"], F.substring(F.col(text_col), acc["at"].cast("int") + 1, (x["start"] - acc["at"]).cast("int"))).alias("out"))

    joined = rows.join(cut, "row", "left").withColumn("removed", F.coalesce("removed", zero))
    rest = F.aggregate("removed", F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.substring(F.col(text_col), acc["at"].cast("int") + 1, F.char_length(text_col))))
    return joined.select(id_col, rest.alias(text_col), "removed")
