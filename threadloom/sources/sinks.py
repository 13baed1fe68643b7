"""Sinks: staged writes that are checked before they replace anything, JSON lines, notes."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions import text as T
from threadloom.operators.ordering import numbered


class SinkError(RuntimeError):
    """A write was refused; what was there before is unchanged."""


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def staged_write(df: DataFrame, path: str, check: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Writes beside ``path``, reads it back, and puts it in place if ``check`` returns no row; else SinkError."""
    spark, staging = df.sparkSession, f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    fs, target = _fs(spark, path)
    _, source = _fs(spark, staging)
    _, old = _fs(spark, f"{staging}.old")
    try:
        df.write.parquet(staging)
        if check is not None:
            bad = check(spark.read.parquet(staging)).limit(5).collect()
            if bad:
                raise SinkError(f"refused: {bad}")
        # What was there steps aside until the new table stands, and comes back if it can't.
        aside = fs.exists(target)
        if aside and not fs.rename(target, old):
            raise SinkError(f"{path} can't be moved aside")
        moved = False
        try:
            moved = fs.rename(source, target)
        finally:
            if not moved and aside:
                fs.rename(old, target)
        if not moved:
            raise SinkError(f"{staging} can't be moved to {path}")
        fs.delete(old, True)
    finally:
        fs.delete(source, True)


def json_lines(df: DataFrame, path: str, order: list[str]) -> None:
    """Deterministic JSON lines: keys by name, rows by ``order``; one file a range of rows, in order."""
    columns = sorted(df.columns)
    df.orderBy(*order).select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def replace_own(rows: DataFrame, path: str, owner: str) -> None:
    """Replaces a store by rows that carry their owner; one with rows of another owner is refused."""
    fs, target = _fs(rows.sparkSession, path)
    if fs.exists(target):
        kept = rows.sparkSession.read.parquet(path)
        if "extraction_owner" not in kept.columns or not kept.where(~F.col("extraction_owner").eqNullSafe(F.lit(owner))).isEmpty():
            raise SinkError("the store has rows of another owner")
    staged_write(rows.withColumn("extraction_owner", F.lit(owner)), path)


MARKER = "extraction_generated: true"


def candidate_notes(records: DataFrame, submitter: str = "threadloom.extraction") -> DataFrame:
    """(name, text) of the note that proposes each record."""
    fields = {
        "extraction_generated": F.lit("true"), "candidate_type": F.lit("NEW"), "proposed_operation": F.lit("CREATE"), "proposed_knowledge_id": F.col("knowledge_id"), "base_canonical_revision": F.col("revision").cast("string"),
        "submitter": F.lit(submitter), "provenance_refs": F.array_join("evidence_ids", ", "),
    }
    lines = [F.concat(F.lit(f"{k}: "), v if k in ("extraction_generated", "base_canonical_revision") else T.yaml_value(v, escaped=True)) for k, v in fields.items()]
    proofs = F.array_join(F.transform("evidence_ids", lambda x: F.concat(F.lit("- "), x)), "\n")
    text = F.concat_ws("\n", F.lit("---"), *lines, F.lit("---"), F.lit(""), F.concat(F.lit("# "), "title"), F.lit(""), F.coalesce("summary", F.lit("")), F.lit(""), F.lit("## Candidate Canonical Content"), F.lit(""), F.col("content"), F.lit(""), F.lit("## Provenance"), F.lit(""), proofs, F.lit(""))
    return records.select(F.concat("knowledge_id", F.lit(".md")).alias("name"), text.alias("text"))


def write_notes(notes: DataFrame, folder: str, owned: str = MARKER, force: bool = False) -> int:
    """Writes each note (name, text) as a file of ``folder``; how many changed. A file that isn't ours (``owned`` isn't in its front matter) is refused before any is written.

    Notes are for people, so few: they go through the driver one by one, each under
    another name first.
    """
    spark = notes.sparkSession
    jvm, written = spark._jvm, 0
    root = jvm.org.apache.hadoop.fs.Path(folder)
    # An instance of its own without checksum files, as people change notes by other means.
    fs = jvm.org.apache.hadoop.fs.FileSystem.newInstance(root.toUri(), spark._jsc.hadoopConfiguration())
    fs.setVerifyChecksum(False)
    fs.setWriteChecksum(False)
    fs.mkdirs(root)

    def read(path) -> str | None:
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def path_of(name: str):
        if "/" in name or name.startswith("."):
            raise SinkError(f"{name} leaves the folder")
        return jvm.org.apache.hadoop.fs.Path(root, name)

    for row in notes.select("name").toLocalIterator():
        before = read(path_of(row.name))
        if before is not None and not force and (not before.startswith("---") or owned not in before.split("---", 2)[1]):
            raise SinkError(f"{row.name} isn't a generated note")
    for row in notes.toLocalIterator():
        path = path_of(row.name)
        if read(path) == row.text:
            continue
        staged = jvm.org.apache.hadoop.fs.Path(root, f".{row.name}.{uuid.uuid4().hex}")
        out = fs.create(staged, True)
        try:
            out.write(bytearray(row.text.encode()))
            out.hsync()
        finally:
            out.close()
        fs.delete(path, False)
        if not fs.rename(staged, path):
            raise SinkError(f"{row.name} can't be put in place")
        written += 1
    return written


def with_numbers(rows: DataFrame, prefix: str, order: list[str], digits: int = 6) -> DataFrame:
    """Counters such as rh_000001 in a total order."""
    made = numbered(rows, [F.col(c).asc() for c in order], name="_i")
    return made.withColumn("number", F.concat(F.lit(prefix), F.lpad((F.col("_i") + 1).cast("string"), digits, "0"))).drop("_i")
