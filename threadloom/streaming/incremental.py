"""Incremental merging as a stream of files into a bucketed table: of equal keys the first in scan order stays.

Batches come in order; within one, files go by name and rows by their place in the file.
A key belongs to a bucket by its hash, and a batch reads the buckets of its own keys
alone, their key column only. The table's commit log names the batch that each commit
holds, so a batch that is replayed after a failure changes nothing, and a commit is
there as a whole or not at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from threadloom.sources.commits import CommitLog
from threadloom.storage import stored

BUCKET, ORDER = "_bucket", "_order"


def table(spark: SparkSession, target: str, schema: str | StructType) -> CommitLog:
    fields = spark.createDataFrame([], schema).schema.fields
    return CommitLog(spark, target, StructType([*fields, StructField(BUCKET, IntegerType())]), BUCKET)


def read_target(spark: SparkSession, target: str, schema: str | StructType) -> DataFrame:
    """What has been merged."""
    return table(spark, target, schema).read().drop(BUCKET)


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def scan_order() -> Column:
    """The piece of a file that a row of a stream of files comes from: its name, then where it begins."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def merge_batch(log: CommitLog, key: str, buckets: int = 256, writer: str = "stream"):
    """For foreachBatch: commits the rows, first by the column ``ORDER`` and then by their place in the batch, whose keys the table hasn't yet. Rows without key are no messages and are left out."""

    def run(batch: DataFrame, number: int) -> None:
        rest = [c for c in batch.columns if c not in (key, ORDER)]
        # Within a piece of a file rows are numbered as they stand; a stream can't do that, a batch can.
        placed = batch.where(F.col(key).isNotNull()).withColumn(ORDER, F.struct(ORDER, F.monotonically_increasing_id()))
        first = placed.groupBy(key).agg(F.min_by(F.struct(*rest), F.col(ORDER)).alias("row"))
        # Written once: which buckets there are and what is new ask for it, and a lost race asks again.
        rows = stored(first.select(key, *(F.col("row").getField(c).alias(c) for c in rest), bucket_of(key, buckets).alias(BUCKET)), "batch")
        touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]  # ``buckets`` at most

        def fresh(known: DataFrame) -> DataFrame:
            return rows.join(known.where(F.col(BUCKET).isin(touched)).select(BUCKET, key), [BUCKET, key], "left_anti").repartition(BUCKET)

        log.append(fresh, writer, number)

    return run


def ingest_stream(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, key: str = "source_record_id", buckets: int = 256):
    """Reads all files of ``source`` that are new since the last run, and stops. The checkpoint's folder names the stream, so one table may be fed by several."""
    stream = spark.readStream.schema(schema).json(source).withColumn(ORDER, scan_order())
    run = merge_batch(table(spark, target, schema), key, buckets, writer=checkpoint)
    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
