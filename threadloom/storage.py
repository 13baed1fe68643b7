"""Intermediate tables in the shared folder that the session names in spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, a local session gets a temporary one; elsewhere executors couldn't see it, so that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="threadloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Cuts the lineage: writes ``df`` to the shared folder and reads it back, so that it is computed once and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df``, dealt out to all cores where it is small and lies in fewer files than there are cores; for work that costs far more than moving its rows. Large inputs are as they were."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > 128_000_000 * cores or len(df.inputFiles()) >= cores:
        return df
    return df.repartition(cores)


UNSORTED = 200  # partitions up to which Spark deals rows out without sorting them first


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df``, of about so many rows, by ``keys`` in partitions of a million rows, or of up to four million where these would be more than ``UNSORTED``: tasks sort theirs in memory, however large the input. Spark puts small partitions together else, until sorts spill."""
    n = -(-rows // (1 << 20))
    if n > UNSORTED:
        n = max(UNSORTED, -(-rows // (1 << 22)))
    return df.repartition(max(n, df.sparkSession.sparkContext.defaultParallelism), *keys)
