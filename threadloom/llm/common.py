"""What the training-data operators share: reading, shared storage, word arrays."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.storage import shared_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cuts the lineage: writes ``df`` to the shared folder and reads it back, so that a lost executor costs no recomputation.

    The shuffle files behind it, of no use any more, go as soon as it is written.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    made = spark.read.schema(df.schema).parquet(path)
    made.stored_at = path
    return made


def discard(*tables: DataFrame) -> None:
    """Deletes written tables that nothing reads any more."""
    for df in tables:
        drop_path(df.sparkSession, df.stored_at)


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def ascii_lower(column):
    return F.translate(column, UPPER, UPPER.lower())


_RESIDENT: dict = {}


def resident(key: tuple, make):
    """What ``make`` gives, kept for later tasks of this Python worker. A worker keeps one such object only: another operator's cache goes first."""
    if key not in _RESIDENT:
        _RESIDENT.clear()
        release_memory()
        _RESIDENT[key] = make()
    return _RESIDENT[key]


def release_memory() -> None:
    """Gives freed memory back to the system, since workers outlive tasks and stages."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


BATCHES, DEFAULT_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
BATCH_BYTES = 8_000_000


def bound_batches(df: DataFrame) -> DataFrame:
    """``df``; its session sends Python workers batches of BATCH_BYTES, unless it was told otherwise: both sides hold several copies of a batch."""
    conf = df.sparkSession.conf
    if conf.get(BATCHES, DEFAULT_BYTES) == DEFAULT_BYTES:
        conf.set(BATCHES, str(BATCH_BYTES))
    return df


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Cuts record batches so that each holds about ``most`` bytes of text at most (a longer single text stands alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(at, to - at)
            at = to
    release_memory()


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words between ASCII white space of all texts in one array, and each text's first word's place (with the end); null counts as empty."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = lists.flatten()
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not full.all():
        bounds = np.concatenate([[0], np.cumsum(full)])[bounds]
        flat = flat.filter(pa.array(full))
    return flat, bounds


MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 over an array."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= MIX1
    x ^= x >> np.uint64(27)
    x *= MIX2
    x ^= x >> np.uint64(31)
    return x


def raw(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The strings' bytes, and where each begins (with the end)."""
    _, places, data = strings.buffers()
    wide = np.int64 if pa.types.is_large_string(strings.type) or pa.types.is_large_binary(strings.type) else np.int32
    at = np.frombuffer(places, wide)[strings.offset : strings.offset + len(strings) + 1] if len(strings) else np.zeros(1, np.int32)
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8))[at[0] : at[-1]], at - at[0]


LONG_WORD = 65_536  # bytes; longer words are hashed one by one
BYTE_WEIGHTS = mix64(np.arange(1, LONG_WORD + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word (none empty): a sum of bytes weighted by place, mixed with the length."""
    if not len(words):
        return np.zeros(0, np.uint64)
    coded = words.dictionary_encode()
    data, at = raw(coded.dictionary)
    sizes = np.diff(at)
    place = np.arange(len(data), dtype=np.int64) - np.repeat(at[:-1], sizes)
    sums = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * BYTE_WEIGHTS[np.minimum(place, LONG_WORD - 1)], at[:-1])
    hashed = mix64(sums ^ (sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    for i in np.flatnonzero(sizes > LONG_WORD).tolist():
        import xxhash

        hashed[i] = xxhash.xxh3_64_intdigest(data[at[i] : at[i + 1]].tobytes())
    return hashed[coded.indices.to_numpy(zero_copy_only=False)]
