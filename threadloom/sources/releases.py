"""Frozen releases: numbered, read-only, told apart by a hash tree over their rows.

A row's digest is the SHA-256 of its canonical JSON: keys by name, nothing between
them, characters beyond ASCII escaped. Rows in the order of their key lie in chunks of
``CHUNK``; a chunk's digest is that of its rows' digests, and a tree over the chunks' gives
the root. So one changed row shows in its chunk, and no task holds more than a chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from threadloom.functions import text as T
from threadloom.operators.ordering import chunk_digest, numbered, tree_root
from threadloom.sources.sinks import SinkError, _fs, staged_write
from threadloom.storage import stored

CHUNK = 1024


def by_name(value: Column, kind: DataType) -> Column:
    """``value`` with structs' fields and maps' keys in the order of their names, at any depth."""
    if isinstance(kind, StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        made = F.struct(*(by_name(value.getField(f.name), f.dataType).alias(f.name) for f in fields)) if fields else value
        return F.when(value.isNotNull(), made)
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: by_name(x, kind.elementType))
    if isinstance(kind, MapType):
        entries = F.array_sort(F.map_entries(value))
        return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["key"], by_name(e["value"], kind.valueType))))
    return value


def canonical_json(rows: DataFrame, columns: list[str] | None = None) -> Column:
    """The JSON of a row of ``rows`` (its given columns) that any writer of sorted, compact, escaped JSON gives; nulls stay. Numbers with a point are written as Spark writes them."""
    kept = sorted(columns or rows.columns)
    made = F.struct(*(by_name(F.col(c), rows.schema[c].dataType).alias(c) for c in kept))
    return T.ascii_json(F.to_json(made, {"ignoreNullFields": "false"}))


def record_hash(rows: DataFrame, columns: list[str] | None = None) -> Column:
    return F.sha2(canonical_json(rows, columns), 256)


def content_roots(rows: DataFrame, group: str, digest: str, fanout: int = CHUNK) -> DataFrame:
    """(group, root, n): one hash for each group's set of digests, in their own order."""
    placed = numbered(rows.select(group, F.col(digest).alias("digest")), [F.col("digest").asc()], group)
    return tree_root(placed, group, fanout).join(rows.groupBy(F.col(group).alias("_g")).agg(F.count("*").alias("n")), F.col(group).eqNullSafe(F.col("_g"))).drop("_g")


def chunks_of(rows: DataFrame, key: str, chunk: int = CHUNK, columns: list[str] | None = None) -> DataFrame:
    """(idx, first_key, last_key, n, digest) of each chunk of rows (of their given columns) in the order of ``key``."""
    # Written, as ranges are found by a pass of their own, which would hash all rows again.
    hashed = stored(rows.select(F.col(key).alias("key"), record_hash(rows, columns).alias("digest")), "hashed")
    placed = numbered(hashed, [F.col("key").asc(), F.col("digest").asc()], name="place")
    return placed.groupBy(F.floor(F.col("place") / chunk).alias("idx")).agg(F.min("key").alias("first_key"), F.max("key").alias("last_key"), F.count("*").alias("n"), chunk_digest("place", "digest").alias("digest"))


def root_of(chunks: DataFrame) -> str | None:
    row = tree_root(chunks.withColumn("all", F.lit(0)), "all", CHUNK).first()
    return row["root"] if row else None


def _read_only(spark: SparkSession, path: str) -> None:
    """Marks a folder's files; a name a file passes through the driver, no row does."""
    fs, where = _fs(spark, path)
    mode = spark._jvm.org.apache.hadoop.fs.permission.FsPermission("444")
    files = fs.listFiles(where, True)
    while files.hasNext():
        fs.setPermission(files.next().getPath(), mode)


def listed(spark: SparkSession, path: str, release: str) -> dict:
    """A release's entry: release_id, parent, parent_root, key, root, n."""
    fs, table = _fs(spark, f"{path}/releases")
    found = spark.read.parquet(f"{path}/releases").where(F.col("release_id") == release).first() if fs.exists(table) else None
    if found is None:
        raise SinkError(f"no release {release}")
    return found.asDict()


def tampered_chunks(spark: SparkSession, path: str, release: str) -> DataFrame:
    """(idx, first_key, last_key, n, digest) of listed chunks whose rows aren't what was frozen, or that are missing, and of chunks that weren't listed."""
    entry = listed(spark, path, release)
    then, now = spark.read.parquet(f"{path}/chunks/{release}"), chunks_of(spark.read.parquet(f"{path}/data/{release}"), entry["key"])
    return then.exceptAll(now.select(then.columns)).unionByName(now.join(then, "idx", "left_anti"))


def verify_release(spark: SparkSession, path: str, release: str) -> None:
    """Raises SinkError unless the release is listed, its list of chunks gives its root, and its rows are those of the chunks."""
    entry = listed(spark, path, release)
    if root_of(spark.read.parquet(f"{path}/chunks/{release}")) != entry["root"]:
        raise SinkError(f"the list of chunks of {release} isn't the frozen one")
    bad = tampered_chunks(spark, path, release).select("idx", "first_key", "last_key").orderBy("idx").limit(5).collect()
    if bad:
        raise SinkError(f"{release} isn't what was frozen: {bad}")


def freeze_release(rows: DataFrame, path: str, key: str, parent: str | None = None, source: str = "source") -> str:
    """Writes an immutable release under the next number, with its chunks, root, counts by source and its parent, which must be what was frozen; keys must be unique and present."""
    spark = rows.sparkSession
    fs, table = _fs(spark, f"{path}/releases")
    last = spark.read.parquet(f"{path}/releases").agg(F.max("release_id")).first()[0] if fs.exists(table) else None
    release = f"RELEASE_{int(last.rsplit('_', 1)[1]) + 1 if last else 1:03d}"
    above = None
    if parent is not None:
        verify_release(spark, path, parent)
        above = listed(spark, path, parent)["root"]
    twice = lambda df: df.groupBy(key).count().where(F.col(key).isNull() | (F.col("count") > 1))
    staged_write(rows, f"{path}/data/{release}", twice)
    frozen = spark.read.parquet(f"{path}/data/{release}")
    staged_write(chunks_of(frozen, key), f"{path}/chunks/{release}")
    root = root_of(spark.read.parquet(f"{path}/chunks/{release}"))
    for part in ("data", "chunks"):
        _read_only(spark, f"{path}/{part}/{release}")
    if source in rows.columns:
        staged_write(frozen.groupBy(source).agg(F.count("*").alias("n")), f"{path}/sources/{release}")
    text = lambda v: F.lit(v).cast("string")
    entry = frozen.agg(F.count("*").alias("n"))
    # Listed last: until then there is no such release.
    entry.select(text(release).alias("release_id"), text(parent).alias("parent"), text(above).alias("parent_root"), text(key).alias("key"), text(root).alias("root"), "n").write.mode("append").parquet(f"{path}/releases")
    return release


def child_release(spark: SparkSession, path: str, parent: str, column: DataFrame) -> str:
    """A release with one column more than ``parent``: ``column`` holds the parent's key and the new values, one row for each of its rows.

    What the parent froze is kept: without the new column the child's rows give the parent's root.
    """
    entry = listed(spark, path, parent)
    key, rows = entry["key"], spark.read.parquet(f"{path}/data/{parent}")
    added = [c for c in column.columns if c != key]
    if len(added) != 1 or added[0].lower() in {c.lower() for c in rows.columns}:
        raise SinkError("a child adds one column that its parent hasn't")
    if not column.groupBy(key).count().where("count > 1").isEmpty():
        raise SinkError(f"keys of {added[0]} collide")
    if not rows.join(column, key, "left_anti").isEmpty() or not column.join(rows, key, "left_anti").isEmpty():
        raise SinkError(f"keys of {added[0]} aren't those of {parent}")
    child = freeze_release(rows.join(column, key), path, key, parent)
    if root_of(chunks_of(spark.read.parquet(f"{path}/data/{child}").drop(added[0]), key)) != entry["root"]:
        raise SinkError(f"{child} doesn't hold the rows of {parent}")
    return child
