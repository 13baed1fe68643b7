"""Numbers of rows in a total order, and hash trees over them, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.storage import stored


def numbered(df: DataFrame, order: list[Column], within: str | None = None, name: str = "idx") -> DataFrame:
    """``df`` with each row's number (from 0) in ``order``, in each group of the column ``within`` (null is a group) or overall.

    Rows are cut into ranges and written; the ranges' counts, one row a range and group,
    say where each begins. A group larger than a range lies in many, so none is held
    whole by a task. Rows equal in ``order`` get numbers in any order.
    """
    groups = [within] if within else []
    # Equal rows may be many: a number of their own cuts them too.
    keys = [*(F.col(g).asc_nulls_first() for g in groups), *order, F.col("_tie").asc()]
    cut = stored(df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "cut")
    counts = cut.groupBy("_part", *groups).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"), "starts")
    local = cut.withColumn(name, F.row_number().over(Window.partitionBy("_part", *groups).orderBy(*order, "_tie")) - 1)
    same = local["_part"] == starts["_part"]
    for g in groups:
        same &= local[g].eqNullSafe(starts[g])
    return local.join(starts, same).select(*(local[c] for c in df.columns), (local[name] + starts["_before"]).alias(name))


def chunk_digest(place: str, digest: str) -> Column:
    """The digest of a chunk's digests in the order of ``place``; a chunk is as large as its fanout."""
    return F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(place, digest))), lambda x: x[digest]), ""), 256)


def tree_root(chunks: DataFrame, group: str, fanout: int) -> DataFrame:
    """(group, root) over digests (group, idx, digest) with idx from 0 in each group: runs of ``fanout`` become their digest until one is left, which a single one is already."""
    nodes, ends = chunks.select(group, "idx", "digest"), None
    while True:
        counted = stored(nodes.join(nodes.groupBy(F.col(group).alias("_g")).agg(F.count("*").alias("m")), F.col(group).eqNullSafe(F.col("_g"))).drop("_g"), "tree")
        done = counted.where("m = 1").select(group, F.col("digest").alias("root"))
        ends = done if ends is None else ends.unionByName(done)
        rest = counted.where("m > 1")
        if rest.isEmpty():
            return ends
        nodes = rest.groupBy(group, F.floor(F.col("idx") / fanout).alias("up")).agg(chunk_digest("idx", "digest").alias("digest")).withColumnRenamed("up", "idx")
