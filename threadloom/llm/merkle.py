"""Merkle manifest of a dataset: a tree of digests over its rows, a subtree a group, and each row's proof.

A row's leaf is the digest of its fields. In each group leaves stand in order; levels
are DataFrames: a node's number divided by ``fanout`` is its parent's, a parent is
the digest of its children's in order. What remains of each group is its subroot, and
the same levels over the subroots, in the groups' order, give the root. Proofs come
down again, one join a level: a child's proof is its run's other digests, then its
parent's proof. All levels together hold about twice the leaves for a fanout of two,
and so do the joins.

Defined results: null fields count as ``-``, which no value gives; rows without group
are a group of their own, the first; rows whose key repeats or is missing are leaves
each, the latter first, in the order of their digests; no rows give no rows and no
root; extra columns stay as they are, but for those named idx, subroot or proof, which
the result's replace.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .ordering import numbered


def framed(*columns: Column) -> Column:
    """Each value as text with its length in bytes before it, or ``-`` for null, in one string."""
    one = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.concat(*(one(c.cast("string")) for c in columns))


def leaf(*columns: Column) -> Column:
    """The digest of a row's fields."""
    return F.sha2(framed(*columns), 256)


def fold(start: Column, proof: Column) -> Column:
    """The root that follows from a leaf and its proof: each step has the node's own place marked."""
    return F.aggregate(proof, start, lambda digest, step: F.sha2(F.replace(step, F.lit("|"), digest), 256))


def siblings(proof: Column) -> Column:
    """The digests of a proof in one string, without the marks."""
    return F.replace(F.array_join(proof, ""), F.lit("|"), F.lit(""))


def climb(nodes: DataFrame, fanout: int) -> list[DataFrame]:
    """All levels above ``nodes`` (g, idx, digest, m: how many nodes of g there are at this level), lowest first; each node with its children's digests.

    A group of one node is at its end and has no parent.
    """
    most = nodes.agg(F.max("m")).first()[0] or 0
    levels = []
    while most > 1:
        most = -(-most // fanout)
        below = nodes.where("m > 1").select("g", "idx", "digest", "m")
        runs = below.groupBy("g", F.floor(F.col("idx") / fanout).alias("up"), "m").agg(F.array_sort(F.collect_list(F.struct("idx", "digest"))).alias("run"))
        made = runs.select("g", F.col("up").alias("idx"), F.ceil(F.col("m") / fanout).alias("m"), F.transform("run", lambda x: x["digest"]).alias("children"))
        nodes = materialize(made.withColumn("digest", F.sha2(F.array_join("children", ""), 256)), "level")
        levels.append(nodes)
    return levels


def descend(nodes: DataFrame, levels: list[DataFrame], fanout: int, every: int = 8) -> DataFrame:
    """``nodes`` with the column proof: steps to the group's last node, the lowest first. Every so many levels the proofs are written, which cuts the lineage."""
    above = None
    for at in range(len(levels) - 1, -2, -1):
        own = nodes if at < 0 else levels[at]
        if above is None:
            above = own.withColumn("proof", F.array().cast("array<string>"))
            continue
        parents = above.select("g", F.col("idx").alias("_up"), F.col("children").alias("_run"), F.col("proof").alias("_above"))
        place = F.pmod(F.col("idx"), F.lit(fanout)).cast("int")
        step = F.array_join(F.transform("_run", lambda d, i: F.when(i == place, F.lit("|")).otherwise(d)), "")
        joined = own.withColumn("_up", F.floor(F.col("idx") / fanout)).join(parents, ["g", "_up"], "left")
        proof = F.when(F.col("_run").isNull(), F.array().cast("array<string>")).otherwise(F.concat(F.array(step), F.col("_above")))
        above = joined.select(*(own[c] for c in own.columns), proof.alias("proof"))
        if at > 0 and at % every == 0:
            above = materialize(above, "proofs")
    return above


@dataclass
class Manifest:
    """``leaves``: the given rows with idx in their group, subroot and proof up to the root; ``groups``: each group's place, size and subroot; ``root``: None without rows."""

    leaves: DataFrame
    groups: DataFrame
    root: str | None


def manifest(rows: DataFrame, group: str, order: list[str], digest: str = "leaf", fanout: int = 2) -> Manifest:
    """The tree over ``rows``, which hold each row's ``digest``; ties in ``order`` go by the digest."""
    if fanout < 2:
        raise ValueError("a node needs two children or more")
    by = [F.col(f"o{i}").asc_nulls_first() for i in range(len(order))]
    plain = rows.select(F.struct(*rows.columns).alias("row"), F.col(group).alias("grp"), *(F.col(c).alias(f"o{i}") for i, c in enumerate(order)), F.col(digest).alias("digest"))
    placed = materialize(numbered(plain, [*by, F.col("digest").asc()], "grp"), "leaves")
    sizes = materialize(placed.groupBy("grp").agg(F.count("*").alias("m")), "groups")
    named = materialize(numbered(sizes, [F.col("grp").asc_nulls_first()], name="g"), "groups")
    own = named.select(F.col("grp").alias("same"), "g", "m")
    nodes = placed.join(own, placed["grp"].eqNullSafe(own["same"])).select("row", "g", "m", "idx", "digest")
    levels = climb(nodes, fanout)
    ends = [df.where("m = 1").select("g", "digest") for df in [nodes, *levels]]
    subroots = ends[0]
    for more in ends[1:]:
        subroots = subroots.unionByName(more)
    subroots = materialize(subroots.withColumnRenamed("digest", "subroot"), "subroots")
    tops = subroots.select(F.lit(0).alias("g"), F.col("g").alias("idx"), F.col("subroot").alias("digest"), F.lit(named.count()).cast("bigint").alias("m"))
    above = climb(tops, fanout)
    last = (above[-1] if above else tops).select("digest").first()
    upper = materialize(descend(tops, above, fanout).select(F.col("idx").alias("g"), F.col("digest").alias("subroot"), F.col("proof").alias("upper")), "upper")
    full = descend(nodes, levels, fanout).join(upper, "g")
    names = [c for c in rows.columns if c not in ("idx", "subroot", "proof")]
    leaves = full.select(*(F.col("row").getField(c).alias(c) for c in names), "idx", "subroot", F.concat("proof", "upper").alias("proof"))
    groups = named.join(upper, "g").select(F.col("grp").alias(group), F.col("g").alias("place"), F.col("m").alias("n_leaves"), "subroot")
    return Manifest(leaves, groups, last[0] if last else None)


def tampered_check(checked: DataFrame, found: str, root: str | None) -> DataFrame:
    """``checked`` (with proof) with folded_root, what the digests in the column ``found`` lead to, and whether that is ``root``."""
    return checked.withColumn("folded_root", fold(F.col(found), F.col("proof"))).withColumn("verified", F.col("folded_root") == F.lit(root))
