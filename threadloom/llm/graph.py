"""Connected components by contraction, without a link or vertex on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for each vertex of ``edges`` (u, v); root is the component's smallest vertex.

    Each round hooks every vertex to its smallest neighbour, follows these hooks to
    their roots and contracts the links, which at least halves the vertices; a
    star needs one round. Counts of links are all that the driver sees.
    """
    edges = materialize(edges.where("u <> v").select("u", "v").distinct(), "links")
    found = None
    while not edges.isEmpty():
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hooks = table = materialize(both.groupBy("u").agg(F.min("v").alias("p")).select("u", F.least("u", "p").alias("p")), "hooks")
        while True:
            above = hooks.select(F.col("u").alias("p"), F.col("p").alias("pp"))
            jumped = materialize(hooks.join(above, "p", "left").select("u", F.coalesce("pp", "p").alias("p"), (F.coalesce("pp", "p") != F.col("p")).alias("moved")), "jumps")
            discard(table)
            hooks, table = jumped.select("u", "p"), jumped
            if jumped.where("moved").isEmpty():
                break
        if found is None:
            found = hooks.select(F.col("u").alias("v"), F.col("p").alias("root"))
        else:
            found = materialize(found.join(hooks.select(F.col("u").alias("root"), F.col("p").alias("new")), "root", "left").select("v", F.coalesce("new", "root").alias("root")), "roots")
        one = edges.join(hooks.select("u", F.col("p").alias("pu")), "u").select("pu", "v")
        two = one.join(hooks.select(F.col("u").alias("v"), F.col("p").alias("pv")), "v").select(F.col("pu").alias("u"), F.col("pv").alias("v"))
        old, edges = edges, materialize(two.where("u <> v").distinct(), "links")
        discard(old)
    return found if found is not None else edges.select("v", F.col("u").alias("root"))
