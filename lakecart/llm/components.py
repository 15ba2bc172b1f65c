"""Connected components of an edge table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecart.llm.store import written


def connected_components(edges: DataFrame) -> DataFrame:
    """`edges` (a, b: long) → (node, component): each node of an edge with the smallest node reachable from it.

    Alternating large-star and small-star rounds until the edges stand still: each node keeps pointing at the
    smallest neighbour it knows, so the rounds grow with the logarithm of the longest path.  A hub is met by grouped
    minima (combined before the shuffle) and a join that adaptive execution can split; no neighbour list is held.
    Null ends and self loops are ignored; an empty table gives no rows.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, before = written(e, "components"), None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
        )).alias("s")).select("s.*").where("u <> v").distinct()
        e = written(small, "components")
        state = e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if state == before:
            break
        before = state
    nodes = e.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    return nodes.union(nodes.select(F.col("component").alias("node"), "component").distinct())
