"""Connected components of an edge table by alternating stars; nothing is gathered outside Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """edges: u, v. Returns node, root (the least node of its component) for every node that is not its own root.

    A large star hangs each greater neighbour of a node on the least of its neighbourhood, a small star each lesser
    one; both keep components as they are. The stars are settled when a pass changes nothing, after about log(n)
    passes. Every pass is a table in the shared folder, so a lost executor costs one pass at most.
    """
    now = scratch.table(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if not state["n"] or (state["n"], state["s"]) == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = (state["n"], state["s"])
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both).select("u", F.least("m", "u").alias("m")), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.table(large.filter("u <> v"), "large")
        lesser = large.join(_least(large), "u")
        small = lesser.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(lesser.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        after = scratch.table(small, "small")
        scratch.drop(now, large)
        now = after
