"""Connected components by alternating large-star and small-star steps (Kiveris et al. 2014).

Each step is an aggregate (partial per task) and a join, in which the edges of a node with very
many neighbours (the centre of a star) are split over tasks, if there is such a node. What a step
reads more than once is written to the shared folder and read back, so lineage and plans stay short:
the driver plans, compiles and keeps a record of every step. Nothing but a few numbers per step
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hot_keys, split_join, staged


def _with_least(edges: DataFrame, total: int) -> DataFrame:
    """Each edge ``(u, v)`` of at most ``total`` with the least of ``u`` and all its neighbours."""
    around = staged(edges.groupBy("u").agg(F.min("v").alias("_m"), F.count(F.lit(1)).alias("_n")), "around")
    hot = hot_keys(around, ["u"], "_n", total)
    least = around.select("u", F.least("u", "_m").alias("m"))
    if hot.isEmpty():
        return edges.join(least, "u").select("u", "v", "m")
    return split_join(edges, least, ["u"], hot, F.col("v")).select("u", "v", "m")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (long columns ``u, v``); the root is the
    component's least node. Loops and repeated edges do not matter; no edges, no rows."""
    edges = staged(edges.filter("u != v").select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u"))
                   .select("u", "v").distinct(), "edges")
    before, total = None, 2 * edges.count()
    while total:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = staged(_with_least(both, total).filter("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct(), "large")
        small = _with_least(large, total)
        edges = staged(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))).filter("u != v").distinct(), "edges")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before, total = state, 2 * state[0]
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
