"""Connected components of an edge table, by alternating large-star and small-star.

Each round is two shuffles of the edges; the edge table never leaves the cluster
and is written to the shared folder after every round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


#: Edges that one task is given at least, so that a small table isn't dealt into many.
EDGES_OF_TASK = 200_000


def _star(edges: DataFrame, large: bool, width: int) -> DataFrame:
    """edges (u, v). Large: link every larger neighbour of u to u's smallest neighbour
    or itself. Small: link u and its smaller neighbours to the smallest."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")).coalesce(width)
    joined = both.join(least, "u")
    if large:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(width)
    own = least.select("u", F.col("m").alias("v"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own).where("u != v").coalesce(width)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(u, v) undirected to (node, component): the smallest node reachable. Nodes
    without an edge are not in the result; self-loops, repeats and nulls are ignored."""
    now = saved(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _state(now)
    while mark[0]:
        width = max(8, mark[0] // EDGES_OF_TASK)
        now = saved(_star(_star(now, True, width), False, width).distinct().coalesce(width), "edges")
        found = _state(now)
        if found == mark:
            break
        mark = found
    tops = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return tops.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def merged(label: DataFrame, edges: DataFrame) -> DataFrame:
    """Components after more edges: they are drawn between the components so far, and only
    what they join is worked out."""
    at = lambda x: label.select(F.col("node").alias(x), F.col("component").alias(f"{x}_c"))
    between = edges.join(at("u"), "u", "left").join(at("v"), "v", "left").select(F.coalesce("u_c", "u").alias("u"), F.coalesce("v_c", "v").alias("v")).where("u != v")
    between = saved(between.distinct(), "edges-between")
    if between.isEmpty():
        return label
    top = saved(components(between), "components-between")
    step = top.select(F.col("node").alias("component"), F.col("component").alias("top"))
    known = label.join(step, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    return saved(known.unionByName(top.join(label, "node", "left_anti").select("node", "component")), "components")
