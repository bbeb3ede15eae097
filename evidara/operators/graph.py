"""Connected components of an edge list by alternating large-star and small-star steps.

Each step is a grouped minimum and a join with it; neighbours are never gathered, but the pairs of a hub meet in one task of the
join unless adaptive execution splits it. The number of rounds grows with the logarithm of the longest path. State is cut to the shared folder after every round, and
the state before it is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidara.session import cut, drop, large


def _with_min(pairs: DataFrame, grows: bool) -> DataFrame:
    """(u, v, m): each pair with the least of u and all v of u; pairs must lead from every node to all its neighbours.

    A hub that is the least of its component has no smaller neighbour, so its pairs keep u as their minimum.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).where("m < u")
    return pairs.join(large(least) if grows else least, "u", "left").withColumn("m", F.coalesce("m", "u"))


def connected_components(edges: DataFrame, left: str = "u", right: str = "v", grows: bool = False) -> DataFrame:
    """(node, component) for every node that an edge names; component is the smallest node reachable.

    Loops and repeated edges are allowed, edges with a null end are ignored, and an empty list gives an empty result.
    `grows` says that there may be as many edges as the input has rows, so that no side of a join is broadcast.
    """
    now = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where(F.col("u").isNotNull() & F.col("v").isNotNull())
    nodes = now.select("u").union(now.select("v")).distinct()
    now = cut(now.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    nodes = cut(nodes)
    mark = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        far = _with_min(both, grows).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _with_min(far, grows)
        small = small.select("u", F.col("m").alias("v")).union(small.select(F.col("v").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()
        before, now = now, cut(small)
        drop(before)
        told = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if told == mark:
            break
        mark = told
    least = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return nodes.withColumnRenamed("u", "node").join(large(least) if grows else least, "node", "left").withColumn("component", F.coalesce("component", "node"))


def line_components(lines: DataFrame, step: float = 0.5) -> DataFrame:
    """(component, features, isolated, nodes, edges, dangling) of lines (id, line): lines that share a vertex, snapped to `step`, belong together.

    A component has the name of its first line. Nodes are the snapped vertices of segments, edges all segments, as often as they come; a
    node is dangling if just one end of a segment is there. A line of one vertex joins components, but makes no node; one without any, or a null
    line, is a component of its own.
    """
    key = lambda p: F.struct(*((F.floor(p[axis] / step + 0.5)).cast("bigint").alias(axis) for axis in "xy"))
    rows = lines.select(F.col("id").alias("feature"), F.coalesce(F.transform("line", key), F.array().cast("array<struct<x:bigint,y:bigint>>")).alias("keys"))
    vertex = rows.select("feature", F.explode(F.array_distinct("keys")).alias("key"))
    # the lines of a vertex are linked with the first of them, so that vertices need no names of their own
    first = vertex.groupBy("key").agg(F.min("feature").alias("first"))
    links = vertex.join(large(first), "key").select(F.col("feature").alias("u"), F.col("first").alias("v"))
    found = cut(connected_components(links, grows=True))
    own = rows.select("feature").join(large(found.withColumnRenamed("node", "feature")), "feature", "left").select("feature", F.coalesce("component", "feature").alias("component"))
    features = own.groupBy("component").agg(F.count("*").alias("features"), F.min("feature").alias("first"))
    ends = rows.where("size(keys) > 1").select(F.explode(F.concat(F.slice("keys", F.lit(1), F.greatest(F.size("keys") - 1, F.lit(0))), F.slice("keys", F.lit(2), F.greatest(F.size("keys") - 1, F.lit(0))))).alias("key"))
    degrees = ends.groupBy("key").agg(F.count("*").alias("degree")).join(large(first), "key").join(large(found.withColumnRenamed("node", "first")), "first")
    nodes = degrees.groupBy("component").agg(F.count("*").alias("nodes"), (F.sum("degree") / 2).cast("bigint").alias("edges"), F.count_if(F.col("degree") == 1).alias("dangling"))
    zero = F.lit(0).cast("bigint")
    return features.join(large(nodes), "component", "left").select(F.col("first").alias("component"), "features", (F.col("features") == 1).alias("isolated"), *(F.coalesce(c, zero).alias(c) for c in ("nodes", "edges", "dangling")))
