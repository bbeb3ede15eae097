"""Junction vertices put into lines, and connectors as features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidara.functions import geometry as G

POINTS = "array<struct<x:double,y:double>>"


def spliced(lines: DataFrame, targets: DataFrame, key: str, near: float = 0.2, same: float = 0.15) -> DataFrame:
    """Lines (key, line, ...) with the targets (key, pos, x, y) put into their nearest segments, and `inserted`, their number.

    A target counts if its nearest segment, the first of equally near ones, is within `near` and none of the line's vertices is nearer than `same`.
    Along the line, and by `pos` at one place, each is put in unless one before it is nearer than `same`; so the order of rows
    changes nothing. Lines without targets, or of fewer than two points, stay as they are; targets of no line are left out.
    """
    held = targets.where("x IS NOT NULL AND y IS NOT NULL").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "x", "y"))).alias("__t"))
    line = F.col("line")
    rest = F.greatest(F.size(line) - 1, F.lit(0))
    distance = lambda a, b: F.sqrt(F.pow(a["x"] - b["x"], 2) + F.pow(a["y"] - b["y"], 2))
    segments = F.zip_with(F.slice(line, F.lit(1), rest), F.slice(line, F.lit(2), rest), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def nearest(t: Column) -> Column:
        def one(s: Column, i: Column) -> Column:
            share = G.nearest_share(t["x"], t["y"], s["a"]["x"], s["a"]["y"], s["b"]["x"], s["b"]["y"])
            foot = F.struct((s["a"]["x"] + share * (s["b"]["x"] - s["a"]["x"])).alias("x"), (s["a"]["y"] + share * (s["b"]["y"] - s["a"]["y"])).alias("y"))
            return F.struct(distance(foot, t).alias("d"), i.alias("i"), share.alias("share"))

        best = F.array_min(F.transform(F.col("__s"), one))
        return F.transform(F.array(best), lambda b: F.struct(b["i"].alias("i"), b["share"].alias("share"), t["pos"].alias("pos"), t["x"].alias("x"), t["y"].alias("y"), b["d"].alias("d")))[0]

    made = lines.join(held, key, "left").withColumn("__s", segments)
    far = lambda t: ~F.exists(line, lambda p: distance(p, t) < same)
    found = F.filter(F.transform(F.filter("__t", far), nearest), lambda v: v["d"] <= near)
    made = made.withColumn("__t", F.array_sort(F.coalesce(found, F.array().cast("array<struct<i:int,share:double,pos:int,x:double,y:double,d:double>>"))))
    taken = F.aggregate("__t", F.slice("__t", F.lit(1), F.lit(0)), lambda out, v: F.when(F.exists(out, lambda p: distance(p, v) < same), out).otherwise(F.concat(out, F.array(v))))
    made = made.withColumn("__t", taken)
    whole = F.flatten(F.transform(line, lambda p, i: F.concat(F.array(p), F.transform(F.filter("__t", lambda v: v["i"] == i), lambda v: G.point(v["x"], v["y"])))))
    return made.withColumn("line", F.coalesce(whole, line)).withColumn("inserted", F.size("__t")).drop("__t", "__s")


def connector_features(connectors: DataFrame) -> DataFrame:
    """Connectors (id, kind, role, surface, distance, confidence, from_id, to_id) as features with their tags and sources. Tag names and values are fixed."""
    tags = F.array(
        F.struct(F.lit("highway").alias("k"), F.when(F.col("kind") == "road", "service").otherwise("footway").alias("v")), F.struct(F.lit("path:repair").alias("k"), F.lit("endpoint_snap").alias("v")), F.struct(F.lit("repair:distance_m").alias("k"), F.col("distance").cast("string").alias("v")),
        F.struct(F.lit("repair:confidence").alias("k"), F.col("confidence").cast("string").alias("v")), F.struct(F.lit("repair:from").alias("k"), F.col("from_id").cast("string").alias("v")), F.struct(F.lit("repair:to").alias("k"), F.col("to_id").cast("string").alias("v")),
        F.struct(F.lit("queue").alias("k"), F.when(F.col("role") == "queue", "yes").alias("v")), F.struct(F.lit("access").alias("k"), F.when(F.col("role") == "service", "private").alias("v")), F.struct(F.lit("surface").alias("k"), F.nullif("surface", F.lit("")).alias("v")),
    )
    return connectors.select(F.concat(F.lit("derived:"), F.col("id").cast("string")).alias("id"), "kind", F.when(F.col("kind") == "road", "service").otherwise("footway").alias("subtype"), F.map_from_entries(F.filter(tags, lambda t: t["v"].isNotNull())).alias("tags"), "confidence", "distance", F.array("from_id", "to_id").alias("source_features"), F.lit("compiled-repair").alias("status"))
