"""Spatial joins by grid cells, rectangle overlaps, and tile plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidara.functions import geometry as G
from evidara.session import large


def cells_around(x: Column, y: Column, size: float) -> Column:
    """The 3 x 3 cells around a point."""
    near = F.sequence(F.lit(-1).cast("bigint"), F.lit(1).cast("bigint"))
    return F.flatten(F.transform(near, lambda i: F.transform(near, lambda j: F.struct((F.floor(x / size) + i).alias("cx"), (F.floor(y / size) + j).alias("cy")))))


def grid_join(left: DataFrame, right: DataFrame, size: float, how: str = "inner", on: list[str] | None = None, near: Column | None = None) -> DataFrame:
    """Pairs of points no farther apart than `size` in x and y: an equi-join on grid cells and a test of distance.

    left has x, y and right x2, y2. Each left point looks into 9 cells, each right point lies in one. `on` are further equal columns.
    """
    test = (F.pow(F.col("x") - F.col("x2"), 2) + F.pow(F.col("y") - F.col("y2"), 2) <= size * size) if near is None else near
    if how == "left_anti":
        hits = grid_join(left, right, size, "inner", on, near).select(*(F.col(c).alias(f"__{c}") for c in left.columns)).distinct()
        same = [left[c].eqNullSafe(hits[f"__{c}"]) for c in left.columns]  # nulls are values here
        return left.join(large(hits), same, "left_anti")
    a = left.withColumn("__c", F.explode(cells_around(F.col("x"), F.col("y"), size))).select("*", F.col("__c.cx").alias("__cx"), F.col("__c.cy").alias("__cy")).drop("__c")
    b = right.withColumn("__cx", F.floor(F.col("x2") / size)).withColumn("__cy", F.floor(F.col("y2") / size))
    return a.join(large(b), ["__cx", "__cy", *(on or [])]).where(test).drop("__cx", "__cy")


def cells_of_box(x0: Column, y0: Column, x1: Column, y1: Column, size: float) -> Column:
    """All cells that a box touches."""
    index = lambda v: F.floor(v / size)
    return F.flatten(F.transform(F.sequence(index(x0), index(x1)), lambda i: F.transform(F.sequence(index(y0), index(y1)), lambda j: F.struct(i.alias("cx"), j.alias("cy")))))


def box_pairs(left: DataFrame, right: DataFrame, size: float, id_left: str, id_right: str) -> DataFrame:
    """Pairs of boxes that overlap, once each, with their areas. left: x0..y1; right: bx0..by1."""
    a = left.withColumn("__c", F.explode(cells_of_box(*(F.col(c) for c in ("x0", "y0", "x1", "y1")), size)))
    b = right.withColumn("__c", F.explode(cells_of_box(*(F.col(c) for c in ("bx0", "by0", "bx1", "by1")), size)))
    wide, high = F.least("x1", "bx1") - F.greatest("x0", "bx0"), F.least("y1", "by1") - F.greatest("y0", "by0")
    # a pair counts in the cell that holds the lower corner of its overlap
    own = (F.col("__c.cx") == F.floor(F.greatest("x0", "bx0") / size)) & (F.col("__c.cy") == F.floor(F.greatest("y0", "by0") / size))
    pairs = a.join(large(b), "__c").where(own & (wide > 0) & (high > 0))
    return pairs.withColumns({"shared": wide * high, "area": (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")), "other": (F.col("bx1") - F.col("bx0")) * (F.col("by1") - F.col("by0"))}).drop("__c")


def authority_decisions(planning: DataFrame, candidates: DataFrame, mode: str = "v30a", least: float = 0.18, equal: float = 0.82, size: float = 64.0) -> DataFrame:
    """(planning_id, action, target_id, n_targets) per planning box: what it does to overlapping candidate boxes.

    planning: planning_id, x0..y1, eligible; candidates: target_id, bx0..by1. A candidate matches if the overlap is at least `least` of the smaller
    box; the best has the largest intersection over union, then the smallest id. Ineligible rows are withheld, rows
    without a match fill a gap. In mode v18 a second match within 0.9 of the best makes the row ambiguous and an equivalent one (both
    shares `equal` or more) corroborates; in mode v30a all matches are replaced.
    """
    m = box_pairs(planning, candidates, size, "planning_id", "target_id").withColumn("iou", F.col("shared") / (F.col("area") + F.col("other") - F.col("shared")))
    m = m.where(F.col("shared") / F.least("area", "other") >= least)
    w = Window.partitionBy("planning_id").orderBy(F.desc("iou"), "target_id")
    top = m.withColumns({"n": F.row_number().over(w), "second": F.lead("iou").over(w), "n_targets": F.count("*").over(Window.partitionBy("planning_id"))}).where("n = 1")
    both = (F.col("shared") / F.col("area") >= equal) & (F.col("shared") / F.col("other") >= equal)
    best = top.select("planning_id", "target_id", "iou", "second", "n_targets", both.alias("equivalent"))
    rows = planning.select("planning_id", "eligible").join(best, "planning_id", "left")
    action = F.when(~F.col("eligible"), "withheld").when(F.col("target_id").isNull(), "gap-fill")
    if mode == "v18":
        action = action.when(F.col("second") >= F.greatest(F.lit(least), 0.9 * F.col("iou")), "ambiguous").when(F.col("equivalent"), "corroborated")
    return rows.select("planning_id", action.otherwise("replaced").alias("action"), "target_id", F.coalesce("n_targets", F.lit(0)).cast("bigint").alias("n_targets"))


def tile_plan(bounds: DataFrame, size: int) -> DataFrame:
    """The grid tiles of each (plan_id, e0, n0, e1, n1): rows and columns from 0, outer tiles clipped, id rNN-cNN."""
    count = lambda a, b: F.ceil((F.col(b) - F.col(a)) / size).cast("int")
    grid = bounds.withColumn("row", F.explode(F.sequence(F.lit(0), count("n0", "n1") - 1))).withColumn("col", F.explode(F.sequence(F.lit(0), count("e0", "e1") - 1)))
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return grid.select(
        "plan_id", F.concat(F.lit("r"), two(F.col("row")), F.lit("-c"), two(F.col("col"))).alias("tile_id"), (F.col("e0") + F.col("col") * size).alias("te0"), (F.col("n0") + F.col("row") * size).alias("tn0"),
        F.least(F.col("e0") + (F.col("col") + 1) * size, "e1").alias("te1"), F.least(F.col("n0") + (F.col("row") + 1) * size, "n1").alias("tn1"),
    )


def tile_tiers(tiles: DataFrame, core: tuple[int, int, int, int], near_m: int) -> DataFrame:
    """Tiles with tier core (they overlap the core), near (gap up to `near_m`) or outer, and the gap in metres at 2 places."""
    ce0, cn0, ce1, cn1 = core
    de = F.greatest(F.lit(ce0) - F.col("te1"), F.col("te0") - ce1, F.lit(0))
    dn = F.greatest(F.lit(cn0) - F.col("tn1"), F.col("tn0") - cn1, F.lit(0))
    gap = F.sqrt((de * de + dn * dn).cast("double"))
    overlap = (F.col("te0") < ce1) & (F.col("te1") > ce0) & (F.col("tn0") < cn1) & (F.col("tn1") > cn0)
    return tiles.withColumns({"tier": F.when(overlap, "core").when(gap <= near_m, "near").otherwise("outer"), "gap_m": F.floor(gap * 100 + 0.5) / 100})


def shape_labels(shapes: DataFrame, labels: DataFrame, radius: float = 56.0, worth: float = 0.08) -> DataFrame:
    """(shape_id, label_id, distance) for each shape's best label within `radius`: least distance less `worth` for each point of the label's priority, then by position.

    shapes: shape_id, points, closed; labels: label_id, pos, x, y, priority. A label inside a closed shape has no distance; else it's that to the
    nearest segment, a closed shape's last one included. Shapes meet labels in cells as wide as the radius, once each.
    """
    axis = lambda name: F.transform("points", lambda p: p[name])
    # labels meet shapes' boxes first, without their points, and shapes again by their ids
    box = [f(axis(name)) + by for name, f, by in (("x", F.array_min, -radius), ("y", F.array_min, -radius), ("x", F.array_max, radius), ("y", F.array_max, radius))]
    shapes = shapes.where(F.size("points") > 0)
    a = shapes.select(F.col("shape_id").alias("__shape"), *(v.alias(n) for v, n in zip(box, ("__x0", "__y0", "__x1", "__y1"), strict=True))).distinct()
    a = a.withColumn("__c", F.explode(cells_of_box(*(F.col(c) for c in ("__x0", "__y0", "__x1", "__y1")), radius)))
    b = labels.withColumn("__c", F.struct(F.floor(F.col("x") / radius).alias("cx"), F.floor(F.col("y") / radius).alias("cy")))
    x, y, points = F.col("x"), F.col("y"), F.col("points")

    def apart(p: Column, q: Column) -> Column:
        share = G.nearest_share(x, y, p["x"], p["y"], q["x"], q["y"])
        return F.sqrt(F.pow(p["x"] + share * (q["x"] - p["x"]) - x, 2) + F.pow(p["y"] + share * (q["y"] - p["y"]) - y, 2))

    sides = F.zip_with(points, G.turned(points), lambda p, q: apart(q, p))
    open_sides = F.slice(sides, F.lit(2), F.greatest(F.size(sides) - 1, F.lit(0)))
    near = F.when(F.col("closed") & G.inside(points, x, y), 0.0).otherwise(F.array_min(F.when(F.col("closed") & (F.size(points) > 2), sides).otherwise(open_sides)))
    met = a.join(large(b), "__c").where("x BETWEEN __x0 AND __x1 AND y BETWEEN __y0 AND __y1").select("__shape", "label_id", "pos", "x", "y", "priority")
    pairs = met.join(large(shapes), F.col("__shape").eqNullSafe(F.col("shape_id"))).withColumn("distance", near).where(F.col("distance") <= radius)
    best = F.min_by(F.struct("label_id", "distance"), F.struct((F.col("distance") - F.coalesce("priority", F.lit(0)) * worth).alias("score"), "pos"))
    return pairs.groupBy("shape_id").agg(best.alias("b")).select("shape_id", "b.label_id", "b.distance")
