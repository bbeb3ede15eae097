"""Painting shapes on a grid of cells: spans of polygons by sorted crossings, lines of varying width, and layers laid over each other.

A cell (row, col) is the unit square from (col, row); it belongs to a shape if its centre does. Shapes are never tested against
a lattice: an edge gives one crossing for each row that it passes, and neighbouring crossings of a row make a span, so work grows with
the rows that edges pass and the cells that are filled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidara.functions import geometry as G


def spans(shapes: DataFrame, keys: list[str], rings: str = "rings") -> DataFrame:
    """(keys, row, x1, x2): the runs of cells whose centres lie in the shape by the even-odd rule over all of its rings.

    `rings` is an array of rings of points; holes and islands are rings too. Rings of fewer than three points and null shapes give nothing.
    """
    ring = shapes.select(*keys, F.explode(rings).alias("r")).where(F.size("r") >= 3)
    edges = ring.select(*keys, F.explode(F.zip_with("r", G.turned(F.col("r")), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("e")).select(*keys, "e.a", "e.b")
    first = F.ceil(F.least("a.y", "b.y") - 0.5)
    last = F.ceil(F.greatest("a.y", "b.y") - 0.5) - 1
    rows = edges.where(first <= last).withColumn("row", F.explode(F.sequence(first, last)))
    x = (F.col("b.x") - F.col("a.x")) * (F.col("row") + 0.5 - F.col("a.y")) / (F.col("b.y") - F.col("a.y")) + F.col("a.x")
    # the first cell whose centre isn't left of the crossing; two crossings before the same cell cancel out
    crossings = rows.select(*keys, "row", F.ceil(x - 0.5).alias("x1"))
    same, along = Window.partitionBy(*keys, "row", "x1"), Window.partitionBy(*keys, "row").orderBy("x1")
    odd = crossings.withColumns({"n": F.count("*").over(same), "k": F.row_number().over(same.orderBy("x1"))}).where("n % 2 = 1 AND k = 1")
    found = odd.select(*keys, "row", "x1", F.row_number().over(along).alias("n"), (F.lead("x1").over(along) - 1).alias("x2"))
    return found.where("n % 2 = 1").select(*keys, "row", "x1", "x2")


def filled(found: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, row, col): the cells of spans."""
    return found.select(*keys, "row", F.explode(F.sequence("x1", "x2")).alias("col"))


def line_cells(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, row, col), once each: cells whose centres lie within half of `width` of a piece from (ax, ay) to (bx, by)."""
    half = F.col("width") / 2
    index = lambda low, high, by: F.sequence(F.ceil(low - by - 0.5), F.floor(high + by - 0.5))
    wide = pieces.where((F.ceil(F.least("ay", "by") - half - 0.5) <= F.floor(F.greatest("ay", "by") + half - 0.5)) & (F.ceil(F.least("ax", "bx") - half - 0.5) <= F.floor(F.greatest("ax", "bx") + half - 0.5)))
    cells = wide.withColumn("row", F.explode(index(F.least("ay", "by"), F.greatest("ay", "by"), half))).withColumn("col", F.explode(index(F.least("ax", "bx"), F.greatest("ax", "bx"), half)))
    x, y = F.col("col") + 0.5, F.col("row") + 0.5
    t = G.nearest_share(x, y, F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))
    dx, dy = F.col("ax") + t * (F.col("bx") - F.col("ax")) - x, F.col("ay") + t * (F.col("by") - F.col("ay")) - y
    return cells.where(dx * dx + dy * dy <= half * half).select(*keys, "row", "col").distinct()


def tapered_pieces(lines: DataFrame, keys: list[str], step: float = 2.0) -> DataFrame:
    """(keys, ax, ay, bx, by, width): every segment of `line` in pieces of at most `step`, each as wide as the line is at the piece's middle.

    The width goes from `start` to `end` in proportion to the length travelled, is rounded with halves upwards and is 1 at least. Lines of
    fewer than two points or without length give nothing.
    """
    size = lambda a, b: F.sqrt(F.pow(b["x"] - a["x"], 2) + F.pow(b["y"] - a["y"], 2))
    rest = F.greatest(F.size("line") - 1, F.lit(0))
    steps = F.zip_with(F.slice("line", F.lit(1), rest), F.slice("line", F.lit(2), rest), lambda a, b: F.struct(a.alias("a"), b.alias("b"), size(a, b).alias("size")))
    made = lines.where(F.size("line") >= 2).select(*keys, "start", "end", steps.alias("s")).withColumn("total", F.aggregate("s", F.lit(0.0), lambda t, v: t + v["size"])).where("total > 0")
    # each segment with the length before it
    begun = F.aggregate("s", F.struct(F.lit(0.0).alias("at"), F.array().cast("array<double>").alias("all")), lambda t, v: F.struct((t["at"] + v["size"]).alias("at"), F.concat(t["all"], F.array(t["at"])).alias("all")))["all"]
    made = made.withColumn("s", F.arrays_zip(F.col("s").alias("v"), begun.alias("t"))).select(*keys, "start", "end", "total", F.explode("s").alias("s")).select(*keys, "start", "end", "total", "s.v.*", "s.t")
    made = made.withColumn("n", F.greatest(F.lit(1), F.ceil(F.col("size") / step).cast("int"))).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    at = lambda axis, k: F.col(f"a.{axis}") + (F.col(f"b.{axis}") - F.col(f"a.{axis}")) * k / F.col("n")
    share = (F.col("t") + F.col("size") * ((F.col("k") / F.col("n") + (F.col("k") + 1) / F.col("n")) / 2)) / F.col("total")
    width = F.greatest(F.lit(1.0), F.floor(F.col("start") + (F.col("end") - F.col("start")) * share + 0.5))
    return made.select(*keys, at("x", F.col("k")).alias("ax"), at("y", F.col("k")).alias("ay"), at("x", F.col("k") + 1).alias("bx"), at("y", F.col("k") + 1).alias("by"), width.cast("double").alias("width"))


def overpainted(layers: DataFrame, mask: Column | None = None) -> DataFrame:
    """What layers leave on each cell, painted in order of (priority, pos).

    layers: row, col, priority, pos (no two rows of a cell are equal in both), code, access (0: none), discovered, bridge, plaza, natural.
    A discovered layer leaves cells alone that already have access. A bridge gives access, but no surface. Other layers replace the code; where
    access replaces a natural surface, or none, this counts once a cell. Returned are row, col, code (null: no surface yet), access, discovered, and
    path_writes, plaza_writes and natural_replaced (0 or 1). `mask` is a condition on row and col; other cells aren't painted.
    """
    layers = layers if mask is None else layers.where(mask)
    order = F.struct("priority", "pos")
    before = Window.partitionBy("row", "col").orderBy("priority", "pos").rowsBetween(Window.unboundedPreceding, -1)
    gives = F.col("access") > 0
    # the first layer with access is never left out, so any before counts
    skipped = F.col("discovered") & F.coalesce(F.max(gives).over(before), F.lit(False))
    made = layers.withColumn("__on", ~skipped).withColumn("__writes", F.col("__on") & ~F.col("bridge"))
    made = made.withColumn("__below", F.coalesce(F.last(F.when(F.col("__writes"), F.col("natural")), ignorenulls=True).over(before), F.lit(True)))
    path = F.col("__writes") & gives
    return made.groupBy("row", "col").agg(
        F.max_by(F.when(F.col("__writes"), F.col("code")), F.when(F.col("__writes"), order)).alias("code"), F.coalesce(F.max_by("access", F.when(F.col("__on") & gives, order)), F.lit(0)).alias("access"),
        F.bool_or(F.col("__on") & gives & F.col("discovered")).alias("discovered"), F.count_if(path).alias("path_writes"), F.count_if(path & F.col("plaza")).alias("plaza_writes"), F.max((path & F.col("__below")).cast("int")).alias("natural_replaced"),
    )
