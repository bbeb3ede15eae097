"""Control points of drawings from their labels, fits of them, the best fit of a drawing, and promotion of rejected drawings by consensus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidara.functions.scalars import haversine_m
from evidara.session import cut

#: Limits of coordinates in metres, and of labels on a page in points.
LABEL, EASTING, NORTHING = (10_000, 1_300_000), (0, 700_000), (0, 1_300_000)
SAME_LINE, APART, AXIS_VALUES = 18, 80, 8
PAIR_RISE, PAIR_GAP = 12, 120


def label_value(text: Column) -> Column:
    """The coordinate that a label names: five to seven digits, with a fraction or not; null if it names none."""
    compact = F.regexp_replace(F.coalesce(text, F.lit("")), r"[,\s]", "")
    value = F.when(F.rlike(compact, F.lit(r"^\d{5,7}(\.\d+)?$")), compact.try_cast("double"))
    return F.when(value.between(*LABEL), value)


def spread(name: str) -> Column:
    return F.max(name) - F.min(name)


def grid_points(words: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, method, swapped, x, y, easting, northing): control points where lines of repeated labels cross.

    words: keys (a page), pos, text, x, y. A value found twice or more in a narrow column names a vertical line, in a narrow row a horizontal
    one. A page needs two lines of each. As the axes may be swapped both ways are tried, if all values of an axis are plausible; of an
    axis the first AXIS_VALUES lines in order of words count, so a page has at most 64 points each way.
    """
    values = words.withColumn("value", label_value(F.col("text"))).where("value IS NOT NULL")
    lines = values.groupBy(*keys, "value").agg(F.count("*").alias("n"), spread("x").alias("wide"), spread("y").alias("high"), F.avg("x").alias("mx"), F.avg("y").alias("my"), F.min("pos").alias("pos")).where("n >= 2")
    vertical = lines.where(f"wide <= {SAME_LINE} AND high >= {APART}").select(*keys, "value", F.col("mx").alias("at"), "pos")
    horizontal = lines.where(f"high <= {SAME_LINE} AND wide >= {APART}").select(*keys, "value", F.col("my").alias("at"), "pos")

    def axis(side: DataFrame, name: str) -> DataFrame:
        facts = side.groupBy(*keys).agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).where("n >= 2")
        few = side.withColumn("k", F.row_number().over(Window.partitionBy(*keys).orderBy("pos"))).where(f"k <= {AXIS_VALUES}")
        return few.join(facts, keys).select(*keys, *(F.col(c).alias(f"{name}_{c}") for c in ("value", "at", "low", "high")))

    # at most AXIS_VALUES rows of a page on each side
    crossed = axis(vertical, "v").join(axis(horizontal, "h"), keys)
    fine = lambda side, limits: (F.col(f"{side}_low") >= limits[0]) & (F.col(f"{side}_high") <= limits[1])
    ways = F.array(*(F.struct(F.lit(swapped).alias("swapped"), (fine(e, EASTING) & fine(n, NORTHING)).alias("fine"), F.col(f"{e}_value").alias("easting"), F.col(f"{n}_value").alias("northing")) for swapped, e, n in ((False, "v", "h"), (True, "h", "v"))))
    return crossed.select(*keys, F.lit("coordinate-grid").alias("method"), F.col("v_at").alias("x"), F.col("h_at").alias("y"), F.explode(ways).alias("w")).where("w.fine").select(*keys, "method", "w.swapped", "x", "y", "w.easting", "w.northing")


def pair_points(words: DataFrame, keys: list[str]) -> DataFrame:
    """The same from labels that stand side by side: in reading order a word and the next one, both coordinates, on one line and near.

    words: keys, pos, text, x, y, x0, x1. A page needs three pairs, and three plausible points each way.
    """
    order = Window.partitionBy(*keys).orderBy("y", "x", "pos")
    w = words.withColumn("value", label_value(F.col("text")))
    w = w.select(*keys, "x", "y", "x1", "value", *(F.lead(c).over(order).alias(f"next_{c}") for c in ("x", "y", "x0", "value")))
    pairs = w.where(f"value IS NOT NULL AND next_value IS NOT NULL AND abs(y - next_y) <= {PAIR_RISE} AND next_x0 - x1 <= {PAIR_GAP}")
    pairs = pairs.withColumn("pairs", F.count("*").over(Window.partitionBy(*keys))).where("pairs >= 3")
    ways = F.array(*(F.struct(F.lit(s).alias("swapped"), F.col(e).alias("easting"), F.col(n).alias("northing")) for s, e, n in ((False, "value", "next_value"), (True, "next_value", "value"))))
    points = pairs.select(*keys, F.lit("coordinate-pairs").alias("method"), ((F.col("x") + F.col("next_x")) / 2).alias("x"), ((F.col("y") + F.col("next_y")) / 2).alias("y"), F.explode(ways).alias("w")).select(*keys, "method", "w.swapped", "x", "y", "w.easting", "w.northing")
    points = points.where(F.col("easting").between(*EASTING) & F.col("northing").between(*NORTHING))
    return points.withColumn("n", F.count("*").over(Window.partitionBy(*keys, "method", "swapped"))).where("n >= 3").drop("n")


def fitted(points: DataFrame, candidate: list[str], pages: DataFrame, keys: list[str], box: tuple[float, float, float, float], max_rmse: float = 3.0, max_km2: float = 25.0) -> DataFrame:
    """A row for each candidate: its affine fit a, b, c (easting) and d, e, f (northing) by least squares, rmse, points, and `reason`, null if accepted.

    pages: keys, width, height. Tests in order: three points, a spread of ten in both directions that isn't a line, a fit, its rmse, scale, ratio of
    scales, skew, determinant, and the page's extent on the ground: at most `max_km2`, with two hundredths of it or of `box` (west, south, east,
    north in metres) shared. Sums are taken about the first point, so that they stay exact for whole numbers.
    """
    points = cut(points)
    first = points.groupBy(*candidate).agg(F.min(F.struct("x", "y", "easting", "northing")).alias("o"))
    p = points.join(first, candidate).select(*candidate, "o", *((F.col(c) - F.col(f"o.{c}")).alias(k) for c, k in (("x", "x"), ("y", "y"), ("easting", "e"), ("northing", "n"))))
    total = {f"s{u}{v}": F.sum(F.col(u) * F.col(v)) for u, v in ("xx", "xy", "yy", "xe", "ye", "xn", "yn")} | {f"s{u}": F.sum(u) for u in "xyen"}
    g = p.groupBy(*candidate).agg(F.first("o").alias("o"), F.count("*").cast("double").alias("k"), spread("x").alias("wide"), spread("y").alias("high"), F.collect_list(F.struct("x", "y")).alias("all"), *(c.alias(n) for n, c in total.items()))
    central = lambda u, v: F.col("k") * F.col(f"s{u}{v}") - F.col(f"s{u}") * F.col(f"s{v}")
    g = g.withColumns({f"m{u}{v}": central(u, v) for u, v in ("xx", "xy", "yy", "xe", "ye", "xn", "yn")}).withColumn("det", F.col("mxx") * F.col("myy") - F.col("mxy") * F.col("mxy"))
    solve = lambda v: ((F.col(f"mx{v}") * F.col("myy") - F.col(f"my{v}") * F.col("mxy")) / F.col("det"), (F.col(f"my{v}") * F.col("mxx") - F.col(f"mx{v}") * F.col("mxy")) / F.col("det"))
    (a, b), (d, e) = ((F.when(F.col("det") != 0, v) for v in solve(c)) for c in "en")
    g = g.withColumns({"a": a, "b": b, "d": d, "e": e})
    at = lambda u, v, s: (F.col(f"s{s}") - F.col(u) * F.col("sx") - F.col(v) * F.col("sy")) / F.col("k")
    g = g.withColumns({"ce": at("a", "b", "e"), "cn": at("d", "e", "n")})
    fits = g.drop("o").join(first, candidate)
    # residuals in whole millionths of a square metre, so that their sum doesn't depend on its order
    off = lambda u, v, c, s: F.pow(F.col(u) * F.col("x") + F.col(v) * F.col("y") + F.col(c) - F.col(s), 2)
    rest = p.drop("o").join(fits.select(*candidate, "a", "b", "d", F.col("e").alias("e2"), "ce", "cn"), candidate)
    rest = rest.groupBy(*candidate).agg(F.sum(F.floor((off("a", "b", "ce", "e") + off("d", "e2", "cn", "n")) * 1e6 + 0.5)).alias("rest"))
    fits = fits.join(rest, candidate).withColumn("rmse", F.sqrt(F.col("rest") / 1e6 / F.col("k")))
    fits = fits.withColumns({"c": F.col("ce") + F.col("o.easting") - F.col("a") * F.col("o.x") - F.col("b") * F.col("o.y"), "f": F.col("cn") + F.col("o.northing") - F.col("d") * F.col("o.x") - F.col("e") * F.col("o.y")})
    cross = lambda s, t: F.abs((s["x"] - F.col("all")[0]["x"]) * (t["y"] - F.col("all")[0]["y"]) - (s["y"] - F.col("all")[0]["y"]) * (t["x"] - F.col("all")[0]["x"]))
    flat = (F.col("wide") < 10) | (F.col("high") < 10) | ~F.exists("all", lambda s: F.exists("all", lambda t: cross(s, t) > 25))
    sx, sy = F.sqrt(F.pow("a", F.lit(2)) + F.pow("d", F.lit(2))), F.sqrt(F.pow("b", F.lit(2)) + F.pow("e", F.lit(2)))
    fits = fits.withColumns({"flat": flat, "sx": sx, "sy": sy}).join(pages, keys)
    corner = lambda u, v, c, x, y: F.col(u) * x + F.col(v) * y + F.col(c)
    ends = [(F.lit(0.0), F.lit(0.0)), (F.col("width"), F.lit(0.0)), (F.col("width"), F.col("height")), (F.lit(0.0), F.col("height"))]
    east, north = [corner("a", "b", "c", *v) for v in ends], [corner("d", "e", "f", *v) for v in ends]
    fits = fits.withColumns({"w": F.least(*east), "s": F.least(*north), "x2": F.greatest(*east), "y2": F.greatest(*north)})
    own, asked = (F.col("x2") - F.col("w")) * (F.col("y2") - F.col("s")), (box[2] - box[0]) * (box[3] - box[1])
    shared = F.greatest(F.lit(0.0), F.least("x2", F.lit(box[2])) - F.greatest("w", F.lit(box[0]))) * F.greatest(F.lit(0.0), F.least("y2", F.lit(box[3])) - F.greatest("s", F.lit(box[1])))
    ratio, small = F.greatest("sx", "sy") / F.greatest(F.lit(1e-9), F.least("sx", "sy")), F.least("sx", "sy")
    skew = F.abs(F.col("a") * F.col("b") + F.col("d") * F.col("e")) / F.greatest(F.lit(1e-9), F.col("sx") * F.col("sy"))
    reason = (
        F.when(F.col("width").isNull() | F.col("height").isNull(), "missing-page-dimensions").when(F.col("k") < 3, "fewer-than-three-control-points").when(F.col("flat"), "control-points-are-collinear").when(F.col("a").isNull(), "affine-fit-failed")
        .when(F.col("rmse") > max_rmse, "control-point-rmse-exceeds-limit").when((small < 0.005) | (F.greatest("sx", "sy") > 20), "implausible-drawing-scale").when(ratio > 5, "anisotropic-scale-exceeds-limit").when(skew > 0.35, "affine-axes-too-skewed")
        .when(F.abs(F.col("a") * F.col("e") - F.col("b") * F.col("d")) < 1e-6, "degenerate-affine-transform").when(own > max_km2 * 1e6, "extent-exceeds-limit").when(shared < 0.02 * F.least(own, F.lit(float(asked))), "outside-of-the-area")
    )
    return fits.select(*candidate, F.col("k").cast("int").alias("points"), "a", "b", "c", "d", "e", "f", "rmse", reason.alias("reason"))


def best_fits(fits: DataFrame, keys: list[str]) -> DataFrame:
    """The accepted fit of each drawing: least rmse in thousandths of a millimetre, then most points, grids before pairs, unswapped axes first."""
    order = Window.partitionBy(*keys).orderBy(F.floor(F.col("rmse") * 1e6 + 0.5), F.desc("points"), "method", "swapped")
    return fits.where("reason IS NULL").withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n", "reason")


def consensus(candidates: DataFrame, metres: float = 140.0, least: float = 0.72, documents: int = 2) -> DataFrame:
    """(app, id) of the candidates that agree: those within `metres` of the anchor of each application with the most such, the first of equally good ones.

    candidates: app, id, pos (order within the application), document, lon, lat, confidence. Of less than `least` confidence none counts; an anchor's
    candidates must come from two documents. Neighbours are looked up by cells as high as the distance.
    """
    sure = candidates.where(F.col("confidence") >= least).where("lon IS NOT NULL AND lat IS NOT NULL")
    high = metres / 111_000.0
    # cells are as wide as the distance up to 75 degrees of latitude
    cell = lambda lon, lat: (F.floor(lon / (high * 4)), F.floor(lat / high))
    around = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1))))
    cx, cy = cell(F.col("lon"), F.col("lat"))
    a = sure.select("app", F.col("id").alias("anchor"), F.col("pos").alias("anchor_pos"), F.col("lon").alias("lon1"), F.col("lat").alias("lat1"), cx.alias("cx"), cy.alias("cy")).withColumn("s", around).withColumns({"cx": F.col("cx") + F.col("s.i"), "cy": F.col("cy") + F.col("s.j")}).drop("s")
    b = sure.select("app", "id", "document", "lon", "lat", cx.alias("cx"), cy.alias("cy"))
    pairs = a.join(b, ["app", "cx", "cy"]).where(haversine_m(F.col("lat1"), F.col("lon1"), F.col("lat"), F.col("lon")) <= metres)
    sizes = pairs.groupBy("app", "anchor", "anchor_pos").agg(F.count("*").alias("n"), F.count_distinct("document").alias("documents"))
    best = sizes.groupBy("app").agg(F.max_by(F.struct("anchor", "documents"), F.struct("n", -F.col("anchor_pos"))).alias("b")).where(F.col("b.documents") >= documents)
    return pairs.join(best.select("app", F.col("b.anchor").alias("anchor")), ["app", "anchor"]).select("app", "id")


def promoted(documents: DataFrame, agreed: DataFrame, fits: DataFrame) -> DataFrame:
    """Documents (app, id, status, method) with those that agree and whose own fit (app, id, reason) is accepted upgraded; accepted ones stay as they are."""
    hits = agreed.select("app", "id").distinct().withColumn("__hit", F.lit(True))
    valid = fits.groupBy("app", "id").agg(F.bool_or(F.col("reason").isNull()).alias("__fits"))
    up = (F.col("status") != "accepted") & F.coalesce("__hit", F.lit(False)) & F.coalesce("__fits", F.lit(False))
    made = documents.join(hits, ["app", "id"], "left").join(valid, ["app", "id"], "left").withColumn("upgraded", up)
    return made.select("app", "id", F.when(up, "accepted").otherwise(F.col("status")).alias("status"), F.when(up, "automatic-linework-consensus").otherwise(F.col("method")).alias("method"), "upgraded")
