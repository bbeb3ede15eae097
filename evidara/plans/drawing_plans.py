"""Queries over polygons, drawings and their registration, and the same in DuckDB SQL.

Shapes stand along a strip that grows with the tables, so that pairs grow in proportion to the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidara.functions import geometry as G
from evidara.functions import rules as R
from evidara.functions.scalars import half_up
from evidara.operators import spatial as P
from evidara.operators.graph import connected_components
from evidara.operators.ranking import first_per_key
from evidara.session import large, spread


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


OUTER = ((-12, -6), (-6, -12), (6, -12), (12, -6), (12, 6), (6, 12), (-6, 12), (-12, 6))
HOLE = ((-3, -3), (3, -3), (3, 3), (-3, 3))


def _sites(spark, sf):
    """Planning polygons: octagons, every other one with a hole."""
    k = F.col("s_suppkey")
    x, y = k * 60, F.pmod(k * 37, F.lit(5)) * 10
    hole = F.when(F.pmod(k, F.lit(2)) == 0, F.array(G.ring(x, y, HOLE)))
    return _t(spark, sf, "supplier").select("s_suppkey", "s_name", F.concat(F.array(G.ring(x, y, OUTER)), F.coalesce(hole, F.array().cast("array<array<struct<x:double,y:double>>>"))).alias("rings"), (x - 12).cast("double").alias("x0"), (y - 12).cast("double").alias("y0"), (x + 12).cast("double").alias("x1"), (y + 12).cast("double").alias("y1"))


def _mapped(spark, sf):
    """Mapped polygons: diamonds."""
    k = F.col("p_partkey")
    x, y, r = k * 3, F.pmod(k * 53, F.lit(50)), F.pmod(k, F.lit(9)) + 4
    return _t(spark, sf, "part").select("p_partkey", "p_name", "p_brand", F.array(G.point(x - r, y), G.point(x, y - r), G.point(x + r, y), G.point(x, y + r)).alias("ring"), *((v).cast("double").alias(n) for n, v in (("bx0", x - r), ("by0", y - r), ("bx1", x + r), ("by1", y + r))))


#: The share of overlap that makes a match, and that makes two shapes the same.
LEAST, SAME = 0.18, 0.82


def _overlaps(spark, sf):
    """Pairs of polygons whose boxes overlap, with the lattice points in both: a row of the lattice is counted by the crossings of both shapes' edges."""
    area = F.aggregate(F.col("rings"), F.lit(None).cast("double"), lambda s, r: F.when(s.isNull(), F.abs(G.signed_area(r))).otherwise(s - F.abs(G.signed_area(r))))
    edges = lambda ring: F.zip_with(ring, G.turned(ring), lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")))
    box = ["x0", "y0", "x1", "y1"]
    # what belongs to a shape is worked out once, before it is paired
    sites = _sites(spark, sf).select("s_suppkey", *box, F.greatest(F.lit(0.0), area).alias("site_area"), F.flatten(F.transform("rings", edges)).alias("ea"))
    mapped = _mapped(spark, sf).select("p_partkey", *(f"b{c}" for c in box), F.abs(G.signed_area(F.col("ring"))).alias("map_area"), edges(F.col("ring")).alias("eb"))
    pairs = P.box_pairs(sites, mapped, 64.0, "s_suppkey", "p_partkey").drop("area", "other")
    wide, high = F.least("x1", "bx1") - F.greatest("x0", "bx0"), F.least("y1", "by1") - F.greatest("y0", "by0")
    spacing = F.greatest(F.lit(0.5), F.least(F.lit(3.0), F.sqrt(wide * high / 4000)))
    pairs = pairs.select("s_suppkey", "p_partkey", F.col("site_area").alias("area"), F.col("map_area").alias("other"), "ea", "eb", wide.alias("wide"), high.alias("high"), spacing.alias("spacing"), F.greatest("x0", "bx0").alias("ox"), F.greatest("y0", "by0").alias("oy"))
    count = lambda v: F.greatest(F.lit(1), F.ceil(F.col(v) / F.col("spacing") - 0.5).cast("int"))
    # pairs are small, but each is much work
    pairs = spread(pairs, "s_suppkey", "p_partkey").withColumns({"nx": count("wide"), "ny": count("high")})

    def starts(side: str, y: Column) -> Column:
        """The first lattice point of a row that isn't left of each crossing, in order; points between neighbours are inside."""
        crossing = F.filter(F.col(side), lambda e: (e["ay"] > y) != (e["by"] > y))
        first = lambda e: F.ceil(((e["bx"] - e["ax"]) * (y - e["ay"]) / (e["by"] - e["ay"]) + e["ax"] - F.col("ox")) / F.col("spacing") - 0.5)
        return F.array_sort(F.transform(crossing, lambda e: F.greatest(F.lit(0), F.least(F.col("nx"), first(e).cast("int")))))

    def both(ends: Column) -> Column:
        """How many points of a row lie between crossings 2k and 2k + 1 of both shapes."""
        at = lambda side, i: F.get(ends[side], i)
        pairs_of = lambda side: F.sequence(F.lit(0), F.greatest(F.floor(F.size(ends[side]) / 2).cast("int") - 1, F.lit(0)))
        shared = lambda i, j: F.greatest(F.lit(0), F.coalesce(F.least(at("a", 2 * i + 1), at("b", 2 * j + 1)) - F.greatest(at("a", 2 * i), at("b", 2 * j)), F.lit(0)))
        return F.when((F.size(ends["a"]) > 1) & (F.size(ends["b"]) > 1), F.aggregate(F.flatten(F.transform(pairs_of("a"), lambda i: F.transform(pairs_of("b"), lambda j: shared(i, j)))), F.lit(0), lambda s, v: s + v)).otherwise(0)

    rows = F.transform(F.sequence(F.lit(0), F.col("ny") - 1), lambda j: F.col("oy") + F.col("spacing") * (j + 0.5))
    found = F.transform(F.transform(rows, lambda y: F.struct(starts("ea", y).alias("a"), starts("eb", y).alias("b"))), both)
    # exploded from an array of one, as a filter on what follows would else work it out again for each of its uses
    hits = pairs.select("s_suppkey", "p_partkey", "area", "other", "spacing", F.explode_outer(F.array(F.aggregate(found, F.lit(0).cast("bigint"), lambda s, v: s + v))).alias("samples")).withColumn("shared", F.col("samples") * F.col("spacing") * F.col("spacing"))
    a, b = F.least(F.lit(1.0), F.col("shared") / F.col("area")), F.least(F.lit(1.0), F.col("shared") / F.col("other"))
    hits = hits.withColumns({"share": a, "other_share": b, "iou": F.least(F.lit(1.0), F.col("shared") / (F.col("area") + F.col("other") - F.col("shared")))})
    return hits.withColumns({"matched": F.greatest("share", "other_share", "iou") >= LEAST, "equivalent": (a >= SAME) & (b >= SAME), "score": F.greatest("iou", F.least("share", "other_share"))})


def polygon_overlaps(spark, sf):
    """Planning and mapped polygons whose boxes overlap: the lattice points in both, shares, and whether they match or are the same."""
    return _overlaps(spark, sf).select("s_suppkey", "p_partkey", "samples", half_up(F.col("share"), 4).alias("share"), half_up(F.col("other_share"), 4).alias("other_share"), half_up(F.col("iou"), 4).alias("iou"), "matched", "equivalent")


def inherited_evidence(spark, sf):
    """What each planning polygon does: it replaces all mapped polygons that match, and takes a missing name, missing tags and a missing height from the best of them; without one it fills a gap."""
    m = _overlaps(spark, sf).where("matched").select("s_suppkey", "p_partkey", half_up(F.col("score"), 6).alias("score"))
    targets = m.groupBy("s_suppkey").agg(F.count("*").alias("n_targets"), F.sum("p_partkey").alias("targets_sum"))
    best = first_per_key(m, ["s_suppkey"], [F.desc("score"), F.col("p_partkey")]).join(targets, "s_suppkey").join(_t(spark, sf, "part").select("p_partkey", "p_name", "p_brand"), "p_partkey")
    k = F.col("s_suppkey")
    own = _t(spark, sf, "supplier").select("s_suppkey", F.when(F.pmod(k, F.lit(3)) == 0, F.col("s_name")).alias("own_name"), F.when(F.pmod(k, F.lit(4)) == 0, F.create_map(F.lit("surface"), F.lit("paved"))).otherwise(F.create_map(F.lit("ref"), k.cast("string"))).alias("own_tags"), F.when(F.pmod(k, F.lit(5)) == 0, 9.5).alias("own_height"))
    j = own.join(best, "s_suppkey", "left")
    found = F.col("p_partkey").isNotNull()
    old = F.when(found, F.create_map(F.lit("surface"), F.col("p_brand"), F.lit("ref"), F.lit("mapped"), F.lit("source"), F.lit("map"))).otherwise(F.create_map().cast("map<string,string>"))
    # new values win
    entries = F.concat(F.map_entries(F.map_filter(old, lambda key, _: ~F.array_contains(F.map_keys("own_tags"), key))), F.map_entries("own_tags"))
    tags = F.array_join(F.array_sort(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"]))), ";")
    height = F.when(found, F.pmod("p_partkey", F.lit(30)) + 2.5)
    return j.select(
        "s_suppkey", F.when(found, "replaced").otherwise("gap-fill").alias("action"), F.coalesce("n_targets", F.lit(0)).cast("bigint").alias("n_targets"), F.coalesce("targets_sum", F.lit(0)).cast("bigint").alias("targets_sum"), F.coalesce("own_name", "p_name", F.lit("")).alias("name"), tags.alias("tags"),
        F.coalesce("own_height", height, F.lit(-1.0)).alias("height_m"), F.when(F.col("own_height").isNotNull(), "own").when(found, "retained").otherwise("none").alias("height_source"),
    )


def replaced_features(spark, sf):
    """Features that name another one which they replace: what was found goes, and misses are counted, by brand."""
    p = _t(spark, sf, "part").select("p_partkey", "p_brand", F.when(F.pmod("p_partkey", F.lit(7)) == 1, F.pmod(F.col("p_partkey") * 31, F.lit(5000))).alias("replaces"))
    asked = p.where("replaces IS NOT NULL").select("p_brand", F.col("replaces").alias("target"))
    hit = asked.join(p.select(F.col("p_partkey").alias("target"), F.lit(1).alias("hit")), "target", "left")
    gone = asked.select(F.col("target").alias("p_partkey")).distinct()
    left = p.join(gone, "p_partkey", "left_anti").groupBy("p_brand").agg(F.count("*").alias("left"))
    told = hit.groupBy("p_brand").agg(F.count("hit").alias("replaced"), F.count_if(F.col("hit").isNull()).alias("missing"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return p.select("p_brand").distinct().join(left, "p_brand", "left").join(told, "p_brand", "left").select("p_brand", *(zero(c) for c in ("left", "replaced", "missing")))


ROLES = ("guest", "guest", "service", "guest", "queue")
DIRECTIONS = ((6, 0), (0, 6), (4, 4), (5, -3))
#: Metres: the reach of a connector, the nearest foreign vertex, and the step at which it is tested for blockers.
REACH, NEAR, STEP = 2.5, 0.75, 0.5


def path_connectors(spark, sf):
    """A connector for each loose path end: the best compatible segment within reach that it runs on to, claimed once, inside the boundary and clear of buildings and water, with its confidence; else why there is none."""
    k = F.col("p_partkey")
    way = lambda axis: F.element_at(F.array(*(F.lit(d[axis]) for d in DIRECTIONS)), (F.pmod(k, F.lit(4)) + 1).cast("int"))
    x, y = (k * 3).cast("double"), F.pmod(k * 53, F.lit(50)).cast("double")
    paths = _t(spark, sf, "part").select("p_partkey", x.alias("ax"), y.alias("ay"), (x + way(0)).alias("bx"), (y + way(1)).alias("by"), R.dealt(k, ROLES, 4).alias("role"), (F.pmod(k, F.lit(7)) == 0).alias("layer"), F.col("p_brand").alias("surface"))
    ends = paths.select("p_partkey", "role", "layer", "surface", F.explode(F.array(*(F.struct(F.lit(e).alias("side"), F.col(f"{p}x").alias("x"), F.col(f"{p}y").alias("y"), (F.col(f"{p}x") - F.col(f"{q}x")).alias("ox"), (F.col(f"{p}y") - F.col(f"{q}y")).alias("oy")) for e, p, q in ((0, "a", "b"), (1, "b", "a"))))).alias("e")).select("p_partkey", "role", "layer", "surface", "e.*")
    vertices = ends.select(F.col("p_partkey").alias("p2"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    close = (F.pow(F.col("x") - F.col("x2"), 2) + F.pow(F.col("y") - F.col("y2"), 2) <= NEAR * NEAR) & (F.col("p_partkey") != F.col("p2"))
    tied = P.grid_join(ends, vertices, 1.0, near=close)
    links = tied.select(F.col("p_partkey").alias("u"), F.col("p2").alias("v"))
    groups = paths.select("p_partkey").join(large(connected_components(links, grows=True).withColumnRenamed("node", "p_partkey")), "p_partkey", "left").select("p_partkey", F.coalesce("component", "p_partkey").alias("component"))
    loose = ends.join(large(tied.select("p_partkey", "side").distinct()), ["p_partkey", "side"], "left_anti").join(large(groups), "p_partkey")
    size = 8.0
    grown = [F.least("ax", "bx") - REACH, F.least("ay", "by") - REACH, F.greatest("ax", "bx") + REACH, F.greatest("ay", "by") + REACH]
    segments = paths.join(large(groups), "p_partkey").select(F.col("p_partkey").alias("p2"), "ax", "ay", "bx", "by", F.col("role").alias("role2"), F.col("layer").alias("layer2"), F.col("surface").alias("surface2"), F.col("component").alias("component2"), F.explode(P.cells_of_box(*grown, size)).alias("cell"))
    pairs = loose.withColumn("cell", F.struct(F.floor(F.col("x") / size).alias("cx"), F.floor(F.col("y") / size).alias("cy"))).join(large(segments), "cell").where("p_partkey <> p2 AND layer = layer2 AND role = role2")
    t = G.nearest_share(*(F.col(c) for c in ("x", "y", "ax", "ay", "bx", "by")))
    pairs = pairs.withColumn("t", t).withColumns({"nx": F.col("ax") + F.col("t") * (F.col("bx") - F.col("ax")), "ny": F.col("ay") + F.col("t") * (F.col("by") - F.col("ay"))})
    pairs = pairs.withColumns({"dx": F.col("nx") - F.col("x"), "dy": F.col("ny") - F.col("y")}).withColumn("d", F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy"))).where(f"d >= 0.2 AND d <= {REACH}")
    goes_on = (F.col("ox") * F.col("dx") + F.col("oy") * F.col("dy")) / (F.sqrt(F.col("ox") * F.col("ox") + F.col("oy") * F.col("oy")) * F.col("d"))
    pairs = pairs.withColumns({"goes_on": half_up(goes_on, 9), "d": half_up(F.col("d"), 9), "joins": (F.col("component") != F.col("component2")).cast("int")}).where("goes_on >= -0.15")
    best = first_per_key(pairs, ["p_partkey", "side"], [F.desc("joins"), F.col("d"), F.desc("goes_on"), F.col("p2")])
    # an end's claims come in the order of paths and ends: first on the pair and target, then on the geometry
    key = lambda x, y, step: F.concat_ws(",", F.floor(x / step + 0.5).cast("bigint").cast("string"), F.floor(y / step + 0.5).cast("bigint").cast("string"))
    pair_key = F.concat_ws("|", F.least("p_partkey", "p2").cast("string"), F.greatest("p_partkey", "p2").cast("string"), key(F.col("nx"), F.col("ny"), 0.5))
    here, there = key(F.col("x"), F.col("y"), 0.25), key(F.col("nx"), F.col("ny"), 0.25)
    claimed = first_per_key(best.withColumn("pair_key", pair_key), ["pair_key"], [F.col("p_partkey"), F.col("side")])
    claimed = first_per_key(claimed.withColumns({"g1": F.least(here, there), "g2": F.greatest(here, there)}), ["g1", "g2"], [F.col("p_partkey"), F.col("side")])
    within = lambda x, y: (y >= 1.0) & (y < 49.0) & (x >= 30.0)
    in_park = within(F.col("x"), F.col("y")) & within(F.col("nx"), F.col("ny")) & within((F.col("x") + F.col("nx")) / 2, (F.col("y") + F.col("ny")) / 2)
    sites = _sites(spark, sf).select("s_suppkey", "rings", F.explode(P.cells_of_box(*(F.col(c) for c in ("x0", "y0", "x1", "y1")), 16.0)).alias("cell"))
    steps = F.greatest(F.lit(2), F.ceil(F.col("d") / STEP).cast("int"))
    samples = claimed.select("p_partkey", "side", F.explode(F.transform(F.sequence(F.lit(1), steps - 1), lambda i: F.struct(i.alias("i"), (F.col("x") + F.col("dx") * i / steps).alias("sx"), (F.col("y") + F.col("dy") * i / steps).alias("sy")))).alias("s")).select("p_partkey", "side", "s.*")
    samples = samples.withColumn("cell", F.struct(F.floor(F.col("sx") / 16.0).alias("cx"), F.floor(F.col("sy") / 16.0).alias("cy")))
    blocked = samples.join(large(sites), "cell").where(G.inside_rings(F.col("rings"), F.col("sx"), F.col("sy"))).groupBy("p_partkey", "side").agg(F.min_by("s_suppkey", F.struct("i", "s_suppkey")).alias("blocker"))
    same = F.col("surface") == F.col("surface2")
    sure = F.least(F.lit(0.96), 0.62 + 0.2 * F.greatest(F.lit(0.0), 1 - F.col("d") / REACH) + 0.06 * F.greatest(F.lit(0.0), F.col("goes_on")) + 0.04 + F.when(same, 0.02).otherwise(0.0) + 0.06 * F.col("joins"))
    status = F.when(~in_park, "outside-park-boundary").when(F.col("blocker").isNotNull(), F.when(F.pmod("blocker", F.lit(2)) == 0, "crosses-water").otherwise("crosses-building")).when(half_up(sure, 3) >= 0.8, "accepted").otherwise("review")
    out = claimed.join(large(blocked), ["p_partkey", "side"], "left").select("p_partkey", "side", "p2", status.alias("status"), F.when(status.isin("accepted", "review"), half_up(sure, 3)).otherwise(0.0).alias("confidence"))
    rest = ends.select("p_partkey", "side").join(large(claimed.select("p_partkey", "side")), ["p_partkey", "side"], "left_anti")
    rest = rest.join(large(tied.select("p_partkey", "side").distinct().withColumn("tie", F.lit(True))), ["p_partkey", "side"], "left").join(large(best.select("p_partkey", "side", F.lit(True).alias("found"))), ["p_partkey", "side"], "left")
    return out.unionByName(rest.select("p_partkey", "side", F.lit(-1).cast("bigint").alias("p2"), F.coalesce(F.when(F.col("tie"), "already-connected-or-coincident"), F.when(F.col("found"), "duplicate-connector"), F.lit("no-compatible-route-within-tolerance")).alias("status"), F.lit(0.0).alias("confidence")))


# -- drawings ------------------------------------------------------------------------------------------------------

NOTES = ("Retaining wall 2.5m wide", "Proposed footbridge", "Raised walkway timber", "FFL 132.50 building", "Tarmac path width 3 m", "New pond", "Fence line", "Tree planting", "Existing level 98.25", "Ride layout", "Culvert", "Rock face", "Block paving plaza 4m wide", "plain", "")
#: Classes of labels in order with their priority; materials in order.
CLASSES = (
    (r"\b(tunnel|underpass|subway|culvert)\b", "tunnel", 100), (r"\b(footbridge|bridge|boardwalk|raised walkway|raised path|elevated walkway|elevated path|deck)\b", "bridge", 98),
    (r"\b(roller ?coaster|coaster|ride layout|ride track|track alignment|ride footprint|attraction layout)\b", "ride", 96), (r"\b(retaining wall|boundary wall|screen wall|wall)\b", "wall", 94),
    (r"\b(fence|fencing|railing|railings|balustrade|guard ?rail)\b", "fence", 91), (r"\b(pond|lake|water body|waterbody|watercourse|stream|channel|basin|lagoon|pool|ditch|swale)\b", "water", 90),
    (r"\b(rockwork|boulder|boulders|rock outcrop|rock face|gabion|rocks?)\b", "rock", 88), (r"\b(tree|trees|tree planting|planting|hedge|hedgerow|shrub|shrubs|woodland)\b", "vegetation", 86),
    (r"\b(contour|earthworks|embankment|cutting|slope|mound|bund|ground level|proposed level|existing level|finished floor level|ffl|spot level|levels?)\b", "terrain", 84),
    (r"\b(building|station building|ride station|kiosk|restaurant|cafe|toilet|shop|maintenance|plant room|control room|operator cabin|service building)\b", "building", 82),
    (r"\b(path|footpath|walkway|plaza|paving|hardstanding|pedestrian|queue|circulation|access route|access path|footway)\b", "path", 80),
)
MATERIALS = ((r"\b(tarmac|asphalt|bitmac)\b", "asphalt"), (r"\bresin(?: bound| bonded)?\b", "resin"), (r"\b(block paving|pavers?|paving slabs?|flagstones?|flags)\b", "paving_stones"), (r"\bconcrete\b", "concrete"), (r"\bgravel|hoggin|self binding gravel\b", "gravel"), (r"\b(timber|wood|boardwalk)\b", "wood"), (r"\bcobble(?:stone)?s?\b", "cobblestone"), (r"\bbrick\b", "brick"), (r"\bstone\b", "stone"))
#: The candidate's role for an open and for a closed shape of each class.
SHAPE_ROLES = {
    "path": ("site-path-centerline-candidate", "site-path-surface-candidate"), "bridge": ("site-bridge-centerline-candidate", "site-bridge-surface-candidate"), "tunnel": ("site-tunnel-centerline-candidate", "site-tunnel-surface-candidate"),
    "ride": ("ride-centerline-candidate", "ride-footprint-candidate"), "building": (None, "site-building-footprint-candidate"), "wall": ("site-wall-candidate", "site-wall-footprint-candidate"), "fence": ("site-fence-candidate", "site-fence-footprint-candidate"),
    "water": ("site-watercourse-candidate", "site-water-body-candidate"), "vegetation": ("site-vegetation-boundary-candidate", "site-vegetation-area-candidate"), "rock": ("site-rock-line-candidate", "site-rock-area-candidate"), "terrain": ("site-terrain-change-line-candidate", "site-terrain-change-area-candidate"),
}
LEVEL = r"(?:\bffl\b|\brl\b|\blevel\b|\blvl\b|proposed level|existing level|spot level)\s*[:=+]?\s*(\d{1,3}(?:\.\d{1,3})?)"
WIDTHS = (r"(\d+(?:\.\d+)?)\s*m\s*(?:wide|width)", r"(?:width|wide)\s*[:=]?\s*(\d+(?:\.\d+)?)\s*m\b")


def semantic_labels(spark, sf):
    """Labels of drawings: class, priority, vertical relation, material, level, width, and the role of an open or closed shape that carries one."""
    k = F.col("p_partkey")
    p = _t(spark, sf, "part").select("p_partkey", F.trim(F.lower(F.concat_ws(" ", R.dealt(k, NOTES), F.when(F.pmod(k, F.lit(4)) == 0, F.col("p_name")).otherwise("")))).alias("text"), (F.pmod(k, F.lit(2)) == 0).alias("closed"))
    kind = R.first_match(F.col("text"), CLASSES)
    number = lambda pattern, low, high: (lambda v: F.when((v > low) & (v <= high), v))(F.regexp_extract("text", pattern, 1).try_cast("double"))
    table = lambda at: F.create_map(*[F.lit(x) for c, roles in SHAPE_ROLES.items() for x in (c, roles[at] or "")])
    p = p.withColumns({"class": kind, "priority": R.first_match(F.col("text"), CLASSES, value=2)}).where("class IS NOT NULL")
    vertical = F.when(F.col("class") == "tunnel", "tunnel").when(F.col("class") == "bridge", F.when(F.rlike("text", F.lit("raised|elevated")), "raised").otherwise("bridge")).when((F.col("class") == "wall") & F.rlike("text", F.lit("retaining")), "retaining")
    return p.select(
        "p_partkey", "class", "priority", F.coalesce(vertical, F.lit("")).alias("vertical"), F.coalesce(R.first_match(F.col("text"), MATERIALS), F.lit("")).alias("material"), F.coalesce(number(LEVEL, 9.999999, 500), F.lit(-1.0)).alias("level_m"),
        F.coalesce(F.when(F.regexp_extract("text", WIDTHS[0], 1) != "", number(WIDTHS[0], 0.2, 50)).otherwise(number(WIDTHS[1], 0.2, 50)), F.lit(-1.0)).alias("width_m"), F.when(F.col("closed"), table(1)[F.col("class")]).otherwise(table(0)[F.col("class")]).alias("role"),
    )


DRAWN = ("ride-layout", "access-plan", "landscape-plan", "terrain-or-drainage", "floor-plan", "site-plan", "lighting-plan", "elevation", "block-plan")
#: Roles of drawings whose lines and whose areas count, and the candidates' roles by that of the drawing (open, closed).
LINE_ROLES = ("ride-layout", "access-plan", "terrain-or-drainage", "lighting-plan", "site-plan", "block-plan", "landscape-plan")
AREA_ROLES = ("site-plan", "block-plan", "landscape-plan", "ride-layout", "floor-plan", "terrain-or-drainage", "access-plan", "lighting-plan")
CANDIDATES = {
    "ride-layout": ("ride-centerline-candidate", "ride-footprint-candidate"), "access-plan": ("access-path-centerline-candidate", "access-surface-candidate"), "landscape-plan": ("landscape-boundary-candidate", "landscape-polygon-candidate"),
    "terrain-or-drainage": ("drainage-or-contour-line-candidate", "terrain-or-drainage-polygon-candidate"), "floor-plan": ("building-detail-line-candidate", "building-footprint-candidate"), "site-plan": ("site-plan-linear-candidate", "site-or-building-footprint-candidate"),
    "block-plan": ("site-plan-linear-candidate", "site-or-building-footprint-candidate"), "lighting-plan": ("lighting-layout-line-candidate", "lighting-area-candidate"),
}
PAGE = (842.0, 595.0)


def shape_candidates(spark, sf):
    """Shapes on registered drawings: page frames, small ones and those of other roles are withheld with the reason; the rest get a role, length, area and confidence."""
    k = F.col("o_orderkey")
    w, h = (F.pmod(k * 13, F.lit(840)) + 1).cast("double"), (F.pmod(k * 29, F.lit(590)) + 1).cast("double")
    x, y = F.pmod(k, F.lit(50)).cast("double"), F.pmod(k * 3, F.lit(40)).cast("double")
    points = F.array(G.point(x, y), G.point(x + w, y), G.point(x + w, y + h), G.point(x, y + h))
    o = _t(spark, sf, "orders").select("o_orderkey", points.alias("page"), w.alias("w"), h.alias("h"), (F.pmod(k, F.lit(2)) == 0).alias("closed"), R.dealt(k, DRAWN, 5).alias("role"), R.dealt(k, ("approved", "proposed", "as-built"), 7).alias("state"), R.dealt(k, ("approved", "unknown", "granted", "refused"), 3).alias("status"), (F.pmod(k, F.lit(30)) / 10.0).alias("rmse"))
    # page points to metres on the ground: a scale of 0.1 and a turn
    o = o.withColumn("ground", F.transform("page", lambda p: G.point(0.08 * p["x"] - 0.06 * p["y"] + 400000, 0.06 * p["x"] + 0.08 * p["y"] + 350000)))
    o = o.withColumns({"length_m": half_up(G.length(F.col("ground")), 2), "area_m2": F.when(F.col("closed"), half_up(F.abs(G.signed_area(F.col("ground"))), 2)).otherwise(0.0)})
    frame = F.col("closed") & (F.col("w") >= PAGE[0] * 0.92) & (F.col("h") >= PAGE[1] * 0.92)
    small = (~F.col("closed") & (F.col("length_m") < 20)) | (F.col("closed") & (F.col("area_m2") < 60))
    reason = F.when(frame, "page-frame").when(small, "below-size-threshold").when(F.col("closed") & ~F.col("role").isin(*AREA_ROLES), "role-not-polygon-eligible").when(~F.col("closed") & ~F.col("role").isin(*LINE_ROLES), "role-not-line-eligible").otherwise("")
    table = lambda at: F.create_map(*[F.lit(x) for r, c in CANDIDATES.items() for x in (r, c[at])])
    role = F.when(F.col("closed"), F.coalesce(table(1)[F.col("role")], F.lit("unknown-polygon-candidate"))).otherwise(F.coalesce(table(0)[F.col("role")], F.lit("unknown-linear-candidate")))
    sure = 0.52 + F.when(F.col("state").isin("approved", "as-built"), 0.1).otherwise(0.0) + F.when(F.col("status").isin("approved", "implemented", "granted"), 0.08).otherwise(0.0) + F.when(F.col("role").isin("ride-layout", "access-plan", "floor-plan", "landscape-plan"), 0.08).otherwise(0.0) + F.greatest(F.lit(0.0), 0.1 - F.col("rmse") * 0.025) + F.when((F.col("length_m") > 10) | (F.col("area_m2") > 25), 0.02).otherwise(0.0)
    return o.select("o_orderkey", reason.alias("withheld"), F.when(reason == "", role).otherwise("").alias("candidate"), "length_m", "area_m2", F.when(reason == "", F.least(F.lit(0.94), half_up(sure + 1e-9, 3))).otherwise(0.0).alias("confidence"))


def curve_lengths(spark, sf):
    """Curves of drawings flattened to lines: steps and lengths of cubic and quadratic ones."""
    k = F.col("c_custkey")
    at = lambda a, b: G.point(F.pmod(k * a, F.lit(97)).cast("double"), F.pmod(k * b, F.lit(89)).cast("double"))
    c = spread(_t(spark, sf, "customer").select("c_custkey"), "c_custkey").select("c_custkey", *(at(a, b).alias(f"p{i}") for i, (a, b) in enumerate(((3, 5), (7, 11), (13, 17), (19, 23)))))
    cubic, quadratic = ([F.col(f"p{i}") for i in range(n)] for n in (4, 3))
    c = c.withColumns({"cubic_steps": G.curve_steps(cubic, 2.0), "quadratic_steps": G.curve_steps(quadratic, 2.0)})
    c = c.withColumns({"cubic": G.curve(cubic, F.col("cubic_steps")), "quadratic": G.curve(quadratic, F.col("quadratic_steps"))})
    return c.select("c_custkey", "cubic_steps", half_up(G.length(F.col("cubic")), 3).alias("cubic_length"), "quadratic_steps", half_up(G.length(F.col("quadratic")), 3).alias("quadratic_length"))


def affine_checks(spark, sf):
    """The affine fit of each supplier's control points with its root mean square error, and the first check that it fails."""
    rows = _t(spark, sf, "lineitem").select("l_suppkey", F.col("l_quantity").cast("double").alias("x"), (F.col("l_linenumber") * 9.0).alias("y"), F.pmod("l_orderkey", F.lit(5)).cast("double").alias("o"))
    spread = F.pmod("l_suppkey", F.lit(7)).cast("double")
    rows = rows.withColumns({"e": F.col("x") * 3 + F.col("y") * 0.5 * spread + F.col("o") * 0.4 * F.pmod("l_suppkey", F.lit(3)), "n": F.col("y") * 3 - F.col("x") * 0.25 * spread + F.col("o") * 0.3})
    s = lambda a, b=None: F.sum(F.col(a) * F.col(b) if b else F.col(a))
    g = rows.groupBy("l_suppkey").agg(F.count("*").cast("double").alias("k"), *(s(a).alias(f"s{a}") for a in "xyen"), *(s(a, b).alias(a + b) for a, b in ("xx", "xy", "yy", "xe", "ye", "xn", "yn", "ee", "nn")))
    det = "(xx*(yy*k-sy*sy)-xy*(xy*k-sy*sx)+sx*(xy*sy-yy*sx))"
    solve = lambda p, q, r: (f"({p}*(yy*k-sy*sy)-xy*({q}*k-sy*{r})+sx*({q}*sy-yy*{r}))/{det}", f"(xx*({q}*k-sy*{r})-{p}*(xy*k-sy*sx)+sx*(xy*{r}-{q}*sx))/{det}", f"(xx*(yy*{r}-sy*{q})-xy*(xy*{r}-sx*{q})+{p}*(xy*sy-yy*sx))/{det}")
    fit = g.where(F.expr(f"k >= 3 AND abs({det}) > 1e-6")).selectExpr("*", *(f"{f} AS {n}" for n, f in zip("abc", solve("xe", "ye", "se"), strict=True)), *(f"{f} AS {n}" for n, f in zip("dfg", solve("xn", "yn", "sn"), strict=True)))
    # the residuals' squares from the sums alone
    left = lambda p, q, r, one, two, total: f"({total} - ({p}*{one} + {q}*{two} + {r}*s{total[0]}))"
    fit = fit.withColumn("rmse", F.expr(f"sqrt(greatest(0, {left('a', 'b', 'c', 'xe', 'ye', 'ee')} + {left('d', 'f', 'g', 'xn', 'yn', 'nn')}) / k)")).withColumns({"x_scale": F.expr("sqrt(a*a + d*d)"), "y_scale": F.expr("sqrt(b*b + f*f)")})
    skew = F.expr("abs(a*b + d*f) / greatest(1e-9, x_scale*y_scale)")
    check = (
        F.when(half_up(F.col("rmse"), 3) > 1.0, "control-point-rmse-exceeds-limit").when(F.expr("least(x_scale, y_scale) < 0.005 OR greatest(x_scale, y_scale) > 20"), "implausible-drawing-scale")
        .when(F.expr("greatest(x_scale, y_scale) / greatest(1e-9, least(x_scale, y_scale)) > 5"), "anisotropic-scale-exceeds-limit").when(skew > 0.35, "affine-axes-too-skewed").when(F.expr("abs(a*f - b*d) < 1e-6"), "degenerate-affine-transform").otherwise("accepted")
    )
    r3 = lambda c: (half_up(F.col(c), 3) + 0.0).alias(c)
    return fit.select("l_suppkey", r3("a"), r3("b"), r3("d"), F.col("f").alias("e")).withColumn("e", half_up(F.col("e"), 3)).join(fit.select("l_suppkey", r3("rmse"), check.alias("verdict")), "l_suppkey")


def grid_coordinates(spark, sf):
    """Customers' points on the British National Grid, in centimetres."""
    k = F.col("c_custkey")
    c = _t(spark, sf, "customer").select("c_custkey", (F.lit(-5.0) + F.pmod(k * 7919, F.lit(60000)) / 10000.0).alias("lon"), (F.lit(50.0) + F.pmod(k * 104729, F.lit(80000)) / 10000.0).alias("lat"))
    e, n = G.british_grid(F.col("lon"), F.col("lat"))
    return c.select("c_custkey", half_up(e, 2).alias("easting"), half_up(n, 2).alias("northing"))


def extent_gate(spark, sf):
    """Registered extents against the area that is built: too large, outside, hardly overlapping, or accepted."""
    k = F.col("s_suppkey")
    s = _t(spark, sf, "supplier").select("s_suppkey", (F.lit(52.9) + F.pmod(k * 37, F.lit(150)) / 1000.0).alias("south"), (F.lit(-2.0) + F.pmod(k * 53, F.lit(200)) / 1000.0).alias("west"), (F.pmod(k, F.lit(50)) / 1000.0).alias("high"), (F.pmod(k, F.lit(70)) / 1000.0).alias("wide"))
    s = s.withColumns({"north": F.col("south") + F.col("high"), "east": F.col("west") + F.col("wide")})
    box = {"south": 52.98, "west": -1.90, "north": 53.0, "east": -1.87}
    i = [F.greatest("south", F.lit(box["south"])), F.greatest("west", F.lit(box["west"])), F.least("north", F.lit(box["north"])), F.least("east", F.lit(box["east"]))]
    own, whole = G.area_km2(*(F.col(c) for c in ("south", "west", "north", "east"))), G.area_km2(*(F.lit(box[c]) for c in ("south", "west", "north", "east")))
    overlap = G.area_km2(*i) / F.greatest(F.lit(1e-9), F.least(own, whole))
    reason = F.when(half_up(own, 9) <= 0, "invalid-georeferenced-extent").when(own > 25, "georeferenced-extent-exceeds-area-limit").when((i[1] >= i[3]) | (i[0] >= i[2]), "georeferenced-extent-outside-build-geofence").when(overlap < 0.02, "geofence-overlap-below-two-percent").otherwise("accepted")
    return s.select("s_suppkey", reason.alias("verdict"), half_up(own, 4).alias("area_km2"))


QUERIES = {f.__name__: f for f in (polygon_overlaps, inherited_evidence, replaced_features, path_connectors, semantic_labels, shape_candidates, curve_lengths, affine_checks, grid_coordinates, extent_gate)}

_D = R.sql_dealt
_R = lambda x, n: f"floor(({x}) * 1e{n} + 0.5) / 1e{n}"
_SITES = f"SELECT s_suppkey, s_name, {G.sql_ring('s_suppkey * 60', 's_suppkey * 37 % 5 * 10', OUTER)} AS outer_ring, CASE WHEN s_suppkey % 2 = 0 THEN {G.sql_ring('s_suppkey * 60', 's_suppkey * 37 % 5 * 10', HOLE)} END AS hole, s_suppkey * 60 - 12.0 AS x0, s_suppkey * 37 % 5 * 10 - 12.0 AS y0, s_suppkey * 60 + 12.0 AS x1, s_suppkey * 37 % 5 * 10 + 12.0 AS y1 FROM supplier"
_MAPPED = "SELECT *, [{'x': (x - r)::DOUBLE, 'y': y::DOUBLE}, {'x': x::DOUBLE, 'y': (y - r)::DOUBLE}, {'x': (x + r)::DOUBLE, 'y': y::DOUBLE}, {'x': x::DOUBLE, 'y': (y + r)::DOUBLE}] AS ring, (x - r)::DOUBLE AS bx0, (y - r)::DOUBLE AS by0, (x + r)::DOUBLE AS bx1, (y + r)::DOUBLE AS by1 FROM (SELECT p_partkey, p_name, p_brand, p_partkey * 3 AS x, p_partkey * 53 % 50 AS y, p_partkey % 9 + 4 AS r FROM part)"
_IN_SITE = lambda x, y: f"({G.sql_inside('outer_ring', x, y)} AND NOT coalesce({G.sql_inside('hole', x, y)}, false))"
_OVERLAPS = f"""
o AS (SELECT s_suppkey, p_partkey, p_name, p_brand, s_name, outer_ring, hole, ring, greatest(x0, bx0) AS ox, greatest(y0, by0) AS oy, (least(x1, bx1) - greatest(x0, bx0))::DOUBLE AS wide, (least(y1, by1) - greatest(y0, by0))::DOUBLE AS high,
abs({G.sql_signed_area('outer_ring')}) - coalesce(abs({G.sql_signed_area('hole')}), 0) AS area, abs({G.sql_signed_area('ring')}) AS other FROM ({_SITES}) s JOIN ({_MAPPED}) m ON x0 < bx1 AND bx0 < x1 AND y0 < by1 AND by0 < y1),
l AS (SELECT *, greatest(0.5, least(3.0, sqrt(wide * high / 4000)))::DOUBLE AS spacing FROM o), li AS (SELECT *, unnest(range(0, greatest(1, ceil(wide / spacing - 0.5)::BIGINT))) AS i FROM l),
lj AS (SELECT *, unnest(range(0, greatest(1, ceil(high / spacing - 0.5)::BIGINT))) AS j FROM li), pt AS (SELECT *, (ox + spacing * (i + 0.5))::DOUBLE AS px, (oy + spacing * (j + 0.5))::DOUBLE AS py FROM lj),
h AS (SELECT s_suppkey, p_partkey, any_value(p_name) AS p_name, any_value(p_brand) AS p_brand, any_value(area) AS area, any_value(other) AS other, any_value(spacing) AS spacing, count(*) FILTER ({_IN_SITE('px', 'py')} AND {G.sql_inside('ring', 'px', 'py')}) AS samples FROM pt GROUP BY 1, 2),
v AS (SELECT *, samples * spacing * spacing AS shared FROM h), u AS (SELECT *, least(1.0, shared / area) AS share, least(1.0, shared / other) AS other_share, least(1.0, shared / (area + other - shared)) AS iou FROM v),
z AS (SELECT *, greatest(share, other_share, iou) >= {LEAST} AS matched, share >= {SAME} AND other_share >= {SAME} AS equivalent, greatest(iou, least(share, other_share)) AS score FROM u)"""
_WAY = lambda axis: f"([{', '.join(str(d[axis]) for d in DIRECTIONS)}])[p_partkey % 4 + 1]"
_KEY = lambda x, y, step: f"floor({x} / {step} + 0.5)::BIGINT || ',' || floor({y} / {step} + 0.5)::BIGINT"
_WITHIN = lambda x, y: f"(({y}) >= 1.0 AND ({y}) < 49.0 AND ({x}) >= 30.0)"
_SURE = f"least(0.96, 0.62 + 0.2 * greatest(0.0, 1 - d / {REACH}) + 0.06 * greatest(0.0, goes_on) + 0.04 + CASE WHEN surface = surface2 THEN 0.02 ELSE 0.0 END + 0.06 * joins)"
_NUM = lambda pattern, low, high: f"(SELECT CASE WHEN n > {low} AND n <= {high} THEN n END FROM (SELECT try_cast(regexp_extract(text, '{pattern}', 1) AS DOUBLE) AS n))"
_SHAPE = lambda at: "CASE class " + " ".join(f"WHEN '{c}' THEN '{r[at] or ''}'" for c, r in SHAPE_ROLES.items()) + " END"
_CAND = lambda at, rest: "CASE role " + " ".join(f"WHEN '{c}' THEN '{r[at]}'" for c, r in CANDIDATES.items()) + f" ELSE '{rest}' END"
_IN = lambda values: "(" + ", ".join(map(R.quoted, values)) + ")"


def _sql_curve(n: int) -> str:
    weights = (1, 3, 3, 1) if n == 4 else (1, 2, 1)
    low, high = (4, 128) if n == 4 else (3, 96)
    steps = f"greatest({low}, least({high}, ceil(({' + '.join(f'sqrt(pow(p{i + 1}.x - p{i}.x, 2) + pow(p{i + 1}.y - p{i}.y, 2))' for i in range(n - 1))}) / 2.0)::INTEGER))"
    axis = lambda a: " + ".join(f"{w} * pow(1 - i / {steps}, {n - 1 - k}) * pow(i / {steps}, {k}) * p{k}.{a}" for k, w in enumerate(weights))
    return f"{steps}, list_transform(range(0, {steps} + 1), lambda i: {{'x': {axis('x')}, 'y': {axis('y')}}})"


def _sql_grid() -> str:
    rad = 3.141592653589793 / 180
    a, b = G.WGS84
    e2 = 1 - b * b / (a * a)
    rx, ry, rz = (G.SHIFT[k] * rad / 3600 for k in ("rx", "ry", "rz"))
    sc = 1 + G.SHIFT["s"] * 1e-6
    a2, b2 = G.AIRY
    f2, n = 1 - b2 * b2 / (a2 * a2), (a2 - b2) / (a2 + b2)
    fs = G.GRID["f"]
    lat0, lon0 = G.GRID["lat"] * rad, G.GRID["lon"] * rad
    turns = ", ".join(f"t{i} AS (SELECT *, atan2(z2 + {f2!r} * ({a2!r} / sqrt(1 - {f2!r} * sin(v{i - 1}) * sin(v{i - 1}))) * sin(v{i - 1}), flat) AS v{i} FROM t{i - 1})" for i in range(1, 13))
    return f"""
WITH c AS (SELECT c_custkey, (-5.0 + (c_custkey * 7919 % 60000) / 10000.0) * {rad!r} AS lam, (50.0 + (c_custkey * 104729 % 80000) / 10000.0) * {rad!r} AS phi FROM customer),
x AS (SELECT *, {a!r} / sqrt(1 - {e2!r} * sin(phi) * sin(phi)) AS nu FROM c), y AS (SELECT c_custkey, nu * cos(phi) * cos(lam) AS x, nu * cos(phi) * sin(lam) AS y, {1 - e2!r} * nu * sin(phi) AS z FROM x),
h AS (SELECT c_custkey, {G.SHIFT['tx']} + x * {sc!r} - y * ({rz!r}) + z * ({ry!r}) AS x2, {G.SHIFT['ty']} + x * ({rz!r}) + y * {sc!r} - z * ({rx!r}) AS y2, {G.SHIFT['tz']} - x * ({ry!r}) + y * ({rx!r}) + z * {sc!r} AS z2 FROM y),
p AS (SELECT *, sqrt(x2 * x2 + y2 * y2) AS flat FROM h), t0 AS (SELECT *, atan2(z2, flat * {1 - f2!r}) AS v0 FROM p), {turns},
g AS (SELECT c_custkey, v12 AS phi, sin(v12) AS s, cos(v12) AS c, tan(v12) * tan(v12) AS t2, atan2(y2, x2) - ({lon0!r}) AS l, v12 - {lat0!r} AS d, v12 + {lat0!r} AS m, 1 - {f2!r} * sin(v12) * sin(v12) AS root FROM t12),
q AS (SELECT *, {a2 * fs!r} / sqrt(root) AS nu, {a2 * fs * (1 - f2)!r} / pow(root, 1.5) AS rho FROM g), e AS (SELECT *, nu / rho - 1 AS eta FROM q)
SELECT c_custkey, {_R(f"{G.GRID['east']} + nu * c * l + nu / 6 * pow(c, 3) * (nu / rho - t2) * pow(l, 3) + nu / 120 * pow(c, 5) * (5 - 18 * t2 + t2 * t2 + 14 * eta - 58 * t2 * eta) * pow(l, 5)", 2)} AS easting,
{_R(f"{b2 * fs!r} * ({1 + n + 1.25 * n**2 + 1.25 * n**3!r} * d - {3 * n + 3 * n**2 + 2.625 * n**3!r} * sin(d) * cos(m) + {1.875 * n**2 + 1.875 * n**3!r} * sin(2 * d) * cos(2 * m) - {35 / 24 * n**3!r} * sin(3 * d) * cos(3 * m)) + ({G.GRID['north']}) + nu / 2 * s * c * l * l + nu / 24 * s * pow(c, 3) * (5 - t2 + 9 * eta) * pow(l, 4) + nu / 720 * s * pow(c, 5) * (61 - 58 * t2 + t2 * t2) * pow(l, 6)", 2)} AS northing FROM e"""


_DET = "(xx*(yy*k-sy*sy)-xy*(xy*k-sy*sx)+sx*(xy*sy-yy*sx))"
_SOLVE = lambda p, q, r: (f"({p}*(yy*k-sy*sy)-xy*({q}*k-sy*{r})+sx*({q}*sy-yy*{r}))/{_DET}", f"(xx*({q}*k-sy*{r})-{p}*(xy*k-sy*sx)+sx*(xy*{r}-{q}*sx))/{_DET}", f"(xx*(yy*{r}-sy*{q})-xy*(xy*{r}-sx*{q})+{p}*(xy*sy-yy*sx))/{_DET}")
_AREA = lambda s, w, n, e: f"abs(({e} - {w}) * 111.32 * cos(({s} + {n}) / 2 * 3.141592653589793 / 180) * ({n} - {s}) * 111.32)"
_BOX = ("greatest(south, 52.98)", "greatest(west, -1.90)", "least(north, 53.0)", "least(east, -1.87)")

ORACLE_SQL = {
    "polygon_overlaps": f"WITH {_OVERLAPS} SELECT s_suppkey, p_partkey, samples::BIGINT AS samples, {_R('share', 4)} AS share, {_R('other_share', 4)} AS other_share, {_R('iou', 4)} AS iou, matched, equivalent FROM z",
    "inherited_evidence": f"""
WITH {_OVERLAPS}, m AS (SELECT *, {_R('score', 6)} AS s6 FROM z WHERE matched), b AS (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY s6 DESC, p_partkey) AS n, count(*) OVER (PARTITION BY s_suppkey) AS n_targets, sum(p_partkey) OVER (PARTITION BY s_suppkey) AS targets_sum FROM m)
SELECT s.s_suppkey, CASE WHEN p_partkey IS NULL THEN 'gap-fill' ELSE 'replaced' END AS action, coalesce(n_targets, 0)::BIGINT AS n_targets, coalesce(targets_sum, 0)::BIGINT AS targets_sum, coalesce(CASE WHEN s.s_suppkey % 3 = 0 THEN s.s_name END, p_name, '') AS name,
CASE WHEN p_partkey IS NULL THEN CASE WHEN s.s_suppkey % 4 = 0 THEN 'surface=paved' ELSE 'ref=' || s.s_suppkey END WHEN s.s_suppkey % 4 = 0 THEN 'ref=mapped;source=map;surface=paved' ELSE 'ref=' || s.s_suppkey || ';source=map;surface=' || p_brand END AS tags,
coalesce(CASE WHEN s.s_suppkey % 5 = 0 THEN 9.5 END, p_partkey % 30 + 2.5, -1.0)::DOUBLE AS height_m, CASE WHEN s.s_suppkey % 5 = 0 THEN 'own' WHEN p_partkey IS NULL THEN 'none' ELSE 'retained' END AS height_source FROM supplier s LEFT JOIN b ON b.s_suppkey = s.s_suppkey AND b.n = 1""",
    "replaced_features": """
WITH p AS (SELECT p_partkey, p_brand, CASE WHEN p_partkey % 7 = 1 THEN p_partkey * 31 % 5000 END AS replaces FROM part)
SELECT p_brand, count(*) FILTER (p_partkey NOT IN (SELECT replaces FROM p WHERE replaces IS NOT NULL)) AS left, count(*) FILTER (replaces IN (SELECT p_partkey FROM p)) AS replaced, count(*) FILTER (replaces IS NOT NULL AND replaces NOT IN (SELECT p_partkey FROM p)) AS missing FROM p GROUP BY 1""",
    "path_connectors": f"""
WITH RECURSIVE paths AS (SELECT p_partkey, (p_partkey * 3)::DOUBLE AS ax, (p_partkey * 53 % 50)::DOUBLE AS ay, (p_partkey * 3 + {_WAY(0)})::DOUBLE AS bx, (p_partkey * 53 % 50 + {_WAY(1)})::DOUBLE AS bz, {_D('p_partkey', ROLES, 4)} AS role, p_partkey % 7 = 0 AS layer, p_brand AS surface FROM part),
ends AS (SELECT p_partkey, role, layer, surface, 0 AS side, ax AS x, ay AS y, ax - bx AS ox, ay - bz AS oy FROM paths UNION ALL SELECT p_partkey, role, layer, surface, 1, bx, bz, bx - ax, bz - ay FROM paths),
tied AS (SELECT a.p_partkey, a.side, b.p_partkey AS p2 FROM ends a JOIN ends b ON a.p_partkey <> b.p_partkey AND b.x BETWEEN a.x - 1 AND a.x + 1 AND b.y BETWEEN a.y - 1 AND a.y + 1 WHERE pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= {NEAR * NEAR}),
reach AS (SELECT p_partkey AS u, p_partkey AS v FROM part UNION SELECT r.u, t.p2 FROM reach r JOIN tied t ON t.p_partkey = r.v), groups AS (SELECT u AS p_partkey, min(v) AS component FROM reach GROUP BY 1),
loose AS (SELECT e.*, component FROM ends e JOIN groups USING (p_partkey) WHERE NOT EXISTS (SELECT 1 FROM tied t WHERE t.p_partkey = e.p_partkey AND t.side = e.side)),
pr AS (SELECT l.*, s.p_partkey AS p2, s.ax, s.ay, s.bx, s.bz, s.surface AS surface2, g.component AS component2, greatest(0.0, least(1.0, ((l.x - s.ax) * (s.bx - s.ax) + (l.y - s.ay) * (s.bz - s.ay)) / ((s.bx - s.ax) * (s.bx - s.ax) + (s.bz - s.ay) * (s.bz - s.ay)))) AS t
  FROM loose l JOIN paths s ON s.p_partkey <> l.p_partkey AND s.layer = l.layer AND s.role = l.role AND l.x BETWEEN least(s.ax, s.bx) - {REACH} AND greatest(s.ax, s.bx) + {REACH} AND l.y BETWEEN least(s.ay, s.bz) - {REACH} AND greatest(s.ay, s.bz) + {REACH} JOIN groups g ON g.p_partkey = s.p_partkey),
n AS (SELECT *, ax + t * (bx - ax) AS nx, ay + t * (bz - ay) AS ny FROM pr), d AS (SELECT *, nx - x AS dx, ny - y AS dy, sqrt((nx - x) * (nx - x) + (ny - y) * (ny - y)) AS d0 FROM n),
c AS (SELECT *, {_R('(ox * dx + oy * dy) / (sqrt(ox * ox + oy * oy) * d0)', 9)} AS goes_on, {_R('d0', 9)} AS d, (component <> component2)::INTEGER AS joins FROM d WHERE d0 >= 0.2 AND d0 <= {REACH}),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey, side ORDER BY joins DESC, d, goes_on DESC, p2) AS rn FROM c WHERE goes_on >= -0.15) WHERE rn = 1),
k1 AS (SELECT *, row_number() OVER (PARTITION BY least(p_partkey, p2), greatest(p_partkey, p2), {_KEY('nx', 'ny', 0.5)} ORDER BY p_partkey, side) AS c1, least({_KEY('x', 'y', 0.25)}, {_KEY('nx', 'ny', 0.25)}) AS g1, greatest({_KEY('x', 'y', 0.25)}, {_KEY('nx', 'ny', 0.25)}) AS g2 FROM b),
claimed AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY g1, g2 ORDER BY p_partkey, side) AS c2 FROM k1 WHERE c1 = 1) WHERE c2 = 1),
st AS (SELECT *, greatest(2, ceil(d / {STEP})::INTEGER) AS steps FROM claimed), sm AS (SELECT p_partkey, side, x, y, dx, dy, steps, unnest(range(1, steps)) AS i FROM st),
sp AS (SELECT p_partkey, side, i, x + dx * i / steps AS sx, y + dy * i / steps AS sy FROM sm),
bl AS (SELECT p_partkey, side, min_by(s_suppkey, (i, s_suppkey)) AS blocker FROM sp JOIN ({_SITES}) q ON sx BETWEEN x0 AND x1 AND sy BETWEEN y0 AND y1 WHERE {_IN_SITE('sx', 'sy')} GROUP BY 1, 2),
f AS (SELECT p_partkey, side, p2, CASE WHEN NOT ({_WITHIN('x', 'y')} AND {_WITHIN('nx', 'ny')} AND {_WITHIN('(x + nx) / 2', '(y + ny) / 2')}) THEN 'outside-park-boundary' WHEN blocker IS NOT NULL THEN CASE WHEN blocker % 2 = 0 THEN 'crosses-water' ELSE 'crosses-building' END WHEN {_R(_SURE, 3)} >= 0.8 THEN 'accepted' ELSE 'review' END AS status, {_R(_SURE, 3)} AS sure FROM claimed LEFT JOIN bl USING (p_partkey, side))
SELECT e.p_partkey, e.side, coalesce(f.p2, -1) AS p2, CASE WHEN f.status IS NOT NULL THEN f.status WHEN EXISTS (SELECT 1 FROM tied t WHERE t.p_partkey = e.p_partkey AND t.side = e.side) THEN 'already-connected-or-coincident' WHEN EXISTS (SELECT 1 FROM b WHERE b.p_partkey = e.p_partkey AND b.side = e.side) THEN 'duplicate-connector' ELSE 'no-compatible-route-within-tolerance' END AS status,
CASE WHEN f.status IN ('accepted', 'review') THEN sure ELSE 0.0 END::DOUBLE AS confidence FROM ends e LEFT JOIN f ON f.p_partkey = e.p_partkey AND f.side = e.side""",
    "semantic_labels": f"""
WITH p AS (SELECT p_partkey, trim(lower({_D('p_partkey', NOTES)} || ' ' || CASE WHEN p_partkey % 4 = 0 THEN p_name ELSE '' END)) AS text, p_partkey % 2 = 0 AS closed FROM part),
c AS (SELECT *, {R.sql_first_match('text', CLASSES)} AS class, {R.sql_first_match('text', CLASSES, value=2)} AS priority FROM p)
SELECT p_partkey, class, priority, CASE WHEN class = 'tunnel' THEN 'tunnel' WHEN class = 'bridge' THEN CASE WHEN regexp_matches(text, 'raised|elevated') THEN 'raised' ELSE 'bridge' END WHEN class = 'wall' AND regexp_matches(text, 'retaining') THEN 'retaining' ELSE '' END AS vertical, coalesce({R.sql_first_match('text', MATERIALS)}, '') AS material,
coalesce({_NUM(LEVEL, 9.999999, 500)}, -1.0)::DOUBLE AS level_m, coalesce(CASE WHEN regexp_extract(text, '{WIDTHS[0]}', 1) <> '' THEN {_NUM(WIDTHS[0], 0.2, 50)} ELSE {_NUM(WIDTHS[1], 0.2, 50)} END, -1.0)::DOUBLE AS width_m, CASE WHEN closed THEN {_SHAPE(1)} ELSE {_SHAPE(0)} END AS role FROM c WHERE class IS NOT NULL""",
    "shape_candidates": f"""
WITH o AS (SELECT o_orderkey, (o_orderkey * 13 % 840 + 1)::DOUBLE AS w, (o_orderkey * 29 % 590 + 1)::DOUBLE AS h, (o_orderkey % 50)::DOUBLE AS x, (o_orderkey * 3 % 40)::DOUBLE AS y, o_orderkey % 2 = 0 AS closed, {_D('o_orderkey', DRAWN, 5)} AS role, {_D('o_orderkey', ("approved", "proposed", "as-built"), 7)} AS state, {_D('o_orderkey', ("approved", "unknown", "granted", "refused"), 3)} AS status, (o_orderkey % 30) / 10.0 AS rmse FROM orders),
p AS (SELECT *, [{{'x': x, 'y': y}}, {{'x': x + w, 'y': y}}, {{'x': x + w, 'y': y + h}}, {{'x': x, 'y': y + h}}] AS page FROM o), g AS (SELECT *, list_transform(page, lambda q: {{'x': 0.08::DOUBLE * q.x - 0.06::DOUBLE * q.y + 400000, 'y': 0.06::DOUBLE * q.x + 0.08::DOUBLE * q.y + 350000}}) AS ground FROM p),
m AS (SELECT *, {_R(G.sql_length('ground'), 2)} AS length_m, CASE WHEN closed THEN {_R(f"abs({G.sql_signed_area('ground')})", 2)} ELSE 0.0 END AS area_m2 FROM g),
r AS (SELECT *, CASE WHEN closed AND w >= {PAGE[0] * 0.92} AND h >= {PAGE[1] * 0.92} THEN 'page-frame' WHEN (NOT closed AND length_m < 20) OR (closed AND area_m2 < 60) THEN 'below-size-threshold' WHEN closed AND role NOT IN {_IN(AREA_ROLES)} THEN 'role-not-polygon-eligible' WHEN NOT closed AND role NOT IN {_IN(LINE_ROLES)} THEN 'role-not-line-eligible' ELSE '' END AS withheld FROM m)
SELECT o_orderkey, withheld, CASE WHEN withheld <> '' THEN '' WHEN closed THEN {_CAND(1, 'unknown-polygon-candidate')} ELSE {_CAND(0, 'unknown-linear-candidate')} END AS candidate, length_m, area_m2, CASE WHEN withheld = '' THEN least(0.94, {_R("0.52::DOUBLE + CASE WHEN state IN ('approved', 'as-built') THEN 0.1 ELSE 0.0 END + CASE WHEN status IN ('approved', 'implemented', 'granted') THEN 0.08 ELSE 0.0 END + CASE WHEN role IN ('ride-layout', 'access-plan', 'floor-plan', 'landscape-plan') THEN 0.08 ELSE 0.0 END + greatest(0.0, 0.1 - rmse * 0.025) + CASE WHEN length_m > 10 OR area_m2 > 25 THEN 0.02 ELSE 0.0 END + 1e-9", 3)}) ELSE 0.0 END::DOUBLE AS confidence FROM r""",
    "curve_lengths": f"""
WITH c AS (SELECT c_custkey, {', '.join(f"{{'x': (c_custkey * {a} % 97)::DOUBLE, 'y': (c_custkey * {b} % 89)::DOUBLE}} AS p{i}" for i, (a, b) in enumerate(((3, 5), (7, 11), (13, 17), (19, 23))))} FROM customer),
s AS (SELECT c_custkey, {_sql_curve(4).replace(', list_transform', ' AS cubic_steps, list_transform', 1)} AS cubic, {_sql_curve(3).replace(', list_transform', ' AS quadratic_steps, list_transform', 1)} AS quadratic FROM c)
SELECT c_custkey, cubic_steps, {_R(G.sql_length('cubic'), 3)} AS cubic_length, quadratic_steps, {_R(G.sql_length('quadratic'), 3)} AS quadratic_length FROM s""",
    "affine_checks": f"""
WITH r AS (SELECT l_suppkey, l_quantity::DOUBLE AS x, l_linenumber * 9.0::DOUBLE AS y, (l_orderkey % 5)::DOUBLE AS o, (l_suppkey % 7)::DOUBLE AS sp FROM lineitem), q AS (SELECT l_suppkey, x, y, x * 3 + y * 0.5 * sp + o * 0.4 * (l_suppkey % 3) AS e, y * 3 - x * 0.25 * sp + o * 0.3 AS n FROM r),
g AS (SELECT l_suppkey, count(*)::DOUBLE AS k, {', '.join(f'sum({a}) AS s{a}' for a in 'xyen')}, {', '.join(f'sum({a} * {b}) AS {a}{b}' for a, b in ('xx', 'xy', 'yy', 'xe', 'ye', 'xn', 'yn', 'ee', 'nn'))} FROM q GROUP BY 1),
f AS (SELECT *, {', '.join(f'{e} AS {n}' for n, e in zip('abc', _SOLVE('xe', 'ye', 'se'), strict=True))}, {', '.join(f'{e} AS {n}' for n, e in zip('dfg', _SOLVE('xn', 'yn', 'sn'), strict=True))} FROM g WHERE k >= 3 AND abs({_DET}) > 1e-6),
h AS (SELECT *, sqrt(greatest(0, (ee - (a*xe + b*ye + c*se)) + (nn - (d*xn + f*yn + g*sn))) / k) AS rmse0, sqrt(a*a + d*d) AS xs, sqrt(b*b + f*f) AS ys FROM f)
SELECT l_suppkey, {_R('a', 3)} + 0.0 AS a, {_R('b', 3)} + 0.0 AS b, {_R('d', 3)} + 0.0 AS d, {_R('f', 3)} AS e, {_R('rmse0', 3)} AS rmse, CASE WHEN {_R('rmse0', 3)} > 1.0 THEN 'control-point-rmse-exceeds-limit' WHEN least(xs, ys) < 0.005 OR greatest(xs, ys) > 20 THEN 'implausible-drawing-scale' WHEN greatest(xs, ys) / greatest(1e-9, least(xs, ys)) > 5 THEN 'anisotropic-scale-exceeds-limit'
WHEN abs(a*b + d*f) / greatest(1e-9, xs*ys) > 0.35 THEN 'affine-axes-too-skewed' WHEN abs(a*f - b*d) < 1e-6 THEN 'degenerate-affine-transform' ELSE 'accepted' END AS verdict FROM h""",
    "grid_coordinates": _sql_grid(),
    "extent_gate": f"""
WITH s AS (SELECT s_suppkey, 52.9::DOUBLE + (s_suppkey * 37 % 150) / 1000.0 AS south, -2.0::DOUBLE + (s_suppkey * 53 % 200) / 1000.0 AS west, (s_suppkey % 50) / 1000.0 AS high, (s_suppkey % 70) / 1000.0 AS wide FROM supplier), b AS (SELECT *, south + high AS north, west + wide AS east FROM s),
a AS (SELECT *, {_AREA('south', 'west', 'north', 'east')} AS own FROM b)
SELECT s_suppkey, CASE WHEN {_R('own', 9)} <= 0 THEN 'invalid-georeferenced-extent' WHEN own > 25 THEN 'georeferenced-extent-exceeds-area-limit' WHEN {_BOX[1]} >= {_BOX[3]} OR {_BOX[0]} >= {_BOX[2]} THEN 'georeferenced-extent-outside-build-geofence'
WHEN {_AREA(*_BOX)} / greatest(1e-9, least(own, {_AREA('52.98', '-1.90', '53.0', '-1.87')})) < 0.02 THEN 'geofence-overlap-below-two-percent' ELSE 'accepted' END AS verdict, {_R('own', 4)} AS area_km2 FROM a""",
}
