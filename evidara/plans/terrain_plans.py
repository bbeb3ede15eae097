"""Queries over rasters, vegetation, path widths, tiles and acquisition plans, and the same in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidara.functions import rules as R
from evidara.functions.scalars import clamp, half_up, smooth_step, snap
from evidara.operators import raster


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


#: Metres of a tile, of the strip at its border that blends resolutions, and columns of tiles.
TILE, FEATHER, COLUMNS = 100, 20.0, 8
RESOLUTIONS = (1.0, 0.25, 1.0, 2.0)


def _tiles(spark, sf):
    """Every supplier is a tile of a grid of 8 columns; every ninth tile is missing."""
    k = F.col("s_suppkey")
    tiles = _t(spark, sf, "supplier").select(F.floor(k / COLUMNS).cast("bigint").alias("row"), F.pmod(k, F.lit(COLUMNS)).cast("bigint").alias("col"), R.dealt(k, RESOLUTIONS).alias("res"), F.pmod(k, F.lit(7)).cast("double").alias("level"), (F.pmod(k, F.lit(9)) != 4).alias("there"))
    return tiles.where("there").drop("there")


def blended_samples(spark, sf):
    """Heights at orders' points from tiles of several resolutions: the own tile's, blended near a tile of another resolution, else that of the first neighbour; each tile is a plane."""
    k = F.col("o_orderkey")
    rows = F.lit(_t(spark, sf, "supplier").count() // COLUMNS + 1)
    p = _t(spark, sf, "orders").select("o_orderkey", (F.pmod(k * 7919, F.lit(COLUMNS * TILE * 4)) / 4.0).alias("x"), (F.pmod(k * 104729, rows * TILE * 4) / 4.0).alias("y"))
    p = p.withColumns({"row": F.floor(F.col("y") / TILE).cast("bigint"), "col": F.floor(F.col("x") / TILE).cast("bigint")})
    around = F.explode(F.flatten(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda i: F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda j: F.struct(i.cast("bigint").alias("dr"), j.cast("bigint").alias("dc"))))))
    near = p.withColumn("d", around).select("o_orderkey", "x", "y", (F.col("row") + F.col("d.dr")).alias("row"), (F.col("col") + F.col("d.dc")).alias("col"), ((F.col("d.dr") == 0) & (F.col("d.dc") == 0)).alias("own"), (F.col("d.dr") * 3 + F.col("d.dc")).alias("place"))
    hit = near.join(_tiles(spark, sf), ["row", "col"])
    x0, y0 = F.col("col") * TILE, F.col("row") * TILE
    edge = F.greatest(F.lit(0.001), F.least(F.lit(0.25), F.col("res") * 0.05))
    cx, cy = F.greatest(x0 + edge, F.least(F.col("x"), x0 + TILE - edge)), F.greatest(y0 + edge, F.least(F.col("y"), y0 + TILE - edge))
    dx, dy = F.greatest(x0 - F.col("x"), F.col("x") - x0 - TILE, F.lit(0.0)), F.greatest(y0 - F.col("y"), F.col("y") - y0 - TILE, F.lit(0.0))
    plane = lambda x, y: 100 + F.col("level") + x * 0.01 + y * 0.02
    hit = hit.withColumns({"distance": F.sqrt(dx * dx + dy * dy), "direct": plane(F.col("x"), F.col("y")), "clamped": plane(cx, cy)})
    weight = F.when(F.col("distance") <= 0, 1.0).otherwise(smooth_step(1 - F.col("distance") / FEATHER)) / F.sqrt(F.greatest(F.lit(0.25), F.col("res")))
    close = F.col("distance") <= FEATHER
    g = hit.withColumn("w", F.when(close, weight)).groupBy("o_orderkey").agg(
        F.max(F.when(F.col("own"), F.col("direct"))).alias("own"), F.max(F.when(F.col("own"), F.col("res"))).alias("own_res"), F.collect_set(F.when(close, F.col("res"))).alias("resolutions"),
        F.sum(F.col("w") * F.col("clamped")).alias("sum"), F.sum("w").alias("weights"), F.min_by("direct", F.when(~F.col("own"), F.col("place"))).alias("neighbour"),
    )
    mixed = F.col("own").isNotNull() & F.exists("resolutions", lambda r: r != F.col("own_res"))
    value = F.when(mixed & (F.col("weights") > 0), F.col("sum") / F.col("weights")).otherwise(F.coalesce("own", "neighbour"))
    how = F.when(mixed, "blended").when(F.col("own").isNotNull(), "direct").otherwise("neighbour")
    return p.select("o_orderkey").join(g, "o_orderkey", "left").select("o_orderkey", F.coalesce(half_up(value, 4), F.lit(-1.0)).alias("height"), F.when(value.isNull(), "none").otherwise(how).alias("how"))


def tile_gates(spark, sf):
    """Coverage tiles against what was asked: bounds within a tolerance, resolution, share of valid cells; and whether the surface tile fits the terrain tile."""
    k = F.col("s_suppkey")
    t = _t(spark, sf, "supplier").select("s_suppkey", R.dealt(k, (0.5, 1.0, 2.0, 3.0)).alias("res"), F.pmod(k * 3, F.lit(9)).cast("double").alias("short"), (F.pmod(k * 37, F.lit(30)) / 100.0 + 0.7).alias("valid"), (F.pmod(k, F.lit(4)) * 0.9).alias("shift"), R.dealt(k, (1.0, 1.0, 2.0), 2).alias("surface_res"), (F.pmod(k, F.lit(5)) == 0).alias("profiled"), R.dealt(k, ("4x4", "4x4", "8x2"), 3).alias("grid"))
    gate = F.when(F.col("short") > F.greatest(F.lit(2.0), F.col("res") * 2.5), "bounds").when(F.col("res") > 2, "resolution").when(F.col("valid") < 0.85, "coverage").otherwise("accepted")
    fits = F.when(F.col("shift") >= 2.5, "bounds").when(~F.col("profiled") & (F.abs(F.col("res") - F.col("surface_res")) >= 0.001), "resolution").when(F.col("grid") != "4x4", "grid").otherwise("compatible")
    return t.select("s_suppkey", gate.alias("gate"), fits.alias("pair"), half_up(F.col("valid") * 100, 3).alias("coverage"))


def component_shapes(spark, sf):
    """4-connected groups of occupied cells of half a metre: size, fill, elongation, perimeter and compactness, and whether each looks like a plaza or a route."""
    cell = 0.5
    k = F.col("event_id")
    c = _t(spark, sf, "events").select((F.floor(k / 60) * 2 + F.pmod(k * 7, F.lit(4))).cast("int").alias("row"), F.pmod(k * 13, F.lit(61)).cast("int").alias("col")).distinct()
    c = c.withColumn("id", (F.col("row") * 100 + F.col("col")).cast("bigint"))
    links = raster.neighbours(c)
    groups = raster.connected_cells(c).join(c, "id")
    inner = links.join(groups.select(F.col("id").alias("u"), "component"), "u").groupBy("component").agg(F.count("*").alias("links"))
    g = groups.groupBy("component").agg(F.count("*").alias("cells"), ((F.max("col") - F.min("col") + 1) * cell).alias("wide"), ((F.max("row") - F.min("row") + 1) * cell).alias("high")).join(inner, "component", "left")
    area, perimeter = F.col("cells") * cell * cell, (4 * F.col("cells") - 2 * F.coalesce("links", F.lit(0))) * cell
    major, minor = F.greatest("wide", "high"), F.greatest(F.lit(cell), F.least("wide", "high"))
    g = g.withColumns({"area": area, "perimeter": perimeter, "fill": area / F.greatest(F.lit(cell * cell), F.col("wide") * F.col("high")), "major": major, "minor": minor}).withColumn("compact", 4 * 3.141592653589793 * F.col("area") / (F.col("perimeter") * F.col("perimeter")))
    plaza = (F.col("area") >= 28) & (F.col("minor") >= 4) & (F.col("fill") >= 0.26) & (F.col("compact") >= 0.08)
    route = (F.col("major") >= 10) & (F.col("major") / F.col("minor") >= 2.2) & (F.col("fill") >= 0.12)
    return g.select("component", "cells", half_up(F.col("area"), 1).alias("area_m2"), half_up(F.col("fill"), 3).alias("fill"), half_up(F.col("major") / F.col("minor"), 2).alias("elongation"), half_up(F.col("perimeter"), 1).alias("perimeter_m"), half_up(F.col("compact"), 3).alias("compactness"), plaza.alias("plaza"), route.alias("route"))


def component_appearance(spark, sf):
    """The most frequent prototype of each group's cells and the medians of colour and texture."""
    k = F.col("event_id")
    e = _t(spark, sf, "events").select(F.pmod("user_id", F.lit(50)).alias("component"), F.pmod(k * 7, F.lit(5)).alias("prototype"), F.pmod(k * 31, F.lit(256)).cast("double").alias("grey"), F.pmod(k, F.lit(40)).cast("double").alias("texture"))
    votes = e.groupBy("component", "prototype").agg(F.count("*").alias("n"))
    best = votes.groupBy("component").agg(F.max_by("prototype", F.struct("n", -F.col("prototype"))).alias("prototype"))
    middle = e.groupBy("component").agg(F.percentile("grey", 0.5).alias("grey"), F.percentile("texture", 0.5).alias("texture"), F.count("*").alias("cells"))
    return best.join(middle, "component").select("component", "prototype", F.floor(F.col("grey") + 0.5).cast("bigint").alias("grey"), half_up(F.col("texture"), 1).alias("texture"), "cells")


SUBTYPES = ("tree", "Lone Tree Canopy", "hedge", "protected-or-recorded-tree", "woodland", "surveyed tree", "scrub")


def tree_evidence(spark, sf):
    """Trees' crowns and heights by the best evidence: the tag, the canopy model between 2.5 and 70 m, else surface less terrain."""
    k = F.col("p_partkey")
    p = _t(spark, sf, "part").select("p_partkey", F.regexp_replace(F.lower(R.dealt(k, SUBTYPES)), "[ -]+", "_").alias("subtype"), F.when(F.pmod(k, F.lit(4)) == 0, F.pmod(k, F.lit(9)) + 1.5).alias("tagged_crown"), F.when(F.pmod(k, F.lit(3)) > 0, F.pmod(k * 11, F.lit(900)) / 10.0).alias("area"), F.when(F.pmod(k, F.lit(5)) == 0, F.pmod(k, F.lit(25)) + 3.0).alias("tagged"), F.when(F.pmod(k, F.lit(2)) == 0, F.pmod(k * 17, F.lit(800)) / 10.0).alias("canopy"), F.when(F.pmod(k, F.lit(7)) < 5, F.pmod(k * 3, F.lit(400)) / 10.0 - 2).alias("difference"))
    tree = F.col("subtype").isin("tree", "lone_tree_canopy", "lone_tree", "tree_canopy", "protected_or_recorded_tree", "recorded_tree", "individual_tree", "surveyed_tree")
    mapped = F.when(tree & (F.col("area") > 0), half_up(2 * F.sqrt(F.col("area") / 3.141592653589793), 1))
    canopy, difference = F.when(F.col("canopy").between(2.5, 70), half_up(F.col("canopy"), 1)), F.when(F.col("difference").between(2.5, 70), half_up(F.col("difference"), 1))
    source = F.when(F.col("tagged").isNotNull(), "tag").when(canopy.isNotNull(), "canopy-model").when(difference.isNotNull(), "surface-less-terrain").otherwise("none")
    return p.select("p_partkey", F.when(tree, "tree").otherwise("other").alias("model"), F.coalesce("tagged_crown", mapped, F.lit(-1.0)).alias("crown_m"), F.when(F.col("tagged_crown").isNotNull(), "tag").when(mapped.isNotNull(), "canopy").otherwise("none").alias("crown_source"), F.coalesce("tagged", canopy, difference, F.lit(-1.0)).alias("height_m"), source.alias("height_source"), F.when(source == "tag", 0.88).when(source == "canopy-model", 0.84).otherwise(0.0).alias("confidence"))


def width_profiles(spark, sf):
    """Paths with a tagged width at both ends: each end within bounds, the nominal width between, and their range."""
    k = F.col("p_partkey")
    p = _t(spark, sf, "part").select("p_partkey", (F.pmod(k * 7, F.lit(900)) / 20.0).alias("a"), (F.pmod(k * 13, F.lit(900)) / 20.0).alias("b")).where("a > 0 AND b > 0")
    p = p.withColumns({"start_m": clamp(half_up(F.col("a"), 1), 0.5, 40.0), "end_m": clamp(half_up(F.col("b"), 1), 0.5, 40.0)})
    return p.select("p_partkey", "start_m", "end_m", half_up((F.col("start_m") + F.col("end_m")) / 2, 1).alias("width_m"), F.least("start_m", "end_m").alias("least_m"), F.greatest("start_m", "end_m").alias("most_m"), snap((F.col("start_m") + F.col("end_m")) / 2, 0.25).alias("raster_m"))


PROFILES, PATHS = ("manual", "open", "maximum-public"), ("mapped-only", "aerial-preferred", "aerial-required")


def source_plans(spark, sf):
    """Which sources each request acquires: by profile, by the path source it wants, and by what it already has; with the run's status."""
    k = F.col("c_custkey")
    c = _t(spark, sf, "customer").select("c_custkey", R.dealt(k, PROFILES).alias("profile"), R.dealt(k, PATHS, 3).alias("paths"), (F.pmod(k, F.lit(4)) == 0).alias("has_photo"), F.pmod(k, F.lit(5)).alias("found"), F.pmod(k, F.lit(3)).alias("failed"), (F.pmod(k, F.lit(2)) == 0).alias("strict"))
    auto, aerial = F.col("profile") != "manual", F.col("paths") != "mapped-only"
    status = F.when(~auto, "disabled").when((F.col("failed") > 0) & F.col("strict"), "failed").when((F.col("failed") > 0) & (F.col("found") > 0), "partial").when(F.col("failed") > 0, "failed-open").when(F.col("found") > 0, "active").otherwise("active-no-results")
    return c.groupBy("profile", "paths", "has_photo").agg(F.count_if(auto).alias("buildings"), F.count_if(auto & aerial & ~F.col("has_photo")).alias("imagery"), F.count_if((F.col("profile") == "maximum-public") & aerial).alias("coverage_index"), F.count_if((F.col("paths") == "aerial-required") & ~auto & ~F.col("has_photo")).alias("impossible"), *(F.count_if(status == s).alias(s.replace("-", "_")) for s in ("disabled", "failed", "partial", "failed-open", "active", "active-no-results")))


def paged_features(spark, sf):
    """Features in pages of 500 by their position: the rows of each page, the last short page, and the features under the cap of 100 pages."""
    part = _t(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"))
    # positions by counts per block of keys and per range of blocks, so that no task numbers all rows, nor all blocks
    block, wide = F.floor(F.col("l_partkey") / 1000), F.floor(F.col("block") / 1000)
    sums = part.groupBy(block.alias("block")).agg(F.sum("n").alias("rows")).withColumn("wide", wide)
    until = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    ranges = sums.groupBy("wide").agg(F.sum("rows").alias("rows"))
    ranges = ranges.select("wide", F.coalesce(F.sum("rows").over(until(Window.orderBy("wide"))), F.lit(0)).alias("wide_before"))
    before = sums.withColumn("own_before", F.coalesce(F.sum("rows").over(until(Window.partitionBy("wide").orderBy("block"))), F.lit(0))).join(ranges, "wide").select("block", (F.col("own_before") + F.col("wide_before")).alias("before"))
    inside = Window.partitionBy("block").orderBy("l_partkey").rowsBetween(Window.unboundedPreceding, -1)
    first = part.withColumn("block", block).withColumn("within", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(before, "block").withColumn("first", F.col("within") + F.col("before"))
    pages = first.withColumn("page", F.explode(F.sequence(F.floor(F.col("first") / 500), F.floor((F.col("first") + F.col("n") - 1) / 500)))).where("page < 100")
    rows = F.least(F.col("first") + F.col("n"), (F.col("page") + 1) * 500) - F.greatest(F.col("first"), F.col("page") * 500)
    g = pages.groupBy("page").agg(F.sum(rows).cast("bigint").alias("rows"), F.count("*").alias("parts"), F.min("l_partkey").alias("first_part"))
    return g.withColumn("short", F.col("rows") < 500)


QUERIES = {f.__name__: f for f in (blended_samples, tile_gates, component_shapes, component_appearance, tree_evidence, width_profiles, source_plans, paged_features)}

_D = R.sql_dealt
_R = lambda x, n: f"floor(({x}) * 1e{n} + 0.5) / 1e{n}"
_PLANE = lambda x, y: f"(100 + level + {x} * 0.01::DOUBLE + {y} * 0.02::DOUBLE)"

ORACLE_SQL = {
    "blended_samples": f"""
WITH tiles AS (SELECT s_suppkey // {COLUMNS} AS r, s_suppkey % {COLUMNS} AS c, ({_D("s_suppkey", RESOLUTIONS)})::DOUBLE AS res, (s_suppkey % 7)::DOUBLE AS level FROM supplier WHERE s_suppkey % 9 <> 4),
p AS (SELECT o_orderkey, (o_orderkey * 7919 % {COLUMNS * TILE * 4}) / 4.0::DOUBLE AS x, (o_orderkey * 104729 % (((SELECT count(*) FROM supplier) // {COLUMNS} + 1) * {TILE * 4})) / 4.0::DOUBLE AS y FROM orders),
q AS (SELECT *, floor(y / {TILE})::BIGINT AS pr, floor(x / {TILE})::BIGINT AS pc FROM p),
h AS (SELECT o_orderkey, x, y, r, c, res, level, r = pr AND c = pc AS own, (r - pr) * 3 + c - pc AS place, greatest(0.001, least(0.25, res * 0.05)) AS edge FROM q JOIN tiles ON r BETWEEN pr - 1 AND pr + 1 AND c BETWEEN pc - 1 AND pc + 1),
d AS (SELECT *, sqrt(pow(greatest(c * {TILE} - x, x - c * {TILE} - {TILE}, 0.0), 2) + pow(greatest(r * {TILE} - y, y - r * {TILE} - {TILE}, 0.0), 2)) AS distance, {_PLANE('x', 'y')} AS direct,
{_PLANE(f'greatest(c * {TILE} + edge, least(x, c * {TILE} + {TILE} - edge))', f'greatest(r * {TILE} + edge, least(y, r * {TILE} + {TILE} - edge))')} AS clamped FROM h),
w AS (SELECT *, CASE WHEN distance <= {FEATHER} THEN CASE WHEN distance <= 0 THEN 1.0 ELSE pow(1 - distance / {FEATHER}, 2) * (3 - 2 * (1 - distance / {FEATHER})) END / sqrt(greatest(0.25, res)) END AS w FROM d),
g AS (SELECT o_orderkey, max(CASE WHEN own THEN direct END) AS direct, max(CASE WHEN own THEN res END) AS own_res, list_distinct(list(res) FILTER (distance <= {FEATHER})) AS rs, sum(w * clamped) AS s, sum(w) AS ws, arg_min(direct, place) FILTER (NOT own) AS neighbour FROM w GROUP BY 1),
v AS (SELECT o_orderkey, CASE WHEN direct IS NOT NULL AND len(list_filter(rs, lambda z: z <> own_res)) > 0 THEN 'blended' WHEN direct IS NOT NULL THEN 'direct' ELSE 'neighbour' END AS how, direct, neighbour, s, ws FROM g)
SELECT p.o_orderkey, coalesce({_R("CASE WHEN how = 'blended' AND ws > 0 THEN s / ws ELSE coalesce(direct, neighbour) END", 4)}, -1.0) AS height, CASE WHEN v.o_orderkey IS NULL OR coalesce(direct, neighbour) IS NULL THEN 'none' ELSE how END AS how FROM p LEFT JOIN v USING (o_orderkey)""",
    "tile_gates": f"""
WITH t AS (SELECT s_suppkey, ({_D('s_suppkey', (0.5, 1.0, 2.0, 3.0))})::DOUBLE AS res, (s_suppkey * 3 % 9)::DOUBLE AS short, (s_suppkey * 37 % 30) / 100.0::DOUBLE + 0.7::DOUBLE AS valid, (s_suppkey % 4) * 0.9::DOUBLE AS shift, ({_D('s_suppkey', (1.0, 1.0, 2.0), 2)})::DOUBLE AS surface_res, s_suppkey % 5 = 0 AS profiled, {_D('s_suppkey', ("4x4", "4x4", "8x2"), 3)} AS grid FROM supplier)
SELECT s_suppkey, CASE WHEN short > greatest(2.0, res * 2.5) THEN 'bounds' WHEN res > 2 THEN 'resolution' WHEN valid < 0.85::DOUBLE THEN 'coverage' ELSE 'accepted' END AS gate, CASE WHEN shift >= 2.5 THEN 'bounds' WHEN NOT profiled AND abs(res - surface_res) >= 0.001 THEN 'resolution' WHEN grid <> '4x4' THEN 'grid' ELSE 'compatible' END AS pair, {_R('valid * 100', 3)} AS coverage FROM t""",
    "component_shapes": f"""
WITH RECURSIVE c AS (SELECT DISTINCT (event_id // 60 * 2 + event_id * 7 % 4)::INTEGER AS r, (event_id * 13 % 61)::INTEGER AS k FROM events), i AS (SELECT r, k, r * 100 + k AS id FROM c),
l AS (SELECT a.id AS u, b.id AS v FROM i a JOIN i b ON b.r = a.r AND b.k = a.k + 1 UNION ALL SELECT a.id, b.id FROM i a JOIN i b ON b.r = a.r + 1 AND b.k = a.k), b AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
lab(id, m, n) AS (SELECT id, id, 0 FROM i UNION ALL SELECT x.id, least(any_value(x.m), min(y.m)), any_value(x.n) + 1 FROM (SELECT * FROM lab) x LEFT JOIN b ON b.u = x.id LEFT JOIN (SELECT * FROM lab) y ON y.id = b.v WHERE x.n < 400 GROUP BY x.id),
g AS (SELECT id, min(m) AS component FROM lab GROUP BY id), e AS (SELECT component, count(*) AS links FROM l JOIN g ON g.id = l.u GROUP BY 1),
s AS (SELECT component, count(*) AS cells, (max(k) - min(k) + 1) * 0.5::DOUBLE AS wide, (max(r) - min(r) + 1) * 0.5::DOUBLE AS high FROM g JOIN i USING (id) GROUP BY 1),
a AS (SELECT *, cells * 0.25::DOUBLE AS area, (4 * cells - 2 * coalesce(links, 0)) * 0.5::DOUBLE AS perimeter, greatest(wide, high) AS major, greatest(0.5, least(wide, high))::DOUBLE AS minor FROM s LEFT JOIN e USING (component)),
f AS (SELECT *, area / greatest(0.25, wide * high) AS fill, 4 * 3.141592653589793 * area / (perimeter * perimeter) AS compact FROM a)
SELECT component, cells, {_R('area', 1)} AS area_m2, {_R('fill', 3)} AS fill, {_R('major / minor', 2)} AS elongation, {_R('perimeter', 1)} AS perimeter_m, {_R('compact', 3)} AS compactness, area >= 28 AND minor >= 4 AND fill >= 0.26 AND compact >= 0.08 AS plaza, major >= 10 AND major / minor >= 2.2 AND fill >= 0.12 AS route FROM f""",
    "component_appearance": """
WITH e AS (SELECT user_id % 50 AS component, event_id * 7 % 5 AS prototype, (event_id * 31 % 256)::DOUBLE AS grey, (event_id % 40)::DOUBLE AS texture FROM events), v AS (SELECT component, prototype, row_number() OVER (PARTITION BY component ORDER BY count(*) DESC, prototype) AS n FROM e GROUP BY 1, 2),
m AS (SELECT component, quantile_cont(grey, 0.5) AS grey, quantile_cont(texture, 0.5) AS texture, count(*) AS cells FROM e GROUP BY 1)
SELECT component, prototype, floor(grey + 0.5)::BIGINT AS grey, floor(texture * 10 + 0.5) / 10 AS texture, cells FROM v JOIN m USING (component) WHERE n = 1""",
    "tree_evidence": f"""
WITH p AS (SELECT p_partkey AS k, regexp_replace(lower({_D('p_partkey', SUBTYPES)}), '[ -]+', '_', 'g') AS subtype FROM part),
e AS (SELECT *, CASE WHEN k % 4 = 0 THEN k % 9 + 1.5::DOUBLE END AS tagged_crown, CASE WHEN k % 3 > 0 THEN (k * 11 % 900) / 10.0::DOUBLE END AS area, CASE WHEN k % 5 = 0 THEN k % 25 + 3.0::DOUBLE END AS tagged, CASE WHEN k % 2 = 0 THEN (k * 17 % 800) / 10.0::DOUBLE END AS canopy, CASE WHEN k % 7 < 5 THEN (k * 3 % 400) / 10.0::DOUBLE - 2 END AS difference,
subtype IN ('tree', 'lone_tree_canopy', 'lone_tree', 'tree_canopy', 'protected_or_recorded_tree', 'recorded_tree', 'individual_tree', 'surveyed_tree') AS tree FROM p),
m AS (SELECT *, CASE WHEN tree AND area > 0 THEN {_R('2 * sqrt(area / 3.141592653589793)', 1)} END AS mapped, CASE WHEN canopy BETWEEN 2.5 AND 70 THEN {_R('canopy', 1)} END AS c1, CASE WHEN difference BETWEEN 2.5 AND 70 THEN {_R('difference', 1)} END AS d1 FROM e)
SELECT k AS p_partkey, CASE WHEN tree THEN 'tree' ELSE 'other' END AS model, coalesce(tagged_crown, mapped, -1.0)::DOUBLE AS crown_m, CASE WHEN tagged_crown IS NOT NULL THEN 'tag' WHEN mapped IS NOT NULL THEN 'canopy' ELSE 'none' END AS crown_source, coalesce(tagged, c1, d1, -1.0)::DOUBLE AS height_m,
CASE WHEN tagged IS NOT NULL THEN 'tag' WHEN c1 IS NOT NULL THEN 'canopy-model' WHEN d1 IS NOT NULL THEN 'surface-less-terrain' ELSE 'none' END AS height_source, CASE WHEN tagged IS NOT NULL THEN 0.88 WHEN c1 IS NOT NULL THEN 0.84 ELSE 0.0 END::DOUBLE AS confidence FROM m""",
    "width_profiles": f"""
WITH p AS (SELECT p_partkey, (p_partkey * 7 % 900) / 20.0::DOUBLE AS a, (p_partkey * 13 % 900) / 20.0::DOUBLE AS b FROM part), c AS (SELECT p_partkey, least(40.0, greatest(0.5, {_R('a', 1)}))::DOUBLE AS start_m, least(40.0, greatest(0.5, {_R('b', 1)}))::DOUBLE AS end_m FROM p WHERE a > 0 AND b > 0)
SELECT p_partkey, start_m, end_m, {_R('(start_m + end_m) / 2', 1)} AS width_m, least(start_m, end_m) AS least_m, greatest(start_m, end_m) AS most_m, floor((start_m + end_m) / 2 / 0.25 + 0.5) * 0.25::DOUBLE AS raster_m FROM c""",
    "source_plans": f"""
WITH c AS (SELECT {_D('c_custkey', PROFILES)} AS profile, {_D('c_custkey', PATHS, 3)} AS paths, c_custkey % 4 = 0 AS has_photo, c_custkey % 5 AS found, c_custkey % 3 AS failed_n, c_custkey % 2 = 0 AS strict FROM customer),
s AS (SELECT *, CASE WHEN profile = 'manual' THEN 'disabled' WHEN failed_n > 0 AND strict THEN 'failed' WHEN failed_n > 0 AND found > 0 THEN 'partial' WHEN failed_n > 0 THEN 'failed-open' WHEN found > 0 THEN 'active' ELSE 'active-no-results' END AS st FROM c)
SELECT profile, paths, has_photo, count(*) FILTER (profile <> 'manual') AS buildings, count(*) FILTER (profile <> 'manual' AND paths <> 'mapped-only' AND NOT has_photo) AS imagery, count(*) FILTER (profile = 'maximum-public' AND paths <> 'mapped-only') AS coverage_index, count(*) FILTER (paths = 'aerial-required' AND profile = 'manual' AND NOT has_photo) AS impossible,
count(*) FILTER (st = 'disabled') AS disabled, count(*) FILTER (st = 'failed') AS failed, count(*) FILTER (st = 'partial') AS partial, count(*) FILTER (st = 'failed-open') AS failed_open, count(*) FILTER (st = 'active') AS active, count(*) FILTER (st = 'active-no-results') AS active_no_results FROM s GROUP BY 1, 2, 3""",
    "paged_features": """
WITH r AS (SELECT l_partkey, row_number() OVER (ORDER BY l_partkey) - 1 AS i FROM lineitem)
SELECT i // 500 AS page, count(*) AS rows, count(DISTINCT l_partkey) AS parts, min(l_partkey) AS first_part, count(*) < 500 AS short FROM r WHERE i // 500 < 100 GROUP BY 1""",
}
