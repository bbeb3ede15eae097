"""Queries of the map, georeferencing and raster side on geometry made from keys, and the same in DuckDB SQL.

Points are x = key * 7919 mod 5000, y = key * 104729 mod 5000 (metres); a part is a rectangle of p_size metres at its point. Squares of 5000 m stand
side by side, each for as many neighbouring keys of a table as are in its share, so that the ground grows with the rows and pairs in proportion.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from evidara.functions import scalars as S
from evidara.operators import raster as G
from evidara.operators import spatial as P
from evidara.operators.graph import connected_components


def _t(spark: SparkSession, sf: str, name: str):
    return spark.read.parquet(f"{sf}/{name}.parquet")


#: Keys of each table that share a square.
SHARE = {"event_id": 10_000, "s_suppkey": 100, "p_partkey": 2_000, "l_partkey": 2_000, "c_custkey": 1_500, "o_orderkey": 15_000}


def _x(key: str, size: int = 5000):
    return F.pmod(F.col(key).cast("bigint") * 7919, F.lit(size)) + F.floor(F.col(key) / SHARE[key]) * size


def _y(key: str, size: int = 5000):
    return F.pmod(F.col(key).cast("bigint") * 104729, F.lit(size))


def gap_fill_points(spark, sf):
    """Events that no supplier of the same name class lies within 100 m of."""
    e = _t(spark, sf, "events").select("event_id", F.pmod("event_id", F.lit(5)).alias("name"), _x("event_id").alias("x"), _y("event_id").alias("y"))
    s = _t(spark, sf, "supplier").select(F.pmod("s_suppkey", F.lit(5)).alias("name"), _x("s_suppkey").alias("x2"), _y("s_suppkey").alias("y2"))
    return P.grid_join(e, s, 100.0, "left_anti", ["name"]).select("event_id", "name")


def _boxes(spark, sf):
    p = _t(spark, sf, "part").select("p_partkey", _x("p_partkey", 997).alias("x0"), _y("p_partkey", 997).alias("y0"), "p_size")
    p = p.withColumns({"x1": F.col("x0") + F.col("p_size"), "y1": F.col("y0") + F.col("p_size")})
    planning = p.where("p_partkey % 4 = 0").select(F.col("p_partkey").alias("planning_id"), "x0", "y0", "x1", "y1", (F.pmod("p_partkey", F.lit(3)) > 0).alias("eligible"))
    osm = p.where("p_partkey % 4 <> 0").select(F.col("p_partkey").alias("target_id"), *(F.col(c).alias(f"b{c}") for c in ("x0", "y0", "x1", "y1")))
    return planning, osm


def authority_decisions_v30a(spark, sf):
    """What each planning box does to the map's boxes when approved plans replace all matches."""
    return P.authority_decisions(*_boxes(spark, sf)).fillna(-1, ["target_id"])


def authority_decisions_v18(spark, sf):
    """The same with ambiguous and corroborating matches told apart."""
    return P.authority_decisions(*_boxes(spark, sf), mode="v18").fillna(-1, ["target_id"])


def decision_counters(spark, sf):
    """Decisions by action."""
    return authority_decisions_v18(spark, sf).groupBy("action").agg(F.count("*").alias("n"), F.sum("n_targets").alias("targets"))


#: Vectors that are promoted at most.
PROMOTED = 500
#: What tells vectors apart.
VECTOR = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


def vector_promotion(spark, sf):
    """Line items as drawing vectors by the first gate that stops each: role, status, confidence, registration, size, provenance, licence, state; of those that pass, the first 500 by priority are promoted and the rest withheld by the cap."""
    k = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    v = _t(spark, sf, "lineitem").select(
        *VECTOR, F.pmod("l_partkey", F.lit(12)).alias("role"), F.pmod("l_suppkey", F.lit(9)).alias("status"), (F.lit(100) - F.pmod("l_partkey", F.lit(45))).alias("conf"), F.pmod("l_orderkey", F.lit(40)).alias("rmse10"), F.col("l_quantity").cast("bigint").alias("size"), F.pmod("l_orderkey", F.lit(6)).alias("licence"), F.pmod(k, F.lit(11)).alias("source"), F.pmod(k, F.lit(5)).alias("state"),
    )
    v = v.withColumn("private", (F.col("licence") == 1) & (F.pmod("l_orderkey", F.lit(4)) < 2))
    gate = (
        F.when(F.col("role") > 9, "role").when(F.col("status") < 2, "status").when(F.col("conf") < 78, "confidence").when(F.col("rmse10") > 25, "georeference").when(F.col("size") < 5, "size")
        .when(F.col("source") == 0, "provenance").when((F.col("licence") == 0) | ((F.col("licence") == 1) & ~F.col("private")), "licence").when(F.col("state") == 4, "unresolved-status")
    )
    v = v.withColumns({"gate": gate, "priority": F.col("role") * 10 + F.col("conf") * 10 - F.col("rmse10") * 4})
    # the first vectors that pass are few enough for one task; whoever isn't among them is beyond the cap
    first = v.where("gate IS NULL").orderBy(F.desc("priority"), *VECTOR).limit(PROMOTED).select(*VECTOR, F.lit(True).alias("in_cap")).distinct()
    v = v.join(F.broadcast(first), VECTOR, "left")
    named = F.coalesce("gate", F.when(F.col("in_cap"), F.when(F.col("private"), "promoted-private-use").otherwise("promoted")).otherwise("cap"))
    return v.groupBy(named.alias("gate")).agg(F.count("*").alias("n"), F.max("priority").alias("best"), F.sum("size").alias("size"))


def affine_fit(spark, sf):
    """Least-squares scale and shift of x on price per supplier, by sums and Cramer's rule."""
    c = _t(spark, sf, "lineitem").select("l_suppkey", F.col("l_quantity").cast("bigint").alias("x"), F.col("l_linenumber").cast("bigint").alias("y"), (F.col("l_quantity") * 3 + F.col("l_linenumber") * 7 + F.pmod("l_orderkey", F.lit(5))).cast("bigint").alias("e"))
    s = lambda a, b: F.sum(F.col(a) * F.col(b)).cast("double")
    g = c.groupBy("l_suppkey").agg(F.count("*").cast("double").alias("n"), *(F.sum(k).cast("double").alias(f"s{k}") for k in "xye"), s("x", "x").alias("xx"), s("x", "y").alias("xy"), s("y", "y").alias("yy"), s("x", "e").alias("xe"), s("y", "e").alias("ye"))
    det = F.expr("xx*(yy*n-sy*sy)-xy*(xy*n-sy*sx)+sx*(xy*sy-yy*sx)")
    a = F.expr("xe*(yy*n-sy*sy)-xy*(ye*n-sy*se)+sx*(ye*sy-yy*se)")
    b = F.expr("xx*(ye*n-sy*se)-xe*(xy*n-sy*sx)+sx*(xy*se-ye*sx)")
    r4 = lambda v: S.half_up(v, 4)
    return g.where(det != 0).select("l_suppkey", r4(a / det).alias("a"), r4(b / det).alias("b"))


def tile_plan_tiers(spark, sf):
    """The tiles of every supplier's area with the resolution tier of each against one core."""
    k = F.col("s_suppkey")
    e, n = F.pmod(k * 7919, F.lit(6000)), F.pmod(k * 104729, F.lit(2500))
    bounds = _t(spark, sf, "supplier").select(k.alias("plan_id"), e.alias("e0"), n.alias("n0"), (e + 500 + F.pmod(k * 37, F.lit(3000))).alias("e1"), (n + 300 + F.pmod(k * 53, F.lit(2500))).alias("n1"))
    return P.tile_tiers(P.tile_plan(bounds, 1000), (2000, 0, 4000, 1000), 750)


def tile_summary(spark, sf):
    """Cells and valid cells per tier of tiles filled with events."""
    e = _t(spark, sf, "events").select(F.floor(F.pmod(F.col("event_id") * 7919, F.lit(6000)) / 1000).cast("int").alias("col"), (F.pmod("event_id", F.lit(10)) > 0).cast("int").alias("valid"))
    tier = F.when(F.col("col").isin(2, 3), "core").when(F.col("col").isin(1, 4), "near").otherwise("outer")
    g = e.groupBy(tier.alias("tier")).agg(F.count("*").alias("total"), F.sum("valid").alias("valid"), F.min("col").alias("first"), F.max("col").alias("last"))
    return g.withColumn("coverage", F.floor(F.col("valid") * 100000.0 / F.col("total") + 0.5) / 1000)


def consensus_groups(spark, sf):
    """Pairs of sure events of a user within 140 m from different types: supporters of each, two at least. Confidence is made from the key."""
    e = _t(spark, sf, "events").select("event_id", "event_type", F.pmod("user_id", F.lit(8)).alias("app"), _x("event_id").alias("x"), _y("event_id").alias("y"), (F.pmod("event_id", F.lit(100)) / 100.0).alias("confidence"))
    e = e.where(F.col("confidence") >= 0.72).drop("confidence")
    o = e.select(F.col("event_id").alias("o_id"), F.col("event_type").alias("o_type"), "app", F.col("x").alias("x2"), F.col("y").alias("y2"))
    g = P.grid_join(e, o, 140.0, "inner", ["app"]).groupBy("app", "event_id").agg(F.countDistinct("o_type").alias("types"), F.count("*").alias("support"))
    return g.where("types >= 2")


#: Metres to which the ends of path segments are snapped.
SNAP = 25


def path_components(spark, sf):
    """Every part is a segment of p_size metres, east for odd keys and north for even ones, with snapped ends: connected paths with their nodes."""
    p = _t(spark, sf, "part").select(_x("p_partkey").alias("x"), _y("p_partkey").alias("y"), F.when(F.pmod("p_partkey", F.lit(2)) == 1, F.col("p_size")).otherwise(F.lit(0)).alias("east"), "p_size")
    node = lambda x, y: (F.floor(x / SNAP) * 1000 + F.floor(y / SNAP)).cast("bigint")
    links = p.select(node(F.col("x"), F.col("y")).alias("u"), node(F.col("x") + F.col("east"), F.col("y") + F.col("p_size") - F.col("east")).alias("v"))
    return connected_components(links).groupBy("component").agg(F.count("*").alias("nodes"))


def _cells(spark, sf):
    """Cells of 50 metres that hold an event."""
    e = _t(spark, sf, "events").select(F.floor(_x("event_id") / 50).cast("int").alias("row"), F.floor(_y("event_id") / 50).cast("int").alias("col")).distinct()
    return e.withColumn("id", (F.col("row") * 100 + F.col("col")).cast("bigint"))


def connected_cell_groups(spark, sf):
    """4-connected groups of occupied cells: sizes and bounding boxes."""
    c = _cells(spark, sf)
    g = G.connected_cells(c.select("id", "row", "col")).join(c, "id")
    return g.groupBy("component").agg(F.count("*").alias("cells"), F.min("row").alias("r0"), F.max("row").alias("r1"), F.min("col").alias("c0"), F.max("col").alias("c1"))


def mask_distance(spark, sf):
    """Steps from each occupied cell to the nearest one on the left border."""
    return G.distance_to_mask(_cells(spark, sf).select("id", "row", "col", (F.col("col") < 3).alias("mask")))


def surface_paint(spark, sf):
    """Cells painted by parts in order of priority, and whether each is an edge."""
    p = _t(spark, sf, "part").select(F.pmod(F.col("p_partkey") * 7919, F.lit(60)).cast("int").alias("row"), _y("p_partkey", 60).cast("int").alias("col"), "p_brand", "p_size", "p_partkey")
    cells = G.painted(p.select("row", "col", F.col("p_brand").alias("code"), F.pmod("p_size", F.lit(5)).alias("priority"), F.col("p_partkey").alias("pos")))
    return G.with_edges(cells)


def pixel_classes(spark, sf):
    """Vectors read as colours with a texture: whether each is hardscape on its own evidence with its class and confidence, and the material of a component that looks so."""
    c, gsd = F.col("embedding"), 0.35
    v = _t(spark, sf, "embeddings").select("vec_id", *((F.floor((F.least(F.greatest(c[k].cast("double"), F.lit(-0.3)), F.lit(0.3)) + 0.3) * 425)).cast("double").alias(n) for k, n in enumerate("rgb")), F.pmod("vec_id", F.lit(60)).cast("double").alias("texture"))
    r, g, b, texture = (F.col(n) for n in ("r", "g", "b", "texture"))
    top = F.greatest("r", "g", "b")
    v = v.withColumns({"sat": F.when(top > 0, (top - F.least("r", "g", "b")) / F.greatest(top, F.lit(1.0))).otherwise(0.0), "lum": (0.2126 * r + 0.7152 * g + 0.0722 * b) / 255})
    sat, lum = F.col("sat"), F.col("lum")
    out = (lum < 0.07) | (lum > 0.9) | ((g - (r + b) / 2) / 255 > 0.055) | ((b - (r + g) / 2) / 255 > 0.09)
    warm = (r > g * 1.04) & (g > b * 1.03) & (sat <= 0.5) & (lum >= 0.16) & (lum <= 0.72)
    sure = 0.54 + 0.18 * S.clamp(1 - sat / 0.34, 0.0, 1.0) + 0.13 * S.clamp(1 - F.greatest(F.lit(0.0), texture - 30) / 32, 0.0, 1.0) + 0.1 * max(0.3, min(1.0, 1 - (gsd - 0.15) / 1.1)) + F.when(warm, 0.06).otherwise(0.0) + F.when((lum >= 0.14) & (lum <= 0.78), 0.04).otherwise(0.0)
    kind = F.when(warm, "warm-paving-candidate").when(lum < 0.42, "dark-hardscape-candidate").otherwise("light-hardscape-candidate")
    material = F.when((sat < 0.2) & (lum < 0.42) & (texture < 15), "asphalt").when((sat < 0.2) & (lum >= 0.42) & (texture < 13), "concrete").when((sat < 0.28) & (texture >= 13), F.when(texture <= 28, "paving_stones").otherwise("gravel")).when((r > g * 1.05) & (g > b * 1.03) & (sat <= 0.52), "paving_stones").otherwise("")
    look = F.when(material == "asphalt", S.clamp(0.86 - texture / 180, 0.72, 0.91)).when(material == "concrete", S.clamp(0.84 - texture / 180, 0.7, 0.9)).when((sat < 0.28) & (texture >= 13), F.when(texture <= 28, 0.78).otherwise(0.72)).when(material != "", 0.76).otherwise(0.45)
    return v.select("vec_id", F.when(out, "").otherwise(kind).alias("hardscape"), F.when(out, 0.0).otherwise(S.half_up(S.clamp(sure, 0.0, 0.96) + 1e-9, 3)).alias("confidence"), material.alias("material"), S.half_up(look + 1e-9, 3).alias("material_confidence"))


def label_nearest_shape(spark, sf):
    """For each supplier's label the part within 56 units with the least distance, less 0.08 for each point of its size as its priority."""
    lab = _t(spark, sf, "supplier").select("s_suppkey", _x("s_suppkey", 800).alias("x"), _y("s_suppkey", 800).alias("y"))
    shape = _t(spark, sf, "part").select("p_partkey", "p_size", _x("p_partkey", 800).alias("x2"), _y("p_partkey", 800).alias("y2"))
    distance = F.sqrt(F.pow(F.col("x") - F.col("x2"), 2) + F.pow(F.col("y") - F.col("y2"), 2))
    score = S.half_up(distance - 0.08 * F.col("p_size"), 6)
    return P.grid_join(lab, shape, 56.0).groupBy("s_suppkey").agg(F.min_by("p_partkey", F.struct(score.alias("s"), "p_partkey")).alias("p_partkey"), F.count("*").alias("near"))


def great_circle(spark, sf):
    """Metres from each customer to the first, rounded to centimetres."""
    lon = lambda k: F.lit(-1.897) + F.pmod(F.col(k) * 7919, F.lit(28000)) / 1e6
    lat = lambda k: F.lit(52.981) + F.pmod(F.col(k) * 104729, F.lit(15000)) / 1e6
    return _t(spark, sf, "customer").select("c_custkey", S.half_up(S.haversine_m(lat("c_custkey"), lon("c_custkey"), F.lit(52.981), F.lit(-1.897)), 2).alias("metres"))


QUERIES = {f.__name__: f for f in (gap_fill_points, authority_decisions_v30a, authority_decisions_v18, decision_counters, vector_promotion, affine_fit, tile_plan_tiers, tile_summary, consensus_groups, path_components, connected_cell_groups, mask_distance, surface_paint, pixel_classes, label_nearest_shape, great_circle)}

X, Y = "({k}::BIGINT * 7919 % {n})", "({k}::BIGINT * 104729 % {n})"
_xy = lambda key, n=5000: f"{X.format(k=key, n=n)} + {key} // {SHARE[key]} * {n} AS x, {Y.format(k=key, n=n)} AS y"


def _authority(mode: str) -> str:
    more = "WHEN second >= greatest(0.18, 0.9 * iou) THEN 'ambiguous' WHEN equivalent THEN 'corroborated'" if mode == "v18" else ""
    return f"""
WITH p AS (SELECT p_partkey, x AS x0, y AS y0, x + p_size AS x1, y + p_size AS y1 FROM (SELECT p_partkey, p_size, {_xy('p_partkey', 997)} FROM part)),
m AS (SELECT a.p_partkey AS planning_id, b.p_partkey AS target_id, (least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0)) AS shared, (a.x1 - a.x0) * (a.y1 - a.y0) AS area, (b.x1 - b.x0) * (b.y1 - b.y0) AS other
  FROM p a JOIN p b ON a.p_partkey % 4 = 0 AND b.p_partkey % 4 <> 0 AND a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1),
i AS (SELECT *, shared / (area + other - shared) AS iou, shared / area >= 0.82 AND shared / other >= 0.82 AS equivalent FROM m WHERE shared / least(area, other) >= 0.18),
t AS (SELECT *, row_number() OVER w AS n, lead(iou) OVER w AS second, count(*) OVER (PARTITION BY planning_id) AS n_targets FROM i WINDOW w AS (PARTITION BY planning_id ORDER BY iou DESC, target_id))
SELECT p.p_partkey AS planning_id, CASE WHEN p.p_partkey % 3 = 0 THEN 'withheld' WHEN target_id IS NULL THEN 'gap-fill' {more} ELSE 'replaced' END AS action, coalesce(target_id, -1) AS target_id, coalesce(n_targets, 0) AS n_targets
FROM p LEFT JOIN (SELECT * FROM t WHERE n = 1) t ON t.planning_id = p.p_partkey WHERE p.p_partkey % 4 = 0"""


_CELLS = f"SELECT DISTINCT (x // 50)::INTEGER AS row, (y // 50)::INTEGER AS col, (x // 50) * 100 + y // 50 AS id FROM (SELECT {_xy('event_id')} FROM events)"
ORACLE_SQL = {
    "gap_fill_points": f"""
WITH e AS (SELECT event_id, event_id % 5 AS name, {_xy('event_id')} FROM events), s AS (SELECT s_suppkey % 5 AS name, {_xy('s_suppkey')} FROM supplier)
SELECT event_id, name FROM e WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.name = e.name AND (e.x - s.x) * (e.x - s.x) + (e.y - s.y) * (e.y - s.y) <= 10000)""",
    "authority_decisions_v30a": _authority("v30a"),
    "authority_decisions_v18": _authority("v18"),
    "decision_counters": f"SELECT action, count(*) AS n, sum(n_targets)::BIGINT AS targets FROM ({_authority('v18')}) GROUP BY action",
    "vector_promotion": f"""
WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_partkey % 12 AS role, l_suppkey % 9 AS status, 100 - l_partkey % 45 AS conf, l_orderkey % 40 AS rmse10, l_quantity::BIGINT AS size, l_orderkey % 6 AS licence, (l_orderkey * 7 + l_linenumber) % 11 AS source, (l_orderkey * 7 + l_linenumber) % 5 AS state, l_orderkey % 6 = 1 AND l_orderkey % 4 < 2 AS private FROM lineitem),
g AS (SELECT *, role * 10 + conf * 10 - rmse10 * 4 AS priority, CASE WHEN role > 9 THEN 'role' WHEN status < 2 THEN 'status' WHEN conf < 78 THEN 'confidence' WHEN rmse10 > 25 THEN 'georeference' WHEN size < 5 THEN 'size' WHEN source = 0 THEN 'provenance' WHEN licence = 0 OR (licence = 1 AND NOT private) THEN 'licence' WHEN state = 4 THEN 'unresolved-status' END AS gate FROM v),
r AS (SELECT *, row_number() OVER (PARTITION BY gate IS NULL ORDER BY priority DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) AS n FROM g)
SELECT CASE WHEN gate IS NOT NULL THEN gate WHEN n > {PROMOTED} THEN 'cap' WHEN private THEN 'promoted-private-use' ELSE 'promoted' END AS gate, count(*) AS n, max(priority) AS best, sum(size)::BIGINT AS size FROM r GROUP BY 1""",
    "affine_fit": """
WITH c AS (SELECT l_suppkey, l_quantity::BIGINT AS x, l_linenumber::BIGINT AS y, (l_quantity * 3 + l_linenumber * 7 + l_orderkey % 5)::BIGINT AS e FROM lineitem),
g AS (SELECT l_suppkey, count(*)::DOUBLE AS n, sum(x)::DOUBLE AS sx, sum(y)::DOUBLE AS sy, sum(e)::DOUBLE AS se, sum(x * x)::DOUBLE AS xx, sum(x * y)::DOUBLE AS xy, sum(y * y)::DOUBLE AS yy, sum(x * e)::DOUBLE AS xe, sum(y * e)::DOUBLE AS ye FROM c GROUP BY 1),
d AS (SELECT *, xx*(yy*n-sy*sy)-xy*(xy*n-sy*sx)+sx*(xy*sy-yy*sx) AS det FROM g)
SELECT l_suppkey, floor((xe*(yy*n-sy*sy)-xy*(ye*n-sy*se)+sx*(ye*sy-yy*se)) / det * 10000 + 0.5) / 10000 AS a, floor((xx*(ye*n-sy*se)-xe*(xy*n-sy*sx)+sx*(xy*se-ye*sx)) / det * 10000 + 0.5) / 10000 AS b FROM d WHERE det <> 0""",
    "tile_plan_tiers": """
WITH b AS (SELECT s_suppkey AS plan_id, e AS e0, n AS n0, e + 500 + s_suppkey * 37 % 3000 AS e1, n + 300 + s_suppkey * 53 % 2500 AS n1 FROM (SELECT s_suppkey, s_suppkey * 7919 % 6000 AS e, s_suppkey * 104729 % 2500 AS n FROM supplier)),
t AS (SELECT *, unnest(range(0, ceil((e1 - e0) / 1000.0)::INTEGER)) AS c FROM (SELECT *, unnest(range(0, ceil((n1 - n0) / 1000.0)::INTEGER)) AS r FROM b)),
k AS (SELECT plan_id, 'r' || lpad(r::VARCHAR, 2, '0') || '-c' || lpad(c::VARCHAR, 2, '0') AS tile_id, (e0 + c * 1000)::BIGINT AS te0, (n0 + r * 1000)::BIGINT AS tn0, least(e0 + (c + 1) * 1000, e1)::BIGINT AS te1, least(n0 + (r + 1) * 1000, n1)::BIGINT AS tn1 FROM t),
g AS (SELECT *, sqrt((greatest(2000 - te1, te0 - 4000, 0) ** 2 + greatest(0 - tn1, tn0 - 1000, 0) ** 2)::DOUBLE) AS gap FROM k)
SELECT plan_id, tile_id, te0, tn0, te1, tn1, CASE WHEN te0 < 4000 AND te1 > 2000 AND tn0 < 1000 AND tn1 > 0 THEN 'core' WHEN gap <= 750 THEN 'near' ELSE 'outer' END AS tier, floor(gap * 100 + 0.5) / 100 AS gap_m FROM g""",
    "tile_summary": f"""
WITH e AS (SELECT floor({X.format(k='event_id', n=6000)} / 1000)::INTEGER AS col, (event_id % 10 > 0)::INTEGER AS valid FROM events)
SELECT CASE WHEN col IN (2, 3) THEN 'core' WHEN col IN (1, 4) THEN 'near' ELSE 'outer' END AS tier, count(*) AS total, sum(valid)::BIGINT AS valid, min(col) AS first, max(col) AS last, floor(sum(valid) * 100000.0 / count(*) + 0.5) / 1000 AS coverage FROM e GROUP BY 1""",
    "consensus_groups": f"""
WITH e AS (SELECT event_id, event_type, user_id % 8 AS app, {_xy('event_id')} FROM events WHERE (event_id % 100) / 100.0::DOUBLE >= 0.72)
SELECT a.app, a.event_id, count(DISTINCT b.event_type) AS types, count(*) AS support FROM e a JOIN e b ON a.app = b.app AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 19600 GROUP BY 1, 2 HAVING count(DISTINCT b.event_type) >= 2""",
    "path_components": f"""
WITH RECURSIVE p AS (SELECT {_xy('p_partkey')}, CASE WHEN p_partkey % 2 = 1 THEN p_size ELSE 0 END AS east, p_size FROM part),
l AS (SELECT DISTINCT (x // {SNAP}) * 1000 + y // {SNAP} AS u, ((x + east) // {SNAP}) * 1000 + (y + p_size - east) // {SNAP} AS v FROM p), e AS (SELECT u, v FROM l UNION SELECT v, u FROM l),
r AS (SELECT u AS node, u AS root FROM e UNION SELECT e.v, r.root FROM r JOIN e ON e.u = r.node)
SELECT component, count(*) AS nodes FROM (SELECT node, min(root) AS component FROM r GROUP BY node) GROUP BY 1""",
    "connected_cell_groups": f"""
WITH RECURSIVE c AS ({_CELLS}), e AS (SELECT a.id AS u, b.id AS v FROM c a JOIN c b ON abs(a.row - b.row) + abs(a.col - b.col) = 1), r AS (SELECT id AS node, id AS root FROM c UNION SELECT e.v, r.root FROM r JOIN e ON e.u = r.node),
g AS (SELECT node, min(root) AS component FROM r GROUP BY node)
SELECT component, count(*) AS cells, min(row) AS r0, max(row) AS r1, min(col) AS c0, max(col) AS c1 FROM g JOIN c ON c.id = g.node GROUP BY 1""",
    "mask_distance": f"""
WITH RECURSIVE c AS ({_CELLS}), e AS (SELECT a.id AS u, b.id AS v FROM c a JOIN c b ON abs(a.row - b.row) + abs(a.col - b.col) = 1),
r AS (SELECT id, 0 AS d FROM c WHERE col < 3 UNION SELECT e.v, r.d + 1 FROM r JOIN e ON e.u = r.id WHERE r.d < 300)
SELECT c.id, coalesce(min(d), 65535)::INTEGER AS distance FROM c LEFT JOIN r USING (id) GROUP BY c.id""",
    "surface_paint": f"""
WITH p AS (SELECT {X.format(k='p_partkey', n=60)}::INTEGER AS row, {Y.format(k='p_partkey', n=60)}::INTEGER AS col, p_brand, p_size % 5 AS priority, p_partkey FROM part),
c AS (SELECT row, col, arg_max(p_brand, priority * 100000000 + p_partkey) AS code FROM p GROUP BY 1, 2)
SELECT row, col, code, (SELECT count(*) FROM c o WHERE abs(o.row - c.row) + abs(o.col - c.col) = 1) < 4 AS edge FROM c""",
    "pixel_classes": """
WITH v AS (SELECT vec_id, floor((least(greatest(embedding[1]::DOUBLE, -0.3), 0.3) + 0.3) * 425)::DOUBLE AS r, floor((least(greatest(embedding[2]::DOUBLE, -0.3), 0.3) + 0.3) * 425)::DOUBLE AS g, floor((least(greatest(embedding[3]::DOUBLE, -0.3), 0.3) + 0.3) * 425)::DOUBLE AS b, (vec_id % 60)::DOUBLE AS texture FROM embeddings),
m AS (SELECT *, CASE WHEN greatest(r, g, b) > 0 THEN (greatest(r, g, b) - least(r, g, b)) / greatest(r, g, b, 1.0) ELSE 0.0 END AS sat, (0.2126::DOUBLE * r + 0.7152::DOUBLE * g + 0.0722::DOUBLE * b) / 255 AS lum FROM v),
w AS (SELECT *, lum < 0.07 OR lum > 0.9 OR (g - (r + b) / 2) / 255 > 0.055 OR (b - (r + g) / 2) / 255 > 0.09 AS gone, r > g * 1.04::DOUBLE AND g > b * 1.03::DOUBLE AND sat <= 0.5 AND lum >= 0.16 AND lum <= 0.72 AS warm,
CASE WHEN sat < 0.2 AND lum < 0.42 AND texture < 15 THEN 'asphalt' WHEN sat < 0.2 AND lum >= 0.42 AND texture < 13 THEN 'concrete' WHEN sat < 0.28 AND texture >= 13 THEN CASE WHEN texture <= 28 THEN 'paving_stones' ELSE 'gravel' END WHEN r > g * 1.05::DOUBLE AND g > b * 1.03::DOUBLE AND sat <= 0.52 THEN 'paving_stones' ELSE '' END AS material FROM m)
SELECT vec_id, CASE WHEN gone THEN '' WHEN warm THEN 'warm-paving-candidate' WHEN lum < 0.42 THEN 'dark-hardscape-candidate' ELSE 'light-hardscape-candidate' END AS hardscape,
CASE WHEN gone THEN 0.0 ELSE floor((least(0.96, greatest(0.0, 0.54::DOUBLE + 0.18 * least(1.0, greatest(0.0, 1 - sat / 0.34)) + 0.13 * least(1.0, greatest(0.0, 1 - greatest(0.0, texture - 30) / 32)) + 0.1 * (1 - 0.2::DOUBLE / 1.1) + CASE WHEN warm THEN 0.06 ELSE 0.0 END + CASE WHEN lum >= 0.14 AND lum <= 0.78 THEN 0.04 ELSE 0.0 END)) + 1e-9) * 1000 + 0.5) / 1000 END AS confidence, material,
floor((CASE WHEN material = 'asphalt' THEN least(0.91, greatest(0.72, 0.86::DOUBLE - texture / 180)) WHEN material = 'concrete' THEN least(0.9, greatest(0.7, 0.84::DOUBLE - texture / 180)) WHEN sat < 0.28 AND texture >= 13 THEN CASE WHEN texture <= 28 THEN 0.78 ELSE 0.72 END WHEN material <> '' THEN 0.76 ELSE 0.45 END + 1e-9) * 1000 + 0.5) / 1000 AS material_confidence FROM w""",
    "label_nearest_shape": f"""
WITH l AS (SELECT s_suppkey, {_xy('s_suppkey', 800)} FROM supplier), p AS (SELECT p_partkey, p_size, {_xy('p_partkey', 800)} FROM part),
j AS (SELECT s_suppkey, p_partkey, ((l.x - p.x) * (l.x - p.x) + (l.y - p.y) * (l.y - p.y)) AS d2, p_size FROM l JOIN p ON (l.x - p.x) * (l.x - p.x) + (l.y - p.y) * (l.y - p.y) <= 3136)
SELECT s_suppkey, arg_min(p_partkey, (floor((sqrt(d2) - 0.08::DOUBLE * p_size) * 1e6 + 0.5) / 1e6, p_partkey)) AS p_partkey, count(*) AS near FROM j GROUP BY 1""",
    "great_circle": """
WITH p AS (SELECT c_custkey, radians(52.981 + (c_custkey * 104729 % 15000) / 1e6) AS b, radians(-1.897 + (c_custkey * 7919 % 28000) / 1e6) AS l FROM customer)
SELECT c_custkey, floor(2000.0 * 6371.0088 * asin(least(1.0, sqrt(sin((radians(52.981) - b) / 2) ** 2 + cos(b) * cos(radians(52.981)) * sin((radians(-1.897) - l) / 2) ** 2))) * 100 + 0.5) / 100 AS metres FROM p""",
}
