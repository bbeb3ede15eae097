"""Drawings with nested groups and path data: their shapes, and the same in DuckDB SQL.

Every supplier has a drawing of one template with numbers of its own. The twin walks tags and path steps by recursion, row by row,
and samples curves as rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidara.functions import geometry as G
from evidara.functions import rules as R
from evidara.functions.scalars import half_up
from evidara.operators import drawings as D
from evidara.operators import junctions as J
from evidara.operators import spatial as P
from evidara.operators.graph import line_components
from evidara.session import spread

#: The template's text between its numbers, and each number as (factor, modulus) of the key.
PIECES = (
    '<svg width="842" height="595"><g transform="translate(', (3, 50), ",", (5, 40), ") rotate(", (11, 360), ' 5 5)"><g transform=\'scale(2 3) matrix(1 0 0.5 1 0 ', (7, 9), ')\'><path d="M', (13, 60), " 2 L3,", (17, 70), " h5 v-", (19, 20), " l1 1 2 2z m1,1 c1 0 2 ", (23, 15), " 3 3 s1 1 2 2 q1 ", (29, 25),
    " 2 0 t3 3 t1 1 a1 1 0 0 1 4 4 H", (31, 30), ' v.5" stroke="#f00" opacity="0.5"/></g><rect x="1" y="2" width="', (37, 12), '" height="4" style="fill: blue; stroke-width:2"/></g></g><path d="M0 0 Q', (41, 44), " 5 10 0 Z L", (43, 8), ' 4 M1 1" visibility="visible"/><g transform="scale(', (47, 3), ')"><path d="M1 1 L2 2 B3 3 L9 9"/><path d="M1 1 L2 2" style="display:none"/>',
    '<polygon points="0,0 ', (53, 9), ',0 1,1"/></g><path d="S 5 5 ', (59, 17), ' 3 T 9 9 L 7"/><polyline points="0 0 0 0 5 ', (61, 6), ' 7"/><line x2="', (67, 5), '" y2="1"/></svg>',
)


def _drawings(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    svg = F.concat(*(F.lit(p) if isinstance(p, str) else F.pmod(k * p[0], F.lit(p[1])).cast("string") for p in PIECES))
    return spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey", svg.alias("svg"))


def drawing_paths(spark, sf):
    """The shapes of every drawing: points, whether closed and curved, style, corners and length."""
    s = D.shapes(spread(_drawings(spark, sf), "s_suppkey"), ["s_suppkey"])
    corner = lambda f, axis: half_up(f(F.transform("points", lambda p: p[axis])) + 1e-7, 4)
    return s.select("s_suppkey", "place", "part", "kind", F.size("points").alias("n"), "closed", "curved", F.coalesce("stroke", F.lit("")).alias("stroke"), F.coalesce("fill", F.lit("")).alias("fill"), "opacity", corner(F.array_min, "x").alias("x0"), corner(F.array_max, "y").alias("y1"), half_up(G.length(F.col("points")) + 1e-7, 4).alias("length"))


def junction_lines(spark, sf):
    """Orders as bent lines with their line items' places put in as junctions: the points, how many were put in, and a mark of points and order."""
    k = F.col("o_orderkey")
    line = F.array(G.point(F.pmod(k, F.lit(20)), F.lit(0)), G.point(F.pmod(k, F.lit(20)) + 8, F.lit(0)), G.point(F.pmod(k, F.lit(20)) + 8, F.pmod(k, F.lit(9)) + 4))
    lines = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", line.alias("line"))
    k, n = F.col("l_orderkey"), F.col("l_partkey") * 7 + F.col("l_linenumber") * 3
    # every other place is beside the second segment, some are too far off
    off = (F.pmod(n, F.lit(5)) - 2) * 0.09375
    along, up = F.pmod(n, F.lit(64)) / 8.0, F.pmod(F.col("l_suppkey"), F.lit(2)) == 1
    x, y = F.pmod(k, F.lit(20)) + F.when(up, 8 + off).otherwise(along), F.when(up, along).otherwise(off)
    places = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").cast("int").alias("pos"), x.cast("double").alias("x"), y.cast("double").alias("y"))
    found = J.spliced(lines, places, "o_orderkey")
    whole = lambda v: F.floor(v * 100000 + 0.5).cast("bigint")
    marks = F.aggregate(F.transform("line", lambda p, i: (whole(p["x"]) * 7 + whole(p["y"]) * 13) * (i + 1)), F.lit(0).cast("bigint"), lambda s, v: s + v)
    return found.select("o_orderkey", F.size("line").alias("points"), "inserted", marks.alias("mark"))


#: Roles and surfaces of connectors, dealt by key.
ROLES, SURFACES = ("guest", "queue", "service"), ("asphalt", "", None, "gravel")


def connector_rows(spark, sf):
    """Line items as connectors between their part and supplier: each as a derived feature, its tags in order of name."""
    k = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"), F.when(F.pmod(k, F.lit(3)) == 0, "road").otherwise("path").alias("kind"), R.dealt(k, ROLES).alias("role"), R.dealt(k, SURFACES).alias("surface"), (F.pmod(k, F.lit(40)) / 8.0).alias("distance"), (F.pmod(k, F.lit(16)) / 16.0).alias("confidence"), F.col("l_partkey").alias("from_id"), F.col("l_suppkey").alias("to_id"))
    tags = F.array_join(F.array_sort(F.transform(F.map_entries("tags"), lambda e: F.concat_ws("=", e["key"], e["value"]))), ";")
    return J.connector_features(rows).select("id", "kind", "subtype", tags.alias("tags"), "status")


def line_connectivity(spark, sf):
    """Orders as bent lines along a strip: each connected group with its lines, nodes, edges and dangling ends."""
    k = F.col("o_orderkey")
    x, y = F.floor(k / 3) * 4, F.pmod(k * 7, F.lit(5)) * 4
    line = F.array(G.point(x, y), G.point(x + F.pmod(k, F.lit(3)) * 4 + 0.1, y), G.point(x + F.pmod(k, F.lit(3)) * 4, y + F.pmod(k, F.lit(2)) * 4 + 0.2))
    return line_components(spark.read.parquet(f"{sf}/orders.parquet").select(k.alias("id"), F.when(F.pmod(k, F.lit(50)) > 0, line).alias("line")))


SHAPE = ((0, 0), (30, 0), (30, 20), (10, 25), (0, 20))


def shape_labels(spark, sf):
    """The label, a customer's place, of every part's shape, closed or open."""
    k = F.col("p_partkey")
    shapes = spark.read.parquet(f"{sf}/part.parquet").select(k.alias("shape_id"), G.ring(k * 40, F.pmod(k * 13, F.lit(90)), SHAPE).alias("points"), (F.pmod(k, F.lit(3)) > 0).alias("closed"))
    k = F.col("c_custkey")
    labels = spark.read.parquet(f"{sf}/customer.parquet").select(k.alias("label_id"), k.alias("pos"), (k * 53.25).cast("double").alias("x"), F.pmod(k * 17, F.lit(100)).cast("double").alias("y"), (F.pmod(k, F.lit(6)) * 20).cast("int").alias("priority"))
    return P.shape_labels(shapes, labels).select("shape_id", "label_id", half_up(F.col("distance") + 1e-9, 4).alias("distance"))


#: Roles of vectors, with the kind and subtype of what they become, the geometry they need, and their priority.
VECTOR_ROLES = (
    ("access-path-centerline-candidate", "path", "planning-access-path", "line", 100), ("access-surface-candidate", "surface", "planning-access-surface", "area", 95), ("ride-centerline-candidate", "ride_track", "planning-ride-centerline", "line", 92),
    ("ride-footprint-candidate", "attraction", "planning-ride-footprint", "area", 86), ("building-footprint-candidate", "building", "planning-building-footprint", "area", 90), ("landscape-polygon-candidate", "vegetation", "planning-landscape-area", "area", 72),
    ("landscape-boundary-candidate", "barrier", "planning-landscape-boundary", "line", 48), ("drainage-or-contour-line-candidate", "water", "planning-drainage-line", "line", 62), ("lighting-area-candidate", "detail", "planning-lighting-area", "area", 35), ("lighting-layout-line-candidate", "detail", "planning-lighting-layout", "line", 35),
    ("site-path-centerline-candidate", "path", "planning-site-path", "line", 108), ("site-path-surface-candidate", "path", "planning-site-path-surface", "area", 109), ("site-building-footprint-candidate", "building", "planning-site-building", "area", 106), ("site-wall-candidate", "barrier", "wall", "line", 104),
    ("site-wall-footprint-candidate", "structure", "planning-wall-footprint", "area", 101), ("site-fence-candidate", "barrier", "fence", "line", 100), ("site-fence-footprint-candidate", "structure", "planning-fence-footprint", "area", 96), ("site-bridge-centerline-candidate", "path", "planning-bridge", "line", 110),
    ("site-bridge-surface-candidate", "path", "planning-bridge-deck", "area", 111), ("site-tunnel-centerline-candidate", "path", "planning-tunnel", "line", 110), ("site-tunnel-surface-candidate", "path", "planning-tunnel-surface", "area", 111), ("site-water-body-candidate", "water", "planning-water-body", "area", 102),
    ("site-watercourse-candidate", "water", "planning-watercourse", "line", 98), ("site-vegetation-area-candidate", "vegetation", "planning-vegetation-area", "area", 94), ("site-vegetation-boundary-candidate", "vegetation", "planning-vegetation-boundary", "line", 82),
    ("site-rock-area-candidate", "terrain_detail", "planning-rockwork", "area", 92), ("site-rock-line-candidate", "terrain_detail", "planning-rockwork-line", "line", 80), ("site-terrain-change-area-candidate", "terrain_detail", "planning-earthworks", "area", 90),
    ("site-terrain-change-line-candidate", "terrain_detail", "planning-level-or-earthwork-line", "line", 88),
)


def vector_roles(spark, sf):
    """Line items as vectors by role and geometry: what they become, those that a role doesn't allow, and the best priority with confidence and error."""
    k = F.col("l_orderkey") * 3 + F.col("l_linenumber")
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select(R.dealt(k, [*(r[0] for r in VECTOR_ROLES), "site-unknown-candidate"]).alias("role"), R.dealt(F.col("l_partkey"), ("line", "area")).alias("geometry"), (60 + F.pmod("l_partkey", F.lit(40))).alias("percent"), F.pmod("l_suppkey", F.lit(30)).alias("tenths"))
    known = spark.createDataFrame(VECTOR_ROLES, "role string, kind string, subtype string, needs string, base int")
    made = rows.join(F.broadcast(known), "role", "left").withColumn("allowed", F.coalesce(F.col("needs") == F.col("geometry"), F.lit(False)))
    # role + 100 * confidence - 4 * error, in tenths so that it is whole
    priority = F.col("base") * 10 + F.col("percent") * 10 - F.col("tenths") * 4
    return made.groupBy("role", "geometry", F.coalesce("kind", F.lit("")).alias("kind"), F.coalesce("subtype", F.lit("")).alias("subtype"), "allowed").agg(F.count("*").alias("n"), F.max(F.when(F.col("allowed"), priority)).alias("best")).fillna(-1, ["best"])


QUERIES = {f.__name__: f for f in (drawing_paths, junction_lines, connector_rows, line_connectivity, shape_labels, vector_roles)}

_quote = lambda v: "'" + v.replace("'", "''") + "'"
_SVG = " || ".join(_quote(p) if isinstance(p, str) else f"(s_suppkey * {p[0]} % {p[1]})" for p in PIECES)
_attr = lambda tag, name: f"""CASE WHEN regexp_matches({tag}, '(?i)\\b{name}\\s*=\\s*["'']') THEN regexp_extract({tag}, '(?i)\\b{name}\\s*=\\s*(?:"([^"]*)"|''([^'']*)'')', 1) || regexp_extract({tag}, '(?i)\\b{name}\\s*=\\s*(?:"([^"]*)"|''([^'']*)'')', 2) END"""
_style = lambda name: f"coalesce({_attr('tag', name)}, nullif(trim(regexp_extract({_attr('tag', 'style')}, '(?:^|;)\\s*{name}\\s*:\\s*([^;]*)', 1)), ''))"
_numbers = lambda text: f"list_transform(regexp_extract_all({text}, '[-+]?(?:\\d*\\.\\d+|\\d+\\.?)'), lambda v: v::DOUBLE)"
_TIMES = "[m[1]*n[1]+m[3]*n[2], m[2]*n[1]+m[4]*n[2], m[1]*n[3]+m[3]*n[4], m[2]*n[3]+m[4]*n[4], m[1]*n[5]+m[3]*n[6]+m[5], m[2]*n[5]+m[4]*n[6]+m[6]]"
_IDENTITY = "[1.0, 0, 0, 1, 0, 0]::DOUBLE[]"
_OWN = f"""list_reduce(list_prepend({_IDENTITY}, list_transform(list_transform(regexp_extract_all(coalesce({_attr('tag', 'transform')}, ''), '(?:matrix|translate|scale|rotate)\\s*\\([^)]*\\)'), lambda p: {{'kind': regexp_extract(p, '^[a-z]+'), 'n': {_numbers('p')}}}), lambda p:
  CASE p.kind WHEN 'translate' THEN [1, 0, 0, 1, p.n[1], coalesce(p.n[2], 0)] WHEN 'scale' THEN [p.n[1], 0, 0, coalesce(p.n[2], p.n[1]), 0, 0] WHEN 'matrix' THEN p.n
  ELSE [cos(radians(p.n[1])), sin(radians(p.n[1])), -sin(radians(p.n[1])), cos(radians(p.n[1])), p.n[2] - p.n[2] * cos(radians(p.n[1])) + p.n[3] * sin(radians(p.n[1])), p.n[3] - p.n[2] * sin(radians(p.n[1])) - p.n[3] * cos(radians(p.n[1]))] END::DOUBLE[])), lambda m, n: {_TIMES})"""

ORACLE_SQL = {
    "drawing_paths": f"""
WITH RECURSIVE t AS MATERIALIZED (SELECT s_suppkey, i, tags[i] AS tag, CASE WHEN tags[i] LIKE '</g%' THEN -1 WHEN tags[i] LIKE '<g%' THEN 1 ELSE 0 END AS step FROM (SELECT *, unnest(range(1, len(tags) + 1)) AS i FROM (SELECT s_suppkey, regexp_extract_all({_SVG}, '</?g\\b[^>]*>|<(?:path|polyline|polygon|line|rect)\\b[^>]*>') AS tags FROM supplier))),
o AS MATERIALIZED (SELECT *, {_OWN} AS n FROM t),
walk AS (SELECT s_suppkey, 0::BIGINT AS i, [{_IDENTITY}] AS stack, {_IDENTITY} AS here FROM supplier UNION ALL
  SELECT s_suppkey, i, CASE step WHEN 1 THEN list_append(stack, made) WHEN -1 THEN CASE WHEN len(stack) > 1 THEN stack[:-2] ELSE stack END ELSE stack END, made FROM (SELECT o.s_suppkey, o.i, step, stack, (SELECT {_TIMES} FROM (SELECT stack[-1] AS m, o.n AS n)) AS made FROM walk w JOIN o ON o.s_suppkey = w.s_suppkey AND o.i = w.i + 1)),
e AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY i) - 1 AS place, regexp_extract(tag, '^<([a-z]+)', 1) AS kind, coalesce({_style('opacity')}::DOUBLE, 1.0) AS opacity, {_style('stroke')} AS stroke, {_style('fill')} AS fill FROM (SELECT o.*, here FROM o JOIN walk USING (s_suppkey, i) WHERE step = 0)),
shown AS (SELECT * FROM e WHERE coalesce({_style('display')}, '') <> 'none' AND coalesce({_style('visibility')}, '') <> 'hidden' AND opacity <> 0),
c AS (SELECT s_suppkey, place, generate_subscripts(cs, 1) AS j, unnest(cs) AS c FROM (SELECT s_suppkey, place, regexp_extract_all({_attr('tag', 'd')}, '[a-zA-Z][^a-zA-Z]*') AS cs FROM shown WHERE kind = 'path')),
a AS (SELECT *, upper(c[1]) AS op, c[1] <> upper(c[1]) AS rel, {_numbers('c')} AS n, coalesce((MAP {{'M': 2, 'L': 2, 'H': 1, 'V': 1, 'C': 6, 'S': 4, 'Q': 4, 'T': 2, 'A': 7}})[upper(c[1])], 0) AS takes FROM c),
b AS (SELECT *, min(CASE WHEN (op = 'Z' AND len(n) > 0) OR (op <> 'Z' AND (takes = 0 OR len(n) < takes OR len(n) % takes > 0)) THEN j END) OVER (PARTITION BY s_suppkey, place) AS bad FROM a),
sets AS (SELECT s_suppkey, place, j, q, rel, CASE WHEN op = 'M' AND q > 0 THEN 'L' ELSE op END AS op, n[q * takes + 1 : q * takes + takes] AS n FROM (SELECT *, unnest(CASE WHEN op = 'Z' THEN [0] ELSE range(0, len(n) // greatest(takes, 1)) END) AS q FROM b WHERE (bad IS NULL OR j <= bad) AND (op = 'Z' OR takes > 0))),
s AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY s_suppkey, place ORDER BY j, q) AS k FROM sets),
pen AS (SELECT DISTINCT s_suppkey, place, 0::BIGINT AS k, ''::VARCHAR AS op, 0.0::DOUBLE AS x0, 0.0::DOUBLE AS y0, NULL::DOUBLE AS x1, NULL::DOUBLE AS y1, NULL::DOUBLE AS x2, NULL::DOUBLE AS y2, 0.0::DOUBLE AS x, 0.0::DOUBLE AS y, NULL::DOUBLE AS bx, NULL::DOUBLE AS sy, NULL::DOUBLE AS cx, NULL::DOUBLE AS cy, -1 AS part, false AS opened, false AS first FROM s UNION ALL
  SELECT s_suppkey, place, k, op, px, py, x1, y1, x2, y2, x, y, CASE WHEN op = 'M' THEN x ELSE bx END, CASE WHEN op = 'M' THEN y ELSE sy END, CASE WHEN op IN ('C', 'S') THEN x2 WHEN op IN ('Q', 'T') THEN x1 END, CASE WHEN op IN ('C', 'S') THEN y2 WHEN op IN ('Q', 'T') THEN y1 END, part + fresh::INTEGER, op <> 'Z', fresh FROM (
    SELECT s.s_suppkey, s.place, s.k, s.op, p.x AS px, p.y AS py, p.bx, p.sy, p.part, s.op = 'M' OR NOT p.opened AS fresh, CASE WHEN rel THEN p.x ELSE 0 END AS rx, CASE WHEN rel THEN p.y ELSE 0 END AS ry,
      CASE WHEN s.op IN ('C', 'Q') THEN rx + n[1] WHEN s.op IN ('S', 'T') THEN coalesce(2 * p.x - p.cx, p.x) END AS x1, CASE WHEN s.op IN ('C', 'Q') THEN ry + n[2] WHEN s.op IN ('S', 'T') THEN coalesce(2 * p.y - p.cy, p.y) END AS y1,
      CASE s.op WHEN 'C' THEN rx + n[3] WHEN 'S' THEN rx + n[1] END AS x2, CASE s.op WHEN 'C' THEN ry + n[4] WHEN 'S' THEN ry + n[2] END AS y2,
      CASE WHEN s.op = 'Z' THEN coalesce(p.bx, p.x) WHEN s.op = 'V' THEN p.x WHEN s.op = 'H' THEN rx + n[1] ELSE rx + n[-2] END AS x, CASE WHEN s.op = 'Z' THEN coalesce(p.sy, p.y) WHEN s.op = 'H' THEN p.y ELSE ry + n[-1] END AS y
    FROM pen p JOIN s ON s.s_suppkey = p.s_suppkey AND s.place = p.place AND s.k = p.k + 1)),
w AS (SELECT *, CASE WHEN op IN ('C', 'S') THEN least(128, greatest(4, ceil(sqrt((x1-x0)**2 + (y1-y0)**2) + sqrt((x2-x1)**2 + (y2-y1)**2) + sqrt((x-x2)**2 + (y-y2)**2)))) WHEN op IN ('Q', 'T') THEN least(96, greatest(3, ceil(sqrt((x1-x0)**2 + (y1-y0)**2) + sqrt((x-x1)**2 + (y-y1)**2)))) WHEN op = 'Z' AND sqrt((x-x0)**2 + (y-y0)**2) <= 1e-9 THEN 0 ELSE 1 END::INTEGER AS steps FROM pen WHERE k > 0),
u AS (SELECT *, unnest(range(CASE WHEN first AND op <> 'M' THEN 0 ELSE 1 END, steps + 1)) AS g FROM w), v AS (SELECT *, CASE WHEN steps = 0 THEN 0.0 ELSE g::DOUBLE / steps END AS h FROM u),
pp AS (SELECT s_suppkey, place, part, k, g, op, CASE WHEN g = 0 THEN x0 WHEN op IN ('C', 'S') THEN (1-h)**3*x0 + 3*(1-h)**2*h*x1 + 3*(1-h)*h**2*x2 + h**3*x WHEN op IN ('Q', 'T') THEN (1-h)**2*x0 + 2*(1-h)*h*x1 + h**2*x ELSE x END AS x, CASE WHEN g = 0 THEN y0 WHEN op IN ('C', 'S') THEN (1-h)**3*y0 + 3*(1-h)**2*h*y1 + 3*(1-h)*h**2*y2 + h**3*y WHEN op IN ('Q', 'T') THEN (1-h)**2*y0 + 2*(1-h)*h*y1 + h**2*y ELSE y END AS y FROM v),
kept AS (SELECT *, row_number() OVER (PARTITION BY s_suppkey, place ORDER BY part) - 1 AS newpart FROM (SELECT s_suppkey, place, part, bool_or(op = 'Z') AS closed, bool_or(op IN ('C', 'S', 'Q', 'T', 'A')) AS curved FROM w JOIN (SELECT s_suppkey, place, part FROM pp GROUP BY s_suppkey, place, part HAVING count(*) >= 2) USING (s_suppkey, place, part) GROUP BY s_suppkey, place, part)),
flat AS (SELECT s_suppkey, place, kind, CASE kind WHEN 'line' THEN [0.0, 0.0, {_attr('tag', 'x2')}::DOUBLE, {_attr('tag', 'y2')}::DOUBLE] WHEN 'rect' THEN [rx, ry, rx + rw, ry, rx + rw, ry + rh, rx, ry + rh, rx, ry] ELSE {_numbers(_attr('tag', 'points'))} END AS n FROM (SELECT *, {_attr('tag', 'x')}::DOUBLE AS rx, {_attr('tag', 'y')}::DOUBLE AS ry, {_attr('tag', 'width')}::DOUBLE AS rw, {_attr('tag', 'height')}::DOUBLE AS rh FROM shown WHERE kind <> 'path') WHERE kind <> 'rect' OR (rw > 0 AND rh > 0)),
raw AS (SELECT s_suppkey, place, newpart AS part, closed, curved, k * 1000 + g AS pos, x, y FROM pp JOIN kept USING (s_suppkey, place, part) UNION ALL
  SELECT s_suppkey, place, 0, kind IN ('rect', 'polygon'), false, z, n[2 * z + 1], n[2 * z + 2] FROM (SELECT *, unnest(range(0, len(n) // 2)) AS z FROM flat)),
placed AS (SELECT raw.s_suppkey, place, part, closed, curved, pos, here[1] * x + here[3] * y + here[5] AS x, here[2] * x + here[4] * y + here[6] AS y, kind, opacity, stroke, fill FROM raw JOIN shown USING (s_suppkey, place)),
steps AS (SELECT *, lag(x) OVER q AS lx, lag(y) OVER q AS ly FROM placed WINDOW q AS (PARTITION BY s_suppkey, place, part ORDER BY pos))
SELECT s_suppkey, place::INTEGER AS place, part::INTEGER AS part, kind, count(*)::INTEGER AS n, closed, curved, coalesce(stroke, '') AS stroke, coalesce(fill, '') AS fill, opacity, floor((min(x) + 1e-7) * 10000 + 0.5) / 10000 AS x0, floor((max(y) + 1e-7) * 10000 + 0.5) / 10000 AS y1,
  floor((coalesce(sum(sqrt((x - lx) ** 2 + (y - ly) ** 2)), 0) + 1e-7) * 10000 + 0.5) / 10000 AS length FROM steps WHERE lx IS NULL OR lx <> x OR ly <> y GROUP BY ALL HAVING count(*) >= 2""",
    "junction_lines": """
WITH RECURSIVE o AS (SELECT o_orderkey AS k, (o_orderkey % 20)::DOUBLE AS x0, (o_orderkey % 20 + 8)::DOUBLE AS x1, (o_orderkey % 9 + 4)::DOUBLE AS y2 FROM orders),
n AS (SELECT l_orderkey AS k, l_linenumber AS pos, l_partkey * 7 + l_linenumber * 3 AS n, l_suppkey % 2 = 1 AS up FROM lineitem),
t AS (SELECT k, pos, k % 20 + CASE WHEN up THEN 8 + (n % 5 - 2) * 0.09375::DOUBLE ELSE (n % 64) / 8.0::DOUBLE END AS x, CASE WHEN up THEN (n % 64) / 8.0::DOUBLE ELSE (n % 5 - 2) * 0.09375::DOUBLE END AS y FROM n),
d AS (SELECT *, greatest(0.0, least(1.0, (x - x0) / 8)) AS s0, greatest(0.0, least(1.0, y / y2)) AS s1 FROM t JOIN o USING (k)),
e AS (SELECT *, sqrt((x0 + s0 * 8 - x) ** 2 + y ** 2) AS d0, sqrt((x1 - x) ** 2 + (s1 * y2 - y) ** 2) AS d1, least(sqrt((x - x0) ** 2 + y ** 2), sqrt((x - x1) ** 2 + y ** 2), sqrt((x - x1) ** 2 + (y - y2) ** 2)) AS vertex FROM d),
f AS MATERIALIZED (SELECT k, x, y, i, row_number() OVER (PARTITION BY k ORDER BY i, share, pos, x, y) AS j FROM (SELECT *, CASE WHEN d0 <= d1 THEN 0 ELSE 1 END AS i, CASE WHEN d0 <= d1 THEN s0 ELSE s1 END AS share FROM e WHERE least(d0, d1) <= 0.2 AND vertex >= 0.15)),
-- one target after the other, along the line
put AS (SELECT k, 0::BIGINT AS j, []::STRUCT(x DOUBLE, y DOUBLE, i INTEGER)[] AS taken FROM o UNION ALL
  SELECT f.k, f.j, CASE WHEN len(list_filter(taken, lambda p: sqrt((p.x - f.x) ** 2 + (p.y - f.y) ** 2) < 0.15)) > 0 THEN taken ELSE list_append(taken, {'x': f.x, 'y': f.y, 'i': f.i}) END FROM put JOIN f ON f.k = put.k AND f.j = put.j + 1),
g AS (SELECT k, arg_max(taken, j) AS taken FROM put GROUP BY k),
l AS (SELECT k, len(taken) AS inserted, [{'x': x0, 'y': 0.0}] || list_transform(list_filter(taken, lambda p: p.i = 0), lambda p: {'x': p.x, 'y': p.y}) || [{'x': x1, 'y': 0.0}] || list_transform(list_filter(taken, lambda p: p.i = 1), lambda p: {'x': p.x, 'y': p.y}) || [{'x': x1, 'y': y2}] AS line FROM g JOIN o USING (k))
SELECT k AS o_orderkey, len(line)::INTEGER AS points, inserted::INTEGER AS inserted, list_sum(list_transform(range(1, len(line) + 1), lambda i: (floor(line[i].x * 100000 + 0.5)::BIGINT * 7 + floor(line[i].y * 100000 + 0.5)::BIGINT * 13) * i))::BIGINT AS mark FROM l""",
    "connector_rows": f"""
WITH c AS (SELECT *, l_orderkey * 7 + l_linenumber AS k FROM lineitem),
d AS (SELECT *, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, CASE WHEN k % 3 = 0 THEN 'service' ELSE 'footway' END AS way, {R.sql_dealt('k', ROLES)} AS role, {R.sql_dealt('k', SURFACES)} AS surface FROM c)
SELECT 'derived:' || id AS id, CASE WHEN k % 3 = 0 THEN 'road' ELSE 'path' END AS kind, way AS subtype, concat_ws(';', CASE WHEN role = 'service' THEN 'access=private' END, 'highway=' || way, 'path:repair=endpoint_snap', CASE WHEN role = 'queue' THEN 'queue=yes' END, 'repair:confidence=' || ((k % 16) / 16.0::DOUBLE), 'repair:distance_m=' || ((k % 40) / 8.0::DOUBLE), 'repair:from=' || l_partkey, 'repair:to=' || l_suppkey, CASE WHEN surface <> '' THEN 'surface=' || surface END) AS tags, 'compiled-repair' AS status FROM d""",
    "line_connectivity": """
WITH RECURSIVE o AS (SELECT o_orderkey AS k, o_orderkey // 3 * 4 AS x, o_orderkey * 7 % 5 * 4 AS y, o_orderkey % 3 * 4 AS a, o_orderkey % 2 * 4 AS b FROM orders),
p AS (SELECT k, 0 AS i, x::DOUBLE AS px, y::DOUBLE AS py FROM o WHERE k % 50 > 0 UNION ALL SELECT k, 1, x + a + 0.1::DOUBLE, y FROM o WHERE k % 50 > 0 UNION ALL SELECT k, 2, x + a, y + b + 0.2::DOUBLE FROM o WHERE k % 50 > 0),
v AS MATERIALIZED (SELECT k, i, floor(px / 0.5 + 0.5)::BIGINT || ',' || floor(py / 0.5 + 0.5)::BIGINT AS key FROM p),
e AS MATERIALIZED (SELECT DISTINCT a.k AS u, b.k AS w FROM v a JOIN v b USING (key)), r AS (SELECT k AS node, k AS root FROM o UNION SELECT e.w, r.root FROM r JOIN e ON e.u = r.node),
g AS MATERIALIZED (SELECT node AS k, min(root) AS component FROM r GROUP BY node), f AS (SELECT component, count(*) AS features FROM g GROUP BY 1),
s AS (SELECT key FROM v WHERE i < 2 UNION ALL SELECT key FROM v WHERE i > 0), d AS (SELECT key, count(*) AS degree FROM s GROUP BY 1), h AS (SELECT DISTINCT key, component FROM v JOIN g USING (k)),
n AS (SELECT component, count(*) AS nodes, (sum(degree) / 2)::BIGINT AS edges, count(*) FILTER (degree = 1) AS dangling FROM d JOIN h USING (key) GROUP BY 1)
SELECT component, features, features = 1 AS isolated, coalesce(nodes, 0) AS nodes, coalesce(edges, 0) AS edges, coalesce(dangling, 0) AS dangling FROM f LEFT JOIN n USING (component)""",
    "shape_labels": f"""
WITH s AS (SELECT p_partkey, p_partkey % 3 > 0 AS closed, {G.sql_ring('p_partkey * 40', '(p_partkey * 13 % 90)', SHAPE)} AS ring FROM part), l AS (SELECT c_custkey, (c_custkey * 53.25::DOUBLE) AS x, (c_custkey * 17 % 100)::DOUBLE AS y, c_custkey % 6 * 20 AS priority FROM customer),
j AS (SELECT * FROM s JOIN l ON x BETWEEN ring[1].x - 60 AND ring[1].x + 90),
g AS (SELECT *, unnest(range(1, len(ring) + closed::INTEGER)) AS i FROM j), h AS (SELECT *, ring[i] AS a, ring[i % len(ring) + 1] AS b FROM g),
t AS (SELECT *, greatest(0.0, least(1.0, ((x - a.x) * (b.x - a.x) + (y - a.y) * (b.y - a.y)) / ((b.x - a.x) ** 2 + (b.y - a.y) ** 2))) AS z FROM h),
d AS (SELECT p_partkey, c_custkey, any_value(priority) AS priority, CASE WHEN bool_or(closed AND {G.sql_inside('ring', 'x', 'y')}) THEN 0.0 ELSE min(sqrt((a.x + z * (b.x - a.x) - x) ** 2 + (a.y + z * (b.y - a.y) - y) ** 2)) END AS distance FROM t GROUP BY 1, 2)
SELECT p_partkey AS shape_id, c_custkey AS label_id, floor((distance + 1e-9) * 10000 + 0.5) / 10000 AS distance FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY distance - 0.08::DOUBLE * priority, c_custkey) AS n FROM d WHERE distance <= 56) WHERE n = 1""",
    "vector_roles": f"""
WITH v AS (SELECT {R.sql_dealt('l_orderkey * 3 + l_linenumber', [*(r[0] for r in VECTOR_ROLES), 'site-unknown-candidate'])} AS role, {R.sql_dealt('l_partkey', ('line', 'area'))} AS geometry, 60 + l_partkey % 40 AS percent, l_suppkey % 30 AS tenths FROM lineitem),
k(role, kind, subtype, needs, base) AS (VALUES {', '.join('(' + ', '.join(map(R.quoted, r)) + ')' for r in VECTOR_ROLES)})
SELECT role, geometry, coalesce(kind, '') AS kind, coalesce(subtype, '') AS subtype, coalesce(needs = geometry, false) AS allowed, count(*) AS n, coalesce(max(CASE WHEN needs = geometry THEN base * 10 + percent * 10 - tenths * 4 END), -1)::BIGINT AS best FROM v LEFT JOIN k USING (role) GROUP BY ALL""",
}
