"""Queries that paint shapes on cells and place things on them, and the same in DuckDB SQL.

Shapes stand along a strip that grows with the tables, so that overlaps grow in proportion to the rows. The twins reach the same
cells by testing every cell of a shape's box against its rings, and lay layers over each other by a fold in their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidara.functions import geometry as G
from evidara.functions import scalars as S
from evidara.operators import pixels as X
from evidara.operators import placement as V
from evidara.operators import raster
from evidara.operators import scanline as L
from evidara.session import spread

#: Stars with a notch, by offsets in thirds of a radius; plazas with a hole.
STAR = ((0, -3), (1, -1), (3, 0), (1, 1), (0, 3), (-1, 1), (-3, 0), (-2, -2))
PLAZA = ((-9, -5), (9, -5), (9, 4), (2, 4), (2, 7), (-9, 7))
COURT = ((-4, -2), (4, -2), (0, 3))


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _shapes(spark, sf) -> DataFrame:
    """Parts as stars of all kinds, some of them bridges or discovered, and suppliers as plazas."""
    k = F.col("p_partkey")
    x, y, r = k * 5, F.pmod(k * 53, F.lit(40)), (F.pmod(k, F.lit(6)) + 3) / 3
    kind = F.pmod(k, F.lit(5))
    star = F.array(F.array(*(G.point(x + dx * r, y + dy * r) for dx, dy in STAR)))
    access = F.when(kind == 2, 2).when(kind >= 3, 1).otherwise(0)
    parts = _t(spark, sf, "part").select(
        k.alias("pos"), star.alias("rings"), F.when(kind == 0, 0).when(kind == 1, 10).when(kind == 2, 20).otherwise(30).alias("priority"), F.concat(F.element_at(F.array(*map(F.lit, ("grass", "water", "road", "path", "path"))), kind.cast("int") + 1), F.lit(" "), "p_brand").alias("code"),
        access.alias("access"), ((kind >= 2) & (F.pmod(k, F.lit(3)) == 0)).alias("discovered"), ((kind == 2) & (F.pmod(k, F.lit(4)) == 0)).alias("bridge"), (kind >= 3).alias("plaza"), (kind == 0).alias("natural"),
    )
    k = F.col("s_suppkey")
    x, y = k * 100, F.pmod(k * 37, F.lit(30)) + 5
    plazas = _t(spark, sf, "supplier").select((-k - 1).alias("pos"), F.array(G.ring(x, y, PLAZA), G.ring(x, y, COURT)).alias("rings"), F.lit(30).alias("priority"), F.lit("plaza").alias("code"), F.lit(1).alias("access"), F.lit(False).alias("discovered"), F.lit(False).alias("bridge"), F.lit(True).alias("plaza"), F.lit(False).alias("natural"))
    return parts.union(plazas)


LAYER = ["pos", "priority", "code", "access", "discovered", "bridge", "plaza", "natural"]
#: Cells outside of the map's mask.
OFF = "(row * 7 + col * 3) % 19"


#: A shape fills less than 100 cells or so.
SHAPES_A_TASK = 5000


def shape_spans(spark, sf):
    """The runs of cells that every shape fills."""
    return L.spans(_shapes(spark, sf), ["pos"])


def scanline_paint(spark, sf):
    """Every painted cell: its surface, access, and how often paths and plazas wrote to it."""
    shapes = _shapes(spark, sf)
    # tasks grow in number with the shapes, not in size
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-shapes.count() // SHAPES_A_TASK))
    # a shape's crossings stay in its task
    layers = L.filled(L.spans(shapes.repartition(tasks, "pos"), LAYER), LAYER).repartition(tasks, "row", "col")
    return L.overpainted(layers, F.expr(OFF) != 0)


def paint_totals(spark, sf):
    """The counters of the paint by access: cells, cells of discovered access, writes by paths and by plazas, and natural cells replaced."""
    return scanline_paint(spark, sf).groupBy("access").agg(F.count("*").alias("cells"), F.count_if("discovered").alias("discovered"), F.sum("path_writes").alias("path_writes"), F.sum("plaza_writes").alias("plaza_writes"), F.sum("natural_replaced").cast("bigint").alias("natural_replaced"))


def tapered_lines(spark, sf):
    """Orders as bent lines whose width goes from 1 to 5 metres or back: the cells that each covers."""
    k = F.col("o_orderkey")
    x, y, d = k * 3, F.pmod(k * 31, F.lit(50)), F.pmod(k, F.lit(7)) + 1
    line = F.array(G.point(x, y), G.point(x + d, y + 3), G.point(x + d, y + 3), G.point(x + 2 * d, y - d))
    wide = F.pmod(k, F.lit(3)) == 0
    lines = _t(spark, sf, "orders").where(F.pmod("o_custkey", F.lit(5)) == 0).select("o_orderkey", line.alias("line"), F.when(wide, 5.0).otherwise(1.0).alias("start"), F.when(wide, 1.5).otherwise(4.0).alias("end"))
    cells = L.line_cells(L.tapered_pieces(lines, ["o_orderkey"]), ["o_orderkey"])
    return cells.groupBy("o_orderkey").agg(F.count("*").alias("cells"), F.min("row").alias("r0"), F.max("row").alias("r1"), F.min("col").alias("c0"), F.max("col").alias("c1"), F.sum(F.col("row") * 1000003 + F.col("col") * 7).alias("mark"))


#: Areas of so many candidates or fewer are passed in one row each; larger ones in rounds.
SMALL_AREA = 4096


def vegetation_placement(spark, sf):
    """Parts as areas of plants: of the cells scanned, the candidates taken at the area's spacing in order of score, hash and place, up to the area's number."""
    k = F.col("p_partkey")
    areas = spread(_t(spark, sf, "part"), "p_partkey").select("p_partkey", (F.pmod("p_size", F.lit(3)) + 3).alias("spacing"), (F.pmod("p_size", F.lit(20)) + 6).alias("wide"), (F.pmod(k, F.lit(10)) + 6).alias("high"), F.when(F.pmod(k, F.lit(7)) == 0, F.pmod(k, F.lit(4)) + 3).alias("explicit"), F.pmod("p_size", F.lit(12)).alias("density"))
    step = F.greatest(F.lit(1), F.floor(F.col("spacing") / 2)).cast("int")
    cells = areas.withColumn("y", F.explode(F.sequence(F.lit(0), F.col("high").cast("int"), step))).withColumn("x", F.explode(F.sequence(F.lit(0), F.col("wide").cast("int"), step)))
    cells = cells.withColumn("hash", raster.cell_hash(F.col("x"), F.col("y"), k)).where(F.pmod("hash", F.lit(100)) < 80)
    cells = cells.select(F.concat_ws("-", "p_partkey", "x", "y").alias("id"), "p_partkey", "x", "y", "spacing", "explicit", "density", F.pmod(F.floor(F.col("hash") / 128), F.lit(16)).alias("score"), "hash", F.count("*").over(Window.partitionBy("p_partkey")).alias("eligible"))
    target = V.cover_target(F.col("eligible"), F.col("density"), F.col("explicit"))
    return V.spaced(cells, "p_partkey", ["score", "hash", "y", "x"], target, small=SMALL_AREA).select("p_partkey", "x", "y", "place")


#: Colours of known paths, with how sure their source is.
PROTOTYPES = [(96.0, 94.0, 92.0, 0.9), (150.0, 146.0, 138.0, 0.7), (132.0, 100.0, 84.0, 0.5), (96.0, 94.0, 92.0, 0.2)]
COLUMNS = 40


def _pixels(spark, sf) -> DataFrame:
    """Vectors as cells of a grid of 40 columns: patches of a colour, varied by the vector's first places."""
    row, col = F.floor(F.col("vec_id") / COLUMNS), F.pmod("vec_id", F.lit(COLUMNS))
    patch = F.pmod(F.floor(row / 3) * 37 + F.floor(col / 4) * 59, F.lit(96)) + 56
    part = lambda k, base, by: S.clamp(F.floor(base + S.clamp(F.element_at("embedding", k).cast("double"), -0.3, 0.3) * by), 0.0, 255.0).cast("double")
    return _t(spark, sf, "embeddings").select(row.alias("row"), col.alias("col"), part(1, patch, 30).alias("r"), part(2, patch - 2 + F.when(F.pmod(patch, F.lit(5)) == 0, 40).otherwise(0), 30).alias("g"), part(3, patch - 6, 30).alias("b"))


def walkable_pixels(spark, sf):
    """The grid's cells classified by prototypes or on their own evidence, then refined; cells of users who bought are seeds."""
    seeds = _t(spark, sf, "events").where("event_type = 'purchase' AND user_id % 3 = 0").select(F.floor(F.col("user_id") / COLUMNS).alias("row"), F.pmod("user_id", F.lit(COLUMNS)).alias("col")).distinct().withColumn("seed", F.lit(True))
    found = X.refined(X.classified(_pixels(spark, sf), PROTOTYPES, 20.0, 0.62).join(seeds, ["row", "col"], "left"))
    return found.withColumn("texture", S.half_up(F.col("texture"), 2))


QUERIES = {f.__name__: f for f in (shape_spans, scanline_paint, paint_totals, tapered_lines, vegetation_placement, walkable_pixels)}

_STAR = "[" + ", ".join(f"{{'x': (x + {dx} * r)::DOUBLE, 'y': (y + {dy} * r)::DOUBLE}}" for dx, dy in STAR) + "]"
_SHAPES = f"""
p AS (SELECT p_partkey AS pos, p_partkey * 5 AS x, p_partkey * 53 % 40 AS y, (p_partkey % 6 + 3)::DOUBLE / 3 AS r, p_partkey % 5 AS kind, p_brand FROM part),
s AS (SELECT -s_suppkey - 1 AS pos, s_suppkey * 100 AS x, s_suppkey * 37 % 30 + 5 AS y FROM supplier),
shapes AS (SELECT pos, [{_STAR}] AS rings, CASE kind WHEN 0 THEN 0 WHEN 1 THEN 10 WHEN 2 THEN 20 ELSE 30 END AS priority, ['grass', 'water', 'road', 'path', 'path'][kind + 1] || ' ' || p_brand AS code,
  CASE WHEN kind = 2 THEN 2 WHEN kind >= 3 THEN 1 ELSE 0 END AS access, kind >= 2 AND pos % 3 = 0 AS discovered, kind = 2 AND pos % 4 = 0 AS bridge, kind >= 3 AS plaza, kind = 0 AS wild FROM p
  UNION ALL SELECT pos, [{G.sql_ring('x', 'y', PLAZA)}, {G.sql_ring('x', 'y', COURT)}], 30, 'plaza', 1, false, false, true, false FROM s),
box AS (SELECT *, floor(list_min([q.x for q in rings[1]]))::BIGINT AS x0, ceil(list_max([q.x for q in rings[1]]))::BIGINT AS x1, floor(list_min([q.y for q in rings[1]]))::BIGINT AS y0, ceil(list_max([q.y for q in rings[1]]))::BIGINT AS y1 FROM shapes),
lattice AS (SELECT *, col + 0.5::DOUBLE AS px, row + 0.5::DOUBLE AS py FROM (SELECT *, unnest(range(x0, x1)) AS col FROM (SELECT *, unnest(range(y0, y1)) AS row FROM box))),
cells AS (SELECT * FROM lattice WHERE {G.sql_inside('rings[1]', 'px', 'py')} AND NOT coalesce({G.sql_inside('rings[2]', 'px', 'py')}, false))"""
_FOLD = """
painted AS (SELECT row, col, list_reduce(layers, lambda s, v: CASE WHEN v.discovered AND s.access > 0 THEN s ELSE {
  'code': CASE WHEN v.bridge THEN s.code ELSE v.code END, 'wild': CASE WHEN v.bridge THEN s.wild ELSE v.wild END, 'access': CASE WHEN v.access > 0 THEN v.access ELSE s.access END, 'discovered': s.discovered OR (v.discovered AND v.access > 0),
  'bridge': false, 'plaza': false, 'writes': s.writes + (v.access > 0 AND NOT v.bridge)::BIGINT, 'plazas': s.plazas + (v.access > 0 AND NOT v.bridge AND v.plaza)::BIGINT, 'replaced': greatest(s.replaced, (v.access > 0 AND NOT v.bridge AND s.wild)::INTEGER)} END) AS s FROM
  (SELECT row, col, list_prepend({'code': NULL::VARCHAR, 'wild': true, 'access': 0, 'discovered': false, 'bridge': false, 'plaza': false, 'writes': 0::BIGINT, 'plazas': 0::BIGINT, 'replaced': 0},
    list({'code': code, 'wild': wild, 'access': access, 'discovered': discovered, 'bridge': bridge, 'plaza': plaza, 'writes': 0::BIGINT, 'plazas': 0::BIGINT, 'replaced': 0} ORDER BY priority, pos)) AS layers FROM cells WHERE {off} <> 0 GROUP BY row, col)),
paint AS (SELECT row, col, s.code AS code, s.access AS access, s.discovered AS discovered, s.writes AS path_writes, s.plazas AS plaza_writes, s.replaced AS natural_replaced FROM painted)""".replace("{off}", OFF)

_HASH = "2166136261::BIGINT"
for _v in ("x", "y", "p_partkey"):
    _HASH = f"((xor({_HASH}, ({_v})::BIGINT & 65535)::HUGEINT * 16777619) % 4294967296)::BIGINT"


def _lab(r: str, g: str, b: str) -> str:
    linear = lambda v: f"CASE WHEN {v} <= 0.04045::DOUBLE * 255 THEN {v} / 255 / 12.92::DOUBLE ELSE pow(({v} / 255 + 0.055::DOUBLE) / 1.055::DOUBLE, 2.4::DOUBLE) END"
    rgb = f"[{linear(r)}, {linear(g)}, {linear(b)}]"
    xyz = f"list_transform([{rgb}], lambda c: [(0.4124::DOUBLE * c[1] + 0.3576::DOUBLE * c[2] + 0.1805::DOUBLE * c[3]) / 0.95047::DOUBLE, 0.2126::DOUBLE * c[1] + 0.7152::DOUBLE * c[2] + 0.0722::DOUBLE * c[3], (0.0193::DOUBLE * c[1] + 0.1192::DOUBLE * c[2] + 0.9505::DOUBLE * c[3]) / 1.08883::DOUBLE])[1]"
    bent = f"list_transform({xyz}, lambda v: CASE WHEN v > 216::DOUBLE / 24389 THEN pow(v, 1::DOUBLE / 3) ELSE (24389::DOUBLE / 27 * v + 16) / 116 END)"
    return f"list_transform([{bent}], lambda f: [116 * f[2] - 16, 500 * (f[1] - f[2]), 200 * (f[2] - f[3])])[1]"


def _pixel_sql() -> str:
    known = ", ".join(f"({k}, {_lab(*(f'{v}::DOUBLE' for v in p[:3]))}, {p[3]}::DOUBLE)" for k, p in enumerate(PROTOTYPES))
    clamp = lambda v: f"least(1.0, greatest(0.0, {v}))"
    part = lambda k, base: f"least(255.0, greatest(0.0, floor({base} + least(0.3, greatest(-0.3, embedding[{k}]::DOUBLE)) * 30)))::DOUBLE"
    return f"""
WITH cells AS (SELECT vec_id // {COLUMNS} AS row, vec_id % {COLUMNS} AS col, {part(1, 'p')} AS r, {part(2, "p - 2 + CASE WHEN p % 5 = 0 THEN 40 ELSE 0 END")} AS g, {part(3, 'p - 6')} AS b FROM (SELECT *, (vec_id // {COLUMNS} // 3 * 37 + vec_id % {COLUMNS} // 4 * 59) % 96 + 56 AS p FROM embeddings)),
l AS (SELECT *, {_lab('r', 'g', 'b')} AS lab, (g - (r + b) / 2) / 255 <= 0.08::DOUBLE AS eligible FROM cells),
known(k, lab, sure) AS (VALUES {known}),
t AS (SELECT a.row, a.col, sum(floor(list_distance(a.lab, b.lab) * 1000 + 0.5))::DOUBLE / count(*) / 1000 AS texture FROM l a JOIN l b ON a.eligible AND b.eligible AND (b.row - a.row, b.col - a.col) IN ((0, -1), (0, 1), (-1, 0), (1, 0), (-1, -1), (1, 1)) GROUP BY a.row, a.col),
d AS (SELECT l.row, l.col, min({{'d': list_distance(l.lab, known.lab), 'k': k, 'sure': sure}}) AS m FROM l, known GROUP BY l.row, l.col),
m AS (SELECT l.*, coalesce(texture, 30.0) AS texture, m.d AS dist, m.k AS k, m.sure AS src, greatest(r, g, b) AS top, (0.2126::DOUBLE * r + 0.7152::DOUBLE * g + 0.0722::DOUBLE * b) / 255 AS lum FROM l JOIN d USING (row, col) LEFT JOIN t USING (row, col)),
n AS (SELECT *, 0.12::DOUBLE + 0.62::DOUBLE * {clamp('1 - dist / 20')} + 0.16::DOUBLE * {clamp('1 - texture / 28')} + 0.1::DOUBLE * src AS sure, CASE WHEN top > 0 THEN (top - least(r, g, b)) / greatest(top, 1.0) ELSE 0.0 END AS sat FROM m),
o AS (SELECT *, r > g * 1.04::DOUBLE AND g > b * 1.03::DOUBLE AND sat <= 0.5 AND lum >= 0.16 AND lum <= 0.72 AS warm FROM n),
i AS (SELECT *, CASE WHEN lum < 0.07 OR lum > 0.9 OR (g - (r + b) / 2) / 255 > 0.055 OR (b - (r + g) / 2) / 255 > 0.09 THEN 0.0 ELSE floor((least(0.96, 0.54::DOUBLE + 0.18::DOUBLE * {clamp('1 - sat / 0.34::DOUBLE')} + 0.13::DOUBLE * {clamp('1 - greatest(0.0, texture - 30) / 32')} + 0.1::DOUBLE * (1 - 0.2::DOUBLE / 1.1) + CASE WHEN warm THEN 0.06 ELSE 0.0 END + CASE WHEN lum >= 0.14 AND lum <= 0.78 THEN 0.04 ELSE 0.0 END) + 1e-9) * 1000 + 0.5) / 1000 END AS alone, eligible AND dist <= 20 AND sure >= 0.62 AS hit FROM o),
c AS (SELECT row, col, eligible, texture, hit, eligible AND NOT hit AND alone >= 0.78 AS lone, CASE WHEN hit THEN k ELSE -1 END AS prototype, CASE WHEN hit THEN floor({clamp('sure')} * 255 + 0.5) WHEN eligible AND alone >= 0.78 THEN floor({clamp('alone')} * 255 + 0.5) ELSE 0 END::INTEGER AS confidence FROM i),
near AS (SELECT a.row, a.col, b.prototype, b.confidence FROM c a JOIN c b ON (b.hit OR b.lone) AND abs(a.row - b.row) <= 1 AND abs(a.col - b.col) <= 1 AND NOT (a.row = b.row AND a.col = b.col)),
g AS (SELECT row, col, count(*) AS n, sum(confidence) AS s FROM near GROUP BY row, col),
p AS (SELECT row, col, prototype AS p FROM (SELECT row, col, prototype, count(*) AS n FROM near WHERE prototype >= 0 GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY row, col ORDER BY n DESC, prototype) = 1),
seeds AS (SELECT DISTINCT user_id // {COLUMNS} AS row, user_id % {COLUMNS} AS col, true AS seed FROM events WHERE event_type = 'purchase' AND user_id % 3 = 0),
f AS (SELECT c.*, coalesce(n, 0) AS n, s, p, coalesce(seed, false) AS seed, NOT (hit OR lone) AND eligible AND coalesce(n, 0) >= 6 AS grown FROM c LEFT JOIN g USING (row, col) LEFT JOIN p USING (row, col) LEFT JOIN seeds USING (row, col))
SELECT row, col, eligible, floor(texture * 100 + 0.5) / 100 AS texture, n::INTEGER AS neighbours, grown OR ((hit OR lone) AND (n > 1 OR seed)) AS candidate, CASE WHEN grown THEN p IS NULL ELSE lone END AS independent,
  (CASE WHEN grown THEN coalesce(p, -1) ELSE prototype END)::INTEGER AS prototype, (CASE WHEN grown THEN floor(s::DOUBLE / n + 0.5) ELSE confidence END)::INTEGER AS confidence FROM f"""


ORACLE_SQL = {
    "vegetation_placement": f"""
WITH RECURSIVE areas AS (SELECT p_partkey, p_size % 3 + 3 AS spacing, p_size % 20 + 6 AS wide, p_partkey % 10 + 6 AS high, CASE WHEN p_partkey % 7 = 0 THEN p_partkey % 4 + 3 END AS explicit, p_size % 12 AS density FROM part),
xy AS (SELECT *, unnest(range(0, wide + 1, greatest(1, spacing // 2))) AS x FROM (SELECT *, unnest(range(0, high + 1, greatest(1, spacing // 2))) AS y FROM areas)),
h AS (SELECT *, count(*) OVER (PARTITION BY p_partkey) AS eligible FROM (SELECT *, {_HASH} AS hash FROM xy) WHERE hash % 100 < 80),
c AS MATERIALIZED (SELECT p_partkey, x, y, spacing, CASE WHEN explicit > 0 THEN explicit WHEN density > 0 THEN greatest(1, floor(eligible * density::DOUBLE / 100 + 0.5)) ELSE 0 END AS target, row_number() OVER (PARTITION BY p_partkey ORDER BY hash // 128 % 16, hash, y, x) AS i FROM h),
-- an ordered pass: the list of what was taken so far, candidate by candidate
pass AS (SELECT p_partkey, 0::BIGINT AS i, []::BIGINT[] AS taken FROM areas UNION ALL
  SELECT p.p_partkey, c.i, CASE WHEN len(taken) < target AND len(list_filter(taken, lambda t: (t // 1000 - x) * (t // 1000 - x) + (t % 1000 - y) * (t % 1000 - y) < spacing * spacing)) = 0 THEN list_append(taken, (x * 1000 + y)::BIGINT) ELSE taken END FROM pass p JOIN c ON c.p_partkey = p.p_partkey AND c.i = p.i + 1),
done AS (SELECT p_partkey, arg_max(taken, i) AS taken FROM pass GROUP BY p_partkey)
SELECT p_partkey, (t // 1000)::INTEGER AS x, (t % 1000)::INTEGER AS y, place::INTEGER AS place FROM (SELECT p_partkey, unnest(taken) AS t, generate_subscripts(taken, 1) AS place FROM done)""",
    "walkable_pixels": _pixel_sql(),
    "shape_spans": f"""
WITH {_SHAPES},
runs AS (SELECT pos, row, col, col - row_number() OVER (PARTITION BY pos, row ORDER BY col) AS run FROM cells)
SELECT pos, row, min(col) AS x1, max(col) AS x2 FROM runs GROUP BY pos, row, run""",
    "scanline_paint": f"WITH {_SHAPES}, {_FOLD} SELECT * FROM paint",
    "paint_totals": f"""
WITH {_SHAPES}, {_FOLD} SELECT access, count(*) AS cells, count(*) FILTER (discovered) AS discovered, sum(path_writes)::BIGINT AS path_writes, sum(plaza_writes)::BIGINT AS plaza_writes, sum(natural_replaced)::BIGINT AS natural_replaced FROM paint GROUP BY access""",
    "tapered_lines": """
WITH o AS (SELECT o_orderkey, (o_orderkey * 3)::DOUBLE AS x, (o_orderkey * 31 % 50)::DOUBLE AS y, (o_orderkey % 7 + 1)::DOUBLE AS d, CASE WHEN o_orderkey % 3 = 0 THEN 5.0::DOUBLE ELSE 1.0 END AS w0, CASE WHEN o_orderkey % 3 = 0 THEN 1.5::DOUBLE ELSE 4.0 END AS w1 FROM orders WHERE o_custkey % 5 = 0),
g AS (SELECT *, sqrt(d * d + 9) AS s1, sqrt(d * d + (d + 3) * (d + 3)) AS s2 FROM o),
seg AS (SELECT o_orderkey, w0, w1, s1 + s2 AS total, 0.0::DOUBLE AS t, s1 AS size, x AS ax, y AS ay, x + d AS ex, y + 3 AS ey FROM g UNION ALL SELECT o_orderkey, w0, w1, s1 + s2, s1, s2, x + d, y + 3, x + 2 * d, y - d FROM g),
n AS (SELECT *, greatest(1, ceil(size / 2))::INTEGER AS n FROM seg), k AS (SELECT *, unnest(range(0, n)) AS k FROM n),
q AS (SELECT o_orderkey, ax + (ex - ax) * k / n AS ax, ay + (ey - ay) * k / n AS ay, ax + (ex - ax) * (k + 1) / n AS ex, ay + (ey - ay) * (k + 1) / n AS ey, greatest(1.0, floor(w0 + (w1 - w0) * ((t + size * ((k::DOUBLE / n + (k + 1)::DOUBLE / n) / 2)) / total) + 0.5)) / 2 AS h FROM k),
l AS (SELECT *, col + 0.5::DOUBLE AS px, row + 0.5::DOUBLE AS py FROM (SELECT *, unnest(range(floor(least(ax, ex) - h)::BIGINT, ceil(greatest(ax, ex) + h)::BIGINT)) AS col FROM (SELECT *, unnest(range(floor(least(ay, ey) - h)::BIGINT, ceil(greatest(ay, ey) + h)::BIGINT)) AS row FROM q))),
f AS (SELECT *, greatest(0.0, least(1.0, ((px - ax) * (ex - ax) + (py - ay) * (ey - ay)) / ((ex - ax) * (ex - ax) + (ey - ay) * (ey - ay)))) AS z FROM l),
c AS (SELECT DISTINCT o_orderkey, row, col FROM f WHERE (ax + z * (ex - ax) - px) * (ax + z * (ex - ax) - px) + (ay + z * (ey - ay) - py) * (ay + z * (ey - ay) - py) <= h * h)
SELECT o_orderkey, count(*) AS cells, min(row) AS r0, max(row) AS r1, min(col) AS c0, max(col) AS c1, sum(row * 1000003 + col * 7)::BIGINT AS mark FROM c GROUP BY 1""",
}
