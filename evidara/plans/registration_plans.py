"""Registration of drawings: control points from labels, fits, the best fit, and promotion by consensus; the same in DuckDB SQL.

Every supplier is a drawing whose labels name coordinates, as a grid or in pairs, with axes the one way or the other, some of
them wrong. Labels are expressions that both engines read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidara.functions.scalars import half_up
from evidara.operators import registration as R

#: West, south, east and north of the area asked for, in metres.
AREA = (400_000.0, 330_000.0, 460_000.0, 390_000.0)
KEYS = ["s_suppkey"]


def _label(axis: str, i: int) -> str:
    """The i-th easting or northing; a seventh of the drawings has a wrong one, a fifth lies far north."""
    if axis == "e":
        return f"400000 + k % 50 * 1000 + {100 * i}" + (" + CASE WHEN k % 7 = 0 THEN 300 ELSE 0 END" if i == 2 else "")
    return f"340000 + k % 40 * 1000 + {80 * i} + CASE WHEN k % 5 = 0 THEN 500000 ELSE 0 END"


def _either(a: str, b: str) -> str:
    return f"CASE WHEN k % 4 = 1 THEN {b} ELSE {a} END"


def _words() -> list[tuple[str, str, str, str, int]]:
    """(condition, text, x, y, half a word's width)"""
    out = [("k >= 0", "'Scale 1:500'", "5", "5", 4), ("k >= 0", "'12,345'", "700", "590", 15), ("k % 6 = 0", "'400100'", "300", "300", 15)]
    for i in range(3):
        v, h = (f"CAST({_either(_label(a, i), _label(b, i))} AS STRING)" for a, b in (("e", "n"), ("n", "e")))
        out += [("k % 3 <> 2", v, str(60 + 200 * i), "20", 15), ("k % 3 <> 2", v, f"{60 + 200 * i} + k * {i + 1} % 3 * 2", "500", 15), ("k % 3 <> 2", h, "15", str(460 - 160 * i), 10), ("k % 3 <> 2", h, "780", f"{460 - 160 * i} + k * {i + 2} % 4 * 2", 10)]
    for m in range(5):
        e, n = _label("e", m % 2), _label("n", m // 2)
        for first, (a, b) in enumerate(((e, n), (n, e))):
            out.append((f"k % 3 = 2 AND ({m} < 4 OR k % 2 = 0)", f"CAST({_either(a, b)} AS STRING)", str(100 + 200 * (m % 2) + 70 * first), str(400 - 160 * (m // 2)), 20))
    return out


def _words_of(spark: SparkSession, sf: str) -> DataFrame:
    items = ", ".join(f"struct({c} AS used, {p} AS pos, {t} AS text, CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y, CAST({x} - {w} AS DOUBLE) AS x0, CAST({x} + {w} AS DOUBLE) AS x1)" for p, (c, t, x, y, w) in enumerate(_words()))
    rows = spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey", F.col("s_suppkey").alias("k"))
    return rows.select("s_suppkey", F.explode(F.expr(f"array({items})")).alias("w")).where("w.used").select("s_suppkey", "w.pos", "w.text", "w.x", "w.y", "w.x0", "w.x1")


def _points(spark, sf) -> DataFrame:
    words = _words_of(spark, sf)
    return R.grid_points(words, KEYS).union(R.pair_points(words, KEYS))


def _fits(spark, sf) -> DataFrame:
    pages = spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey", F.when(F.pmod("s_suppkey", F.lit(11)) > 0, 842.0).alias("width"), F.lit(595.0).alias("height"))
    return R.fitted(_points(spark, sf), [*KEYS, "method", "swapped"], pages, KEYS, AREA)


def control_points(spark, sf):
    """The control points of every drawing, from grids and from pairs, with axes both ways."""
    return _points(spark, sf)


def _rounded(fits: DataFrame) -> list:
    return [half_up(F.col(c) + 1e-9, 5).alias(c) for c in "abde"] + [half_up(F.col(c) + 1e-9, 2).alias(c) for c in ("c", "f", "rmse")]


def registration_fits(spark, sf):
    """Every candidate's fit and why it isn't accepted."""
    f = _fits(spark, sf)
    return f.select(*KEYS, "method", "swapped", "points", *(F.coalesce(c, F.lit(-1.0)).alias(n) for c, n in zip(_rounded(f), [*"abde", "c", "f", "rmse"], strict=True)), F.coalesce("reason", F.lit("")).alias("reason"))


def best_registration(spark, sf):
    """The fit that every drawing is registered by."""
    best = R.best_fits(_fits(spark, sf), KEYS)
    return best.select(*KEYS, "method", "swapped", "points", *_rounded(best))


def _candidates(spark, sf) -> DataFrame:
    k = F.col("s_suppkey")
    return spark.read.parquet(f"{sf}/supplier.parquet").select(
        F.floor(k / 9).alias("app"), k.alias("id"), k.alias("pos"), F.concat(F.lit("d"), F.pmod(k, F.lit(4)).cast("string")).alias("document"), (F.lit(-1.897) + F.pmod(k * 7, F.lit(6)) * 0.0009).alias("lon"), (F.lit(52.98) + F.pmod(k * 5, F.lit(4)) * 0.0006).alias("lat"), (F.pmod(k * 37, F.lit(40)) + 60).cast("double").alias("percent"),
    ).withColumn("confidence", F.col("percent") / 100)


def consensus_clusters(spark, sf):
    """The drawings of each application that agree on a place: the strongest anchor's neighbours, from two documents or more."""
    return R.consensus(_candidates(spark, sf))


def promoted_drawings(spark, sf):
    """All drawings with the rejected ones that agree and have a fit of their own upgraded."""
    k = F.col("s_suppkey")
    own = spark.read.parquet(f"{sf}/supplier.parquet").select(F.floor(k / 9).alias("app"), k.alias("id"), F.when(F.pmod(k, F.lit(4)) == 0, "accepted").otherwise("rejected").alias("status"), F.when(F.pmod(k, F.lit(4)) == 0, "embedded").otherwise("none").alias("method"))
    fits = _fits(spark, sf).select(F.floor(k / 9).alias("app"), k.alias("id"), "reason")
    return R.promoted(own, R.consensus(_candidates(spark, sf)), fits)


QUERIES = {f.__name__: f for f in (control_points, registration_fits, best_registration, consensus_clusters, promoted_drawings)}

_LIST = ", ".join(f"{{'used': {c}, 'pos': {p}, 'text': {t}, 'x': ({x})::DOUBLE, 'y': ({y})::DOUBLE, 'x0': ({x} - {w})::DOUBLE, 'x1': ({x} + {w})::DOUBLE}}" for p, (c, t, x, y, w) in enumerate(_words()))
_POINTS_SQL = f"""
words AS (SELECT s_suppkey, w.pos, w.x, w.y, w.x0, w.x1, CASE WHEN v >= 10000 AND v <= 1300000 THEN v END AS value FROM (SELECT s_suppkey, w, CASE WHEN regexp_matches(regexp_replace(w.text, '[,\\s]', '', 'g'), '^\\d{{5,7}}(\\.\\d+)?$') THEN regexp_replace(w.text, '[,\\s]', '', 'g')::DOUBLE END AS v FROM (SELECT s_suppkey, unnest([{_LIST}]) AS w FROM (SELECT s_suppkey, s_suppkey AS k FROM supplier)) WHERE w.used)),
lines AS (SELECT s_suppkey, value, max(x) - min(x) AS wide, max(y) - min(y) AS high, avg(x) AS mx, avg(y) AS my, min(pos) AS pos FROM words WHERE value IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 2),
ver AS (SELECT *, count(*) OVER q AS n, max(value) OVER q AS top, row_number() OVER (PARTITION BY s_suppkey ORDER BY pos) AS i FROM lines WHERE wide <= 18 AND high >= 80 WINDOW q AS (PARTITION BY s_suppkey)),
hor AS (SELECT *, count(*) OVER q AS n, max(value) OVER q AS top, row_number() OVER (PARTITION BY s_suppkey ORDER BY pos) AS i FROM lines WHERE high <= 18 AND wide >= 80 WINDOW q AS (PARTITION BY s_suppkey)),
grid AS (SELECT v.s_suppkey, v.mx AS x, h.my AS y, v.value AS a, h.value AS b, v.top AS ta, h.top AS tb FROM ver v JOIN hor h USING (s_suppkey) WHERE v.n >= 2 AND h.n >= 2 AND v.i <= 8 AND h.i <= 8),
w AS (SELECT *, lead(value) OVER o AS v2, lead(x) OVER o AS xx, lead(y) OVER o AS yy, lead(x0) OVER o AS xx0 FROM words WINDOW o AS (PARTITION BY s_suppkey ORDER BY y, x, pos)),
pairs AS (SELECT *, count(*) OVER (PARTITION BY s_suppkey) AS n FROM w WHERE value IS NOT NULL AND v2 IS NOT NULL AND abs(y - yy) <= 12 AND xx0 - x1 <= 120),
twos AS (SELECT s_suppkey, (x + xx) / 2 AS x, (y + yy) / 2 AS y, value AS a, v2 AS b FROM pairs WHERE n >= 3),
points AS (SELECT s_suppkey, 'coordinate-grid' AS method, false AS swapped, x, y, a AS easting, b AS northing FROM grid WHERE ta <= 700000 UNION ALL SELECT s_suppkey, 'coordinate-grid', true, x, y, b, a FROM grid WHERE tb <= 700000
  UNION ALL SELECT * FROM (SELECT s_suppkey, 'coordinate-pairs', false, x, y, a, b FROM twos WHERE a <= 700000 QUALIFY count(*) OVER (PARTITION BY s_suppkey) >= 3) UNION ALL SELECT * FROM (SELECT s_suppkey, 'coordinate-pairs', true, x, y, b, a FROM twos WHERE b <= 700000 QUALIFY count(*) OVER (PARTITION BY s_suppkey) >= 3))"""
_W, _S, _E, _N = AREA
_FITS_SQL = f"""
m AS (SELECT s_suppkey, method, swapped, count(*)::DOUBLE AS k, avg(x) AS mx, avg(y) AS my, avg(easting) AS me, avg(northing) AS mn, max(x) - min(x) AS wide, max(y) - min(y) AS high, list({{'x': x, 'y': y}}) AS pts FROM points GROUP BY 1, 2, 3),
c AS (SELECT m.*, sum((x - mx) * (x - mx)) AS xx, sum((x - mx) * (y - my)) AS xy, sum((y - my) * (y - my)) AS yy, sum((x - mx) * (easting - me)) AS xe, sum((y - my) * (easting - me)) AS ye, sum((x - mx) * (northing - mn)) AS xn, sum((y - my) * (northing - mn)) AS yn FROM m JOIN points USING (s_suppkey, method, swapped) GROUP BY ALL),
l AS (SELECT *, wide < 10 OR high < 10 OR len(list_filter(pts, lambda p: len(list_filter(pts, lambda q: abs((p.x - pts[1].x) * (q.y - pts[1].y) - (p.y - pts[1].y) * (q.x - pts[1].x)) > 25)) > 0)) = 0 AS flat FROM c),
s AS (SELECT *, CASE WHEN NOT flat THEN (xe * yy - ye * xy) / (xx * yy - xy * xy) END AS a, CASE WHEN NOT flat THEN (ye * xx - xe * xy) / (xx * yy - xy * xy) END AS b, CASE WHEN NOT flat THEN (xn * yy - yn * xy) / (xx * yy - xy * xy) END AS d, CASE WHEN NOT flat THEN (yn * xx - xn * xy) / (xx * yy - xy * xy) END AS e FROM l),
o AS (SELECT s.* EXCLUDE (pts), me - a * mx - b * my AS c, mn - d * mx - e * my AS f FROM s),
r AS (SELECT o.*, sqrt(avg((a * x + b * y + c - easting) ** 2 + (d * x + e * y + f - northing) ** 2)) AS rmse FROM o JOIN points USING (s_suppkey, method, swapped) GROUP BY ALL),
g AS (SELECT *, sqrt(a * a + d * d) AS sx, sqrt(b * b + e * e) AS sy, CASE WHEN s_suppkey % 11 > 0 THEN 842.0 END AS width FROM r),
x AS (SELECT *, least(c, c + a * width, c + a * width + b * 595, c + b * 595) AS w, greatest(c, c + a * width, c + a * width + b * 595, c + b * 595) AS w2, least(f, f + d * width, f + d * width + e * 595, f + e * 595) AS z, greatest(f, f + d * width, f + d * width + e * 595, f + e * 595) AS z2 FROM g),
fits AS (SELECT *, CASE WHEN width IS NULL THEN 'missing-page-dimensions' WHEN flat THEN 'control-points-are-collinear' WHEN rmse > 3 THEN 'control-point-rmse-exceeds-limit' WHEN least(sx, sy) < 0.005 OR greatest(sx, sy) > 20 THEN 'implausible-drawing-scale' WHEN greatest(sx, sy) / greatest(1e-9, least(sx, sy)) > 5 THEN 'anisotropic-scale-exceeds-limit'
  WHEN abs(a * b + d * e) / greatest(1e-9, sx * sy) > 0.35 THEN 'affine-axes-too-skewed' WHEN abs(a * e - b * d) < 1e-6 THEN 'degenerate-affine-transform' WHEN (w2 - w) * (z2 - z) > 25e6 THEN 'extent-exceeds-limit'
  WHEN greatest(0.0, least(w2, {_E}) - greatest(w, {_W})) * greatest(0.0, least(z2, {_N}) - greatest(z, {_S})) < 0.02 * least((w2 - w) * (z2 - z), {(_E - _W) * (_N - _S)}) THEN 'outside-of-the-area' END AS reason FROM x)"""
_TO = lambda c, n: f"floor(({c} + 1e-9) * 1e{n} + 0.5) / 1e{n}"
_ROUND = {**{c: 5 for c in "abde"}, "c": 2, "f": 2, "rmse": 2}
_AGREED = """
cand AS (SELECT s_suppkey // 9 AS app, s_suppkey AS id, 'd' || (s_suppkey % 4) AS document, -1.897::DOUBLE + (s_suppkey * 7 % 6) * 0.0009::DOUBLE AS lon, 52.98::DOUBLE + (s_suppkey * 5 % 4) * 0.0006::DOUBLE AS lat FROM supplier WHERE s_suppkey * 37 % 40 + 60 >= 72),
near AS (SELECT a.app, a.id AS anchor, b.id AS id, b.document FROM cand a JOIN cand b ON a.app = b.app AND 2000 * 6371.0088 * asin(least(1.0, sqrt(sin(radians(b.lat - a.lat) / 2) ** 2 + cos(radians(a.lat)) * cos(radians(b.lat)) * sin(radians(b.lon - a.lon) / 2) ** 2))) <= 140),
best AS (SELECT app, anchor FROM (SELECT app, anchor, count(*) AS n, count(DISTINCT document) AS docs FROM near GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY app ORDER BY n DESC, anchor) = 1) WHERE docs >= 2),
agreed AS (SELECT near.app, id FROM near JOIN best USING (app, anchor))"""

ORACLE_SQL = {
    "control_points": f"WITH {_POINTS_SQL} SELECT * FROM points",
    "registration_fits": f"WITH {_POINTS_SQL}, {_FITS_SQL} SELECT s_suppkey, method, swapped, k::INTEGER AS points, {', '.join(f'coalesce({_TO(c, n)}, -1.0) AS {c}' for c, n in _ROUND.items())}, coalesce(reason, '') AS reason FROM fits",
    "best_registration": f"WITH {_POINTS_SQL}, {_FITS_SQL} SELECT s_suppkey, method, swapped, k::INTEGER AS points, {', '.join(f'{_TO(c, n)} AS {c}' for c, n in _ROUND.items())} FROM (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY floor(rmse * 1e6 + 0.5), k DESC, method, swapped) AS i FROM fits WHERE reason IS NULL) WHERE i = 1",
    "consensus_clusters": f"WITH {_AGREED} SELECT * FROM agreed",
    "promoted_drawings": f"""
WITH {_POINTS_SQL}, {_FITS_SQL}, {_AGREED},
u AS (SELECT s_suppkey // 9 AS app, s_suppkey AS id, s_suppkey % 4 = 0 AS old, s_suppkey IN (SELECT id FROM agreed) AND s_suppkey IN (SELECT s_suppkey FROM fits WHERE reason IS NULL) AS good FROM supplier)
SELECT app, id, CASE WHEN old OR good THEN 'accepted' ELSE 'rejected' END AS status, CASE WHEN old THEN 'embedded' WHEN good THEN 'automatic-linework-consensus' ELSE 'none' END AS method, good AND NOT old AS upgraded FROM u""",
}
