"""Queries that read drawings' text layers, attachments, styles and reference features, and the same in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidara.functions import geometry as G
from evidara.functions import rules as R
from evidara.functions import scalars as S
from evidara.functions.scalars import half_up
from evidara.operators.ranking import first_per_key, round_robin
from evidara.plans.drawing_plans import CLASSES


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


LINES = (("Retaining", "wall"), ("Proposed", "pond"), ("Note", "12"), ("Tree", "planting"), ("Ride", "layout"), ("Plain", "text"), ("Path", "&amp; plaza"))


def text_anchors(spark, sf):
    """Lines of a drawing's text layer that name something, with their boxes in the drawing's units; the words of a page are read one by one only if no line of it does."""
    k = F.col("s_suppkey")
    x, y = F.pmod(k * 7, F.lit(400)), F.pmod(k * 11, F.lit(300))
    box = lambda dx: F.concat(F.lit(' xMin="'), (x + dx).cast("string"), F.lit('" yMin="'), y.cast("string"), F.lit('" xMax="'), (x + dx + 40).cast("string"), F.lit('" yMax="'), (y + 10).cast("string"), F.lit('">'))
    word = lambda axis: R.dealt(k, [a[axis] for a in LINES])
    line = F.concat(F.lit("<line"), box(0), F.lit("<word"), box(0), word(0), F.lit("</word><word"), box(50), word(1), F.lit("</word></line>"))
    loose = F.when(F.pmod(k, F.lit(3)) == 0, F.concat(F.lit("<word"), box(100), F.lit("Boundary fence</word>"))).otherwise("")
    pages = _t(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit('<page width="842" height="595">'), line, loose, F.lit("</page>")).alias("xml"))
    number = lambda text, name: F.regexp_extract(text, name + r'="([^"]+)"', 1).try_cast("double")
    clean = lambda text: F.trim(F.regexp_replace(F.replace(F.regexp_replace(text, "<[^>]+>", " "), F.lit("&amp;"), F.lit("&")), r"\s+", " "))

    def anchors(tag: str) -> DataFrame:
        found = pages.select("s_suppkey", F.explode(F.regexp_extract_all("xml", F.lit(rf"(?is)<{tag}\b([^>]*>.*?)</{tag}>"), F.lit(1))).alias("part"))
        head, body = F.regexp_extract("part", "^([^>]*)>", 1), F.regexp_replace("part", "^[^>]*>", "")
        found = found.select("s_suppkey", clean(body).alias("text"), *(half_up(number(head, n) * scale, 2).alias(n.lower()) for n, scale in (("xMin", 1684 / 842), ("yMin", 1190 / 595), ("xMax", 1684 / 842), ("yMax", 1190 / 595))))
        return found.withColumn("class", R.first_match(F.lower("text"), CLASSES)).where("class IS NOT NULL")

    lines = anchors("line")
    return lines.unionByName(anchors("word").join(lines.select("s_suppkey").distinct(), "s_suppkey", "left_anti"))


ATTACHED = ("Approved site plan", "Proposed elevation", "As built block plan", "Neighbour comment", "Existing access plan", "Discharge of condition drawing", "Covering letter", "Location plan")
TOKENS = ("IMG_001.pdf", "plan-2.tif", "bad name.pdf", "x/y.pdf", "a.b-c_d")
#: What roles, states and wording add to an attachment's score.
ROLE_SCORES = (("ride|track layout", 140), ("access plan", 125), ("site plan", 120), ("location plan", 118), ("block plan", 115), ("landscap", 110))
STATE_SCORES = ((r"as[- ]?built", 55), ("existing", 35), ("approved", 30), ("revised", 10), ("proposed", 5))
REJECTED = "comment|neighbour|covering letter|correspondence|email|fee|application form"


def attachments(spark, sf):
    """Attachments that a portal's pages open by script: well-formed names, the best text of each, its score and whether it is rejected."""
    k = F.col("c_custkey")
    html = F.concat(F.lit("<p><a class='i' href=\"javascript:AppBlobImage('"), R.dealt(k, TOKENS), F.lit("');\">"), R.dealt(k, ATTACHED, 5), F.lit(" <b>"), F.pmod(k, F.lit(4)).cast("string"), F.lit("</b></a></p>"))
    pages = _t(spark, sf, "customer").select(F.pmod(k, F.lit(500)).alias("page"), "c_custkey", html.alias("html"))
    name = F.regexp_extract("html", r"(?i)javascript:AppBlobImage\(\s*'([^'\")&]+)'\s*\)", 1)
    text = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract("html", r"(?is)AppBlobImage\([^>]*>(.*?)</a>", 1), "<[^>]+>", " "), r"\s+", " "))
    found = pages.select("page", "c_custkey", name.alias("name"), text.alias("text")).where(F.rlike("name", F.lit(r"^[A-Za-z0-9._-]{1,160}$")))
    low = F.lower("text")
    approved = F.contains(low, F.lit("approved"))
    score = R.first_match(low, ROLE_SCORES, 0) + R.first_match(low, STATE_SCORES, 0) + F.when(approved, 20).otherwise(0) + F.when(F.rlike(low, F.lit(r"as[- ]?built|implemented|completion|discharge of condition")), 35).otherwise(0) - F.when(F.rlike(low, F.lit(REJECTED)), 160).otherwise(0) - F.when(F.contains(low, F.lit("proposed")) & ~approved, 10).otherwise(0)
    found = found.withColumns({"score": score, "rejected": F.rlike(low, F.lit(REJECTED))})
    return first_per_key(found, ["page", "name"], [F.desc("score"), F.col("c_custkey")]).select("page", "name", "text", "score", "rejected")


TAGS = (("attraction", "roller_coaster"), ("building", "yes"), ("highway", "footway"), ("natural", "water"), ("boundary", "protected_area"), ("man_made", "embankment"), ("amenity", "bench"), ("waterway", "stream"), ("railway", "miniature"))


def reference_features(spark, sf):
    """Mapped features that a drawing can be laid on: their kind by tags, those with a vertex in the box or within a hundredth of a degree of it."""
    k = F.col("o_orderkey")
    o = _t(spark, sf, "orders").select("o_orderkey", R.dealt(k, [t[0] for t in TAGS]).alias("key"), R.dealt(k, [t[1] for t in TAGS]).alias("value"), F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.struct((F.lit(-1.95) + (F.pmod(k * 13, F.lit(100)) + i * 4) / 1000.0).alias("lon"), (F.lit(52.96) + (F.pmod(k * 29, F.lit(60)) + i * 3) / 1000.0).alias("lat"))).alias("points"))
    ride = F.col("key").isin("attraction", "railway") & (F.col("value") == "roller_coaster")
    kind = F.when(ride, "ride").when(F.col("key") == "building", "building").when(F.col("key") == "highway", "path").when((F.col("key") == "waterway") | (F.col("value") == "water"), "water").when(F.col("key") == "boundary", "boundary").when(F.col("value").isin("embankment", "cliff"), "terrain")
    near = F.exists("points", lambda p: p["lon"].between(-1.91, -1.86) & p["lat"].between(52.97, 53.01))
    return o.withColumn("kind", kind).where(F.col("kind").isNotNull() & near).groupBy("kind").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last"))


def registered_drawings(spark, sf):
    """Documents with an accepted registration, by priority: the least error first among those of a role."""
    k = F.col("p_partkey")
    d = _t(spark, sf, "part").select("p_partkey", R.dealt(k, ("ride-layout", "site-plan", "elevation")).alias("role"), R.dealt(k, ("approved", "proposed", "as-built"), 3).alias("state"))
    g = _t(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), R.dealt(F.col("l_orderkey"), ("accepted", "rejected", "review")).alias("status"), (F.pmod("l_orderkey", F.lit(50)) / 10.0).alias("rmse"), "l_orderkey", "l_linenumber")
    best = g.where("status = 'accepted'").groupBy("p_partkey").agg(F.min("rmse").alias("rmse"), F.count("*").alias("fits"))
    priority = R.dealt(k, (100, 90, 58)) + F.when(F.col("state") == "as-built", 30).when(F.col("state") == "approved", 25).otherwise(0) - 5 * F.col("rmse")
    return d.join(best, "p_partkey").select("p_partkey", "role", "state", "fits", half_up(F.col("rmse"), 2).alias("rmse_m"), half_up(priority, 2).alias("priority"))


PLACES, LICENCES = ("Point(-1.885 52.985)", "Point(-1.9 53.2)", "", "Point(-1.8801 52.9902)", "bad"), ("CC-BY 4.0", "All rights reserved", "cc0", "<b>CC-BY-SA 4.0</b>")


def nearby_places(spark, sf):
    """Places of a query service: the first row of each item with a point inside the box, its distance, and evidence pictures whose licence is open once their markup is gone."""
    k = F.col("o_orderkey")
    o = _t(spark, sf, "orders").select(F.pmod(k * 7, F.lit(2000)).alias("item"), "o_orderkey", R.dealt(k, PLACES, 3).alias("wkt"), R.dealt(k, LICENCES, 5).alias("licence"))
    part = lambda i: F.regexp_extract("wkt", r"(?i)point\s*\(\s*(-?\d+(?:\.\d+)?)\s+(-?\d+(?:\.\d+)?)\s*\)", i).try_cast("double")
    first = first_per_key(o, ["item"], [F.col("o_orderkey")]).withColumns({"lon": part(1), "lat": part(2)})
    inside = first.where(F.col("lon").between(-1.91, -1.86) & F.col("lat").between(52.97, 53.01))
    metres = S.haversine_m(F.lit(52.987), F.lit(-1.89), F.col("lat"), F.col("lon"))
    plain = F.trim(F.regexp_replace("licence", "<[^>]+>", " "))
    return inside.select("item", "o_orderkey", half_up(metres, 1).alias("metres"), S.is_open_license(plain).alias("open"))


#: Pixels within which of two registrations only the cheaper stays, and how many are looked at.
APART, TRIED = 35, 8


def suppressed_candidates(spark, sf):
    """Registrations of each drawing: of its eight cheapest, in order, those that are farther than 35 pixels from every one kept before."""
    k = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    c = _t(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("copies")).select(F.pmod("l_orderkey", F.lit(300)).alias("drawing"), k.alias("id"), F.pmod(k * 31, F.lit(10007)).alias("cost"), F.pmod(k * 17, F.lit(200)).cast("double").alias("x"), F.pmod(k * 29, F.lit(150)).cast("double").alias("y"))
    first = round_robin(c, "drawing", [F.col("cost"), F.col("id")], TRIED)
    listed = F.array_sort(F.collect_list(F.struct("turn", "id", "x", "y")))

    def step(kept, v):
        near = F.exists(kept, lambda o: F.pow(o["x"] - v["x"], 2) + F.pow(o["y"] - v["y"], 2) < APART * APART)
        return F.when(near, kept).otherwise(F.concat(kept, F.array(v)))

    g = first.groupBy("drawing").agg(F.aggregate(listed, F.array().cast("array<struct<turn:int,id:bigint,x:double,y:double>>"), step).alias("kept"))
    return g.select("drawing", F.explode("kept").alias("v")).select("drawing", "v.id", F.col("v.turn").alias("rank"))


def svg_shapes(spark, sf):
    """Lines, polylines, polygons and rectangles of drawings, hidden ones aside, with their group's shift and scale: points, whether closed, box and length."""
    k = F.col("s_suppkey")
    n = lambda m, mod: F.pmod(k * m, F.lit(mod)).cast("string")
    svg = F.concat(
        F.lit('<svg width="842" height="595"><g transform="translate('), n(3, 50), F.lit(","), n(5, 40), F.lit(') scale(2)"><polyline points="0,0 '), n(7, 90), F.lit(",0 "), n(7, 90), F.lit(","), n(11, 80), F.lit('" stroke="#000"/><polygon points="0 0 10 0 10 10"/><rect x="'), n(13, 30), F.lit('" y="4" width="12" height="'), n(17, 20),
        F.lit('"/><line x1="0" y1="0" x2="'), n(19, 70), F.lit('" y2="3"/><rect x="1" y="1" width="5" height="5" display="none"/></g></svg>'),
    )
    s = _t(spark, sf, "supplier").select("s_suppkey", svg.alias("svg"))
    number = lambda text, name: F.regexp_extract(text, rf'\b{name}="(-?[0-9.]+)"', 1).try_cast("double")
    shift = lambda i: F.regexp_extract("svg", r"translate\((-?[0-9.]+),(-?[0-9.]+)\)", i).cast("double")
    tags = s.select("s_suppkey", shift(1).alias("tx"), shift(2).alias("ty"), F.regexp_extract("svg", r"scale\(([0-9.]+)\)", 1).cast("double").alias("scale"), F.posexplode(F.regexp_extract_all("svg", F.lit(r"<((?:polyline|polygon|rect|line)\b[^>]*)>"), F.lit(1))).alias("place", "tag")).where("NOT tag LIKE '%display=\"none\"%'")
    kind = F.regexp_extract("tag", "^([a-z]+)", 1)
    numbers = F.transform(F.regexp_extract_all(F.regexp_extract("tag", r'points="([^"]*)"', 1), F.lit(r"-?[0-9.]+"), F.lit(0)), lambda v: v.cast("double"))
    t = F.col("tag")
    flat = F.when(kind == "rect", F.array(number(t, "x"), number(t, "y"), number(t, "x") + number(t, "width"), number(t, "y"), number(t, "x") + number(t, "width"), number(t, "y") + number(t, "height"), number(t, "x"), number(t, "y") + number(t, "height"))).when(kind == "line", F.array(number(t, "x1"), number(t, "y1"), number(t, "x2"), number(t, "y2"))).otherwise(numbers)
    tags = tags.select("s_suppkey", "place", kind.alias("kind"), "tx", "ty", "scale", flat.alias("flat"))
    points = F.transform(F.sequence(F.lit(0), (F.size("flat") / 2).cast("int") - 1), lambda i: G.point(F.col("tx") + F.col("scale") * F.get("flat", (2 * i).cast("int")), F.col("ty") + F.col("scale") * F.get("flat", (2 * i + 1).cast("int"))))
    tags = tags.withColumn("points", points)
    return tags.select("s_suppkey", "place", "kind", F.size("points").alias("n"), F.col("kind").isin("rect", "polygon").alias("closed"), F.array_min(F.transform("points", lambda p: p["x"])).alias("x0"), F.array_max(F.transform("points", lambda p: p["y"])).alias("y1"), half_up(G.length(F.col("points")), 3).alias("length"))


QUERIES = {f.__name__: f for f in (text_anchors, attachments, reference_features, registered_drawings, nearby_places, suppressed_candidates, svg_shapes)}

_D = R.sql_dealt
_R = lambda x, n: f"floor(({x}) * 1e{n} + 0.5) / 1e{n}"
_BOX = lambda dx: f"' xMin=\"' || (x + {dx}) || '\" yMin=\"' || y || '\" xMax=\"' || (x + {dx} + 40) || '\" yMax=\"' || (y + 10) || '\">'"
_ANCHORS = lambda tag: f"SELECT s_suppkey, trim(regexp_replace(replace(regexp_replace(regexp_replace(part, '^[^>]*>', ''), '<[^>]+>', ' ', 'g'), '&amp;', '&'), '\\s+', ' ', 'g')) AS text, {', '.join(f'''{_R(f'regexp_extract(part, {R.quoted(n + '="([^"]+)"')}, 1)::DOUBLE * 2', 2)} AS {n.lower()}''' for n in ('xMin', 'yMin', 'xMax', 'yMax'))} FROM (SELECT s_suppkey, unnest(regexp_extract_all(xml, '(?is)<{tag}\\b([^>]*>.*?)</{tag}>', 1)) AS part FROM p)"
_SCORE = f"{R.sql_first_match('low', ROLE_SCORES, 0)} + {R.sql_first_match('low', STATE_SCORES, 0)} + CASE WHEN contains(low, 'approved') THEN 20 ELSE 0 END + CASE WHEN regexp_matches(low, 'as[- ]?built|implemented|completion|discharge of condition') THEN 35 ELSE 0 END - CASE WHEN regexp_matches(low, '{REJECTED}') THEN 160 ELSE 0 END - CASE WHEN contains(low, 'proposed') AND NOT contains(low, 'approved') THEN 10 ELSE 0 END"
_POINT = r"(?i)point\s*\(\s*(-?\d+(?:\.\d+)?)\s+(-?\d+(?:\.\d+)?)\s*\)"

ORACLE_SQL = {
    "text_anchors": f"""
WITH s AS (SELECT s_suppkey, s_suppkey * 7 % 400 AS x, s_suppkey * 11 % 300 AS y FROM supplier),
p AS (SELECT s_suppkey, '<page width="842" height="595"><line' || {_BOX(0)} || '<word' || {_BOX(0)} || {_D('s_suppkey', [a[0] for a in LINES])} || '</word><word' || {_BOX(50)} || {_D('s_suppkey', [a[1] for a in LINES])} || '</word></line>' || CASE WHEN s_suppkey % 3 = 0 THEN '<word' || {_BOX(100)} || 'Boundary fence</word>' ELSE '' END || '</page>' AS xml FROM s),
l AS (SELECT * FROM (SELECT *, {R.sql_first_match('lower(text)', CLASSES)} AS class FROM ({_ANCHORS('line')})) WHERE class IS NOT NULL), w AS (SELECT * FROM (SELECT *, {R.sql_first_match('lower(text)', CLASSES)} AS class FROM ({_ANCHORS('word')})) WHERE class IS NOT NULL)
SELECT * FROM l UNION ALL SELECT * FROM w WHERE s_suppkey NOT IN (SELECT s_suppkey FROM l)""",
    "attachments": f"""
WITH c AS (SELECT c_custkey % 500 AS page, c_custkey, {_D('c_custkey', TOKENS)} AS name, {_D('c_custkey', ATTACHED, 5)} || ' ' || (c_custkey % 4) AS text FROM customer), f AS (SELECT *, lower(text) AS low FROM c WHERE regexp_matches(name, '^[A-Za-z0-9._-]{{1,160}}$')),
s AS (SELECT page, name, text, {_SCORE} AS score, regexp_matches(low, '{REJECTED}') AS rejected, c_custkey FROM f)
SELECT page, name, text, score, rejected FROM (SELECT *, row_number() OVER (PARTITION BY page, name ORDER BY score DESC, c_custkey) AS n FROM s) WHERE n = 1""",
    "reference_features": f"""
WITH o AS (SELECT o_orderkey, {_D('o_orderkey', [t[0] for t in TAGS])} AS key, {_D('o_orderkey', [t[1] for t in TAGS])} AS value, list_transform(range(0, 4), lambda i: {{'lon': -1.95::DOUBLE + (o_orderkey * 13 % 100 + i * 4) / 1000.0, 'lat': 52.96::DOUBLE + (o_orderkey * 29 % 60 + i * 3) / 1000.0}}) AS points FROM orders),
k AS (SELECT *, CASE WHEN key IN ('attraction', 'railway') AND value = 'roller_coaster' THEN 'ride' WHEN key = 'building' THEN 'building' WHEN key = 'highway' THEN 'path' WHEN key = 'waterway' OR value = 'water' THEN 'water' WHEN key = 'boundary' THEN 'boundary' WHEN value IN ('embankment', 'cliff') THEN 'terrain' END AS kind FROM o)
SELECT kind, count(*) AS n, min(o_orderkey) AS first, max(o_orderkey) AS last FROM k WHERE kind IS NOT NULL AND len(list_filter(points, lambda p: p.lon BETWEEN -1.91::DOUBLE AND -1.86::DOUBLE AND p.lat BETWEEN 52.97::DOUBLE AND 53.01::DOUBLE)) > 0 GROUP BY 1""",
    "registered_drawings": f"""
WITH d AS (SELECT p_partkey, {_D('p_partkey', ('ride-layout', 'site-plan', 'elevation'))} AS role, {_D('p_partkey', ('approved', 'proposed', 'as-built'), 3)} AS state FROM part),
b AS (SELECT l_partkey AS p_partkey, min((l_orderkey % 50) / 10.0::DOUBLE) AS rmse, count(*) AS fits FROM lineitem WHERE {_D('l_orderkey', ('accepted', 'rejected', 'review'))} = 'accepted' GROUP BY 1)
SELECT p_partkey, role, state, fits, {_R('rmse', 2)} AS rmse_m, {_R(f"{_D('p_partkey', (100, 90, 58))} + CASE state WHEN 'as-built' THEN 30 WHEN 'approved' THEN 25 ELSE 0 END - 5 * rmse", 2)} AS priority FROM d JOIN b USING (p_partkey)""",
    "nearby_places": f"""
WITH o AS (SELECT o_orderkey * 7 % 2000 AS item, o_orderkey, {_D('o_orderkey', PLACES, 3)} AS wkt, {_D('o_orderkey', LICENCES, 5)} AS licence FROM orders), f AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY o_orderkey) AS n FROM o),
c AS (SELECT *, try_cast(regexp_extract(wkt, '{_POINT}', 1) AS DOUBLE) AS lon, try_cast(regexp_extract(wkt, '{_POINT}', 2) AS DOUBLE) AS lat FROM f WHERE n = 1)
SELECT item, o_orderkey, {_R("2000.0 * 6371.0088 * asin(least(1.0, sqrt(sin(radians(lat - 52.987) / 2) ** 2 + cos(radians(52.987)) * cos(radians(lat)) * sin(radians(lon + 1.89) / 2) ** 2)))", 1)} AS metres, NOT contains(licence, 'reserved') AS open FROM c WHERE lon BETWEEN -1.91 AND -1.86 AND lat BETWEEN 52.97 AND 53.01""",
    "suppressed_candidates": f"""
WITH RECURSIVE c AS (SELECT DISTINCT l_orderkey % 300 AS drawing, l_orderkey * 7 + l_linenumber AS id FROM lineitem), p AS (SELECT *, id * 31 % 10007 AS cost, (id * 17 % 200)::DOUBLE AS x, (id * 29 % 150)::DOUBLE AS y FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY drawing ORDER BY cost, id) AS n FROM p), t AS (SELECT * FROM r WHERE n <= {TRIED}),
g AS (SELECT DISTINCT drawing, 0::BIGINT AS n, []::STRUCT(x DOUBLE, y DOUBLE)[] AS kept, NULL::BIGINT AS id, false AS stays FROM t
UNION ALL SELECT t.drawing, t.n, CASE WHEN len(list_filter(kept, lambda o: pow(o.x - t.x, 2) + pow(o.y - t.y, 2) < {APART * APART})) > 0 THEN kept ELSE list_append(kept, {{'x': t.x, 'y': t.y}}) END, t.id, len(list_filter(kept, lambda o: pow(o.x - t.x, 2) + pow(o.y - t.y, 2) < {APART * APART})) = 0 FROM g JOIN t ON t.drawing = g.drawing AND t.n = g.n + 1)
SELECT drawing, id, n::INTEGER AS rank FROM g WHERE stays""",
    "svg_shapes": """
WITH s AS (SELECT s_suppkey, (s_suppkey * 3 % 50)::DOUBLE AS tx, (s_suppkey * 5 % 40)::DOUBLE AS ty, (s_suppkey * 7 % 90)::DOUBLE AS a, (s_suppkey * 11 % 80)::DOUBLE AS b, (s_suppkey * 13 % 30)::DOUBLE AS c, (s_suppkey * 17 % 20)::DOUBLE AS d, (s_suppkey * 19 % 70)::DOUBLE AS e FROM supplier)
SELECT s_suppkey, 0 AS place, 'polyline' AS kind, 3 AS n, false AS closed, tx AS x0, ty + 2 * greatest(0, b) AS y1, floor((2 * a + 2 * b) * 1000 + 0.5) / 1000 AS length FROM s
UNION ALL SELECT s_suppkey, 1, 'polygon', 3, true, tx, ty + 20, 40.0 FROM s UNION ALL SELECT s_suppkey, 2, 'rect', 4, true, tx + 2 * c, ty + 2 * (4 + d), floor((48 + 2 * d) * 1000 + 0.5) / 1000 FROM s
UNION ALL SELECT s_suppkey, 3, 'line', 2, false, tx, ty + 6, floor(2 * sqrt(e * e + 9) * 1000 + 0.5) / 1000 FROM s""",
}
