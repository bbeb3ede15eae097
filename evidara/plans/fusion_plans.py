"""Queries of the fusion side: duplicates, claims, measures of lines, samples of a grid, and the same in DuckDB SQL.

Points are those of `spatial_plans`, in metres.
"""

from __future__ import annotations

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from evidara.functions import scalars as S
from evidara.operators import ranking as R
from evidara.operators import spatial as P
from evidara.plans.spatial_plans import _t, _x, _xy, _y


def semantic_duplicates(spark: SparkSession, sf: str):
    """Customers that no supplier of the same nation, their name here, lies within 40 m of; the others are duplicates."""
    c = _t(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("name"), _x("c_custkey").alias("x"), _y("c_custkey").alias("y"))
    s = _t(spark, sf, "supplier").select(F.col("s_nationkey").alias("name"), _x("s_suppkey").alias("x2"), _y("s_suppkey").alias("y2"))
    hits = P.grid_join(c, s, 40.0, "inner", ["name"]).select("c_custkey").distinct().withColumn("hit", F.lit(True))
    return c.join(hits, "c_custkey", "left").groupBy(F.col("name").alias("nation"), F.coalesce("hit", F.lit(False)).alias("duplicate")).agg(F.count("*").alias("n"))


def polyline_measures(spark, sf):
    """Each customer's orders as a line in order of key: points, length in metres at 2 places, and twice the signed area of the closed ring."""
    o = _t(spark, sf, "orders").select("o_custkey", "o_orderkey", _x("o_orderkey").alias("x"), _y("o_orderkey").alias("y"))
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    # the ring closes from the last point to the first
    last = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    o = o.withColumns({"px": F.lag("x").over(w), "py": F.lag("y").over(w), "lx": F.last("x").over(last), "ly": F.last("y").over(last)})
    step = F.coalesce(F.sqrt(((F.col("x") - F.col("px")) * (F.col("x") - F.col("px")) + (F.col("y") - F.col("py")) * (F.col("y") - F.col("py"))).cast("double")), F.lit(0.0))
    cross = F.coalesce("px", "lx") * F.col("y") - F.col("x") * F.coalesce("py", "ly")
    # sums of whole centimetres don't depend on their order
    return o.groupBy("o_custkey").agg(F.count("*").alias("points"), F.sum(F.floor(step * 100 + 0.5).cast("bigint")).alias("length_cm"), F.sum(cross.cast("bigint")).alias("area2"))


def connector_claims(spark, sf):
    """Line items as connectors: the first claim on (order, supplier), then the first on the rounded place."""
    c = _t(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey", F.floor(_x("l_partkey") / 4).alias("gx"), F.floor(_y("l_partkey") / 4).alias("gy"))
    order = [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey"), F.col("l_partkey")]
    once = R.first_per_key(c, ["l_orderkey", "l_suppkey"], order)
    return R.first_per_key(once, ["gx", "gy"], order).select("l_orderkey", "l_linenumber", "l_suppkey", "gx", "gy")


def coverage_ratios(spark, sf):
    """Shares of length per return flag: quantity is the length, with a width if discounted, with a plan if taxed above 4 per cent."""
    n = _t(spark, sf, "lineitem").select("l_returnflag", F.col("l_quantity").cast("bigint").alias("m"), (F.col("l_discount") > 0).alias("wide"), (F.col("l_tax") > 0.04).alias("planned"))
    part = lambda c: F.sum(F.when(F.col(c), F.col("m")).otherwise(F.lit(0)))
    share = lambda c: S.half_up(part(c) / F.sum("m"), 4)
    return n.groupBy("l_returnflag").agg(F.sum("m").alias("metres"), share("wide").alias("with_width"), share("planned").alias("with_plan"))


def bilinear_samples(spark, sf):
    """Customers' points sampled from the grid of mean part sizes (cells of 500 m) by four cells, in thousandths; -1 where a cell is missing.

    Cell values and weights are whole numbers, so that the sum doesn't depend on its order.
    """
    cell = lambda v: F.floor(v / 500).cast("bigint")
    mean = F.floor(F.sum(F.col("p_size").cast("bigint")) * 1000 / F.count("*")).cast("bigint")
    grid = _t(spark, sf, "part").groupBy(cell(_x("p_partkey")).alias("cx"), cell(_y("p_partkey")).alias("cy")).agg(mean.alias("v"))
    p = _t(spark, sf, "customer").select("c_custkey", _x("c_custkey").alias("x"), _y("c_custkey").alias("y"))
    side = lambda v, far: F.when(F.col(f"k.{far}") == 1, F.pmod(v, F.lit(500))).otherwise(500 - F.pmod(v, F.lit(500)))
    corners = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1))))
    p = p.withColumn("k", corners).select("c_custkey", (cell(F.col("x")) + F.col("k.a")).alias("cx"), (cell(F.col("y")) + F.col("k.b")).alias("cy"), (side(F.col("x"), "a") * side(F.col("y"), "b")).cast("bigint").alias("weight"))
    g = p.join(grid, ["cx", "cy"], "left").groupBy("c_custkey").agg(F.sum(F.col("v") * F.col("weight")).alias("v"), F.count("v").alias("cells"))
    return g.select("c_custkey", F.when(F.col("cells") == 4, F.floor(F.col("v") / 250000).cast("bigint")).otherwise(F.lit(-1).cast("bigint")).alias("value"))


def nearest_segments(spark, sf):
    """For each supplier the nearest of the parts' eastward segments within 60 m: distance in tenths of a metre, ties to the smaller key."""
    s = _t(spark, sf, "supplier").select("s_suppkey", _x("s_suppkey").alias("x"), _y("s_suppkey").alias("y"))
    g = _t(spark, sf, "part").select("p_partkey", _x("p_partkey").alias("x2"), _y("p_partkey").alias("y2"), F.col("p_size").cast("bigint").alias("size"))
    dx = F.col("x") - F.least(F.greatest("x", "x2"), F.col("x2") + F.col("size"))
    dy = F.col("y") - F.col("y2")
    d2 = (dx * dx + dy * dy).cast("bigint")
    # segments have 50 m at most, so a segment within 60 m begins within 110 m
    near = P.grid_join(s, g, 110.0, near=d2 <= 3600).groupBy("s_suppkey").agg(F.min(F.struct(d2.alias("d2"), "p_partkey")).alias("m"))
    return near.select("s_suppkey", F.col("m.p_partkey").alias("p_partkey"), F.floor(F.sqrt(F.col("m.d2").cast("double")) * 10 + 0.5).cast("bigint").alias("decimetres"))


def manifest_ranking(spark, sf):
    """The manifest chosen per segment: verified transport first, then most documents, then most applications, then the name."""
    c = _t(spark, sf, "customer").join(_t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("documents"), F.countDistinct("o_orderpriority").alias("applications")), "c_custkey")
    order = [F.desc(F.col("c_acctbal") > 0), F.desc("documents"), F.desc("applications"), F.col("c_name")]
    return R.first_per_key(c, ["c_mktsegment"], order).select("c_mktsegment", "c_name", "documents", "applications")


QUERIES = {f.__name__: f for f in (semantic_duplicates, polyline_measures, connector_claims, coverage_ratios, bilinear_samples, nearest_segments, manifest_ranking)}

ORACLE_SQL = {
    "semantic_duplicates": f"""
WITH c AS (SELECT c_nationkey AS nation, {_xy('c_custkey')} FROM customer), s AS (SELECT s_nationkey AS nation, {_xy('s_suppkey')} FROM supplier),
d AS (SELECT nation, EXISTS (SELECT 1 FROM s WHERE s.nation = c.nation AND (c.x - s.x) * (c.x - s.x) + (c.y - s.y) * (c.y - s.y) <= 1600) AS duplicate FROM c)
SELECT nation, duplicate, count(*) AS n FROM d GROUP BY 1, 2""",
    "polyline_measures": f"""
WITH o AS (SELECT o_custkey, o_orderkey, {_xy('o_orderkey')} FROM orders),
p AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py, last_value(x) OVER a AS lx, last_value(y) OVER a AS ly FROM o
  WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey), a AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT o_custkey, count(*) AS points, sum(floor(coalesce(sqrt(((x - px) * (x - px) + (y - py) * (y - py))::DOUBLE), 0.0) * 100 + 0.5)::BIGINT)::BIGINT AS length_cm,
sum(coalesce(px, lx) * y - x * coalesce(py, ly))::BIGINT AS area2 FROM p GROUP BY 1""",
    "connector_claims": f"""
WITH c AS (SELECT l_orderkey, l_suppkey, l_linenumber, l_partkey, x // 4 AS gx, y // 4 AS gy FROM (SELECT *, {_xy('l_partkey')} FROM lineitem)),
a AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_partkey) AS n FROM c),
b AS (SELECT *, row_number() OVER (PARTITION BY gx, gy ORDER BY l_orderkey, l_linenumber, l_suppkey, l_partkey) AS m FROM a WHERE n = 1)
SELECT l_orderkey, l_linenumber, l_suppkey, gx, gy FROM b WHERE m = 1""",
    "coverage_ratios": """
WITH n AS (SELECT l_returnflag, l_quantity::BIGINT AS m, l_discount > 0 AS wide, l_tax > 0.04::DOUBLE AS planned FROM lineitem)
SELECT l_returnflag, sum(m)::BIGINT AS metres, floor(sum(CASE WHEN wide THEN m ELSE 0 END)::DOUBLE / sum(m)::DOUBLE * 10000 + 0.5) / 10000 AS with_width,
floor(sum(CASE WHEN planned THEN m ELSE 0 END)::DOUBLE / sum(m)::DOUBLE * 10000 + 0.5) / 10000 AS with_plan FROM n GROUP BY 1""",
    "bilinear_samples": f"""
WITH g AS (SELECT x // 500 AS cx, y // 500 AS cy, floor((sum(p_size) * 1000)::DOUBLE / count(*))::BIGINT AS v FROM (SELECT p_size, {_xy('p_partkey')} FROM part) GROUP BY 1, 2),
p AS (SELECT c_custkey, x // 500 AS ix, y // 500 AS iy, x % 500 AS fx, y % 500 AS fy FROM (SELECT c_custkey, {_xy('c_custkey')} FROM customer)),
q AS (SELECT *, ix + a AS cx, iy + b AS cy, (CASE WHEN a = 1 THEN fx ELSE 500 - fx END) * (CASE WHEN b = 1 THEN fy ELSE 500 - fy END) AS weight FROM p, (VALUES (0), (1)) s(a), (VALUES (0), (1)) t(b))
SELECT c_custkey, CASE WHEN count(v) = 4 THEN sum(v * weight)::BIGINT // 250000 ELSE -1 END AS value FROM q LEFT JOIN g USING (cx, cy) GROUP BY 1""",
    "nearest_segments": f"""
WITH s AS (SELECT s_suppkey, {_xy('s_suppkey')} FROM supplier), p AS (SELECT p_partkey, p_size, {_xy('p_partkey')} FROM part),
d AS (SELECT s_suppkey, p_partkey, (s.x - least(greatest(s.x, p.x), p.x + p_size)) ** 2 + (s.y - p.y) ** 2 AS d2 FROM s JOIN p ON abs(s.y - p.y) <= 60),
m AS (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY d2, p_partkey) AS n FROM d WHERE d2 <= 3600)
SELECT s_suppkey, p_partkey, floor(sqrt(d2) * 10 + 0.5)::BIGINT AS decimetres FROM m WHERE n = 1""",
    "manifest_ranking": """
WITH o AS (SELECT o_custkey AS c_custkey, count(*) AS documents, count(DISTINCT o_orderpriority) AS applications FROM orders GROUP BY 1),
r AS (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal > 0 DESC, documents DESC, applications DESC, c_name) AS n FROM customer JOIN o USING (c_custkey))
SELECT c_mktsegment, c_name, documents, applications FROM r WHERE n = 1""",
}
