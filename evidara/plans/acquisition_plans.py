"""Queries of acquisition and of the world's blocks: failure budgets, boxed partitions, tiled coverage, chunks; the same in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidara.functions import rules as Q
from evidara.functions import scalars as S
from evidara.operators import coverage as C
from evidara.operators import ranking as R
from evidara.operators import voxels as V
from evidara.session import cut

DOCUMENTS, BYTES = 2_000, 55_000_000


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def failure_budgets(spark, sf):
    """Line items as documents to download, in rounds over suppliers: those attempted before the documents, bytes or failures run out."""
    n = F.col("l_orderkey") * 5 + F.col("l_linenumber") * 3 + F.col("l_partkey")
    c = _t(spark, sf, "lineitem").groupBy("l_suppkey", "l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"), F.min("l_quantity").alias("q"))
    # the url decides whether a download works
    url = F.pmod(n, F.lit(7919))
    c = c.select("l_suppkey", "l_orderkey", "l_linenumber", url.alias("url"), (F.col("q").cast("bigint") * 1000).alias("bytes"), (F.pmod(url * 31 + F.floor(url / 97), F.lit(29)) > 0).alias("ok"))
    found = R.downloads(c, "l_suppkey", "l_suppkey", [F.col("l_orderkey"), F.col("l_linenumber")], DOCUMENTS, BYTES)
    return found.select("l_suppkey", "l_orderkey", "l_linenumber", F.col("turn").alias("round"), "ok", "had_before", "used_before", "failed_before")


ZOOM = 14


def boxed_partitions(spark, sf):
    """Suppliers' boxes as tiles, and of the orders in each tile the latest."""
    lon, lat = (lambda k: F.lit(-1.897) + F.pmod(k * 7919, F.lit(28000)) / 1e5), (lambda k: F.lit(52.981) + F.pmod(k * 104729, F.lit(15000)) / 1e5)
    k = F.col("s_suppkey")
    box = (lon(k), lat(k), lon(k) + F.pmod(k, F.lit(7)) / 100, lat(k) + F.pmod(k, F.lit(5)) / 100)
    tiles = _t(spark, sf, "supplier").select("s_suppkey", F.explode(S.box_quadkeys(*box, ZOOM)).alias("quadkey"))
    k = F.col("o_orderkey")
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate", S.quadkey(*S.tile_of(lon(k), lat(k), ZOOM), ZOOM).alias("quadkey"))
    held = orders.join(tiles.select("quadkey").distinct(), "quadkey", "left_semi")
    latest = R.first_per_key(held, ["quadkey"], [F.desc("o_orderdate"), F.col("o_orderkey")])
    return tiles.join(latest, "quadkey", "left").select("s_suppkey", "quadkey", F.coalesce("o_orderkey", F.lit(-1)).alias("o_orderkey"))


ROLES = ("dtm", "dsm", "vom")


def tiled_coverage(spark, sf):
    """Orders as bundles of tiles, their line items: how each bundle was had, with retries at native resolution and one request for all instead."""
    k = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    rows = _t(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"))
    requested = F.when(F.pmod(k, F.lit(3)) == 0, 1.0).otherwise(4.0)
    tiles = rows.select("l_orderkey", F.col("l_linenumber").alias("tile"), requested.alias("requested"))
    role = Q.dealt(F.col("l_orderkey"), ROLES)

    def attempt(kind: str, seed: int, asked):
        h = F.pmod(F.col("p") * seed + k, F.lit(17))
        resolution = F.when(h > 0, asked * F.when(h == 1, 3.0).otherwise(1.0))
        error = C.attempt_fails(role, F.when(h == 2, 30.0).otherwise(1.0), F.when(h == 3, 0.5).otherwise(0.9), resolution, requested)
        return rows.where(h < 16).select("l_orderkey", F.col("l_linenumber").alias("tile"), F.lit(kind).alias("kind"), error.alias("error"))

    settled = C.settled_tiles(tiles, attempt("scaled", 11, requested).union(attempt("native", 23, F.lit(1.0))), ["l_orderkey"])
    o = F.col("o_orderkey")
    single = _t(spark, sf, "orders").select(o.alias("l_orderkey"), (F.pmod(o, F.lit(4)) > 0).alias("allowed"), (F.pmod(o, F.lit(5)) > 0).alias("single_ok"))
    return C.bundles(settled, ["l_orderkey"], single)


BLOCKS = ("minecraft:stone", "minecraft:dirt", "minecraft:grass_block", "minecraft:water", "minecraft:Bad Name", "minecraft:oak_planks", "minecraft:tuff")


def _operations(spark, sf) -> DataFrame:
    k = F.col("l_orderkey") * 11 + F.col("l_linenumber")
    at = lambda m, n: F.pmod(k * m, F.lit(n)).cast("int")
    rows = _t(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"))
    return rows.select(
        F.floor(F.col("l_orderkey") / 400).cast("int").alias("chunk_x"), (F.pmod("l_orderkey", F.lit(10)) - 5).cast("int").alias("chunk_z"), at(7, 5).alias("priority"), k.alias("pos"), (at(3, 20) - 2).alias("x1"), at(13, 60).alias("y1"), at(5, 18).alias("z1"), at(17, 19).alias("x2"), at(19, 60).alias("y2"), (at(23, 20) - 3).alias("z2"), Q.dealt(F.col("p"), BLOCKS).alias("block"),
    )


#: Chunks of the map: all eastward ones, and those from -3 to 3 southward.
BOUNDS = (0, -3, 1 << 30, 3)


def chunk_columns(spark, sf):
    """Each chunk of the map: its columns, their height in all, and a mark of their top blocks."""
    tops = V.column_tops(V.clipped(_operations(spark, sf), BOUNDS))
    # one row for each block of a chunk, so that its columns are formed once
    held = cut(tops.groupBy("chunk_x", "chunk_z", "block").agg(F.count("*").alias("n"), F.sum("height").alias("h"), F.max("height").alias("t"), F.sum(F.col("x") * 16 + F.col("z") + 1).alias("w")))
    marked = held.join(F.broadcast(V.registry(held)), "block").groupBy("chunk_x", "chunk_z")
    return marked.agg(F.sum("n").alias("columns"), F.sum("h").alias("height"), F.max("t").alias("top"), F.sum(F.col("w") * (F.col("id") + 1)).alias("mark"))


def block_registry(spark, sf):
    """Dense ids of the parts' types as block names, in order."""
    return V.registry(_t(spark, sf, "part").select(F.concat(F.lit("minecraft:"), F.regexp_replace(F.lower("p_name"), "[^a-z0-9]+", "_")).alias("block")))


def block_audit(spark, sf):
    """Blocks of operations that the known list lacks."""
    known = spark.createDataFrame([(b,) for b in BLOCKS[:4]], "block string")
    return V.unknown_blocks(_operations(spark, sf), known)


QUERIES = {f.__name__: f for f in (failure_budgets, boxed_partitions, tiled_coverage, chunk_columns, block_registry, block_audit)}

_LON, _LAT = "(-1.897::DOUBLE + ({k}::BIGINT * 7919 % 28000) / 1e5)", "(52.981::DOUBLE + ({k}::BIGINT * 104729 % 15000) / 1e5)"
_X = lambda lon: f"greatest(0, least({(1 << ZOOM) - 1}, floor(({lon} + 180.0) / 360.0 * {1 << ZOOM})::BIGINT))"
_Y = lambda lat: f"greatest(0, least({(1 << ZOOM) - 1}, floor((1.0 - ln(tan(radians({lat})) + 1.0 / cos(radians({lat}))) / 3.141592653589793::DOUBLE) / 2.0 * {1 << ZOOM})::BIGINT))"
_KEY = " || ".join(f"(((x >> {b}) & 1) + 2 * ((y >> {b}) & 1))" for b in range(ZOOM - 1, -1, -1))
_FAILS = lambda asked: f"CASE WHEN h = 0 THEN 'no-raster' WHEN h = 2 AND 30 > greatest(2.0, 2.5 * {asked}) THEN 'bounds-mismatch' WHEN {asked} * CASE WHEN h = 1 THEN 3 ELSE 1 END > greatest(2.0, requested * 1.25) THEN 'resolution-too-coarse' WHEN h = 3 AND l_orderkey % 3 <> 2 THEN 'too-little-coverage' END"
_AT = lambda m, n: f"(k * {m} % {n})"
_OPS = f"""
o AS (SELECT l_orderkey // 400 AS chunk_x, l_orderkey % 10 - 5 AS chunk_z, {_AT(7, 5)} AS priority, k AS pos, {_AT(3, 20)} - 2 AS x1, {_AT(13, 60)} AS y1, {_AT(5, 18)} AS z1, {_AT(17, 19)} AS x2, {_AT(19, 60)} AS y2, {_AT(23, 20)} - 3 AS z2, {Q.sql_dealt('p', BLOCKS)} AS block
  FROM (SELECT l_orderkey, l_linenumber, l_orderkey * 11 + l_linenumber AS k, min(l_partkey) AS p FROM lineitem GROUP BY ALL))"""

ORACLE_SQL = {
    "failure_budgets": f"""
WITH a AS (SELECT l_suppkey, l_orderkey, l_linenumber, (l_orderkey * 5 + l_linenumber * 3 + min(l_partkey)) % 7919 AS url, min(l_quantity)::BIGINT * 1000 AS bytes FROM lineitem GROUP BY 1, 2, 3),
b AS (SELECT *, (url * 31 + url // 97) % 29 > 0 AS ok, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) AS round FROM a),
c AS (SELECT *, coalesce(count(*) FILTER (NOT ok) OVER (PARTITION BY l_suppkey ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS f FROM b WHERE round <= 48),
d AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY round, l_suppkey) AS n FROM c WHERE f < 5),
e AS (SELECT *, count(*) FILTER (ok) OVER w AS had_before, coalesce(sum(bytes) FILTER (ok) OVER w, 0)::BIGINT AS used_before, count(*) FILTER (NOT ok) OVER w AS failed_before FROM d WHERE NOT ok OR n = 1 WINDOW w AS (ORDER BY round, l_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT l_suppkey, l_orderkey, l_linenumber, round::INTEGER AS round, ok, had_before, used_before, failed_before FROM e WHERE had_before < {DOCUMENTS} AND used_before < {BYTES} AND failed_before < 100""",
    "boxed_partitions": f"""
WITH b AS (SELECT s_suppkey, {_LON.format(k='s_suppkey')} AS w, {_LAT.format(k='s_suppkey')} AS s, {_LON.format(k='s_suppkey')} + (s_suppkey % 7) / 100.0::DOUBLE AS e, {_LAT.format(k='s_suppkey')} + (s_suppkey % 5) / 100.0::DOUBLE AS n FROM supplier),
r AS (SELECT s_suppkey, {_X('w')} AS x0, {_X('e')} AS x1, {_Y('n')} AS y0, {_Y('s')} AS y1 FROM b), g AS (SELECT *, unnest(range(x0, x1 + 1)) AS x FROM (SELECT *, unnest(range(y0, y1 + 1)) AS y FROM r)), t AS (SELECT s_suppkey, {_KEY} AS quadkey FROM g),
p AS (SELECT o_orderkey, o_orderdate, {_X(_LON.format(k='o_orderkey'))} AS x, {_Y(_LAT.format(k='o_orderkey'))} AS y FROM orders), q AS (SELECT *, {_KEY} AS quadkey FROM p),
l AS (SELECT quadkey, o_orderkey FROM q QUALIFY row_number() OVER (PARTITION BY quadkey ORDER BY o_orderdate DESC, o_orderkey) = 1)
SELECT s_suppkey, t.quadkey, coalesce(o_orderkey, -1) AS o_orderkey FROM t LEFT JOIN l USING (quadkey)""",
    "tiled_coverage": f"""
WITH r AS (SELECT l_orderkey, l_linenumber, l_orderkey * 7 + l_linenumber AS k, min(l_partkey) AS p FROM lineitem GROUP BY 1, 2), q AS (SELECT *, CASE WHEN k % 3 = 0 THEN 1.0::DOUBLE ELSE 4.0 END AS requested FROM r),
s AS (SELECT *, CASE WHEN h = 16 THEN 'no-answer' ELSE {_FAILS('requested')} END AS e1 FROM (SELECT *, (p * 11 + k) % 17 AS h FROM q)), n AS (SELECT * EXCLUDE (h), (p * 23 + k) % 17 AS h FROM s), m AS (SELECT *, CASE WHEN h = 16 THEN 'no-answer' ELSE {_FAILS('1.0::DOUBLE')} END AS e2 FROM n),
t AS (SELECT *, e1 IS NOT NULL AND requested > 1.001 AS retried, e1 IS NOT NULL AND (requested <= 1.001 OR e2 IS NOT NULL) AS bad FROM m),
b AS (SELECT l_orderkey, count(*) AS tiles, count(*) FILTER (bad) AS failed, count(*) FILTER (retried AND NOT bad) AS native, sum(1 + retried::INTEGER)::BIGINT AS requests, coalesce(arg_min(CASE WHEN retried THEN 'scaled: ' || e1 || '; native: ' || e2 ELSE e1 END, l_linenumber) FILTER (bad), '') AS reason FROM t GROUP BY 1)
SELECT l_orderkey, CASE WHEN failed = 0 THEN 'tiled' WHEN l_orderkey % 4 > 0 AND l_orderkey % 5 > 0 THEN 'single' ELSE 'failed' END AS status, tiles, failed, CASE WHEN failed = 0 THEN native ELSE 0 END AS native, requests + (failed > 0 AND l_orderkey % 4 > 0)::BIGINT AS requests, reason FROM b""",
    "chunk_columns": f"""
WITH {_OPS}, c AS (SELECT *, greatest(y1, y2) AS y FROM o WHERE chunk_x >= 0 AND chunk_z BETWEEN -3 AND 3),
g AS (SELECT *, unnest(range(greatest(0, least(z1, z2)), least(15, greatest(z1, z2)) + 1)) AS z FROM (SELECT *, unnest(range(greatest(0, least(x1, x2)), least(15, greatest(x1, x2)) + 1)) AS x FROM c)),
t AS (SELECT chunk_x, chunk_z, x, z, y AS height, block FROM g QUALIFY row_number() OVER (PARTITION BY chunk_x, chunk_z, x, z ORDER BY y DESC, priority DESC, pos DESC) = 1),
i AS (SELECT block, row_number() OVER (ORDER BY block) AS id FROM (SELECT DISTINCT block FROM t))
SELECT chunk_x::INTEGER AS chunk_x, chunk_z::INTEGER AS chunk_z, count(*) AS columns, sum(height)::BIGINT AS height, max(height)::INTEGER AS top, sum((x * 16 + z + 1) * id)::BIGINT AS mark FROM t JOIN i USING (block) GROUP BY 1, 2""",
    "block_registry": "SELECT block, row_number() OVER (ORDER BY block) - 1 AS id FROM (SELECT DISTINCT 'minecraft:' || regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g') AS block FROM part)",
    "block_audit": f"WITH {_OPS} SELECT block, count(*) AS n, regexp_matches(block, '^minecraft:[a-z0-9_]+$') AS valid FROM o WHERE block NOT IN ({', '.join(map(Q.quoted, BLOCKS[:4]))}) GROUP BY 1",
}
