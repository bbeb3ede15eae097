"""Queries of the planning and document side, and the same in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidara.functions import scalars as S
from evidara.operators import ranking as R


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _lon(key):
    return (F.lit(-1897000).cast("bigint") + (key.cast("bigint") * 7919) % 28000) / F.lit(1e6)


def _lat(key):
    return (F.lit(52981000).cast("bigint") + (key.cast("bigint") * 104729) % 15000) / F.lit(1e6)


SQL_LON = "((-1897000 + ({k}::BIGINT * 7919) % 28000) / 1e6)"
SQL_LAT = "((52981000 + ({k}::BIGINT * 104729) % 15000) / 1e6)"
ZOOM = 9


def latest_partition_per_quadkey(spark, sf):
    """Orders land in tiles; tiles that hold a customer are kept, with the latest order of each."""
    points = lambda df, key: df.withColumn("quadkey", S.quadkey(*S.tile_of(_lon(F.col(key)) * 8, _lat(F.col(key)), ZOOM + 6), ZOOM + 6))
    wanted = points(_t(spark, sf, "customer").where("c_acctbal > 9000"), "c_custkey").select("quadkey").distinct()
    orders = points(_t(spark, sf, "orders"), "o_orderkey").join(wanted, "quadkey", "left_semi")
    latest = R.first_per_key(orders, ["quadkey"], [F.desc("o_orderdate"), F.col("o_orderkey")])
    return latest.select("quadkey", "o_orderkey", "o_orderdate", "o_totalprice")


def _sql_quadkey(key: str, zoom: int) -> str:
    n = 1 << zoom
    x = f"greatest(0, least({n - 1}, floor((({SQL_LON.format(k=key)} * 8) + 180.0) / 360.0 * {n})::BIGINT))"
    phi = f"radians({SQL_LAT.format(k=key)})"
    y = f"greatest(0, least({n - 1}, floor((1.0 - ln(tan({phi}) + 1.0 / cos({phi})) / 3.141592653589793) / 2.0 * {n})::BIGINT))"
    return " || ".join(f"((({x}) >> {k}) & 1) + 2 * ((({y}) >> {k}) & 1)" for k in range(zoom - 1, -1, -1)).replace("((((", "((((")


def bbox_filter_standardize(spark, sf):
    """Events as points: inside the box, confident enough (null or negative passes), with a typed identity."""
    e = _t(spark, sf, "events").withColumns({"lon": _lon(F.col("event_id")), "lat": _lat(F.col("event_id")), "conf": F.when(F.pmod("event_id", F.lit(7)) == 0, F.lit(-1.0)).when(F.pmod("event_id", F.lit(11)) == 0, None).otherwise(F.pmod("event_id", F.lit(100)) / 100.0)})
    kept = e.where(F.col("lon").between(-1.89, -1.875) & F.col("lat").between(52.983, 52.992) & (F.col("conf").isNull() | (F.col("conf") < 0) | (F.col("conf") >= 0.65)))
    sha = F.substring(F.sha2(F.concat_ws("|", F.col("event_id").cast("string"), "event_type"), 256), 1, 10)
    return kept.select(F.concat(F.lit("events:"), sha).alias("id"), F.coalesce(F.nullif(F.col("event_type"), F.lit("")), F.lit("feature")).alias("name"), "lon", "lat", F.col("conf").alias("confidence"))


def classify_documents(spark, sf):
    """Role, state and score of each part's name read as a drawing's title; two in three can be downloaded; rejected ones marked."""
    words = F.concat_ws(" ", F.element_at(F.array(*map(F.lit, ("approved", "proposed", "existing", "superseded", "as built"))), (F.pmod("p_partkey", F.lit(5)) + 1).cast("int")), F.element_at(F.array(*map(F.lit, ("site plan", "block plan", "location plan", "landscaping", "track layout", "roof plan", "elevation", "cross section", "contours", "lighting", "road layout", "decision notice", "covering letter"))), (F.pmod("p_partkey", F.lit(13)) + 1).cast("int")), "p_name")
    t = _t(spark, sf, "part").withColumn("title", words)
    out = t.select("p_partkey", S.document_role(F.col("title")).alias("role"), S.document_state(F.col("title")).alias("state"), (S.document_score(F.col("title")) + F.when(F.pmod("p_partkey", F.lit(3)) > 0, 5).otherwise(0)).cast("bigint").alias("score"), F.rlike(F.lower("title"), F.lit(S.REJECT_WORDS)).alias("unwanted"))
    return out.withColumn("rejected", F.col("unwanted") | (F.col("state") == "superseded")).drop("unwanted")


def _sql_case(text: str, cases, default: str, value=1) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({text}, '{c[0]}') THEN {c[value]!r}" for c in cases) + f" ELSE {default} END"


_TITLE = "lower(['approved','proposed','existing','superseded','as built'][p_partkey % 5 + 1] || ' ' || ['site plan','block plan','location plan','landscaping','track layout','roof plan','elevation','cross section','contours','lighting','road layout','decision notice','covering letter'][p_partkey % 13 + 1] || ' ' || p_name)"


def document_candidates(spark, sf):
    """The best-scored candidate per page and the top twenty that pass the gate."""
    c = classify_documents(spark, sf).withColumn("url", F.concat(F.lit("https://x/"), F.pmod("p_partkey", F.lit(40)).cast("string")))
    best = R.first_per_key(c, ["url"], [F.desc("score"), F.col("p_partkey")]).where("score >= 35 AND NOT rejected")
    return best.orderBy(F.desc("score"), "url").limit(20).select("url", "p_partkey", "role", "score")


#: Anchors put after every page's own, one of each way to name an address.
ANCHORS = " <A href='/single'>x</A> <a class=y HREF=bare/path>z</a> <a href='#top'>t</a> <a href=\"../up/./a/../b?x=../y\">u</a> <a href=//cdn.example.org/c>c</a> <a href='?page=2'>q</a> <a href='/../../r/..'>r</a> <a href='http://localhost:8080/l'>l</a> <a href='http://plain.example.org/'>p</a> <a href='DATA:x'>d</a>"


def extract_links(spark, sf):
    """Anchors of the pages as full addresses, with mail, script and fragment links dropped, and all that isn't https, but for http on the machine itself."""
    html = F.concat("html", F.lit(ANCHORS))
    raw = F.explode(F.regexp_extract_all(html, F.lit(r"""(?i)<a\b[^>]*\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""), F.lit(1)))
    rows = _t(spark, sf, "pages").select("page_id", "url", raw.alias("raw")).withColumn("href", F.regexp_replace("raw", "^[\"']|[\"']$", "")).where("href <> '' AND NOT href rlike '(?i)^(#|mailto:|tel:|javascript:|data:)'")
    return rows.withColumn("link", S.resolved_url(F.col("url"), F.col("href"))).where(S.is_fetchable(F.col("link"))).groupBy("page_id", "link").agg(F.count("*").alias("n"))


def host_page_counts(spark, sf):
    """Pages and distinct canonical addresses per host and scheme."""
    p = _t(spark, sf, "pages").withColumn("canonical", S.canonical_url(F.col("url")))
    return p.groupBy(F.regexp_extract("canonical", "://([^/]+)", 1).alias("host")).agg(F.count("*").alias("pages"), F.countDistinct("canonical").alias("addresses"))


def application_merge(spark, sf):
    """One row per application key: documents united, the first reference, a status that only rises from unknown or pending."""
    o = _t(spark, sf, "orders").withColumn("app", F.pmod("o_custkey", F.lit(97)))
    status = F.when(F.col("o_orderstatus") == "F", "approved").when(F.col("o_orderstatus") == "O", "pending").otherwise("unknown")
    known = F.when(~status.isin("pending", "unknown"), status)
    g = o.groupBy("app").agg(F.min("o_orderkey").alias("reference"), F.count_distinct(F.pmod("o_orderkey", F.lit(50))).alias("documents"), F.min(known).alias("settled"), F.max(F.when(status == "pending", F.lit("pending"))).alias("pending"), F.sum(F.floor(F.col("o_totalprice") * 100 + 0.5).cast("bigint")).alias("cents"))
    return g.select("app", "reference", "documents", F.coalesce("settled", "pending", F.lit("unknown")).alias("status"), "cents")


def round_robin_plan(spark, sf):
    """Turns of conversations: all first, then all second ones, three at most."""
    r = R.round_robin(_t(spark, sf, "conversations").select("conv_id", "turn", F.length("text").alias("size")).withColumnRenamed("turn", "place"), "conv_id", [F.col("place")], 3)
    return r.select("conv_id", "place", F.col("turn").alias("round"), F.col("size").cast("bigint").alias("size"))


def budget_prefix(spark, sf):
    """Documents of a source taken while 60,000 characters and 30 places last."""
    d = _t(spark, sf, "documents").select("source", "doc_id", "n_chars")
    return R.within_budget(d, "source", ["doc_id"], "n_chars", 60_000, 30)


def rejection_histogram(spark, sf):
    """Accepted and rejected candidates by reason."""
    c = classify_documents(spark, sf)
    reason = F.when(F.col("rejected"), "superseded").when(F.col("score") < 35, "low-score").otherwise("accepted")
    return c.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"), F.min("score").alias("least"), F.max("score").alias("most"))


def license_gate(spark, sf):
    """Open licences of documents by a text made from the key."""
    texts = ("CC-BY 4.0", "cc-by-4.0", "https://creativecommons.org/licenses/by-sa/4.0/", "https://creativecommons.org/publicdomain/zero/1.0/", "CC-BY-NC-4.0", "All rights reserved", "OGL-3.0, Crown", "", "proprietary", "odbl")
    d = _t(spark, sf, "documents").withColumn("license", F.element_at(F.array(*map(F.lit, texts)), (F.pmod("doc_id", F.lit(10)) + 1).cast("int")))
    return d.groupBy("license", S.is_open_license(F.col("license")).alias("open")).agg(F.count("*").alias("n"))


def byte_sizes(spark, sf):
    """Sizes written as text, in bytes."""
    text = F.concat((F.pmod("doc_id", F.lit(997)) / 10.0).cast("decimal(10,1)").cast("string"), F.element_at(F.array(*map(F.lit, ("B", "KB", "MB", "GiB", " kb", "??"))), (F.pmod("doc_id", F.lit(6)) + 1).cast("int")))
    return _t(spark, sf, "documents").select("doc_id", F.coalesce(S.byte_size(text).cast("bigint"), F.lit(-1)).alias("bytes"))


def short_hashes(spark, sf):
    """FNV-1a hashes of customers' names."""
    return _t(spark, sf, "customer").select("c_custkey", S.fnv1a(F.col("c_name")).alias("hash"))


def coverage_gate(spark, sf):
    """Live applications and documents per source against a minimum; snapshots don't count."""
    d = _t(spark, sf, "documents").withColumn("kind", F.when(F.pmod("doc_id", F.lit(5)) == 0, "snapshot").otherwise("live"))
    live = F.col("kind") == "live"
    g = d.groupBy("source").agg(F.count_if(live).alias("live"), F.count_if(live & (F.col("n_chars") > 1000)).alias("documents"), F.count_if(~live).alias("snapshots"))
    return g.withColumn("status", F.when((F.col("live") >= 12) & (F.col("documents") >= 6), "pass").otherwise("fail"))


def prefetch_link(spark, sf):
    """Pages with the first page of the same address written in another way, through three aliases of the address."""
    p = _t(spark, sf, "pages").select("page_id", "url").where("page_id % 3 <> 0").select("page_id", F.explode(F.array_distinct(F.array("url", F.regexp_replace("url", "^https:", "http:"), F.regexp_replace("url", "[?].*$", "")))).alias("alias"))
    entries = _t(spark, sf, "pages").where("page_id % 3 = 0").groupBy(F.col("url").alias("alias")).agg(F.min("page_id").alias("entry"))
    hits = p.join(entries, "alias").groupBy("page_id").agg(F.min("entry").alias("entry"))
    return _t(spark, sf, "pages").where("page_id % 3 <> 0").select("page_id").join(hits, "page_id", "left").withColumn("available", F.col("entry").isNotNull()).fillna(-1, ["entry"])


#: Fan-out and levels of the tree of hashes: enough for 2**60 keys.
FAN, LEVELS = 4096, 5


def fingerprint(spark, sf):
    """A hash per order priority over its sorted orders, as a tree: FAN neighbouring keys are hashed, then FAN neighbouring hashes, until one is left."""
    rows = _t(spark, sf, "orders").select("o_orderpriority", F.col("o_orderkey").alias("at"), F.concat_ws(":", F.col("o_orderkey").cast("string"), "o_orderstatus").alias("text"))
    for _ in range(LEVELS):
        items = F.array_sort(F.collect_list(F.struct("at", "text")))
        rows = rows.groupBy("o_orderpriority", F.floor(F.col("at") / FAN).alias("up")).agg(F.sha2(F.array_join(F.transform(items, lambda x: x["text"]), "|"), 256).alias("text")).withColumnRenamed("up", "at")
    return rows.select("o_orderpriority", F.col("text").alias("sha256"))


def imagery_ranking(spark, sf):
    """The finest, then the latest, scene per label of the events."""
    e = _t(spark, sf, "events").withColumn("gsd", F.pmod("event_id", F.lit(17)) / 100.0)
    return R.first_per_key(e, ["event_type"], [F.asc_nulls_last("gsd"), F.desc("ts"), F.col("event_id")]).select("event_type", "event_id", "gsd")


def aerial_gate(spark, sf):
    """Share of documents with enough text per language, in per cent at three places."""
    d = _t(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.col("n_chars") >= 500).alias("valid"))
    share = F.floor(F.col("valid") * 100000.0 / F.col("n") + 0.5) / 1000
    return d.select("lang", "n", "valid", share.alias("coverage"), (share >= 85.0).alias("passed"))


def event_windows(spark, sf):
    """An extension: events per type and hour; the streaming twin is in evidara.streaming."""
    e = _t(spark, sf, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return e.select(F.col("w.start").alias("start"), "event_type", "n")


QUERIES = {f.__name__: f for f in (latest_partition_per_quadkey, bbox_filter_standardize, classify_documents, document_candidates, extract_links, host_page_counts, application_merge, round_robin_plan, budget_prefix, rejection_histogram, license_gate, byte_sizes, short_hashes, coverage_gate, prefetch_link, fingerprint, imagery_ranking, aerial_gate, event_windows)}

_SCORE = " + ".join([f"({_sql_case('t', [(p, s) for p, _, s in S.DOCUMENT_ROLES], '0')})", *(f"(CASE WHEN regexp_matches(t, '{p}') THEN {v} ELSE 0 END)" for p, v in S.SCORE_WORDS)])
_CLASSIFIED = f"SELECT p_partkey, role, state, (score + CASE WHEN p_partkey % 3 > 0 THEN 5 ELSE 0 END)::BIGINT AS score, unwanted OR state = 'superseded' AS rejected FROM (SELECT p_partkey, regexp_matches(t, '{S.REJECT_WORDS}') AS unwanted, {_sql_case('t', S.DOCUMENT_ROLES, repr('unknown'))} AS role, {_sql_case('t', S.DOCUMENT_STATES, repr('unknown'))} AS state, {_SCORE} AS score FROM (SELECT p_partkey, {_TITLE} AS t FROM part))"
_OPEN = ", ".join(map(repr, S.OPEN_LICENSES))
_RULED = " OR ".join(f"contains(low, '{m}')" for m in S.RESTRICTED_MARKERS)



def _fingerprint_sql() -> str:
    sql = "SELECT o_orderpriority, o_orderkey AS place, o_orderkey || ':' || o_orderstatus AS text FROM orders"
    for _ in range(LEVELS):
        sql = f"SELECT o_orderpriority, place // {FAN} AS place, sha256(string_agg(text, '|' ORDER BY place)) AS text FROM ({sql}) GROUP BY 1, 2"
    return f"SELECT o_orderpriority, text AS sha256 FROM ({sql})"


ORACLE_SQL = {
    "latest_partition_per_quadkey": f"""
WITH o AS (SELECT *, {_sql_quadkey('o_orderkey', ZOOM + 6)} AS quadkey FROM orders), c AS (SELECT DISTINCT {_sql_quadkey('c_custkey', ZOOM + 6)} AS quadkey FROM customer WHERE c_acctbal > 9000),
n AS (SELECT *, row_number() OVER (PARTITION BY quadkey ORDER BY o_orderdate DESC, o_orderkey) AS n FROM o WHERE quadkey IN (SELECT quadkey FROM c))
SELECT quadkey, o_orderkey, o_orderdate, o_totalprice FROM n WHERE n = 1""",
    "bbox_filter_standardize": f"""
SELECT 'events:' || substr(sha256(event_id::VARCHAR || '|' || event_type), 1, 10) AS id, coalesce(nullif(event_type, ''), 'feature') AS name, lon, lat, conf AS confidence FROM (
SELECT *, {SQL_LON.format(k='event_id')} AS lon, {SQL_LAT.format(k='event_id')} AS lat, CASE WHEN event_id % 7 = 0 THEN -1.0 WHEN event_id % 11 = 0 THEN NULL ELSE (event_id % 100) / 100.0 END::DOUBLE AS conf FROM events)
WHERE lon BETWEEN -1.89 AND -1.875 AND lat BETWEEN 52.983 AND 52.992 AND (conf IS NULL OR conf < 0 OR conf >= 0.65)""",
    "classify_documents": _CLASSIFIED,
    "document_candidates": f"""
WITH c AS (SELECT *, 'https://x/' || (p_partkey % 40) AS url FROM ({_CLASSIFIED})), b AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY score DESC, p_partkey) AS n FROM c)
SELECT url, p_partkey, role, score FROM b WHERE n = 1 AND score >= 35 AND NOT rejected ORDER BY score DESC, url LIMIT 20""",
    "extract_links": rf"""
WITH h AS (SELECT page_id, url, unnest(regexp_extract_all(html || '{ANCHORS.replace("'", "''")}', '(?i)<a\b[^>]*\bhref\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1)) AS raw FROM pages),
a AS (SELECT page_id, url, regexp_replace(raw, '^["'']|["'']$', '', 'g') AS href FROM h),
p AS (SELECT *, regexp_extract(url, '^([a-z]+:)', 1) AS scheme, regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) AS root, coalesce(nullif(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), ''), '/') AS path, string_split(href, '?')[1] AS own, href[len(string_split(href, '?')[1]) + 1 :] AS rest FROM a WHERE href <> '' AND NOT regexp_matches(href, '(?i)^(#|mailto:|tel:|javascript:|data:)')),
q AS (SELECT *, CASE WHEN starts_with(own, '/') THEN own ELSE regexp_extract(path, '^(.*/)', 1) || own END AS long FROM p),
d AS (SELECT *, list_reduce(list_prepend([]::VARCHAR[], list_transform(string_split(long, '/'), lambda v: [v])), lambda o, v: CASE v[1] WHEN '..' THEN CASE WHEN len(o) > 1 THEN o[:-2] ELSE o END WHEN '.' THEN o ELSE o || v END) AS parts FROM q),
l AS (SELECT page_id, CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href WHEN starts_with(href, '//') THEN scheme || href WHEN starts_with(href, '?') THEN root || path || href ELSE root || array_to_string(parts, '/') || CASE WHEN regexp_matches(long, '/\.\.?$') THEN '/' ELSE '' END || rest END AS link FROM d)
SELECT page_id, link, count(*) AS n FROM l WHERE regexp_matches(link, '(?i)^https://[^/?#]') OR regexp_matches(link, '(?i)^http://(localhost|127\.0\.0\.1)([:/?#]|$)') GROUP BY 1, 2""",
    "host_page_counts": r"""
SELECT host, count(*) AS pages, count(DISTINCT canonical) AS addresses FROM (SELECT lower(regexp_extract(url, '://([^/?#]*)', 1)) AS host,
lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)) || coalesce(nullif(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), ''), '/') || '?' || array_to_string(list_sort(string_split(regexp_extract(url, '\?([^#]*)', 1), '&')), '&') AS canonical FROM pages) GROUP BY 1""",
    "application_merge": """
WITH o AS (SELECT *, o_custkey % 97 AS app, CASE o_orderstatus WHEN 'F' THEN 'approved' WHEN 'O' THEN 'pending' ELSE 'unknown' END AS status FROM orders)
SELECT app, min(o_orderkey) AS reference, count(DISTINCT o_orderkey % 50) AS documents, coalesce(min(CASE WHEN status NOT IN ('pending', 'unknown') THEN status END), max(CASE WHEN status = 'pending' THEN status END), 'unknown') AS status,
sum(floor(o_totalprice * 100 + 0.5)::BIGINT)::BIGINT AS cents FROM o GROUP BY app""",
    "round_robin_plan": """SELECT conv_id, turn AS place, round::INTEGER AS round, length(text)::BIGINT AS size FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS round FROM conversations) WHERE round <= 3""",
    "budget_prefix": """
WITH RECURSIVE d AS (SELECT source, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents),
f AS (SELECT source, 0::BIGINT AS i, 0::BIGINT AS taken, 0::BIGINT AS failed, 0::BIGINT AS used FROM d GROUP BY source
UNION ALL SELECT f.source, d.i, taken + (used + n_chars <= 60000)::BIGINT, failed + (used + n_chars > 60000)::BIGINT, used + CASE WHEN used + n_chars <= 60000 THEN n_chars ELSE 0 END
FROM f JOIN d ON d.source = f.source AND d.i = f.i + 1 WHERE taken + failed < 30 AND used < 60000)
SELECT source, max(taken) AS taken, max(failed) AS failed, max(used) AS used FROM f GROUP BY source""",
    "rejection_histogram": f"""SELECT CASE WHEN rejected THEN 'superseded' WHEN score < 35 THEN 'low-score' ELSE 'accepted' END AS reason, count(*) AS n, min(score) AS least, max(score) AS most FROM ({_CLASSIFIED}) GROUP BY 1""",
    "license_gate": f"""
WITH d AS (SELECT ['CC-BY 4.0','cc-by-4.0','https://creativecommons.org/licenses/by-sa/4.0/','https://creativecommons.org/publicdomain/zero/1.0/','CC-BY-NC-4.0','All rights reserved','OGL-3.0, Crown','','proprietary','odbl'][doc_id % 10 + 1] AS license FROM documents),
l AS (SELECT license, replace(lower(trim(license)), '_', '-') AS low FROM d),
p AS (SELECT *, regexp_replace(regexp_extract(low, 'creativecommons\\.org/(?:licenses|publicdomain/zero)/([^?#]+)', 1), '/$', '') AS part FROM l),
m AS (SELECT *, regexp_replace(regexp_replace(CASE WHEN part = '' THEN low WHEN contains(low, 'publicdomain/zero') THEN 'cc0-' || part ELSE 'cc-' || replace(part, '/', '-') END, '[?#].*$', ''), '/$', '') AS named FROM p)
SELECT license, low <> '' AND NOT ({_RULED}) AND (named IN ({_OPEN}) OR len(list_filter(regexp_split_to_array(named, '[\\s,;()]+'), lambda w: w IN ({_OPEN}))) > 0) AS open, count(*) AS n FROM m GROUP BY 1, 2""",
    "byte_sizes": """SELECT doc_id, CASE WHEN doc_id % 6 = 5 THEN -1 ELSE ceil(((doc_id % 997) / 10.0)::DECIMAL(10, 1)::VARCHAR::DOUBLE * [1.0, 1024.0, 1048576.0, 1073741824.0, 1024.0, 0.0][doc_id % 6 + 1]) END::BIGINT AS bytes FROM documents""",
    "short_hashes": """
SELECT c_custkey, list_reduce(list_prepend(2166136261::BIGINT, list_transform(string_split(c_name, ''), lambda c: unicode(c)::BIGINT)), lambda h, c: ((xor(h, c)::HUGEINT * 16777619) % 4294967296)::BIGINT) AS hash FROM customer""",
    "coverage_gate": """
SELECT *, CASE WHEN live >= 12 AND documents >= 6 THEN 'pass' ELSE 'fail' END AS status FROM (SELECT source, count(*) FILTER (doc_id % 5 <> 0) AS live, count(*) FILTER (doc_id % 5 <> 0 AND n_chars > 1000) AS documents, count(*) FILTER (doc_id % 5 = 0) AS snapshots FROM documents GROUP BY source)""",
    "prefetch_link": """
WITH e AS (SELECT url, min(page_id) AS entry FROM pages WHERE page_id % 3 = 0 GROUP BY url), p AS (SELECT * FROM pages WHERE page_id % 3 <> 0)
SELECT page_id, coalesce(min(entry), -1) AS entry, min(entry) IS NOT NULL AS available FROM p LEFT JOIN e ON e.url IN (p.url, regexp_replace(p.url, '^https:', 'http:'), regexp_replace(p.url, '[?].*$', '')) GROUP BY page_id""",
    "fingerprint": _fingerprint_sql(),
    "imagery_ranking": """SELECT event_type, event_id, gsd FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY gsd, ts DESC, event_id) AS n FROM (SELECT *, (event_id % 17) / 100.0 AS gsd FROM events)) WHERE n = 1""",
    "aerial_gate": """
SELECT lang, n, valid, floor(valid * 100000.0 / n + 0.5) / 1000 AS coverage, floor(valid * 100000.0 / n + 0.5) / 1000 >= 85.0 AS passed FROM (SELECT lang, count(*) AS n, count(*) FILTER (n_chars >= 500) AS valid FROM documents GROUP BY lang)""",
    "event_windows": """SELECT time_bucket(INTERVAL 1 hour, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2""",
}
