"""Queries that standardise planning features, read portal rows and choose documents, and the same in DuckDB SQL.

The tables stand in for the landed records: keys deal out the raw words that the classifiers read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidara.functions import rules as R
from evidara.operators.ranking import greedy_by_alias


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# -- planning features ---------------------------------------------------------------------------------------------

RAW_DATASETS = ("tree", "Listed_Building Outline", "planning application", "listed-building", "ancient  woodland", "conservation_area", "tree preservation zone", "tree-preservation-order", "scheduled monument", "flood zone", "")
GEOMETRIES = ("Polygon", "Point", "MultiPolygon", "LineString")
RAW_STATUS = ("Approved", "", "Under_Review", "withdrawn", "As Built", "granted", "pending", "existing", "refused")
RAW_DONE = ("true", "no", "Built", "", "completed ", "yes", "0")
MODES = ("current", "authoritative", "review", "off")
#: Kind and subtype of each dataset.
DATASET_KINDS = {
    "tree": ("vegetation", "protected-or-recorded-tree"), "tree-preservation-zone": ("detail", "tree-preservation-zone"), "tree-preservation-order": ("detail", "tree-preservation-order"),
    "ancient-woodland": ("vegetation", "ancient-woodland"), "listed-building": ("building", "listed-building"), "listed-building-outline": ("building", "listed-building-outline"),
    "planning-application": ("detail", "planning-application-site"), "scheduled-monument": ("structure", "scheduled-monument"), "conservation-area": ("detail", "conservation-area"),
}
#: Words that mean that something is done.
DONE = ("true", "yes", "implemented", "built", "complete", "completed", "operational")
#: Statuses that block, that say that a thing stands, and that allow it.
BLOCKED, STANDING, ALLOWED = "refused|withdrawn|invalid|expired|cancelled|canceled|superseded|draft|pending|submitted|undecided", "implemented|built|complete|completed|operational|existing|current|extant", "approved|granted|consented|permitted"


def planning_features(spark, sf):
    """Every part as a planning feature: kind, role, merge policy, confidence, status, and what the policy of its mode allows."""
    k = F.col("p_partkey")
    raw = _t(spark, sf, "part").select("p_partkey", R.dealt(k, RAW_DATASETS).alias("raw"), R.dealt(k, GEOMETRIES, 11).alias("geometry"), R.dealt(k, RAW_STATUS, 3).alias("said"), R.dealt(k, RAW_DONE, 7).alias("done"), R.dealt(k, MODES, 5).alias("mode"))
    polygon = F.col("geometry").isin("Polygon", "MultiPolygon")
    dataset = F.col("dataset")
    table = F.create_map(*[F.lit(x) for d, (kind, sub) in DATASET_KINDS.items() for x in (d, f"{kind}|{sub}")])
    found = raw.withColumn("dataset", R.slug(F.when(F.col("raw") == "", "planning-entity").otherwise(F.col("raw")))).withColumn("of", F.split(F.coalesce(table[dataset], F.concat(F.lit("detail|"), dataset)), r"\|"))
    lookup = lambda *values: F.when((dataset == "listed-building-outline") & polygon, values[0]).when((dataset == "tree") & (F.col("geometry") == "Point"), values[1]).when(dataset == "planning-application", values[2]).otherwise(values[3])
    found = found.select(
        "p_partkey", "dataset", "mode", F.when((dataset == "listed-building") & ~polygon, "detail").otherwise(F.col("of")[0]).alias("kind"), F.col("of")[1].alias("subtype"),
        lookup("authoritative-feature", "authoritative-feature", "site-boundary", "constraint-only").alias("role"), lookup("planning-authority", "planning-authority", "planning-site", "independent-detail").alias("merge_policy"),
        lookup(0.92, 0.88, 0.62, 0.68).alias("confidence"), F.when(F.col("said") != "", R.slug(F.col("said"))).when(dataset.isin("listed-building-outline", "tree"), "current").otherwise("unknown").alias("status"),
        F.lower(F.trim("done")).isin(*DONE).alias("implemented"),
    )
    blocked, standing, allowed = (F.rlike("status", F.lit(p)) for p in (BLOCKED, STANDING, ALLOWED))
    status_allowed = ~blocked & (dataset.isin("listed-building-outline", "tree") | F.col("implemented") | standing | ((F.col("mode") == "authoritative") & allowed))
    role_allows = F.col("role").isin("authoritative-feature", "as-built", "implemented-layout", "approved-layout")
    return found.withColumns({"status_allowed": status_allowed, "override_eligible": role_allows & status_allowed, "gap_fill_eligible": role_allows & status_allowed})


STATES = ("unknown", "approved", "as-built", "implemented", "superseded", "Permitted", "complete")


def vector_states(spark, sf):
    """For every pair of an order's status and its document's state in each mode: the role given, and whether a gap may be filled; approved drawings have authority unless the mode is off or review."""
    k = F.col("o_orderkey")
    o = _t(spark, sf, "orders").select(R.dealt(k, RAW_STATUS).alias("status"), R.dealt(k, STATES, 9).alias("state"), R.dealt(k, MODES, 63).alias("mode"))
    text = F.lower(F.concat_ws(" ", "status", "state"))
    standing = F.rlike(text, F.lit(STANDING + "|as[- ]?built"))
    allowed = ~standing & F.rlike(text, F.lit(ALLOWED))
    role = F.when(standing, F.when(F.rlike(text, F.lit("as[- ]?built")), "as-built").otherwise("implemented-layout")).when(allowed, "approved-layout").otherwise("none")
    return o.groupBy("status", "state", "mode", role.alias("role"), (standing | (allowed & ~F.col("mode").isin("off", "review"))).alias("gap_fill")).agg(F.count("*").alias("n"))


HIGHWAYS, ACCESS, SERVICE, FOOT, NAMES = ("footway", "service", "pedestrian", "track", "", "queue", "living_street", "residential"), ("", "private", "customers", "yes", "permit", "no"), ("", "driveway", ""), ("", "no", "yes", "private"), ("Main Street", "Ride queue", "Entrance Line 2", "")


def path_roles(spark, sf):
    """Mapped ways by kind, role of a path, and whether they anchor the network that guests walk on."""
    k = F.col("p_partkey")
    p = _t(spark, sf, "part").select(R.dealt(k, HIGHWAYS).alias("highway"), R.dealt(k, ACCESS, 8).alias("access"), R.dealt(k, SERVICE, 3).alias("service"), R.dealt(k, FOOT, 5).alias("foot"), R.dealt(k, NAMES, 7).alias("name"))
    p = p.withColumn("kind", F.when(F.col("highway").isin("footway", "pedestrian", "path", "steps", "cycleway", "queue"), "path").otherwise("road"))
    queue = (F.col("highway") == "queue") | ((F.col("access") == "customers") & F.rlike(F.lower("name"), F.lit("queue|entrance line")))
    restricted = F.col("access").isin("private", "no", "permit", "delivery", "agricultural", "forestry") | F.col("foot").isin("private", "no")
    service = F.col("highway").isin("service", "track") | (F.col("service") != "") | ((F.col("kind") == "road") & ~F.col("highway").isin("pedestrian", "living_street"))
    role = F.when(queue, "queue").when(restricted | service, "service").otherwise("guest")
    anchor = ~F.col("access").isin("private", "no", "customers") & ~((F.col("kind") == "road") & ((F.col("highway") == "service") | (F.col("service") != ""))) & (F.col("foot") != "no") & ((F.col("kind") == "path") | F.col("highway").isin("pedestrian", "living_street"))
    return p.groupBy("kind", role.alias("role"), anchor.alias("anchor")).agg(F.count("*").alias("n"))


LOCAL = ("Glasshouse", "footpath link", "Primary Road", "woodland scrub", "Pond", "rail siding", "garden wall", "plain")
WOODS = ("Lone Tree", "Group of Trees", "Small Wood", "NFI OHC", "--Hedge Row--", "")
#: What the words of a local map's record and of any other record say, in order.
LOCAL_RULES = (("footpath|path|pedestrian|cycle path", "path"), ("road|motorway|street", "road"), ("wood|forest|trees|scrub", "vegetation"), ("water|lake|pond|river|stream", "water"), ("rail", "rail"), ("barrier|fence|wall", "barrier"))
GENERIC_RULES = (("building|structure", "building"), ("tree|woodland|forest|canopy|vegetation", "vegetation"), ("footway|path|pedestrian", "path"), ("road|highway", "road"), ("water|river|lake|pond", "water"))


def inferred_kinds(spark, sf):
    """Kinds inferred from words: of a local map, of any record, and the woodland's subtype."""
    k = F.col("p_partkey")
    p = _t(spark, sf, "part").select(F.lower(F.concat_ws(" ", R.dealt(k, LOCAL), F.col("p_name"))).alias("text"), R.dealt(k, GEOMETRIES, 8).alias("geometry"), R.dealt(k, WOODS, 5).alias("wood"))
    polygon = F.col("geometry").contains("Polygon")
    rest = F.when(polygon, "surface").otherwise("detail")
    local = F.when(F.rlike("text", F.lit("building|glasshouse")) & polygon, "building").otherwise(F.coalesce(R.first_match(F.col("text"), LOCAL_RULES), rest))
    plain = F.regexp_replace(F.regexp_replace(F.lower("wood"), "[^a-z0-9]+", "-"), "^-|-$", "")
    wood = F.when(F.col("wood") == "", "tree-canopy").when(plain.contains("lone"), "lone-tree-canopy").when(plain.contains("group"), "tree-group-canopy").when(plain.contains("small") & plain.contains("wood"), "small-woodland").when(plain.contains("nfi") & plain.contains("ohc"), "nfi-overhanging-canopy").otherwise(plain)
    return p.groupBy(local.alias("local_kind"), F.coalesce(R.first_match(F.col("text"), GENERIC_RULES), rest).alias("generic_kind"), wood.alias("woodland"), (wood == "nfi-overhanging-canopy").alias("gap_fill_only")).agg(F.count("*").alias("n"))


# -- portal pages --------------------------------------------------------------------------------------------------

OUTCOMES = ("Application approved", "Refused by committee", "Under assessment", "Appeal dismissed", "Returned invalid", "Permission granted", "No status")
WORKS = ("New ride: roller coaster", "Path &amp; queue line works", "Car parking, drainage", "Hotel and lodge", "Signage")
#: Outcomes in order, and what the words of a row add to its priority.
STATUS_RULES = (("withdrawn|invalid|returned", "withdrawn"), ("refused|dismissed", "refused"), ("approved|permission granted|consent granted", "approved"), ("under assessment|consultation|pending|awaiting", "pending"))
PRIORITY_RULES = ((r"roller\s*coaster|ride layout|track layout|new ride", 100), ("path|access|circulation|queue line", 80), ("landscap|ground ?work|drainage|level|parking", 45), ("indoor attraction|building|hotel|lodge|accommodation", 25))


def _rows_html():
    k = F.col("c_custkey")
    year = F.lpad(F.pmod(k, F.lit(25)).cast("string"), 2, "0")
    row = F.concat(F.lit("<TR class='r'><td><a href='/app/"), k.cast("string"), F.lit("'>SMD/20"), year, F.lit("/"), F.lpad(F.pmod(k * 7, F.lit(10000)).cast("string"), 4, "0"), F.lit("</a></td><td>"), R.dealt(k, WORKS), F.lit("</td>\n<td>"), R.dealt(k, OUTCOMES, 5), F.lit("</td></TR>"))
    return F.concat(F.lit("<table><tr><th>Reference</th></tr>"), row, F.lit("<tr><td><a href='/help'>help</a></td></tr></table>"))


def portal_rows(spark, sf):
    """Applications in the rows of a portal's result pages: reference, link, status, priority and the row's text."""
    pages = _t(spark, sf, "customer").select("c_custkey", _rows_html().alias("html"))
    rows = pages.select("c_custkey", F.explode(F.regexp_extract_all("html", F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))).alias("row"))
    text = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace("row", "<[^>]+>", " "), "&amp;", "&"), r"\s+", " "))
    link = F.regexp_extract("row", r"(?i)href\s*=\s*['\"](/app/[^'\"]*)['\"]", 1)
    rows = rows.select("c_custkey", text.alias("text"), link.alias("link")).where("link <> ''").withColumn("reference", F.regexp_extract("text", r"\b[A-Z]{3}/20\d{2}/\d{4}\b", 0))
    low = F.lower("text")
    status = R.first_match(low, STATUS_RULES, "unknown")
    year = F.regexp_extract(low, r"\b(?:smd/)?(20\d{2})/", 1).try_cast("int")
    score = F.when(status == "approved", 40).otherwise(0) + R.matched_sum(low, PRIORITY_RULES) + F.coalesce(F.greatest(F.lit(0), year - 2000), F.lit(0)) / 10
    return rows.select("c_custkey", "reference", "link", "text", status.alias("status"), score.alias("priority"))


DOCUMENT_ROLES = ("site-plan", "ride-layout", "elevation", "decision-notice", "document", "officer-report", "masterplan", "letter", "Roof-Plan ", "lighting-plan", "access-plan", "committee-report", "photo")
DOCUMENT_TITLES = ("Proposed layout drawing", "Covering letter", "Section A-A", "Tree survey report", "General arrangement plan", "Fee receipt")
DOCUMENT_STATES = ("approved", "proposed", "as-built", "superseded")
#: Roles of drawings, roles that aren't, roles that have a geometry, and roles whose geometry is trusted more.
DRAWINGS = ("site-plan", "location-plan", "block-plan", "masterplan", "general-arrangement", "landscape-plan", "access-plan", "ride-layout", "track-layout", "terrain-or-drainage", "floor-plan", "roof-plan", "elevation", "section", "lighting-plan")
NOT_DRAWINGS = ("document", "decision-notice", "officer-report", "committee-report")
WITH_GEOMETRY = ("site-plan", "block-plan", "landscape-plan", "ride-layout", "floor-plan", "elevation", "section", "terrain-or-drainage", "access-plan", "lighting-plan")
TRUSTED = ("site-plan", "block-plan", "ride-layout", "landscape-plan", "access-plan")


def _documents(spark, sf):
    k = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    d = _t(spark, sf, "lineitem").select(F.pmod("l_orderkey", F.lit(97)).alias("application"), "l_orderkey", "l_linenumber", R.dealt(k, DOCUMENT_ROLES).alias("role"), R.dealt(k, DOCUMENT_TITLES, 13).alias("title"), R.dealt(k, DOCUMENT_STATES, 5).alias("state"), (F.pmod(k, F.lit(10)) == 3).alias("rejected"), (F.pmod(k, F.lit(8)) != 5).alias("downloaded"))
    return d.withColumn("application_status", R.dealt(F.col("application"), ("approved", "refused", "granted", "unknown", "withdrawn", "implemented")))


def drawing_documents(spark, sf):
    """Per application: documents, those downloaded, drawings among them, those with a geometry and the sum of their confidence hints."""
    role = F.lower(F.trim("role"))
    text = F.lower("title")
    drawing = ~F.col("rejected") & F.when(role.isin(*DRAWINGS), True).when(role.isin(*NOT_DRAWINGS), False).otherwise(F.rlike(text, F.lit("drawing|plan|section|elevation|layout")) & ~F.rlike(text, F.lit("letter|report|receipt|notice")))
    candidate = F.col("downloaded") & ~F.col("rejected") & ~F.col("application_status").isin("refused", "withdrawn", "invalid") & F.col("role").isin(*WITH_GEOMETRY)
    # in hundredths
    hint = F.least(F.lit(93), F.lit(62) + F.when(F.col("state").isin("approved", "as-built"), 12).otherwise(0) + F.when(F.col("application_status").isin("approved", "implemented", "granted"), 8).otherwise(0) + F.when(F.col("role").isin(*TRUSTED), 8).otherwise(0) + F.when(F.pmod("l_orderkey", F.lit(3)) == 0, 3).otherwise(0))
    g = _documents(spark, sf).groupBy("application", "application_status")
    return g.agg(F.count("*").alias("documents"), F.count_if("downloaded").alias("downloaded"), F.count_if(F.col("downloaded") & drawing).alias("drawings"), F.count_if(candidate).alias("candidates"), F.coalesce(F.sum(F.when(candidate, hint)), F.lit(0)).cast("bigint").alias("hint_hundredths"))


def retained_manifest(spark, sf):
    """Entries that stay with the applications that have drawings: by reference, else by address, and those that have neither and are no page or document; totals by kind."""
    kept = drawing_documents(spark, sf).where("drawings > 100 * documents / 250").select(F.col("application").alias("__a"))
    kept = kept.select("__a", F.concat(F.lit("https://x/"), F.col("__a").cast("string")).alias("__u"))
    e = _t(spark, sf, "orders").select("o_orderkey", F.when(F.pmod("o_orderkey", F.lit(3)) != 0, F.pmod("o_custkey", F.lit(120))).alias("reference"), F.when(F.pmod("o_orderkey", F.lit(5)) < 3, F.concat(F.lit("https://x/"), F.pmod("o_custkey", F.lit(110)).cast("string"))).alias("url"), R.dealt(F.col("o_orderkey"), ("document", "application-page", "search-page", "image"), 2).alias("kind"))
    by_reference = e.where("reference IS NOT NULL").join(kept, F.col("reference") == F.col("__a"), "left_semi")
    paged = F.col("kind").isin("document", "application-page")
    by_url = e.where(F.col("reference").isNull() & paged).join(kept, F.col("url") == F.col("__u"), "left_semi")
    free = e.where(F.col("reference").isNull() & ~paged)
    return by_reference.unionByName(by_url).unionByName(free).groupBy("kind").agg(F.count("*").alias("entries"), F.sum("o_orderkey").alias("checksum"), F.count("reference").alias("with_reference"))


def control_matches(spark, sf):
    """The control manifest's first entry for each drawing by any of four keys, tried one after the other instead of by one OR."""
    d = _t(spark, sf, "orders").select("o_orderkey", F.pmod("o_orderkey", F.lit(1009)).alias("k1"), F.pmod("o_orderkey", F.lit(2003)).alias("k2"), F.pmod("o_custkey", F.lit(701)).alias("k3"), F.pmod(F.col("o_orderkey") + F.col("o_custkey"), F.lit(3001)).alias("k4"))
    c = _t(spark, sf, "supplier").select("s_suppkey", F.pmod(F.col("s_suppkey") * 17, F.lit(1009)).alias("k1"), F.pmod(F.col("s_suppkey") * 31, F.lit(2003)).alias("k2"), F.pmod(F.col("s_suppkey") * 13, F.lit(701)).alias("k3"), F.pmod(F.col("s_suppkey") * 7, F.lit(3001)).alias("k4"))
    for k in range(1, 5):
        d = d.join(c.groupBy(f"k{k}").agg(F.min("s_suppkey").alias(f"m{k}")), f"k{k}", "left")
    return d.select("o_orderkey", F.least("m1", "m2", "m3", "m4").alias("control")).where("control IS NOT NULL")


def cached_files(spark, sf):
    """The largest cached file whose name begins with a document's key; documents of one key share it."""
    names = _t(spark, sf, "part").select(F.concat(F.lpad(F.pmod("p_partkey", F.lit(500)).cast("string"), 6, "0"), F.lit("-"), F.regexp_replace("p_name", "[^a-z]+", "_"), F.lit(".pdf")).alias("file"), (F.pmod(F.col("p_partkey") * 37, F.lit(9973))).alias("bytes"))
    keys = _t(spark, sf, "supplier").select("s_suppkey", F.lpad(F.pmod("s_suppkey", F.lit(700)).cast("string"), 6, "0").alias("key")).distinct()
    # keys have one length, so the prefix is a key to join on
    best = names.groupBy(F.substring("file", 1, 6).alias("key")).agg(F.max_by("file", F.struct("bytes", "file")).alias("file"), F.max("bytes").alias("bytes"))
    return keys.join(best, "key").select("s_suppkey", "file", "bytes")


def new_assets(spark, sf):
    """Assets of pages whose address isn't stored yet and whose content isn't either."""
    p = _t(spark, sf, "pages").select("page_id", "url", F.sha2(F.coalesce("html", F.lit("")), 256).alias("sha"))
    stored = p.where("page_id % 4 = 0")
    fresh = p.where("page_id % 4 <> 0").join(stored.select("url"), "url", "left_anti").join(stored.select("sha"), "sha", "left_anti")
    return fresh.select("page_id", "sha")


def alias_deduplication(spark, sf):
    """Pages taken by falling score unless one of their addresses was taken before."""
    p = _t(spark, sf, "pages")
    plain = F.regexp_replace(F.regexp_replace(F.lower("url"), "[?#].*$", ""), "^https?://(?:www\\.|m\\.|blog\\.)?", "")
    entries = p.select("page_id", F.array_distinct(F.array(plain, F.regexp_replace(plain, "/[0-9]+[^/]*/?$", "/"), F.concat(F.lit("id:"), F.pmod("page_id", F.lit(150)).cast("string")))).alias("aliases"), (F.pmod(F.col("page_id") * 7919, F.lit(1000))).alias("score"))
    return greedy_by_alias(entries, "page_id", "aliases", [-F.col("score"), F.col("page_id")])


TEXTS = ("Scale 1:500 @A1", "1/1250 at A3 and 1:200", "scale 1 : 20", "1:2500", "Scale(s): see 1:500@A1, 1:100@A3", "no scale", "1:99999")
PLACES = ("lat=52.98712,lon=-1.88123", "Point(-1.5 53.25)", "POINT (-0.125 51.5)", "at 52.5, -1.9", "nowhere")
LABELS = ("403,125", "352 118.5", "12", "0403125", "9999999", "10000", "abc")


def label_numbers(spark, sf):
    """Numbers that drawings' labels hold: scale denominators with their paper, grid coordinates, points and lists of addresses."""
    k = F.col("p_partkey")
    p = _t(spark, sf, "part").select("p_partkey", R.dealt(k, TEXTS).alias("text"), R.dealt(k, PLACES, 7).alias("place"), R.dealt(k, LABELS, 3).alias("label"), (F.pmod(k, F.lit(3)) == 0).alias("a1"))
    valid = lambda a: F.filter(F.transform(a, lambda x: x.cast("int")), lambda x: x.between(25, 25000))
    on = lambda paper: valid(F.regexp_extract_all("text", F.lit(r"(?i)\b1\s*[:/]\s*(\d{2,5})\s*(?:@|at)?\s*A" + paper + r"\b"), F.lit(1)))
    fit, any_paper, free = on("1"), on("[0-4]"), valid(F.regexp_extract_all("text", F.lit(r"(?i)\b1\s*[:/]\s*(\d{2,5})\b"), F.lit(1)))
    scales = F.when(F.col("a1") & (F.size(fit) > 0), F.array_distinct(fit)).otherwise(F.array_distinct(F.concat(any_paper, free)))
    compact = F.regexp_replace("label", r"[,\s]", "")
    number = F.when(F.rlike(compact, F.lit(r"^\d{5,7}(?:\.\d+)?$")), compact.try_cast("double"))
    number = F.when(number.between(10_000, 1_300_000), number)
    wkt = lambda i: F.regexp_extract("place", r"(?i)point\s*\(\s*(-?\d+(?:\.\d+)?)\s+(-?\d+(?:\.\d+)?)\s*\)", i).try_cast("double")
    lat = F.regexp_extract("place", r"(?i)lat\w*\s*[=:]\s*(-?\d+(?:\.\d+)?)", 1).try_cast("double")
    lon = F.regexp_extract("place", r"(?i)lon\w*\s*[=:]\s*(-?\d+(?:\.\d+)?)", 1).try_cast("double")
    return p.select("p_partkey", F.array_join(scales.cast("array<string>"), ",").alias("scales"), F.coalesce(number, F.lit(-1.0)).alias("number"), F.coalesce(number <= 700_000, F.lit(False)).alias("easting"), F.coalesce(wkt(1), lon, F.lit(999.0)).alias("lon"), F.coalesce(wkt(2), lat, F.lit(999.0)).alias("lat"))


QUERIES = {f.__name__: f for f in (planning_features, vector_states, path_roles, inferred_kinds, portal_rows, drawing_documents, retained_manifest, control_matches, cached_files, new_assets, alias_deduplication, label_numbers)}

_D = R.sql_dealt
_IN = lambda values: "(" + ", ".join(map(R.quoted, values)) + ")"
_DOCS = f"""SELECT l_orderkey % 97 AS application, l_orderkey, l_linenumber, {_D('l_orderkey * 7 + l_linenumber', DOCUMENT_ROLES)} AS role, {_D('l_orderkey * 7 + l_linenumber', DOCUMENT_TITLES, 13)} AS title, {_D('l_orderkey * 7 + l_linenumber', DOCUMENT_STATES, 5)} AS state,
(l_orderkey * 7 + l_linenumber) % 10 = 3 AS rejected, (l_orderkey * 7 + l_linenumber) % 8 <> 5 AS downloaded, {_D('l_orderkey % 97', ("approved", "refused", "granted", "unknown", "withdrawn", "implemented"))} AS application_status FROM lineitem"""
_PER_APPLICATION = f"""SELECT application, application_status, count(*) AS documents, count(*) FILTER (downloaded) AS downloaded, count(*) FILTER (downloaded AND drawing) AS drawings, count(*) FILTER (candidate) AS candidates,
coalesce(sum(least(93, 62 + CASE WHEN state IN ('approved', 'as-built') THEN 12 ELSE 0 END + CASE WHEN application_status IN ('approved', 'implemented', 'granted') THEN 8 ELSE 0 END + CASE WHEN role IN {_IN(TRUSTED)} THEN 8 ELSE 0 END + CASE WHEN l_orderkey % 3 = 0 THEN 3 ELSE 0 END)) FILTER (candidate), 0)::BIGINT AS hint_hundredths
FROM (SELECT *, NOT rejected AND CASE WHEN lower(trim(role)) IN {_IN(DRAWINGS)} THEN true WHEN lower(trim(role)) IN {_IN(NOT_DRAWINGS)} THEN false ELSE regexp_matches(lower(title), 'drawing|plan|section|elevation|layout') AND NOT regexp_matches(lower(title), 'letter|report|receipt|notice') END AS drawing,
downloaded AND NOT rejected AND application_status NOT IN ('refused', 'withdrawn', 'invalid') AND role IN {_IN(WITH_GEOMETRY)} AS candidate FROM ({_DOCS})) GROUP BY 1, 2"""
_PLAIN = "regexp_replace(regexp_replace(lower(url), '[?#].*$', ''), '^https?://(?:www\\.|m\\.|blog\\.)?', '')"
_LOOK = lambda *v: f"CASE WHEN dataset = 'listed-building-outline' AND polygon THEN {R.quoted(v[0])} WHEN dataset = 'tree' AND geometry = 'Point' THEN {R.quoted(v[1])} WHEN dataset = 'planning-application' THEN {R.quoted(v[2])} ELSE {R.quoted(v[3])} END"
_CASE = lambda at: "CASE dataset " + " ".join(f"WHEN '{d}' THEN '{v[at]}'" for d, v in DATASET_KINDS.items()) + f" ELSE {'dataset' if at else R.quoted('detail')} END"
_VALID = lambda a: f"list_filter(list_transform({a}, lambda x: x::INTEGER), lambda x: x BETWEEN 25 AND 25000)"
_ON = lambda paper: _VALID(rf"regexp_extract_all(text, '(?i)\b1\s*[:/]\s*(\d{{2,5}})\s*(?:@|at)?\s*A{paper}\b', 1)")

ORACLE_SQL = {
    "planning_features": f"""
WITH r AS (SELECT p_partkey, {_D('p_partkey', RAW_DATASETS)} AS raw, {_D('p_partkey', GEOMETRIES, 11)} AS geometry, {_D('p_partkey', RAW_STATUS, 3)} AS said, {_D('p_partkey', RAW_DONE, 7)} AS done, {_D('p_partkey', MODES, 5)} AS mode FROM part),
d AS (SELECT *, {R.sql_slug("CASE WHEN raw = '' THEN 'planning-entity' ELSE raw END")} AS dataset, geometry IN ('Polygon', 'MultiPolygon') AS polygon FROM r),
f AS (SELECT p_partkey, dataset, mode, CASE WHEN dataset = 'listed-building' AND NOT polygon THEN 'detail' ELSE {_CASE(0)} END AS kind, {_CASE(1)} AS subtype, {_LOOK('authoritative-feature', 'authoritative-feature', 'site-boundary', 'constraint-only')} AS role,
{_LOOK('planning-authority', 'planning-authority', 'planning-site', 'independent-detail')} AS merge_policy, ({_LOOK(0.92, 0.88, 0.62, 0.68)})::DOUBLE AS confidence, CASE WHEN said <> '' THEN {R.sql_slug('said')} WHEN dataset IN ('listed-building-outline', 'tree') THEN 'current' ELSE 'unknown' END AS status,
lower(trim(done)) IN {_IN(DONE)} AS implemented FROM d),
s AS (SELECT *, NOT regexp_matches(status, '{BLOCKED}') AND (dataset IN ('listed-building-outline', 'tree') OR implemented OR regexp_matches(status, '{STANDING}') OR (mode = 'authoritative' AND regexp_matches(status, '{ALLOWED}'))) AS status_allowed FROM f)
SELECT *, role = 'authoritative-feature' AND status_allowed AS override_eligible, role = 'authoritative-feature' AND status_allowed AS gap_fill_eligible FROM s""",
    "vector_states": f"""
WITH o AS (SELECT {_D('o_orderkey', RAW_STATUS)} AS status, {_D('o_orderkey', STATES, 9)} AS state, {_D('o_orderkey', MODES, 63)} AS mode FROM orders),
t AS (SELECT *, regexp_matches(lower(status || ' ' || state), '{STANDING}|as[- ]?built') AS standing, regexp_matches(lower(status || ' ' || state), '{ALLOWED}') AS allowed, regexp_matches(lower(status || ' ' || state), 'as[- ]?built') AS made FROM o)
SELECT status, state, mode, CASE WHEN made THEN 'as-built' WHEN standing THEN 'implemented-layout' WHEN allowed THEN 'approved-layout' ELSE 'none' END AS role, standing OR (allowed AND mode NOT IN ('off', 'review')) AS gap_fill, count(*) AS n FROM t GROUP BY ALL""",
    "path_roles": f"""
WITH p AS (SELECT {_D('p_partkey', HIGHWAYS)} AS highway, {_D('p_partkey', ACCESS, 8)} AS access, {_D('p_partkey', SERVICE, 3)} AS service, {_D('p_partkey', FOOT, 5)} AS foot, {_D('p_partkey', NAMES, 7)} AS name FROM part),
k AS (SELECT *, CASE WHEN highway IN ('footway', 'pedestrian', 'path', 'steps', 'cycleway', 'queue') THEN 'path' ELSE 'road' END AS kind FROM p)
SELECT kind, CASE WHEN highway = 'queue' OR (access = 'customers' AND regexp_matches(lower(name), 'queue|entrance line')) THEN 'queue' WHEN access IN ('private', 'no', 'permit', 'delivery', 'agricultural', 'forestry') OR foot IN ('private', 'no') THEN 'service'
WHEN highway IN ('service', 'track') OR service <> '' THEN 'service' WHEN kind = 'road' AND highway NOT IN ('pedestrian', 'living_street') THEN 'service' ELSE 'guest' END AS role,
access NOT IN ('private', 'no', 'customers') AND NOT (kind = 'road' AND (highway = 'service' OR service <> '')) AND foot <> 'no' AND (kind = 'path' OR highway IN ('pedestrian', 'living_street')) AS anchor, count(*) AS n FROM k GROUP BY ALL""",
    "inferred_kinds": f"""
WITH p AS (SELECT lower({_D('p_partkey', LOCAL)} || ' ' || p_name) AS text, {_D('p_partkey', GEOMETRIES, 8)} AS geometry, {_D('p_partkey', WOODS, 5)} AS wood FROM part),
q AS (SELECT *, contains(geometry, 'Polygon') AS polygon, CASE WHEN contains(geometry, 'Polygon') THEN 'surface' ELSE 'detail' END AS rest, regexp_replace(regexp_replace(lower(wood), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS plain FROM p),
w AS (SELECT *, CASE WHEN wood = '' THEN 'tree-canopy' WHEN contains(plain, 'lone') THEN 'lone-tree-canopy' WHEN contains(plain, 'group') THEN 'tree-group-canopy' WHEN contains(plain, 'small') AND contains(plain, 'wood') THEN 'small-woodland' WHEN contains(plain, 'nfi') AND contains(plain, 'ohc') THEN 'nfi-overhanging-canopy' ELSE plain END AS woodland FROM q)
SELECT CASE WHEN regexp_matches(text, 'building|glasshouse') AND polygon THEN 'building' ELSE coalesce({R.sql_first_match('text', LOCAL_RULES)}, rest) END AS local_kind, coalesce({R.sql_first_match('text', GENERIC_RULES)}, rest) AS generic_kind, woodland, woodland = 'nfi-overhanging-canopy' AS gap_fill_only, count(*) AS n FROM w GROUP BY ALL""",
    "portal_rows": rf"""
WITH p AS (SELECT c_custkey, '<table><tr><th>Reference</th></tr><TR class=''r''><td><a href=''/app/' || c_custkey || '''>SMD/20' || lpad((c_custkey % 25)::VARCHAR, 2, '0') || '/' || lpad((c_custkey * 7 % 10000)::VARCHAR, 4, '0') || '</a></td><td>' || {_D('c_custkey', WORKS)} || '</td>' || chr(10) || '<td>' || {_D('c_custkey', OUTCOMES, 5)} || '</td></TR><tr><td><a href=''/help''>help</a></td></tr></table>' AS html FROM customer),
r AS (SELECT c_custkey, unnest(regexp_extract_all(html, '(?is)<tr\b[^>]*>(.*?)</tr>', 1)) AS row FROM p),
t AS (SELECT c_custkey, trim(regexp_replace(replace(regexp_replace(row, '<[^>]+>', ' ', 'g'), '&amp;', '&'), '\s+', ' ', 'g')) AS text, regexp_extract(row, '(?i)href\s*=\s*[''"](/app/[^''"]*)[''"]', 1) AS link FROM r),
s AS (SELECT *, regexp_extract(text, '\b[A-Z]{{3}}/20\d{{2}}/\d{{4}}\b') AS reference, {R.sql_first_match('lower(text)', STATUS_RULES, 'unknown')} AS status FROM t WHERE link <> '')
SELECT c_custkey, reference, link, text, status, CASE WHEN status = 'approved' THEN 40 ELSE 0 END + {R.sql_matched_sum('lower(text)', PRIORITY_RULES)} + coalesce(greatest(0, try_cast(regexp_extract(lower(text), '\b(?:smd/)?(20\d{{2}})/', 1) AS INTEGER) - 2000), 0) / 10 AS priority FROM s""",
    "drawing_documents": _PER_APPLICATION,
    "retained_manifest": f"""
WITH k AS (SELECT application, 'https://x/' || application AS u FROM ({_PER_APPLICATION}) WHERE drawings > 100 * documents / 250),
e AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey % 120 END AS reference, CASE WHEN o_orderkey % 5 < 3 THEN 'https://x/' || (o_custkey % 110) END AS url, {_D('o_orderkey', ("document", "application-page", "search-page", "image"), 2)} AS kind FROM orders)
SELECT kind, count(*) AS entries, sum(o_orderkey)::BIGINT AS checksum, count(reference) AS with_reference FROM e WHERE CASE WHEN reference IS NOT NULL THEN reference IN (SELECT application FROM k) WHEN kind IN ('document', 'application-page') THEN coalesce(url IN (SELECT u FROM k), false) ELSE true END GROUP BY kind""",
    "control_matches": """
WITH d AS (SELECT o_orderkey, o_orderkey % 1009 AS k1, o_orderkey % 2003 AS k2, o_custkey % 701 AS k3, (o_orderkey + o_custkey) % 3001 AS k4 FROM orders), c AS (SELECT s_suppkey, s_suppkey * 17 % 1009 AS k1, s_suppkey * 31 % 2003 AS k2, s_suppkey * 13 % 701 AS k3, s_suppkey * 7 % 3001 AS k4 FROM supplier)
SELECT o_orderkey, min(s_suppkey) AS control FROM d JOIN c ON d.k1 = c.k1 OR d.k2 = c.k2 OR d.k3 = c.k3 OR d.k4 = c.k4 GROUP BY 1""",
    "cached_files": """
WITH f AS (SELECT lpad((p_partkey % 500)::VARCHAR, 6, '0') || '-' || regexp_replace(p_name, '[^a-z]+', '_', 'g') || '.pdf' AS file, p_partkey * 37 % 9973 AS bytes FROM part)
SELECT s_suppkey, max_by(file, (bytes, file)) AS file, max(bytes) AS bytes FROM supplier JOIN f ON starts_with(file, lpad((s_suppkey % 700)::VARCHAR, 6, '0')) GROUP BY 1""",
    "new_assets": """
WITH p AS (SELECT page_id, url, sha256(coalesce(html, '')) AS sha FROM pages), s AS (SELECT * FROM p WHERE page_id % 4 = 0)
SELECT page_id, sha FROM p WHERE page_id % 4 <> 0 AND NOT EXISTS (SELECT 1 FROM s WHERE s.url = p.url) AND NOT EXISTS (SELECT 1 FROM s WHERE s.sha = p.sha)""",
    "alias_deduplication": f"""
WITH RECURSIVE e AS (SELECT page_id, [{_PLAIN}, regexp_replace({_PLAIN}, '/[0-9]+[^/]*/?$', '/'), 'id:' || (page_id % 150)] AS aliases, row_number() OVER (ORDER BY page_id * 7919 % 1000 DESC, page_id) AS i FROM pages),
g AS (SELECT 0::BIGINT AS i, NULL::BIGINT AS page_id, []::VARCHAR[] AS used, false AS taken
UNION ALL SELECT e.i, e.page_id, CASE WHEN list_has_any(used, aliases) THEN used ELSE list_concat(used, aliases) END, NOT list_has_any(used, aliases) FROM g JOIN e ON e.i = g.i + 1)
SELECT page_id FROM g WHERE taken""",
    "label_numbers": rf"""
WITH p AS (SELECT p_partkey, {_D('p_partkey', TEXTS)} AS text, {_D('p_partkey', PLACES, 7)} AS place, {_D('p_partkey', LABELS, 3)} AS label, p_partkey % 3 = 0 AS a1 FROM part),
q AS (SELECT *, {_ON('1')} AS fit, {_ON('[0-4]')} AS papers, {_VALID(chr(114) + "egexp_extract_all(text, '(?i)" + chr(92) + "b1" + chr(92) + "s*[:/]" + chr(92) + "s*(" + chr(92) + "d{2,5})" + chr(92) + "b', 1)")} AS free, regexp_replace(label, '[,\s]', '', 'g') AS compact FROM p),
n AS (SELECT *, CASE WHEN a1 AND len(fit) > 0 THEN fit ELSE list_concat(papers, free) END AS l, CASE WHEN regexp_matches(compact, '^\d{{5,7}}(?:\.\d+)?$') AND compact::DOUBLE BETWEEN 10000 AND 1300000 THEN compact::DOUBLE END AS number FROM q)
SELECT p_partkey, array_to_string(list_transform(list_filter(l, lambda x, i: list_position(l, x) = i), lambda x: x::VARCHAR), ',') AS scales, coalesce(number, -1.0)::DOUBLE AS number, coalesce(number <= 700000, false) AS easting,
coalesce(try_cast(regexp_extract(place, '(?i)point\s*\(\s*(-?\d+(?:\.\d+)?)\s+(-?\d+(?:\.\d+)?)\s*\)', 1) AS DOUBLE), try_cast(regexp_extract(place, '(?i)lon\w*\s*[=:]\s*(-?\d+(?:\.\d+)?)', 1) AS DOUBLE), 999.0)::DOUBLE AS lon,
coalesce(try_cast(regexp_extract(place, '(?i)point\s*\(\s*(-?\d+(?:\.\d+)?)\s+(-?\d+(?:\.\d+)?)\s*\)', 2) AS DOUBLE), try_cast(regexp_extract(place, '(?i)lat\w*\s*[=:]\s*(-?\d+(?:\.\d+)?)', 1) AS DOUBLE), 999.0)::DOUBLE AS lat FROM n""",
}
