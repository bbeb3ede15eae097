"""Scalar expressions that several operators share; all are native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0088
MAX_LATITUDE = 85.05112878


def half_up(x: Column, digits: int = 0) -> Column:
    """Rounds halves towards plus infinity, at `digits` places."""
    scale = float(10**digits)
    return F.floor(x * scale + 0.5) / scale


def clamp(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def smooth_step(x: Column) -> Column:
    t = clamp(x, 0.0, 1.0)
    return t * t * (3.0 - 2.0 * t)


def snap(x: Column, step: float) -> Column:
    """The nearest multiple of `step`, halves upwards."""
    return F.floor(x / step + 0.5) * step


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2000.0 * EARTH_KM * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def tile_of(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    """Web tile column and row of a point, clamped to the grid."""
    n = float(1 << zoom)
    phi = F.radians(clamp(lat, -MAX_LATITUDE, MAX_LATITUDE))
    inside = lambda v: F.least(F.greatest(F.floor(v), F.lit(0)), F.lit((1 << zoom) - 1)).cast("int")
    return inside((lon + 180.0) / 360.0 * n), inside((1.0 - F.log(F.tan(phi) + 1.0 / F.cos(phi)) / F.lit(3.141592653589793)) / 2.0 * n)


def quadkey(x: Column, y: Column, zoom: int) -> Column:
    """The tile's base-4 name, highest zoom bit first."""
    digit = lambda k: (F.shiftright(x, k).bitwiseAND(F.lit(1)) + 2 * F.shiftright(y, k).bitwiseAND(F.lit(1))).cast("string")
    return F.concat(*(digit(k) for k in range(zoom - 1, -1, -1)))


def box_quadkeys(west: Column, south: Column, east: Column, north: Column, zoom: int) -> Column:
    """The names of all tiles that a box touches, row by row from the north-west."""
    (x0, y0), (x1, y1) = tile_of(west, north, zoom), tile_of(east, south, zoom)
    return F.flatten(F.transform(F.sequence(F.least(y0, y1), F.greatest(y0, y1)), lambda y: F.transform(F.sequence(F.least(x0, x1), F.greatest(x0, x1)), lambda x: quadkey(x, y, zoom))))


def fnv1a(text: Column) -> Column:
    """The 32-bit FNV-1a hash of the text's characters as an unsigned number."""
    codes = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c).cast("bigint"))
    return F.aggregate(codes, F.lit(2166136261).cast("bigint"), lambda h, c: (h.bitwiseXOR(c) * 16777619).bitwiseAND(F.lit(4294967295)))


def byte_size(text: Column) -> Column:
    """Bytes of a text such as 23.1MB or 74.7 KiB: units of 1024, rounded up; null if it isn't one."""
    number = F.regexp_extract(text, r"(?i)^\s*([0-9]+(?:\.[0-9]+)?)\s*(?:[KMG]?I?B)?\s*$", 1)
    unit = F.upper(F.regexp_extract(text, r"(?i)([KMG])I?B\s*$", 1))
    factor = F.when(unit == "K", 1024.0).when(unit == "M", 1024.0**2).when(unit == "G", 1024.0**3).otherwise(1.0)
    return F.when(number != "", F.ceil(number.try_cast("double") * factor))


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host, no fragment, query parameters in order."""
    head = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    ordered = F.array_join(F.array_sort(F.split(query, "&")), "&")
    return F.concat(head, F.when(path == "", "/").otherwise(path), F.when(query == "", "").otherwise(F.concat(F.lit("?"), ordered)))


def without_dots(path: Column) -> Column:
    """A path with its . and .. segments worked out; .. at the root stays at the root."""
    none = F.array().cast("array<string>")

    def step(out: Column, s: Column) -> Column:
        up = F.when(F.size(out) > 1, F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(1)))).otherwise(out)
        return F.when(s == "..", up).when(s == ".", out).otherwise(F.concat(out, F.array(s)))

    made = F.aggregate(F.split(path, "/", -1), none, step)
    # a path that ends in dots names a folder
    return F.concat(F.array_join(made, "/"), F.when(F.rlike(path, F.lit(r"/\.\.?$")), "/").otherwise(""))


def resolved_url(base: Column, href: Column) -> Column:
    """An address as its page's address makes it: absolute, without a scheme, from the root, a query or fragment alone, or beside the page; null if it can't be."""
    root = F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)", 1)
    path = F.coalesce(F.nullif(F.regexp_extract(base, "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+([^?#]*)", 1), F.lit("")), F.lit("/"))
    query = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1)
    own, rest = F.regexp_extract(href, "^([^?#]*)", 1), F.regexp_extract(href, "^[^?#]*([?#].*)?$", 1)
    beside = F.concat(F.regexp_extract(path, "^(.*/)", 1), own)
    full = F.when(F.rlike(href, F.lit("^[a-zA-Z][a-zA-Z0-9+.-]*:")), href).when(F.startswith(href, F.lit("//")), F.concat(F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1), href)).when(root == "", F.lit(None))
    full = full.when(F.startswith(href, F.lit("#")), F.concat(root, path, query, href)).when(F.startswith(href, F.lit("?")), F.concat(root, path, href)).when(F.startswith(href, F.lit("/")), F.concat(root, without_dots(own), rest))
    return full.otherwise(F.concat(root, without_dots(beside), rest))


def is_fetchable(url: Column) -> Column:
    """Whether an address is https, or http on this machine itself."""
    return F.rlike(url, F.lit(r"(?i)^https://[^/?#]")) | F.rlike(url, F.lit(r"(?i)^http://(localhost|127\.0\.0\.1|\[::1\])([:/?#]|$)"))


#: Licences that count as open, and markers that rule one out.
OPEN_LICENSES = (
    "cc0", "cc0-1.0", "cc-by", "cc-by-3.0", "cc-by-4.0", "cc-by-sa", "cc-by-sa-3.0", "cc-by-sa-4.0", "odbl", "odbl-1.0",
    "ogl", "ogl-2.0", "ogl-3.0", "open-government-licence", "open-government-license",
)
RESTRICTED_MARKERS = ("noncommercial", "non-commercial", "-nc", "no derivatives", "no-derivatives", "-nd", "all rights reserved", "proprietary", "personal use", "research only")


def licence_token(word: Column) -> Column:
    """A word of a licence text as its plain name: addresses of Creative Commons become cc-<terms>-<version> or cc0-<version>."""
    bare = F.regexp_replace(F.regexp_replace(word, "[?#].*$", ""), "/+$", "")
    pieces = F.split(F.regexp_extract(bare, r"creativecommons\.org/(.*)$", 1), "/")
    terms = F.slice(pieces, F.lit(2), F.size(pieces))
    return F.when(pieces[0] == "licenses", F.concat(F.lit("cc-"), F.array_join(terms, "-"))).when((pieces[0] == "publicdomain") & (F.get(pieces, F.lit(1)) == "zero"), F.concat(F.lit("cc0-"), F.array_join(F.slice(pieces, F.lit(3), F.size(pieces)), "-"))).otherwise(bare)


def is_open_license(text: Column) -> Column:
    """Whether any word of a licence text names an open licence, and nothing in it restricts use."""
    plain = F.translate(F.lower(F.coalesce(text, F.lit(""))), "_", "-")
    denied = F.exists(F.array(*map(F.lit, RESTRICTED_MARKERS)), lambda marker: F.contains(plain, marker))
    return ~denied & F.exists(F.split(plain, r"[\s,;()]+"), lambda word: licence_token(word).isin(*OPEN_LICENSES))


#: Patterns of a planning document's role in the order in which they apply, and each role's score.
DOCUMENT_ROLES = (
    (r"\b(site plan|proposed site|approved site|site layout|master ?plan|general arrangement|ga plan)\b", "site-plan", 90),
    (r"\b(block plan)\b", "block-plan", 82),
    (r"\b(location plan|red line|site location)\b", "location-plan", 32),
    (r"\b(landscape|landscaping|planting plan|soft landscape|hard landscape)\b", "landscape-plan", 78),
    (r"\b(ride layout|track layout|roller coaster|coaster layout)\b", "ride-layout", 95),
    (r"\b(floor plan|ground floor|first floor|roof plan)\b", "floor-plan", 62),
    (r"\b(elevation|facade)\b", "elevation", 58),
    (r"\b(section|cross section|longitudinal section)\b", "section", 58),
    (r"\b(drainage|levels plan|contours?|topographic|topographical)\b", "terrain-or-drainage", 65),
    (r"\b(lighting|illumination)\b", "lighting-plan", 45),
    (r"\b(access plan|highway layout|road layout|parking layout)\b", "access-plan", 60),
    (r"\b(decision notice|grant of permission|planning decision)\b", "decision-notice", 20),
)
#: Patterns of a document's state in order, and what wording adds to its score.
DOCUMENT_STATES = (
    (r"\bsuperseded|obsolete|withdrawn\b", "superseded"), (r"\bas[- ]?built|implemented|completion\b", "as-built"), (r"\bapproved|granted|decision notice\b", "approved"),
    (r"\bproposed\b", "proposed"), (r"\bexisting\b", "existing"),
)
REJECT_WORDS = r"\b(comment|representation|neighbour|consultation|application form|ownership certificate|fee|validation checklist|covering letter|email|correspondence|public notice|press notice|privacy|redact)\b"
CANDIDATE_WORDS = r"\b(site plan|block plan|location plan|masterplan|layout|general arrangement|ga plan|landscape|landscaping|planting|floor plan|roof plan|elevation|section|drainage|lighting|access plan|ride layout|track layout|as built|as-built|approved plan|proposed plan|existing plan|drawing)\b"
SCORE_WORDS = ((r"\bapproved\b", 25), (r"\bas[- ]?built|implemented|completion\b", 35), (r"\bproposed\b", 8), (r"\bexisting\b", 4), (r"\bsuperseded|withdrawn|obsolete\b", -80), (REJECT_WORDS, -100), (CANDIDATE_WORDS, 12))


def first_match(text: Column, cases, default) -> Column:
    """The value of the first (pattern, value, ...) whose pattern is found in `text`."""
    out = F.lit(default)
    for pattern, value, *_ in reversed(cases):
        out = F.when(F.rlike(text, F.lit(pattern)), F.lit(value)).otherwise(out)
    return out


def document_role(text: Column) -> Column:
    return first_match(F.lower(text), DOCUMENT_ROLES, "unknown")


def document_state(text: Column) -> Column:
    return first_match(F.lower(text), DOCUMENT_STATES, "unknown")


def document_score(text: Column) -> Column:
    """The role's score and what each wording adds."""
    low = F.lower(text)
    score = first_match(low, [(pattern, value) for pattern, _, value in DOCUMENT_ROLES], 0)
    for pattern, value in SCORE_WORDS:
        score = score + F.when(F.rlike(low, F.lit(pattern)), F.lit(value)).otherwise(F.lit(0))
    return score
