"""Queries of surface materials: presets by words and colour, blocks by a cell's address, and shares; the same in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidara.functions import rules as R
from evidara.functions import scalars as S
from evidara.operators import materials as M

SEED = 771
NAMES = [p[0] for p in M.palettes()]
SURFACES = (
    "Asphalt", "block paving", "fresh tarmac", "resin", "granite setts", "gravel", "old concrete", "boardwalk deck", "red brick wall", "worn grass", "themed rock face", "beach", "unknown stuff", "red tarmac", "planting bed", "Grey  Block-Paving",
    "natural_rock", "buff paver", "stone", "brick", "  ", "pale asphalt road", "paving stones", "terrazzo", "grass", "sandstone garden wall", "new black asphalt", "resin bound", "rock/work", "compacted",
)
PLAIN = (("asphalt", 0.6), ("gravel", 0.3), ("stone", 0.1))


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _parts(spark, sf) -> DataFrame:
    k = F.col("p_partkey")
    return _t(spark, sf, "part").select("p_partkey", (F.pmod(k * 7919, F.lit(400)) - 200).alias("x"), (F.pmod(k * 104729, F.lit(300)) - 150).alias("z"), R.dealt(k, SURFACES).alias("surface"), F.lit("minecraft:smooth_stone").alias("primary"), *(F.when(F.pmod(k, F.lit(4)) > 0, F.pmod(k * m, F.lit(256)).cast("double")).alias(c) for c, m in (("r", 37), ("g", 53), ("b", 71))))


def surface_materials(spark, sf):
    """The preset of the parts' surfaces by their words, and by their colour where the words leave a shade open."""
    preset = M.preset_of(F.col("surface"), F.col("r"), F.col("g"), F.col("b"))
    return _parts(spark, sf).groupBy(M.plain_name(F.col("surface")).alias("text"), F.coalesce(preset, F.lit("none")).alias("preset")).agg(F.count("*").alias("n"))


def material_blocks(spark, sf):
    """Every event as a cell of one of all palettes: the number that its address gives, and the block."""
    k = F.col("event_id")
    cells = _t(spark, sf, "events").select("event_id", (F.pmod(k * 7919, F.lit(600)) - 300).alias("x"), (F.pmod(k * 104729, F.lit(500)) - 250).alias("z"), R.dealt(k, NAMES).alias("palette"))
    return M.drawn_blocks(cells, SEED).select("event_id", "palette", "block", F.floor(F.col("u") * 4294967296).cast("bigint").alias("draw"))


def surface_blocks(spark, sf):
    """The block of every part's cell: of the preset that its surface names, else of its recipe, else the primary one."""
    return M.surface_blocks(_parts(spark, sf), SEED).select("p_partkey", F.coalesce("palette", F.lit("none")).alias("palette"), "block")


def material_shares(spark, sf):
    """How often each block of a plain palette comes over all line items as cells, and whether the share is within 0.02 of its weight."""
    u = M.cell_unit(F.col("l_orderkey"), F.col("l_linenumber") * 211 + F.col("l_partkey"), F.lit(SEED))
    (first, a), (second, b), (last, _) = PLAIN
    block = F.when(F.col("u") < a, first).when(F.col("u") < round(a + b, 9), second).otherwise(last)
    counts = _t(spark, sf, "lineitem").select(u.alias("u")).groupBy(block.alias("block")).agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1)))  # over three rows
    weight = F.element_at(F.create_map(*(F.lit(v) for pair in PLAIN for v in pair)), F.col("block"))
    return counts.withColumn("of", share).select("block", "n", S.half_up(F.col("of"), 4).alias("share"), (F.abs(F.col("of") - weight) <= 0.02).alias("within"))


QUERIES = {f.__name__: f for f in (surface_materials, material_blocks, surface_blocks, material_shares)}


def _finished(h: str) -> str:
    steps = f"list_transform([({h})::BIGINT], lambda v: xor(v, v >> 16))"
    for factor, shift in ((0x7FEB352D, 15), (0x846CA68B, 16)):
        steps = f"list_transform(list_transform({steps}, lambda v: ((v::HUGEINT * {factor}) % 4294967296)::BIGINT), lambda v: xor(v, v >> {shift}))"
    return f"{steps}[1]"


def _text_draw(*parts: str) -> str:
    text = " || '|' || ".join(f"({p})::VARCHAR" for p in parts)
    return _finished(f"list_reduce(list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT), lambda h, c: (xor(h, c) * 16777619) % 4294967296, 2166136261::BIGINT)")


def _cell_draw(x: str, z: str, seed: int) -> str:
    times = lambda v, f: f"(((({v})::HUGEINT % 4294967296 + 4294967296) % 4294967296 * {f}) % 4294967296)::BIGINT"
    return _finished(f"xor(xor({times(x, 0x1F123BB5)}, {times(z, 0x5F356495)}), {times(str(seed), 0x6C8E9CF5)})")


#: By pattern: the address east and south, and what follows the pattern's name; m(v, n) is the positive remainder, j(w) a jitter.
_MODES = {
    "speckled": ("x", "z", "abs((x * 17 + z * 31) % 11)"), "large_subtle_patches": ("floor(x / 4.0)", "floor(z / 4.0)", "m(x + z, 2)"), "patchy_weathered": ("floor(x / 3.0::DOUBLE)", "floor(z / 3.0::DOUBLE)", "abs((x * 5 - z * 3) % 7)"),
    "repeating_paving_grid": ("floor(x / 4.0)", "floor(z / 4.0)", "m(x, 4) || ':' || m(z, 4)"), "slab_grid": ("floor(x / 3.0::DOUBLE)", "floor(z / 2.0)", "m(x, 3) || ':' || m(z, 2)"), "irregular_clusters": ("floor((x + j(jx) * 2) / 2)", "floor((z + j(jz) * 2) / 2)", None),
    "larger_irregular_slabs": ("floor((x + j(jx) * 3) / 4)", "floor((z + j(jz) * 3) / 3)", None), "dense_granular_noise": ("x", "z", "(x * 3 + z * 5)"), "fine_mottling": ("floor(x / 2.0)", "floor(z / 2.0)", "m(x + z, 3)"), "directional_worn_patches": ("floor((x + z * 0.35::DOUBLE) / 4)", "floor(z / 2.0)", None),
    "organic_clusters": ("floor((x + sin(z * 0.7::DOUBLE) * 2) / 3)", "floor((z + cos(x * 0.6::DOUBLE) * 2) / 3)", None), "very_large_soft_patches": ("floor((x + sin(z * 0.23::DOUBLE) * 3) / 8)", "floor((z + cos(x * 0.19::DOUBLE) * 3) / 8)", None),
    "edge_biased_wear": ("floor(x / 3.0::DOUBLE)", "floor(z / 3.0::DOUBLE)", "'edge' || least(2, m(x, 9), 8 - m(x, 9), m(z, 9), 8 - m(z, 9))"), "directional_strips": ("floor(x / 2.0)", "0", "m(z, 5)"), "soft_noise": ("floor(x / 3.0::DOUBLE)", "floor(z / 3.0::DOUBLE)", "m(x + z, 2)"),
    "large_clustered_blobs": ("floor((x + sin(z * 0.4::DOUBLE) * 2) / 5)", "floor((z + cos(x * 0.37::DOUBLE) * 2) / 5)", None), "large_irregular_blobs": ("floor((x + j(bx) * 4) / 5)", "floor((z + j(bz) * 4) / 5)", None), "layered_patches": ("floor(x / 4.0)", "floor(z / 2.0)", "m(z, 4)"),
    "clustered_weathering": ("floor(x / 3.0::DOUBLE)", "floor(z / 3.0::DOUBLE)", "m(x - z, 5)"), "horizontal_courses": ("floor(x / 3.0::DOUBLE)", "z", "m(z, 3)"),
}


def _address_sql() -> str:
    import re

    def plain(text: str) -> str:
        text = re.sub(r"\bm\(([^,()]+), (\d+)\)", r"(((\1) % \2 + \2) % \2)", text)
        return re.sub(r"\bj\((\w+)\)", lambda m: f"({_text_draw(str(SEED), 'palette', 'x', 'z', R.quoted(m[1]))} / 4294967296.0::DOUBLE)", text)

    cases = " ".join(f"WHEN {R.quoted(k)} THEN {{'ax': ({plain(a)})::BIGINT, 'az': ({plain(b)})::BIGINT, 'salt': {R.quoted(k)}{' || ' + R.quoted(':') + ' || ' + plain(c) if c else ''}}}" for k, (a, b, c) in _MODES.items())
    return f"CASE pattern {cases} ELSE {{'ax': x::BIGINT, 'az': z::BIGINT, 'salt': pattern}} END"


_PALETTES = ", ".join(f"({R.quoted(n)}, {R.quoted(p)}, {s})" for n, p, s, _ in M.palettes())
_RANGES = ", ".join(f"({R.quoted(n)}, {R.quoted(b)}, {lo!r}::DOUBLE, {hi!r}::DOUBLE)" for n, _, _, rs in M.palettes() for b, lo, hi in rs)
_DRAWN = f"""
palettes(palette, pattern, scale) AS (VALUES {_PALETTES}), ranges(palette, block, low, high) AS (VALUES {_RANGES}),
found AS (SELECT cells.*, pattern, scale FROM cells LEFT JOIN palettes USING (palette)),
placed AS (SELECT *, CASE WHEN scale = 0 THEN {_address_sql()} END AS a FROM found),
drawn AS (SELECT *, CASE WHEN scale = 0 THEN {_text_draw(str(SEED), 'palette', 'a.ax', 'a.az', 'a.salt')} WHEN scale > 0 THEN {_cell_draw('floor(x::DOUBLE / scale)::BIGINT', 'floor(z::DOUBLE / scale)::BIGINT', SEED)} END AS draw FROM placed),
blocks AS (SELECT drawn.*, block FROM drawn LEFT JOIN ranges ON ranges.palette = drawn.palette AND draw / 4294967296.0::DOUBLE >= low AND draw / 4294967296.0::DOUBLE < high)"""
_ALIASES = "MAP {" + ", ".join(f"{R.quoted(k)}: {R.quoted(v)}" for k, v in M.ALIASES.items()) + "}"
_NAMED = f"[{', '.join(R.quoted(p[0]) for p in M.PRESETS)}]"
_PARTS = f"""
p AS (SELECT p_partkey, p_partkey * 7919 % 400 - 200 AS x, p_partkey * 104729 % 300 - 150 AS z, {R.sql_dealt('p_partkey', SURFACES)} AS surface, {', '.join(f'CASE WHEN p_partkey % 4 > 0 THEN (p_partkey * {m} % 256)::DOUBLE END AS {c}' for c, m in (("r", 37), ("g", 53), ("b", 71)))} FROM part),
n AS (SELECT *, regexp_replace(regexp_replace(lower(trim(surface)), '[_/]+', ' ', 'g'), '[-–—\\s]+', ' ', 'g') AS text, coalesce(r > 135 AND g > 115 AND b < g * 0.92::DOUBLE AND r > b * 1.22::DOUBLE, false) AS warm, 0.2126::DOUBLE * r + 0.7152::DOUBLE * g + 0.0722::DOUBLE * b AS lum FROM p),
c AS (SELECT *, CASE WHEN r IS NULL THEN 'weathered_asphalt' WHEN r > g * 1.22::DOUBLE AND r > b * 1.18::DOUBLE AND r > 95 THEN 'red_tarmac' WHEN lum < 62 THEN 'fresh_black_asphalt' WHEN lum > 145 THEN 'light_asphalt' ELSE 'weathered_asphalt' END AS asphalt,
  CASE WHEN r IS NULL THEN 'grey_block_paving' WHEN r > g * 1.18::DOUBLE AND r > b * 1.25::DOUBLE AND r > 90 THEN 'red_block_paving' WHEN warm THEN 'buff_paving' ELSE 'grey_block_paving' END AS paving FROM n),
named AS (SELECT *, CASE WHEN list_contains({_NAMED}, replace(text, ' ', '_')) THEN replace(text, ' ', '_') WHEN text = 'asphalt' THEN asphalt WHEN text IN ('block paving', 'paving stones') THEN paving ELSE coalesce(({_ALIASES})[text],
  CASE WHEN regexp_matches(text, 'asphalt|tarmac') THEN CASE WHEN contains(text, 'red') THEN 'red_tarmac' WHEN regexp_matches(text, 'fresh|black|new') THEN 'fresh_black_asphalt' WHEN regexp_matches(text, 'light|pale') THEN 'light_asphalt' ELSE asphalt END
  WHEN contains(text, 'resin') THEN CASE WHEN warm THEN 'resin_bound_beige' ELSE 'resin_bound_grey' END WHEN regexp_matches(text, 'paving|paver') THEN CASE WHEN contains(text, 'red') THEN 'red_block_paving' WHEN regexp_matches(text, 'buff|beige') THEN 'buff_paving' ELSE paving END
  ELSE {R.sql_first_match('text', M.WORDS)} END) END AS preset FROM c)"""
_RECIPES = "MAP {" + ", ".join(f"{R.quoted(k)}: {R.quoted(v)}" for k, v in M.RECIPE_ALIASES.items()) + "}"
_KEY = "regexp_replace(lower(trim(surface)), '[ -]+', '_', 'g')"

ORACLE_SQL = {
    "surface_materials": f"WITH {_PARTS} SELECT text, coalesce(preset, 'none') AS preset, count(*) AS n FROM named GROUP BY ALL",
    "material_blocks": f"""
WITH cells AS (SELECT event_id, event_id * 7919 % 600 - 300 AS x, event_id * 104729 % 500 - 250 AS z, {R.sql_dealt('event_id', NAMES)} AS palette FROM events), {_DRAWN}
SELECT event_id, palette, block, draw FROM blocks""",
    "surface_blocks": f"""
WITH {_PARTS},
r AS (SELECT *, coalesce(({_RECIPES})[{_KEY}], {_KEY}) AS recipe FROM named),
cells AS (SELECT p_partkey, x, z, coalesce(preset, CASE WHEN list_contains([{', '.join(R.quoted(x[0]) for x in (*M.RECIPES, *M.EXTENSION))}], recipe) THEN 'recipe:' || recipe END) AS palette FROM r), {_DRAWN}
SELECT p_partkey, coalesce(palette, 'none') AS palette, coalesce(block, 'minecraft:smooth_stone') AS block FROM blocks""",
    "material_shares": f"""
WITH h AS (SELECT {_cell_draw('l_orderkey', 'l_linenumber * 211 + l_partkey', SEED)} / 4294967296.0::DOUBLE AS u FROM lineitem),
c AS (SELECT CASE WHEN u < 0.6 THEN 'asphalt' WHEN u < 0.9 THEN 'gravel' ELSE 'stone' END AS block, count(*) AS n FROM h GROUP BY 1)
SELECT block, n, floor(n::DOUBLE / sum(n) OVER ()::DOUBLE * 10000 + 0.5) / 10000 AS share, abs(n::DOUBLE / sum(n) OVER ()::DOUBLE - CASE block WHEN 'asphalt' THEN 0.6::DOUBLE WHEN 'gravel' THEN 0.3::DOUBLE ELSE 0.1::DOUBLE END) <= 0.02 AS within FROM c""",
}
