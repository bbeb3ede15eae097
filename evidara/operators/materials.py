"""Materials of surfaces: which preset a surface's words and colour name, and which block of its palette a cell gets.

A cell's block is drawn by a hash of the cell's address, so that it is the same wherever and whenever it is worked out. How a pattern
addresses cells (single cells, patches, slabs, strips, blobs) gives it its look; the hash is then looked up among cumulative
weights, by a join with a small table of ranges.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidara.functions import scalars as S

#: Presets of surfaces, with the pattern by which cells are addressed and the percentages of their blocks.
PRESETS = (
    ("weathered_asphalt", "fine_noise", (("gray_wool", 45), ("gray_concrete", 30), ("light_gray_concrete", 15), ("andesite", 10))),
    ("fresh_black_asphalt", "fine_noise", (("black_concrete", 55), ("black_wool", 25), ("gray_concrete", 15), ("smooth_basalt", 5))),
    ("light_asphalt", "fine_noise", (("light_gray_concrete", 45), ("gray_wool", 30), ("andesite", 15), ("stone", 10))),
    ("red_tarmac", "fine_noise", (("red_concrete", 55), ("red_terracotta", 25), ("brick_block", 10), ("brown_terracotta", 10))),
    ("resin_bound_beige", "speckled", (("smooth_sandstone", 40), ("sandstone", 25), ("birch_planks", 10), ("packed_mud", 10), ("calcite", 15))),
    ("resin_bound_grey", "speckled", (("andesite", 35), ("light_gray_concrete", 30), ("stone", 20), ("polished_andesite", 10), ("gray_concrete", 5))),
    ("concrete_path", "large_subtle_patches", (("light_gray_concrete", 50), ("smooth_stone", 25), ("stone", 15), ("andesite", 10))),
    ("old_concrete", "patchy_weathered", (("smooth_stone", 30), ("light_gray_concrete", 25), ("stone", 20), ("andesite", 15), ("moss_block", 5), ("gravel", 5))),
    ("grey_block_paving", "repeating_paving_grid", (("stone_bricks", 40), ("andesite", 25), ("polished_andesite", 15), ("smooth_stone", 10), ("cracked_stone_bricks", 10))),
    ("red_block_paving", "repeating_paving_grid", (("bricks", 45), ("red_terracotta", 25), ("granite", 15), ("polished_granite", 10), ("packed_mud", 5))),
    ("buff_paving", "slab_grid", (("smooth_sandstone", 35), ("sandstone", 30), ("cut_sandstone", 20), ("birch_planks", 5), ("calcite", 10))),
    ("cobblestone", "irregular_clusters", (("cobblestone", 55), ("mossy_cobblestone", 15), ("andesite", 10), ("stone", 10), ("gravel", 10))),
    ("old_stone_paving", "larger_irregular_slabs", (("stone_bricks", 30), ("stone", 25), ("andesite", 15), ("cracked_stone_bricks", 10), ("mossy_stone_bricks", 10), ("cobblestone", 10))),
    ("gravel_path", "dense_granular_noise", (("gravel", 55), ("andesite", 15), ("coarse_dirt", 15), ("stone", 10), ("tuff", 5))),
    ("hoggin_path", "fine_mottling", (("packed_mud", 35), ("coarse_dirt", 25), ("gravel", 20), ("brown_terracotta", 10), ("sand", 10))),
    ("dirt_trail", "directional_worn_patches", (("coarse_dirt", 40), ("dirt", 30), ("rooted_dirt", 15), ("packed_mud", 10), ("gravel", 5))),
    ("woodland_floor", "organic_clusters", (("podzol", 35), ("dirt", 20), ("coarse_dirt", 15), ("rooted_dirt", 15), ("moss_block", 10), ("brown_wool", 5))),
    ("mulch_planting_bed", "organic_clusters", (("podzol", 40), ("brown_wool", 20), ("coarse_dirt", 20), ("rooted_dirt", 10), ("packed_mud", 10))),
    ("healthy_lawn", "very_large_soft_patches", (("grass_block", 70), ("moss_block", 20), ("green_wool", 5), ("lime_terracotta", 5))),
    ("worn_grass", "edge_biased_wear", (("grass_block", 50), ("moss_block", 15), ("dirt", 15), ("coarse_dirt", 15), ("rooted_dirt", 5))),
    ("boardwalk", "directional_strips", (("spruce_planks", 55), ("dark_oak_planks", 20), ("oak_planks", 15), ("stripped_spruce_wood", 10))),
    ("weathered_timber", "directional_strips", (("spruce_planks", 35), ("dark_oak_planks", 25), ("stripped_spruce_wood", 20), ("brown_terracotta", 10), ("mangrove_planks", 10))),
    ("sand_beach", "soft_noise", (("sand", 65), ("smooth_sandstone", 15), ("sandstone", 10), ("gravel", 5), ("calcite", 5))),
    ("natural_rock", "large_clustered_blobs", (("stone", 30), ("andesite", 20), ("tuff", 20), ("cobblestone", 10), ("mossy_cobblestone", 10), ("gravel", 10))),
    ("dark_rockwork", "large_irregular_blobs", (("tuff", 30), ("cobbled_deepslate", 25), ("deepslate", 20), ("blackstone", 10), ("andesite", 10), ("mossy_cobblestone", 5))),
    ("artificial_themed_rock", "layered_patches", (("tuff", 35), ("stone", 25), ("andesite", 15), ("packed_mud", 10), ("brown_terracotta", 10), ("mossy_cobblestone", 5))),
    ("old_brick_wall", "clustered_weathering", (("bricks", 45), ("terracotta", 20), ("mud_bricks", 15), ("cracked_stone_bricks", 10), ("mossy_stone_bricks", 10))),
    ("sandstone_wall", "horizontal_courses", (("sandstone", 40), ("cut_sandstone", 25), ("smooth_sandstone", 20), ("calcite", 5), ("dripstone_block", 10))),
    ("industrial_service_paving", "fine_noise", (("gray_concrete", 35), ("smooth_stone", 25), ("stone", 20), ("andesite", 15), ("gravel", 5))),
)
#: Other names of presets. Asphalt and paving go by colour where their names leave it open.
ALIASES = {
    "weathered asphalt": "weathered_asphalt", "old asphalt": "weathered_asphalt", "asphalt": "weathered_asphalt", "tarmac": "weathered_asphalt", "fresh black asphalt": "fresh_black_asphalt", "fresh asphalt": "fresh_black_asphalt",
    "black asphalt": "fresh_black_asphalt", "new asphalt": "fresh_black_asphalt", "light asphalt": "light_asphalt", "pale asphalt": "light_asphalt", "red tarmac": "red_tarmac", "red asphalt": "red_tarmac",
    "resin bound beige": "resin_bound_beige", "beige resin": "resin_bound_beige", "resin beige": "resin_bound_beige", "resin bound grey": "resin_bound_grey", "resin bound gray": "resin_bound_grey", "grey resin": "resin_bound_grey",
    "gray resin": "resin_bound_grey", "concrete": "concrete_path", "concrete path": "concrete_path", "old concrete": "old_concrete", "weathered concrete": "old_concrete", "grey block paving": "grey_block_paving",
    "gray block paving": "grey_block_paving", "block paving": "grey_block_paving", "paving stones": "grey_block_paving", "red block paving": "red_block_paving", "buff paving": "buff_paving", "buff block paving": "buff_paving",
    "cobblestone": "cobblestone", "sett": "cobblestone", "setts": "cobblestone", "old stone paving": "old_stone_paving", "stone paving": "old_stone_paving", "gravel": "gravel_path", "gravel path": "gravel_path",
    "fine gravel": "gravel_path", "hoggin": "hoggin_path", "compacted": "hoggin_path", "compacted path": "hoggin_path", "dirt": "dirt_trail", "earth": "dirt_trail", "ground": "dirt_trail", "dirt trail": "dirt_trail",
    "woodland floor": "woodland_floor", "forest floor": "woodland_floor", "mulch": "mulch_planting_bed", "planting bed": "mulch_planting_bed", "flowerbed": "mulch_planting_bed", "grass": "healthy_lawn", "lawn": "healthy_lawn",
    "healthy lawn": "healthy_lawn", "worn grass": "worn_grass", "boardwalk": "boardwalk", "timber": "weathered_timber", "weathered timber": "weathered_timber", "wood": "boardwalk", "sand": "sand_beach", "beach": "sand_beach",
    "sand beach": "sand_beach", "rock": "natural_rock", "stone": "natural_rock", "natural rock": "natural_rock", "dark rockwork": "dark_rockwork", "dark rock": "dark_rockwork", "artificial themed rock": "artificial_themed_rock",
    "themed rock": "artificial_themed_rock", "rockwork": "artificial_themed_rock", "brick": "old_brick_wall", "bricks": "old_brick_wall", "old brick wall": "old_brick_wall", "sandstone wall": "sandstone_wall",
    "industrial paving": "industrial_service_paving", "service paving": "industrial_service_paving", "industrial service paving": "industrial_service_paving",
}
#: Base recipes by material, with pattern, scale and percentages; what is left of 100 goes to the first block.
RECIPES = (
    ("asphalt", "speckled", 1, (("gray_wool", 60), ("gray_concrete", 40))),
    ("brick", "mixed", 1, (("terracotta", 60), ("jungle_planks", 30), ("packed_mud", 10))),
    ("stone", "mosaic", 1, (("stone", 40), ("cracked_stone_bricks", 5), ("stone_bricks", 20), ("andesite", 15), ("polished_andesite", 5))),
    ("grass", "organic", 1, (("grass_block", 70), ("moss_block", 30))),
)
#: Further recipes with the preset whose palette they share, pattern and scale; and the blocks that they name otherwise.
EXTENSION = (
    ("weathered_asphalt", "weathered_asphalt", "speckled", 1),
    ("fresh_asphalt", "fresh_black_asphalt", "speckled", 1),
    ("light_asphalt", "light_asphalt", "speckled", 1),
    ("red_tarmac", "red_tarmac", "speckled", 1),
    ("resin_bound_beige", "resin_bound_beige", "speckled", 1),
    ("resin_bound_grey", "resin_bound_grey", "speckled", 1),
    ("concrete", "concrete_path", "mixed", 3),
    ("old_concrete", "old_concrete", "mosaic", 3),
    ("paving_stones", "grey_block_paving", "mosaic", 1),
    ("red_block_paving", "red_block_paving", "mosaic", 1),
    ("buff_paving", "buff_paving", "mosaic", 2),
    ("cobblestone", "cobblestone", "mosaic", 1),
    ("old_stone_paving", "old_stone_paving", "mosaic", 2),
    ("gravel", "gravel_path", "speckled", 1),
    ("compacted", "hoggin_path", "speckled", 1),
    ("dirt_trail", "dirt_trail", "organic", 2),
    ("woodland_floor", "woodland_floor", "organic", 3),
    ("mulch_bed", "mulch_planting_bed", "organic", 3),
    ("healthy_lawn", "healthy_lawn", "organic", 4),
    ("worn_grass", "worn_grass", "organic", 3),
    ("boardwalk", "boardwalk", "mixed", 2),
    ("weathered_timber", "weathered_timber", "mixed", 2),
    ("sand", "sand_beach", "speckled", 2),
    ("natural_rock", "natural_rock", "mosaic", 4),
    ("dark_rockwork", "dark_rockwork", "mosaic", 4),
    ("artificial_rockwork", "artificial_themed_rock", "mosaic", 4),
    ("old_brick_wall", "old_brick_wall", "mosaic", 2),
    ("sandstone_wall", "sandstone_wall", "mosaic", 2),
    ("industrial_service_paving", "industrial_service_paving", "mixed", 3),
)
RENAMED = {"rooted_dirt": "dirt_with_roots", "stripped_spruce_wood": "stripped_spruce_log"}
#: Other names of recipes.
RECIPE_ALIASES = {
    "weathered_asphalt": "weathered_asphalt", "old_asphalt": "weathered_asphalt", "worn_asphalt": "weathered_asphalt", "fresh_asphalt": "fresh_asphalt", "black_asphalt": "fresh_asphalt", "light_asphalt": "light_asphalt",
    "red_tarmac": "red_tarmac", "red_asphalt": "red_tarmac", "resin_bound": "resin_bound_beige", "resin_bound_beige": "resin_bound_beige", "resin_bound_gravel": "resin_bound_beige", "resin_bound_grey": "resin_bound_grey",
    "resin_bound_gray": "resin_bound_grey", "resin_bonded": "resin_bound_beige", "concrete_path": "concrete", "old_concrete": "old_concrete", "weathered_concrete": "old_concrete", "grey_block_paving": "paving_stones",
    "gray_block_paving": "paving_stones", "red_block_paving": "red_block_paving", "buff_paving": "buff_paving", "old_stone_paving": "old_stone_paving", "gravel_path": "gravel", "hoggin": "compacted", "dirt_trail": "dirt_trail",
    "woodland_floor": "woodland_floor", "mulch": "mulch_bed", "mulch_bed": "mulch_bed", "planting_bed": "mulch_bed", "healthy_lawn": "healthy_lawn", "lawn": "healthy_lawn", "worn_grass": "worn_grass", "boardwalk": "boardwalk",
    "timber_decking": "boardwalk", "weathered_timber": "weathered_timber", "beach": "sand", "sandy": "sand", "natural_rock": "natural_rock", "rock": "natural_rock", "rockwork": "artificial_rockwork", "dark_rockwork": "dark_rockwork",
    "artificial_rockwork": "artificial_rockwork", "old_brick_wall": "old_brick_wall", "sandstone_wall": "sandstone_wall", "industrial_service_paving": "industrial_service_paving",
}
#: Preset words in a surface's text, in order, after those for asphalt, resin and paving.
WORDS = (
    ("cobble|sett", "cobblestone"), ("gravel", "gravel_path"), ("hoggin|compacted", "hoggin_path"), ("mulch|planting", "mulch_planting_bed"), ("woodland|forest floor", "woodland_floor"), ("worn grass", "worn_grass"), ("grass|lawn", "healthy_lawn"), ("boardwalk", "boardwalk"),
    ("timber", "weathered_timber"), ("sandstone.*wall|wall.*sandstone", "sandstone_wall"), ("brick.*wall|wall.*brick", "old_brick_wall"), ("industrial|service paving", "industrial_service_paving"), ("themed rock|artificial rock|^rockwork$", "artificial_themed_rock"), ("dark rock", "dark_rockwork"), ("rock", "natural_rock"),
    ("sand|beach", "sand_beach"), ("old concrete|weathered concrete", "old_concrete"), ("concrete", "concrete_path"), ("dirt|earth", "dirt_trail"),
)


def block(name: str) -> str:
    """A block's full name; bricks have a name of their own."""
    return f"minecraft:{'brick_block' if name == 'bricks' else name}"


def shares(palette: tuple[tuple[str, int], ...]) -> list[tuple[str, float, float]]:
    """(block, from, to): the range of [0, 1) of each block; the last one reaches beyond. What is left of 100 goes to the first."""
    weights = [w for _, w in palette]
    weights[0] += max(0, 100 - sum(weights))
    out, at, total = [], 0, sum(weights)
    for (name, _), w in zip(palette, weights, strict=True):
        out.append((block(name), at / total, (at + w) / total))
        at += w
    return [*out[:-1], (out[-1][0], out[-1][1], 2.0)]


def palettes() -> list[tuple[str, str, int, list[tuple[str, float, float]]]]:
    """(name, pattern, scale, ranges) of every preset, with scale 0, and of every recipe, whose names begin with `recipe:`."""
    known = {name: palette for name, _, palette in PRESETS}
    rest = [(f"recipe:{name}", pattern, scale, shares(palette)) for name, pattern, scale, palette in RECIPES]
    more = [(f"recipe:{name}", pattern, scale, shares(tuple((RENAMED.get(b, b), w) for b, w in known[of]))) for name, of, pattern, scale in EXTENSION]
    return [(name, pattern, 0, shares(palette)) for name, pattern, palette in PRESETS] + rest + more


def palette_ranges(spark: SparkSession) -> DataFrame:
    """(palette, block, low, high): some 290 rows, whatever the data."""
    return spark.createDataFrame([(name, *r) for name, _, _, ranges in palettes() for r in ranges], "palette string, block string, low double, high double")


def finished(h: Column) -> Column:
    """An unsigned 32-bit number with its bits mixed; products are taken in halves, so that they fit a long."""
    mask = F.lit(0xFFFFFFFF)

    def times(v: Column, factor: int) -> Column:
        low, high = v.bitwiseAND(F.lit(65535)) * factor, F.shiftrightunsigned(v, 16) * factor
        return (low + high.bitwiseAND(F.lit(65535)) * 65536).bitwiseAND(mask)

    # each step stands in an array of its own, so that it is worked out once
    step = lambda values, f: F.transform(values, f)
    fold = lambda n: lambda v: v.bitwiseXOR(F.shiftrightunsigned(v, n))
    a = step(step(F.array(h), fold(16)), lambda v: times(v, 0x7FEB352D))
    b = step(step(a, fold(15)), lambda v: times(v, 0x846CA68B))
    return step(b, fold(16))[0]


def text_unit(*parts: Column) -> Column:
    """A number in [0, 1) from values joined by |."""
    return finished(S.fnv1a(F.concat_ws("|", *(p.cast("string") for p in parts)))) / 4294967296.0


def cell_unit(x: Column, z: Column, seed: Column) -> Column:
    """A number in [0, 1) from integer coordinates and a seed; the factors are fixed values."""
    mask = F.lit(0xFFFFFFFF)

    def times(v: Column, factor: int) -> Column:
        v = v.cast("bigint").bitwiseAND(mask)
        return (v.bitwiseAND(F.lit(65535)) * factor + (F.shiftrightunsigned(v, 16) * factor).bitwiseAND(F.lit(65535)) * 65536).bitwiseAND(mask)

    return finished(times(x, 0x1F123BB5).bitwiseXOR(times(z, 0x5F356495)).bitwiseXOR(times(seed, 0x6C8E9CF5))) / 4294967296.0


def wrapped(v: Column, by: int) -> Column:
    return F.pmod(v, F.lit(by))


Address = tuple[Column, Column, Column | None]


def addresses(x: Column, z: Column, jitter: Callable[[str], Column]) -> dict[str, Address]:
    """By pattern: the cell's address in both directions, and what is added to the pattern's name, if anything.

    `jitter` gives a number in [0, 1) of the cell and a word. Patterns that aren't listed address each cell by itself.
    """
    down = lambda v, by: F.floor(v / by)
    blob = lambda v, w, by, size: F.floor((v + jitter(w) * by) / size)
    wave = lambda v, other, f, k, by, size: F.floor((v + f(other * k) * by) / size)
    near = F.least(wrapped(x, 9), 8 - wrapped(x, 9), wrapped(z, 9), 8 - wrapped(z, 9))
    of = lambda *parts: F.concat_ws(":", *(p.cast("string") for p in parts))
    return {
        "speckled": (x, z, of(F.abs((x * 17 + z * 31) % 11))),
        "large_subtle_patches": (down(x, 4), down(z, 4), of(wrapped(x + z, 2))),
        "patchy_weathered": (down(x, 3), down(z, 3), of(F.abs((x * 5 - z * 3) % 7))),
        "repeating_paving_grid": (down(x, 4), down(z, 4), of(wrapped(x, 4), wrapped(z, 4))),
        "slab_grid": (down(x, 3), down(z, 2), of(wrapped(x, 3), wrapped(z, 2))),
        "irregular_clusters": (blob(x, "jx", 2, 2), blob(z, "jz", 2, 2), None),
        "larger_irregular_slabs": (blob(x, "jx", 3, 4), blob(z, "jz", 3, 3), None),
        "dense_granular_noise": (x, z, of(x * 3 + z * 5)),
        "fine_mottling": (down(x, 2), down(z, 2), of(wrapped(x + z, 3))),
        "directional_worn_patches": (F.floor((x + z * 0.35) / 4), down(z, 2), None),
        "organic_clusters": (wave(x, z, F.sin, 0.7, 2, 3), wave(z, x, F.cos, 0.6, 2, 3), None),
        "very_large_soft_patches": (wave(x, z, F.sin, 0.23, 3, 8), wave(z, x, F.cos, 0.19, 3, 8), None),
        "edge_biased_wear": (down(x, 3), down(z, 3), F.concat(F.lit("edge"), F.least(near, F.lit(2)).cast("string"))),
        "directional_strips": (down(x, 2), z * 0, of(wrapped(z, 5))),
        "soft_noise": (down(x, 3), down(z, 3), of(wrapped(x + z, 2))),
        "large_clustered_blobs": (wave(x, z, F.sin, 0.4, 2, 5), wave(z, x, F.cos, 0.37, 2, 5), None),
        "large_irregular_blobs": (blob(x, "bx", 4, 5), blob(z, "bz", 4, 5), None),
        "layered_patches": (down(x, 4), down(z, 2), of(wrapped(z, 4))),
        "clustered_weathering": (down(x, 3), down(z, 3), of(wrapped(x - z, 5))),
        "horizontal_courses": (down(x, 3), z, of(wrapped(z, 3))),
    }


def address(pattern: Column, preset: Column, x: Column, z: Column, seed: Column) -> Column:
    """(ax, az, salt) of a cell under a pattern."""
    jitter = lambda word: text_unit(seed, preset, x, z, F.lit(word))
    made = lambda ax, az, salt: F.struct(ax.cast("bigint").alias("ax"), az.cast("bigint").alias("az"), salt.alias("salt"))
    out = made(x, z, pattern)
    for name, (ax, az, salt) in addresses(x, z, jitter).items():
        out = F.when(pattern == name, made(ax, az, F.lit(name) if salt is None else F.concat(F.lit(f"{name}:"), salt))).otherwise(out)
    return out


def drawn_blocks(cells: DataFrame, seed: int) -> DataFrame:
    """Cells (x, z, palette, ...) with `u`, the number in [0, 1) of the cell's address, and `block`, which u names among the palette's weights.

    `palette` is a preset's name or recipe:name; cells of none of these, or without one, have null. Coordinates are whole numbers of any sign.
    """
    spark = cells.sparkSession
    facts = spark.createDataFrame([(n, p, s) for n, p, s, _ in palettes()], "palette string, __pattern string, __scale int")
    made = cells.join(F.broadcast(facts), "palette", "left").withColumn("__seed", F.lit(seed))
    x, z = F.col("x").cast("bigint"), F.col("z").cast("bigint")
    made = made.withColumn("__a", F.when(F.col("__scale") == 0, address(F.col("__pattern"), F.col("palette"), x, z, F.col("__seed"))))
    a = F.col("__a")
    scale = F.greatest(F.lit(1), F.col("__scale"))
    u = F.when(F.col("__scale") == 0, text_unit(F.col("__seed"), F.col("palette"), a["ax"], a["az"], a["salt"])).when(F.col("__scale") > 0, cell_unit(F.floor(x / scale), F.floor(z / scale), F.col("__seed")))
    made = made.withColumn("u", u).drop("__a", "__seed", "__pattern", "__scale")
    ranges = F.broadcast(palette_ranges(spark).withColumnRenamed("palette", "__palette"))
    return made.join(ranges, (F.col("palette") == F.col("__palette")) & (F.col("u") >= F.col("low")) & (F.col("u") < F.col("high")), "left").drop("__palette", "low", "high")


def plain_name(text: Column) -> Column:
    """Lower case with single spaces for runs of spaces, dashes, underscores and slashes."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(text)), "[_/]+", " "), r"[-–—\s]+", " ")


def preset_of(text: Column, r: Column, g: Column, b: Column) -> Column:
    """The preset that a surface's text names: by its own name, another name, or a word in it; null if none. r, g, b may be null."""
    name = plain_name(text)
    warm = F.coalesce((r > 135) & (g > 115) & (b < g * 0.92) & (r > b * 1.22), F.lit(False))
    light = 0.2126 * r + 0.7152 * g + 0.0722 * b
    asphalt = F.when(r.isNull() | g.isNull() | b.isNull(), "weathered_asphalt").when((r > g * 1.22) & (r > b * 1.18) & (r > 95), "red_tarmac").when(light < 62, "fresh_black_asphalt").when(light > 145, "light_asphalt").otherwise("weathered_asphalt")
    paving = F.when(r.isNull() | g.isNull() | b.isNull(), "grey_block_paving").when((r > g * 1.18) & (r > b * 1.25) & (r > 90), "red_block_paving").when(warm, "buff_paving").otherwise("grey_block_paving")
    has = lambda pattern: F.rlike(name, F.lit(pattern))
    worded = F.when(has("asphalt|tarmac"), F.when(has("red"), "red_tarmac").when(has("fresh|black|new"), "fresh_black_asphalt").when(has("light|pale"), "light_asphalt").otherwise(asphalt))
    worded = worded.when(has("resin"), F.when(warm, "resin_bound_beige").otherwise("resin_bound_grey"))
    worded = worded.when(has("paving|paver"), F.when(has("red"), "red_block_paving").when(has("buff|beige"), "buff_paving").otherwise(paving))
    for pattern, preset in WORDS:
        worded = worded.when(has(pattern), preset)
    own = F.translate(name, " ", "_")
    other = F.element_at(F.create_map(*(F.lit(v) for pair in ALIASES.items() for v in pair)), name)
    return F.when(own.isin([p[0] for p in PRESETS]), own).when(name == "asphalt", asphalt).when(name.isin("block paving", "paving stones"), paving).otherwise(F.coalesce(other, worded))


def recipe_of(text: Column) -> Column:
    """The palette name of the recipe that a surface's text names, or null."""
    key = F.regexp_replace(F.lower(F.trim(text)), "[ -]+", "_")
    named = F.coalesce(F.element_at(F.create_map(*(F.lit(v) for pair in RECIPE_ALIASES.items() for v in pair)), key), key)
    return F.when(named.isin([r[0] for r in (*RECIPES, *EXTENSION)]), F.concat(F.lit("recipe:"), named))


def surface_blocks(cells: DataFrame, seed: int) -> DataFrame:
    """Cells (x, z, surface, r, g, b, primary) with the palette found and the block: of the preset if the surface names one, else of its recipe, else `primary`."""
    named = cells.withColumn("palette", F.coalesce(preset_of(F.col("surface"), F.col("r"), F.col("g"), F.col("b")), recipe_of(F.col("surface"))))
    return drawn_blocks(named, seed).withColumn("block", F.coalesce("block", "primary"))
