"""Materials, placing and pixels against plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from evidara.operators import materials as M
from evidara.operators import pixels as X
from evidara.operators import placement as V


def plain_mix(h):
    h ^= h >> 16
    h = h * 0x7FEB352D & 0xFFFFFFFF
    h ^= h >> 15
    h = h * 0x846CA68B & 0xFFFFFFFF
    return h ^ h >> 16


def plain_text_unit(*parts):
    h = 2166136261
    for c in "|".join(map(str, parts)):
        h = (h ^ ord(c)) * 16777619 & 0xFFFFFFFF
    return plain_mix(h) / 2**32


def plain_cell_unit(x, z, seed):
    return plain_mix((x * 0x1F123BB5 ^ z * 0x5F356495 ^ seed * 0x6C8E9CF5) & 0xFFFFFFFF) / 2**32


def plain_address(pattern, preset, x, z, seed):
    fl, j = math.floor, lambda w: plain_text_unit(seed, preset, x, z, w)
    near = min(x % 9, 8 - x % 9, z % 9, 8 - z % 9)
    cells = {
        "fine_noise": (x, z, ""), "speckled": (x, z, f":{abs(math.fmod(x * 17 + z * 31, 11)):.0f}"), "large_subtle_patches": (x // 4, z // 4, f":{(x + z) % 2}"), "patchy_weathered": (x // 3, z // 3, f":{abs(math.fmod(x * 5 - z * 3, 7)):.0f}"),
        "repeating_paving_grid": (x // 4, z // 4, f":{x % 4}:{z % 4}"), "slab_grid": (x // 3, z // 2, f":{x % 3}:{z % 2}"), "irregular_clusters": (fl((x + j("jx") * 2) / 2), fl((z + j("jz") * 2) / 2), ""),
        "larger_irregular_slabs": (fl((x + j("jx") * 3) / 4), fl((z + j("jz") * 3) / 3), ""), "dense_granular_noise": (x, z, f":{x * 3 + z * 5}"), "fine_mottling": (x // 2, z // 2, f":{(x + z) % 3}"), "directional_worn_patches": (fl((x + z * 0.35) / 4), z // 2, ""),
        "organic_clusters": (fl((x + math.sin(z * 0.7) * 2) / 3), fl((z + math.cos(x * 0.6) * 2) / 3), ""), "very_large_soft_patches": (fl((x + math.sin(z * 0.23) * 3) / 8), fl((z + math.cos(x * 0.19) * 3) / 8), ""), "edge_biased_wear": (x // 3, z // 3, f":edge{min(2, near)}"),
        "directional_strips": (x // 2, 0, f":{z % 5}"), "soft_noise": (x // 3, z // 3, f":{(x + z) % 2}"), "large_clustered_blobs": (fl((x + math.sin(z * 0.4) * 2) / 5), fl((z + math.cos(x * 0.37) * 2) / 5), ""),
        "large_irregular_blobs": (fl((x + j("bx") * 4) / 5), fl((z + j("bz") * 4) / 5), ""), "layered_patches": (x // 4, z // 2, f":{z % 4}"), "clustered_weathering": (x // 3, z // 3, f":{(x - z) % 5}"), "horizontal_courses": (x // 3, z, f":{z % 3}"),
    }
    ax, az, salt = cells[pattern]
    return plain_text_unit(seed, preset, ax, az, pattern + salt)


def test_every_pattern_draws_the_cells_of_its_address(spark):
    assert len(M.PRESETS) == 29 and len({p for _, p, _ in M.PRESETS}) == 21 and len(M.EXTENSION) == 29
    assert all(abs(rs[0][1]) == 0 and rs[-1][2] == 2.0 and all(a[2] == b[1] for a, b in zip(rs, rs[1:])) for *_, rs in M.palettes())  # noqa: B905
    assert M.shares((("stone", 40), ("cracked_stone_bricks", 5), ("stone_bricks", 20), ("andesite", 15), ("polished_andesite", 5)))[0] == ("minecraft:stone", 0.0, 0.55)
    cells = spark.createDataFrame([(x, z, n) for n, *_ in M.palettes() for x, z in ((0, 0), (5, -7), (-13, 4), (101, 60))] + [(1, 1, None), (1, 1, "nothing")], "x int, z int, palette string")
    for r in M.drawn_blocks(cells, 417).collect():
        if r.palette in (None, "nothing"):
            assert r.block is None and r.u is None
            continue
        _, pattern, scale, ranges = next(p for p in M.palettes() if p[0] == r.palette)
        u = plain_cell_unit(r.x // scale, r.z // scale, 417) if scale else plain_address(pattern, r.palette, r.x, r.z, 417)
        assert r.u == pytest.approx(u, abs=1e-12) and r.block == next(b for b, lo, hi in ranges if lo <= u < hi)


def test_shares_of_a_preset(spark):
    lattice = spark.range(180 * 180).select((F.col("id") % 180).alias("x"), F.floor(F.col("id") / 180).alias("z"), F.lit("weathered_asphalt").alias("palette"))
    n = {r.block: r["count"] / 180**2 for r in M.drawn_blocks(lattice, 771).groupBy("block").count().collect()}
    assert all(abs(n[f"minecraft:{b}"] - s) < 0.02 for b, s in (("gray_wool", 0.45), ("gray_concrete", 0.3), ("light_gray_concrete", 0.15), ("andesite", 0.1)))


@pytest.mark.parametrize(
    ("text", "rgb", "want"),
    [
        ("natural_rock", None, "natural_rock"), ("Asphalt", None, "weathered_asphalt"), ("asphalt", (30, 30, 30), "fresh_black_asphalt"), ("asphalt", (160, 160, 160), "light_asphalt"), ("asphalt", (150, 90, 90), "red_tarmac"), ("tarmac", (160, 160, 160), "weathered_asphalt"),
        ("Paving-Stones", (170, 150, 100), "buff_paving"), ("paving stones", None, "grey_block_paving"), ("block_paving", (140, 80, 80), "red_block_paving"), ("resin drive", (180, 150, 100), "resin_bound_beige"), ("resin", None, "resin_bound_grey"), ("setts", None, "cobblestone"),
        ("sandstone garden wall", None, "sandstone_wall"), ("rockwork", None, "artificial_themed_rock"), ("a dark rock", None, "dark_rockwork"), ("fresh tarmac", None, "fresh_black_asphalt"), ("terrazzo", None, None), ("", None, None), (None, None, None),
    ],
)
def test_presets_by_words_and_colour(spark, text, rgb, want):
    r, g, b = rgb or (None, None, None)
    row = spark.createDataFrame([(text, r, g, b)], "t string, r int, g int, b int").select(M.preset_of(F.col("t"), F.col("r"), F.col("g"), F.col("b")).alias("p")).first()
    assert row.p == want


def test_precedence_of_presets_recipes_and_primary(spark):
    rows = [(1, 2, t, None, None, None, "minecraft:glass") for t in ("brick", "resin bonded", "terrazzo", None, "old-asphalt", "jungle")]
    got = {r.surface: (r.palette, r.block) for r in M.surface_blocks(spark.createDataFrame(rows, "x int, z int, surface string, r int, g int, b int, primary string"), 3).collect()}
    assert got["brick"][0] == "old_brick_wall" and got["resin bonded"][0] == "resin_bound_grey" and got["terrazzo"] == (None, "minecraft:glass") == got[None] and got["old-asphalt"][0] == "weathered_asphalt"
    recipe = spark.createDataFrame([("old_asphalt",), ("Stone",), ("lawn",), ("x",)], "t string").select(M.recipe_of(F.col("t")).alias("r"))
    assert [r.r for r in recipe.collect()] == ["recipe:weathered_asphalt", "recipe:stone", "recipe:healthy_lawn", None]


# -- placing -----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", [1, 2])
def test_spaced_equals_an_ordered_pass(spark, seed):
    draw = random.Random(seed)
    rows = [(f"c{i}", draw.randrange(4), draw.uniform(0, 30), draw.uniform(0, 30), draw.randrange(5), i) for i in range(500)]
    rows += [(f"d{i}", 9, float(i), 0.0, i, i) for i in range(60)]  # a chain in order, the worst case for rounds
    frame = spark.createDataFrame([(*r[:4], 3.0, *r[4:], "k") for r in rows] + [("n", None, 1.0, 1.0, 3.0, 0, 0, "k"), ("m", 1, None, 1.0, 3.0, 0, 0, "k")], "id string, g int, x double, y double, spacing double, score int, pos int, u string")
    seen = []
    got = sorted((r.g, r.place, r.id) for r in V.spaced(frame, "g", ["score", "pos"], F.lit(25), seen=seen).collect())
    want, places = [], {}
    for i, g, x, y, _, _ in sorted(rows, key=lambda r: (r[4], r[5])):
        taken = places.setdefault(g, [])
        if len(taken) < 25 and all((x - a) ** 2 + (y - b) ** 2 >= 9 for a, b in taken):
            taken.append((x, y))
            want.append((g, len(taken), i))
    assert got == sorted(want) and seen == sorted(seen, reverse=True)
    assert V.spaced(frame.where("false"), "g", ["score", "pos"]).count() == 0


def test_cover_target(spark):
    rows = spark.createDataFrame([(200, 3.0, None), (10, 1.0, None), (200, 3.0, 7), (200, 0.0, None), (200, None, None), (200, None, 4)], "e int, d double, x int")
    assert [r.t for r in rows.select(V.cover_target(F.col("e"), F.col("d"), F.col("x")).alias("t")).collect()] == [6, 1, 7, 0, 0, 4]


# -- pixels ------------------------------------------------------------------------------------------------------


def plain_lab(rgb):
    lin = [v / 255 / 12.92 if v / 255 <= 0.04045 else ((v / 255 + 0.055) / 1.055) ** 2.4 for v in rgb]
    xyz = [sum(a * b for a, b in zip(m, lin, strict=True)) / w for m, w in (((0.4124, 0.3576, 0.1805), 0.95047), ((0.2126, 0.7152, 0.0722), 1.0), ((0.0193, 0.1192, 0.9505), 1.08883))]
    f = [v ** (1 / 3) if v > 216 / 24389 else (24389 / 27 * v + 16) / 116 for v in xyz]
    return 116 * f[1] - 16, 500 * (f[0] - f[1]), 200 * (f[1] - f[2])


def test_lab_of_known_colours(spark):
    colours = [(255.0, 255.0, 255.0), (0.0, 0.0, 0.0), (255.0, 0.0, 0.0), (12.0, 200.0, 90.0)]
    for r in spark.createDataFrame(colours, "r double, g double, b double").select("r", "g", "b", X.rgb_to_lab(F.col("r"), F.col("g"), F.col("b")).alias("lab")).collect():
        assert r.lab == pytest.approx(plain_lab((r.r, r.g, r.b)), abs=1e-9)
    assert plain_lab((255, 0, 0)) == pytest.approx((53.24, 80.09, 67.2), abs=0.05)


def test_pixels_are_classified_and_refined(spark):
    draw = random.Random(5)
    cells = {(i, j): tuple(float(base + draw.randint(-6, 6)) for base in draw.choice([(96, 94, 92), (100, 96, 95), (90, 160, 80), (140, 110, 90), (100, 100, 98)])) for i in range(12) for j in range(12)}
    cells[0, 0] = None
    prototypes, seeds = [(96.0, 94.0, 92.0, 0.9), (96.0, 94.0, 92.0, 0.1), (150.0, 90.0, 200.0, 1.0)], {(3, 3), (5, 5)}
    frame = spark.createDataFrame([(i, j, *(c or (None,) * 3)) for (i, j), c in cells.items()], "row int, col int, r double, g double, b double")
    found = X.classified(frame, prototypes, 20.0, 0.62)
    first = {(r.row, r.col): r for r in found.collect()}
    green = lambda c: (c[1] - (c[0] + c[2]) / 2) / 255 > 0.08
    for at, c in cells.items():
        if c is None:
            assert at not in first
            continue
        near = [cells.get((at[0] + a, at[1] + b)) for a, b in X.TEXTURE]
        near = [math.dist(plain_lab(c), plain_lab(n)) for n in near if n and not green(n)]
        texture = sum(near) / len(near) if near else 30
        d, k = min((math.dist(plain_lab(c), plain_lab(p[:3])), k) for k, p in enumerate(prototypes))
        sure = 0.12 + 0.62 * max(0, 1 - d / 20) + 0.16 * min(1, max(0, 1 - texture / 28)) + 0.1 * prototypes[k][3]
        r = first[at]
        assert r.eligible == (not green(c)) and (green(c) or r.texture == pytest.approx(texture, abs=1e-3))
        assert (r.prototype == k) == (not green(c) and d <= 20 and sure >= 0.62)
        if r.prototype >= 0:
            assert r.prototype == 0 and r.confidence == math.floor(sure * 255 + 0.5) and not r.independent
    marks = spark.createDataFrame([(*s, True) for s in seeds], "row int, col int, seed boolean")
    for r in X.refined(found.join(marks, ["row", "col"], "left")).collect():
        own = first[r.row, r.col]
        near = [n for a, b in X.AROUND if (n := first.get((r.row + a, r.col + b))) and n.candidate]
        grown = not own.candidate and own.eligible and len(near) >= 6
        assert r.candidate == (grown or own.candidate and (len(near) > 1 or (r.row, r.col) in seeds)) and r.neighbours == len(near)
        if grown:
            known = [n.prototype for n in near if n.prototype >= 0]
            assert r.prototype == (min(set(known), key=lambda k: (-known.count(k), k)) if known else -1) and r.independent == (not known)
            assert r.confidence == math.floor(sum(n.confidence for n in near) / len(near) + 0.5)
