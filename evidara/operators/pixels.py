"""Pixels of a grid classified by colour prototypes, local texture and their own evidence, and a mask refined by neighbour counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidara.functions import scalars as S

#: Steps to the eight cells around one, and to those whose colours make up its texture.
AROUND = tuple((a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b)
TEXTURE = ((0, -1), (0, 1), (-1, 0), (1, 0), (-1, -1), (1, 1))


def rgb_to_lab(r: Column, g: Column, b: Column) -> Column:
    """CIE L*a*b* of an sRGB colour of 0-255 under D65, as an array."""
    linear = lambda v: F.when(v <= 0.04045 * 255, v / 255 / 12.92).otherwise(F.pow((v / 255 + 0.055) / 1.055, 2.4))
    lr, lg, lb = linear(r), linear(g), linear(b)
    x, y, z = (0.4124 * lr + 0.3576 * lg + 0.1805 * lb) / 0.95047, 0.2126 * lr + 0.7152 * lg + 0.0722 * lb, (0.0193 * lr + 0.1192 * lg + 0.9505 * lb) / 1.08883
    bent = lambda v: F.when(v > 216 / 24389, F.pow(v, F.lit(1 / 3))).otherwise((24389 / 27 * v + 16) / 116)
    return F.transform(F.array(F.array(bent(x), bent(y), bent(z))), lambda f: F.array(116 * f[1] - 16, 500 * (f[0] - f[1]), 200 * (f[1] - f[2])))[0]


def delta(a: Column, b: Column) -> Column:
    """The distance of two colours in L*a*b*."""
    return F.sqrt(F.pow(a[0] - b[0], 2) + F.pow(a[1] - b[1], 2) + F.pow(a[2] - b[2], 2))


def vegetated(r: Column, g: Column, b: Column) -> Column:
    """Whether a colour is clearly green (our rule)."""
    return (g - (r + b) / 2) / 255 > 0.08


def hardscape_confidence(r: Column, g: Column, b: Column, texture: Column, gsd: float) -> Column:
    """How sure a colour and its texture look like paving by themselves; 0 if they don't. The limits are fixed values."""
    top = F.greatest(r, g, b)
    saturation = F.when(top > 0, (top - F.least(r, g, b)) / F.greatest(top, F.lit(1.0))).otherwise(0.0)
    light = (0.2126 * r + 0.7152 * g + 0.0722 * b) / 255
    out = (light < 0.07) | (light > 0.9) | ((g - (r + b) / 2) / 255 > 0.055) | ((b - (r + g) / 2) / 255 > 0.09)
    warm = (r > g * 1.04) & (g > b * 1.03) & (saturation <= 0.5) & (light >= 0.16) & (light <= 0.72)
    sure = 0.54 + 0.18 * S.clamp(1 - saturation / 0.34, 0.0, 1.0) + 0.13 * S.clamp(1 - F.greatest(F.lit(0.0), texture - 30) / 32, 0.0, 1.0) + 0.1 * max(0.3, min(1.0, 1 - (gsd - 0.15) / 1.1))
    sure = sure + F.when(warm, 0.06).otherwise(0.0) + F.when((light >= 0.14) & (light <= 0.78), 0.04).otherwise(0.0)
    return F.when(out, 0.0).otherwise(S.half_up(S.clamp(sure, 0.0, 0.96) + 1e-9, 3))


def shifted(cells: DataFrame, steps: tuple[tuple[int, int], ...], *columns: str) -> DataFrame:
    """(row, col, columns): every cell's columns at each cell that sees it by one of the steps."""
    s = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in steps)))
    return cells.withColumn("__s", s).select((F.col("row") - F.col("__s.a")).alias("row"), (F.col("col") - F.col("__s.b")).alias("col"), *columns)


def classified(cells: DataFrame, prototypes: list[tuple[float, float, float, float]], threshold: float, least: float, independent: float = 0.78, gsd: float = 0.35, whole: bool = True) -> DataFrame:
    """Cells (row, col, r, g, b) with eligible, texture, candidate, independent, prototype (-1: none) and confidence (0-255).

    `prototypes` are few colours with the confidence of their source; the nearest in L*a*b* counts, of equally near ones the first. A cell
    is a candidate if its prototype is within `threshold` and its confidence, of 0.12 + 0.62 colour + 0.16 texture + 0.1 source, is `least` or more; else, if
    `whole`, on its own evidence from `independent` on. Texture is the mean distance to the six sampled neighbours that aren't
    vegetated, 30 without any. Vegetated cells, and those without a colour, aren't eligible. Cells are unique by place.
    """
    threshold = max(4.0, threshold)
    seen = cells.where("r IS NOT NULL AND g IS NOT NULL AND b IS NOT NULL").withColumn("__lab", rgb_to_lab(F.col("r"), F.col("g"), F.col("b"))).withColumn("eligible", ~vegetated(F.col("r"), F.col("g"), F.col("b")))
    near = shifted(seen.where("eligible"), TEXTURE, F.col("__lab").alias("__other"))
    own = seen.where("eligible").select("row", "col", "__lab").join(near, ["row", "col"])
    # sums of whole thousandths don't depend on their order
    texture = own.groupBy("row", "col").agg((F.sum(F.floor(delta(F.col("__lab"), F.col("__other")) * 1000 + 0.5)) / F.count("*") / 1000).alias("texture"))
    made = seen.join(texture, ["row", "col"], "left").withColumn("texture", F.coalesce("texture", F.lit(30.0)))
    if prototypes:
        known = F.array(*(F.struct(rgb_to_lab(*(F.lit(float(v)) for v in p[:3])).alias("lab"), F.lit(min(1.0, max(0.0, p[3]))).alias("sure"), F.lit(k).alias("k")) for k, p in enumerate(prototypes)))
        made = made.withColumn("__best", F.array_min(F.transform(known, lambda p: F.struct(delta(F.col("__lab"), p["lab"]).alias("d"), p["k"].alias("k"), p["sure"].alias("sure")))))
        distance, source, k = F.col("__best.d"), F.col("__best.sure"), F.col("__best.k")
        sure = 0.12 + 0.62 * S.clamp(1 - distance / threshold, 0.0, 1.0) + 0.16 * S.clamp(1 - F.col("texture") / 28, 0.0, 1.0) + 0.1 * source
        hit = F.col("eligible") & (distance <= threshold) & (sure >= least)
    else:
        sure, hit, k = F.lit(0.0), F.lit(False), F.lit(-1)
    alone = hardscape_confidence(F.col("r"), F.col("g"), F.col("b"), F.col("texture"), gsd)
    lone = F.col("eligible") & ~hit & F.lit(whole) & (alone >= independent)
    byte = lambda v: F.floor(S.clamp(v, 0.0, 1.0) * 255 + 0.5).cast("int")
    return made.select("row", "col", "r", "g", "b", "eligible", "texture", (hit | lone).alias("candidate"), lone.alias("independent"), F.when(hit, k).otherwise(-1).alias("prototype"), F.when(hit, byte(sure)).when(lone, byte(alone)).otherwise(0).alias("confidence"))


def refined(cells: DataFrame, fill: int = 6, spur: int = 1) -> DataFrame:
    """`classified` cells after one step of a cellular rule over the eight neighbours; `seed` marks cells that stay.

    An eligible cell that is no candidate becomes one if `fill` or more neighbours are candidates (our limit): its confidence is their mean, its
    prototype the most frequent of theirs, of equally frequent ones the smallest, and it is independent if none has one. A candidate with `spur`
    neighbours or fewer goes unless it's a seed.
    """
    near = shifted(cells.where("candidate"), AROUND, "confidence", "prototype")
    counts = near.groupBy("row", "col", "prototype").agg(F.count("*").alias("n"), F.sum("confidence").alias("s"))
    # at most one row of each prototype and cell is left
    best = F.max_by("prototype", F.when(F.col("prototype") >= 0, F.struct("n", (-F.col("prototype")).alias("k"))))
    around = counts.groupBy("row", "col").agg(F.sum("n").alias("__n"), F.sum("s").alias("__s"), best.alias("__p"))
    made = cells.join(around, ["row", "col"], "left").withColumn("neighbours", F.coalesce("__n", F.lit(0)).cast("int"))
    grown = ~F.col("candidate") & F.col("eligible") & (F.col("neighbours") >= fill)
    kept = F.col("candidate") & ((F.col("neighbours") > spur) | F.coalesce(F.col("seed"), F.lit(False)))
    return made.select(
        "row", "col", "eligible", "texture", "neighbours", (grown | kept).alias("candidate"), F.when(grown, F.col("__p").isNull()).otherwise(F.col("independent")).alias("independent"),
        F.when(grown, F.coalesce("__p", F.lit(-1))).otherwise(F.col("prototype")).alias("prototype"), F.when(grown, F.floor(F.col("__s") / F.col("__n") + 0.5).cast("int")).otherwise(F.col("confidence")).alias("confidence"),
    )
