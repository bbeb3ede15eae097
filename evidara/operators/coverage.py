"""Coverage acquired tile by tile: scaled requests with a retry at native resolution, all or nothing, and one request for all instead."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NATIVE = 1.001


def attempt_fails(role: Column, tolerance: Column, covered: Column, resolution: Column, requested: Column, least: float = 0.85, coarsest: float = 2.0) -> Column:
    """Why a tile's raster isn't taken, or null: its bounds are off, it is too coarse, or too little of it is covered (vegetation needs no cover)."""
    return (
        F.when(resolution.isNull(), "no-raster").when(tolerance > F.greatest(F.lit(2.0), 2.5 * resolution), "bounds-mismatch").when(resolution > F.greatest(F.lit(coarsest), requested * 1.25), "resolution-too-coarse")
        .when(covered < F.when(role == "vom", 0.0).otherwise(least), "too-little-coverage")
    )


def settled_tiles(tiles: DataFrame, attempts: DataFrame, keys: list[str]) -> DataFrame:
    """Tiles (keys, tile, requested) with the attempt that settles each: `used` scaled, native or null, `requests` made, and `reason` of a failed one.

    attempts: keys, tile, kind (scaled or native), error (null if the raster is taken). A native retry follows a scaled request that failed, if a coarser
    resolution than the native one was asked for; a request without an attempt has failed.
    """
    by = lambda kind: attempts.where(F.col("kind") == kind).groupBy(*keys, "tile").agg(F.min(F.struct(F.col("error").isNotNull().alias("bad"), "error")).alias(kind))
    made = tiles.join(by("scaled"), [*keys, "tile"], "left").join(by("native"), [*keys, "tile"], "left")
    ok = lambda kind: F.coalesce(~F.col(f"{kind}.bad"), F.lit(False))
    why = lambda kind: F.coalesce(F.col(f"{kind}.error"), F.lit("no-answer"))
    retried = ~ok("scaled") & (F.col("requested") > NATIVE)
    used = F.when(ok("scaled"), "scaled").when(retried & ok("native"), "native")
    reason = F.when(used.isNull(), F.when(retried, F.concat(F.lit("scaled: "), why("scaled"), F.lit("; native: "), why("native"))).otherwise(why("scaled")))
    return made.select(*tiles.columns, used.alias("used"), F.when(retried, 2).otherwise(1).alias("requests"), reason.alias("reason"))


def bundles(settled: DataFrame, keys: list[str], single: DataFrame) -> DataFrame:
    """A row for each bundle: status tiled, single (one request for all replaced it) or failed, with its tiles, failed tiles, native retries, requests and first reason.

    single: keys, allowed (whether one request may replace a failed bundle), single_ok.
    """
    facts = settled.groupBy(*keys).agg(F.count("*").alias("tiles"), F.count_if(F.col("used").isNull()).alias("failed"), F.count_if(F.col("used") == "native").alias("native"), F.sum("requests").alias("requests"), F.min(F.when(F.col("used").isNull(), F.struct("tile", "reason"))).alias("r"))
    made = facts.join(single, keys, "left")
    one = (F.col("failed") > 0) & F.coalesce("allowed", F.lit(False))
    status = F.when(F.col("failed") == 0, "tiled").when(one & F.coalesce("single_ok", F.lit(False)), "single").otherwise("failed")
    return made.select(*keys, status.alias("status"), "tiles", "failed", F.when(F.col("failed") == 0, F.col("native")).otherwise(0).alias("native"), (F.col("requests") + one.cast("int")).alias("requests"), F.coalesce("r.reason", F.lit("")).alias("reason"))
