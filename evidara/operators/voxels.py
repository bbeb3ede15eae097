"""Operations on blocks of a voxel world: clipping by chunk, column tops, and a registry of block names with dense ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidara.session import cut, drop

CHUNK = 16


def clipped(operations: DataFrame, bounds: tuple[int, int, int, int]) -> DataFrame:
    """The operations of chunks (chunk_x, chunk_z) within (least x, least z, most x, most z), both ends included."""
    return operations.where(F.col("chunk_x").between(bounds[0], bounds[2]) & F.col("chunk_z").between(bounds[1], bounds[3]))


def column_tops(operations: DataFrame) -> DataFrame:
    """(chunk_x, chunk_z, x, z, height, block): the top block of each column that an operation reaches, x and z within the chunk.

    operations: chunk_x, chunk_z, priority, pos, x1, y1, z1, x2, y2, z2, block, corners in any order. The part of an operation outside its chunk
    doesn't count. The highest end of an operation is the column's height; where several reach it, the highest priority, then the last
    position gives the block. An operation fills 256 columns at most.

    Operations are sent to their chunk as they are, where they get ranks; columns are formed there, 16 of a row at once, and never shuffled.
    """
    within = lambda a, b: (F.greatest(F.lit(0), F.least(a, b)), F.least(F.lit(CHUNK - 1), F.greatest(a, b)))
    inside = operations.where(f"greatest(x1, x2) >= 0 AND least(x1, x2) < {CHUNK} AND greatest(z1, z2) >= 0 AND least(z1, z2) < {CHUNK}")
    names = registry(inside)
    (x0, x1), (z0, z1) = within("x1", "x2"), within("z1", "z2")
    sent = inside.join(names, "block", "left").select("chunk_x", "chunk_z", "priority", "pos", F.greatest("y1", "y2").alias("top"), x0.alias("x0"), x1.alias("x1"), z0.alias("z0"), z1.alias("z1"), F.coalesce(F.col("id") + 1, F.lit(0)).alias("name"))
    # a rank with the name's number in one whole number, so that the greatest names the block
    place = F.row_number().over(Window.partitionBy("chunk_x", "chunk_z").orderBy("top", "priority", "pos")).cast("bigint")
    rows = sent.withColumn("won", place * (1 << 32) + F.col("name")).withColumn("x", F.explode(F.sequence("x0", "x1")))
    held = lambda z, v: F.max(F.when(F.lit(z).between(F.col("z0"), F.col("z1")), F.col(v)))
    tops = rows.groupBy("chunk_x", "chunk_z", "x").agg(*(held(z, v).alias(f"{v}{z}") for z in range(CHUNK) for v in ("won", "top")))
    cells = tops.select("chunk_x", "chunk_z", "x", F.explode(F.array(*(F.struct(F.lit(z).alias("z"), F.col(f"top{z}").alias("height"), F.col(f"won{z}").alias("won")) for z in range(CHUNK)))).alias("c")).where("c.won IS NOT NULL")
    cells = cells.select("chunk_x", "chunk_z", "x", "c.z", "c.height", (F.pmod("c.won", F.lit(1 << 32)) - 1).alias("id"))
    return cells.join(names, "id", "left").select("chunk_x", "chunk_z", "x", "z", "height", "block")


def registry(names: DataFrame, name: str = "block") -> DataFrame:
    """(name, id): dense ids from 0 in order of name, worked out range by range, so that no task orders all names. Null names have none."""
    found = names.select(name).where(F.col(name).isNotNull()).distinct()
    ranged = cut(found.repartitionByRange(name).withColumn("part", F.spark_partition_id()))
    sizes = ranged.groupBy("part").agg(F.count("*").alias("n"))
    # one row for each range
    before = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    numbered = ranged.withColumn("k", F.row_number().over(Window.partitionBy("part").orderBy(name)) - 1).join(F.broadcast(before), "part")
    made = cut(numbered.select(name, (F.col("k") + F.col("before")).cast("bigint").alias("id")))
    drop(ranged)
    return made


def unknown_blocks(used: DataFrame, known: DataFrame, name: str = "block") -> DataFrame:
    """(name, n, valid): names that are used but not known, with their uses, and whether they could be a block's name at all."""
    counts = used.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n"))
    return counts.join(known.select(name).distinct(), name, "left_anti").withColumn("valid", F.rlike(F.col(name), F.lit("^minecraft:[a-z0-9_]+$")))
