"""Greedy placing of things at a least distance from each other, as rounds of local minima.

An ordered pass takes a candidate unless an earlier one that was taken is too near. Whether a candidate is taken depends on its earlier
neighbours alone, so in each round all candidates without an undecided earlier neighbour are taken at once and their later neighbours
left out; the result is that of the ordered pass. With orders that hash decides, rounds grow with the logarithm of the rows. Groups of few
candidates need no pairs: a fold over their ordered candidates is the pass itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidara.operators.spatial import cells_around
from evidara.session import cut, drop, large


def earlier_neighbours(candidates: DataFrame, group: str, order: list[str], spacing: str = "spacing") -> DataFrame:
    """(u, v): the candidates v of the same group before u in order and nearer than the group's spacing, found by cells as wide as that."""
    size = F.col(spacing).cast("double")
    cells = F.explode(cells_around(F.col("x"), F.col("y"), size))
    a = candidates.select(F.col(group).alias("__g"), F.col("id").alias("u"), "x", "y", size.alias("__s"), F.struct(*order).alias("o"), cells.alias("c"))
    b = candidates.select(F.col(group).alias("__g"), F.col("id").alias("v"), F.col("x").alias("x2"), F.col("y").alias("y2"), F.struct(*order).alias("o2"), F.struct(F.floor(F.col("x") / size).alias("cx"), F.floor(F.col("y") / size).alias("cy")).alias("c"))
    dx, dy = F.col("x") - F.col("x2"), F.col("y") - F.col("y2")
    return a.join(large(b), ["__g", "c"]).where((F.col("o2") < F.col("o")) & (dx * dx + dy * dy < F.col("__s") * F.col("__s"))).select("u", "v")


def passed(rows: DataFrame, group: str, order: list[str], target: Column | None, spacing: str) -> DataFrame:
    """`spaced` for groups that fit into a row each: the ordered pass as a fold, which ends when no row of the group may have a later place."""
    most = F.lit((1 << 31) - 1).cast("bigint") if target is None else target.cast("bigint")
    listed = rows.groupBy(F.col(group).alias("__g")).agg(F.sort_array(F.collect_list(F.struct(F.struct(*order).alias("o"), F.struct(*rows.columns).alias("r"), most.alias("t")))).alias("__all"), F.max(most).alias("__most"), F.max(F.col(spacing).cast("double")).alias("__s"))

    def step(taken: Column, c: Column) -> Column:
        apart = lambda t, axis: (t["r"][axis] - c["r"][axis]) * (t["r"][axis] - c["r"][axis])
        near = F.exists(taken, lambda t: apart(t, "x") + apart(t, "y") < F.col("__s") * F.col("__s"))
        return F.when((F.size(taken) >= F.col("__most")) | near, taken).otherwise(F.concat(taken, F.array(c)))

    taken = listed.select(F.posexplode_outer(F.aggregate("__all", F.slice("__all", F.lit(1), F.lit(0)), step)).alias("place", "c")).where("c IS NOT NULL")
    return taken.where(F.col("place") + 1 <= F.col("c.t")).select(*(F.col(f"c.r.{c}").alias(c) for c in rows.columns), (F.col("place") + 1).alias("place"))


def spaced(candidates: DataFrame, group: str, order: list[str], target: Column | None = None, spacing: str = "spacing", seen: list[int] | None = None, small: int = 0) -> DataFrame:
    """The candidates that an ordered pass takes in each group, with `place`: 1, 2, ... in order; at most `target` of a group.

    candidates: id (unique), `group`, x, y, `spacing` (over 0, the same in a group) and the columns of `order`, which differ within a group.
    Taken is what no taken earlier candidate of the group is nearer to than the spacing. Rows with a null id, group, place or spacing are left out.
    Groups of at most `small` candidates are passed by a fold, one group in a row, all others in rounds. `seen` gets the number of undecided
    pairs of each round, for tests.
    """
    rows = candidates.where(" AND ".join(f"{c} IS NOT NULL" for c in ("id", group, "x", "y", spacing)))
    if small > 0:
        crowded = cut(rows.groupBy(group).agg(F.count("*").alias("__n")).where(F.col("__n") > small).select(group))
        if crowded.isEmpty():
            drop(crowded)
            return passed(rows, group, order, target, spacing)
        fold = passed(rows.join(large(crowded), group, "left_anti"), group, order, target, spacing)
        rounds = spaced(rows.join(large(crowded), group, "left_semi"), group, order, target, spacing, seen)
        return fold.unionByName(rounds).select(*rows.columns, "place")
    pairs = cut(earlier_neighbours(rows, group, order, spacing))
    gone: list[DataFrame] = []
    open_pairs = pairs
    while not open_pairs.isEmpty():
        if seen is not None:
            seen.append(open_pairs.count())
        waiting = open_pairs.select("u").distinct()
        # a pair's earlier end that waits for none is taken, so its later ends go
        left_out = cut(open_pairs.join(large(waiting.withColumnRenamed("u", "v")), "v", "left_anti").select("u").distinct())
        gone.append(left_out)
        rest = open_pairs.join(large(left_out), "u", "left_anti").join(large(left_out.withColumnRenamed("u", "v")), "v", "left_anti").select("u", "v")
        before, open_pairs = open_pairs, cut(rest)
        drop(before)
    drop(open_pairs)
    taken = rows
    if gone:
        out = gone[0]
        for more in gone[1:]:
            out = out.union(more)
        taken = rows.join(large(out.withColumnRenamed("u", "id")), "id", "left_anti")
    placed = taken.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return placed if target is None else placed.where(F.col("place") <= target)


def cover_target(eligible: Column, density: Column, explicit: Column) -> Column:
    """How many plants an area gets: the explicit count if it's a positive whole number, else its density a 100 cells, one at least; 0 without either."""
    counted = F.greatest(F.lit(1), F.floor(eligible * density / 100 + 0.5))
    return F.when(explicit > 0, explicit).when(density > 0, counted).otherwise(0).cast("bigint")
