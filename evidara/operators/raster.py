"""Cell grids: painting, edges, distances, connected cells, and hashes of cells."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidara.operators.graph import connected_components
from evidara.session import cut, drop

SIDES = ((0, 1), (1, 0), (0, -1), (-1, 0))


def painted(layers: DataFrame) -> DataFrame:
    """(row, col, code) of (row, col, code, priority, pos): the row of highest priority, then of last place, paints a cell."""
    return layers.groupBy("row", "col").agg(F.max_by("code", F.struct("priority", "pos")).alias("code"))


def with_edges(cells: DataFrame) -> DataFrame:
    """Cells with `edge`: whether a 4-neighbour is missing."""
    shifts = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in SIDES))
    seen = cells.select("row", "col", F.explode(shifts).alias("s")).select((F.col("row") + F.col("s.a")).alias("row"), (F.col("col") + F.col("s.b")).alias("col"))
    return cells.join(seen.groupBy("row", "col").agg(F.count("*").alias("__n")), ["row", "col"], "left").withColumn("edge", F.coalesce("__n", F.lit(0)) < 4).drop("__n")


def neighbours(cells: DataFrame) -> DataFrame:
    """Edges (u, v) between 4-neighbours by their `id`."""
    out = None
    for a, b in SIDES[:2]:
        other = cells.select((F.col("row") - a).alias("row"), (F.col("col") - b).alias("col"), F.col("id").alias("v"))
        one = cells.select("row", "col", F.col("id").alias("u")).join(other, ["row", "col"]).select("u", "v")
        out = one if out is None else out.union(one)
    return out


def connected_cells(cells: DataFrame) -> DataFrame:
    """(id, component) for 4-connected cells (id, row, col); a lone cell is its own component."""
    found = connected_components(neighbours(cells)).withColumnRenamed("node", "id")
    return cells.select("id").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))


#: Side of the blocks within which distances are worked out at once.
SIDE = 64
FAR = (1 << 31) - 1


def _settled(frame: pd.DataFrame) -> pd.DataFrame:
    """One block's cells with `distance` lowered to what the block's own cells give, and `edge`: cells at the block's border that changed."""
    r, c = (frame["row"] % SIDE).to_numpy(), (frame["col"] % SIDE).to_numpy()
    known = np.full((SIDE + 2, SIDE + 2), -1, np.int64)  # the cell's place in the frame, -1 where there's none
    known[r + 1, c + 1] = np.arange(len(frame))
    before = frame["distance"].to_numpy()
    now = before.copy()
    front = np.flatnonzero(frame["fresh"].to_numpy())
    levels: dict[int, list[np.ndarray]] = {}
    for d in np.unique(now[front]):
        levels[int(d)] = [front[now[front] == d]]
    d = min(levels, default=FAR)
    while levels:
        if d not in levels:
            d = min(levels)
        at = np.unique(np.concatenate(levels.pop(d)))
        at = at[now[at] == d]
        near = np.unique(np.concatenate([known[r[at] + 1 + a, c[at] + 1 + b] for a, b in SIDES]))
        near = near[near >= 0]
        near = near[now[near] > d + 1]
        if len(near):
            now[near] = d + 1
            levels.setdefault(d + 1, []).append(near)
        d += 1
    border = (r == 0) | (r == SIDE - 1) | (c == 0) | (c == SIDE - 1)
    return frame.assign(distance=now.astype(np.int32), edge=border & ((now < before) | (frame["fresh"].to_numpy() & (now < FAR))), fresh=False)


def distance_to_mask(cells: DataFrame, rounds: list[int] | None = None) -> DataFrame:
    """(id, distance) of (id, row, col, mask): steps between 4-neighbours to the nearest cell of the mask, 65535 if none is reached.

    Cells are dealt to square blocks; a block settles all of its distances at once, and only border cells that changed are offered to
    the blocks beside theirs, until no offer lowers a distance. Rounds grow with the blocks that a way crosses, not with its steps.
    Places are unique; a null mask is none. `rounds` gets the number of blocks settled in each round, for tests.
    """
    names = "id", "row", "col", "distance", "fresh", "edge"
    kinds = f"id {cells.schema['id'].dataType.simpleString()}, row long, col long, distance int, fresh boolean, edge boolean"
    block = [F.floor(F.col("row") / SIDE).alias("block_row"), F.floor(F.col("col") / SIDE).alias("block_col")]
    settle = lambda df: df.groupBy(*block).applyInPandas(_settled, kinds)
    mask = F.coalesce("mask", F.lit(False))
    start = cells.select("id", F.col("row").cast("long"), F.col("col").cast("long"), F.when(mask, 0).otherwise(FAR).alias("distance"), mask.alias("fresh"), F.lit(False).alias("edge"))
    now = cut(settle(start))
    while True:
        # a border cell's neighbours within its own block gain nothing from the offer, so they need no test
        shifts = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in SIDES)))
        offers = now.where("edge").withColumn("s", shifts).select((F.col("row") + F.col("s.a")).alias("row"), (F.col("col") + F.col("s.b")).alias("col"), (F.col("distance") + 1).alias("offer"))
        offers = offers.groupBy("row", "col").agg(F.min("offer").alias("offer"))
        better = cut(now.join(offers, ["row", "col"]).where("offer < distance").select("row", "col", "offer"))
        touched = cut(better.select(*block).distinct())
        count = touched.count()
        if rounds is not None:
            rounds.append(count)
        if not count:
            drop(better, touched)
            return now.select("id", F.when(F.col("distance") >= 65535, 65535).otherwise(F.col("distance")).alias("distance"))
        keyed = now.withColumns({"block_row": F.floor(F.col("row") / SIDE), "block_col": F.floor(F.col("col") / SIDE)})
        rest = keyed.join(touched, ["block_row", "block_col"], "left_anti").select("id", "row", "col", "distance", F.lit(False).alias("fresh"), F.lit(False).alias("edge"))
        some = keyed.join(touched, ["block_row", "block_col"], "left_semi").join(better, ["row", "col"], "left")
        some = some.select("id", "row", "col", F.least("distance", F.coalesce("offer", "distance")).alias("distance"), F.col("offer").isNotNull().alias("fresh"), F.lit(False).alias("edge"))
        before, now = now, cut(rest.select(*names).union(settle(some)))
        drop(before, better, touched)


def cell_hash(x: Column, y: Column, seed: Column) -> Column:
    """An unsigned 32-bit number from integer cell coordinates: FNV-1a over the three values' lower 16 bits."""
    h = F.lit(2166136261).cast("bigint")
    for v in (x, y, seed):
        h = (h.bitwiseXOR(v.cast("bigint").bitwiseAND(F.lit(65535))) * 16777619).bitwiseAND(F.lit(4294967295))
    return h

