"""Distances to a mask by blocks against a plain search."""

import random
from collections import deque

from evidara.operators import raster


def plain(cells, mask):
    found, queue = {c: 0 for c in mask}, deque(mask)
    while queue:
        r, c = queue.popleft()
        for a, b in raster.SIDES:
            n = r + a, c + b
            if n in cells and n not in found:
                found[n] = found[r, c] + 1
                queue.append(n)
    return {c: found.get(c, 65535) for c in cells}


def frame(spark, cells, mask):
    rows = [(r * 1000 + c, r, c, True if (r, c) in mask else None if (r + c) % 2 else False) for r, c in sorted(cells)]
    return spark.createDataFrame(rows, "id long, row int, col int, mask boolean").repartition(3)


def test_distances_match_a_plain_search(spark):
    draw = random.Random(7)
    cells = {(r, c) for r in range(-70, 90) for c in range(-10, 150) if draw.random() < 0.68}
    mask = set(draw.sample(sorted(cells), 3))
    got = {r.id: r.distance for r in raster.distance_to_mask(frame(spark, cells, mask)).collect()}
    assert got == {r * 1000 + c: d for (r, c), d in plain(cells, mask).items()}


def test_a_winding_way_takes_rounds_by_blocks_not_by_steps(spark):
    # one way that goes to and fro over three blocks
    cells = {(r, c) for r in range(0, 60, 2) for c in range(192)} | {(r, 191 if r % 4 == 1 else 0) for r in range(1, 59, 2)}
    rounds = []
    got = {r.id: r.distance for r in raster.distance_to_mask(frame(spark, cells, {(0, 0)}), rounds).collect()}
    want = plain(cells, [(0, 0)])
    assert got == {r * 1000 + c: d for (r, c), d in want.items()}
    assert max(want.values()) > 5000 and len(rounds) < 80
    assert raster.distance_to_mask(frame(spark, cells, set())).where("distance <> 65535").count() == 0
    assert raster.distance_to_mask(frame(spark, cells, {(0, 0)}).where("false")).count() == 0
