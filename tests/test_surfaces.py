"""Painting by spans, tapered lines and overpainting against plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from evidara.operators import scanline

RINGS = "id long, rings array<array<struct<x:double,y:double>>>, key string"


def plain_inside(ring, x, y):
    odd = False
    for (ax, ay), (bx, by) in zip(ring, ring[-1:] + ring[:-1], strict=True):
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            odd = not odd
    return odd


def test_spans_match_points_in_polygons(spark):
    draw = random.Random(6)
    shapes = [(i, [[(draw.uniform(-9, 9), draw.uniform(-9, 9)) for _ in range(draw.randint(3, 9))] for _ in range(draw.randint(1, 3))]) for i in range(40)]
    shapes += [(50, [[(0.5, 0.5), (3.5, 0.5), (3.5, 3.5), (0.5, 3.5)]]), (51, [[(0.0, 0.0), (1.0, 1.0)]]), (52, []), (53, None), (54, [[(0.0, 0.2), (9.0, 0.2), (4.0, 0.3)]]), (55, [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)], [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]])]
    frame = spark.createDataFrame([(i, r and [[{"x": x, "y": y} for x, y in ring] for ring in r], "k") for i, r in shapes], RINGS)
    found = scanline.spans(frame, ["id"]).collect()
    got = {(r.id, r.row, c) for r in found for c in range(r.x1, r.x2 + 1)}
    assert sum(r.x2 - r.x1 + 1 for r in found) == len(got) and all(r.x1 <= r.x2 for r in found)
    want = {(i, y, x) for i, rings in shapes for y in range(-10, 10) for x in range(-10, 11) if sum(plain_inside(ring, x + 0.5, y + 0.5) for ring in rings or [] if len(ring) >= 3) % 2}
    assert got == want
    assert {(r.row, r.col) for r in scanline.filled(scanline.spans(frame.where("id = 50"), ["id"]), ["id"]).collect()} == {(y, x) for _, y, x in want if _ == 50}
    assert scanline.spans(frame.where("false"), ["id"]).count() == 0


def plain_paint(layers):
    cells = {}
    for v in sorted(layers, key=lambda v: (v["priority"], v["pos"])):
        s = cells.setdefault((v["row"], v["col"]), {"code": None, "natural": True, "access": 0, "discovered": False, "path_writes": 0, "plaza_writes": 0, "natural_replaced": 0})
        if v["discovered"] and s["access"]:
            continue
        if not v["bridge"]:
            if v["access"]:
                s["natural_replaced"] = int(s["natural_replaced"] or s["natural"])
                s["path_writes"] += 1
                s["plaza_writes"] += v["plaza"]
            s["code"], s["natural"] = v["code"], v["natural"]
        if v["access"]:
            s["access"] = v["access"]
            s["discovered"] = s["discovered"] or v["discovered"]
    return {k: tuple(v[n] for n in ("code", "access", "discovered", "path_writes", "plaza_writes", "natural_replaced")) for k, v in cells.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_overpainting_matches_an_ordered_pass(spark, seed):
    draw = random.Random(seed)
    flip = lambda: draw.random() < 0.4
    layers = [{"row": draw.randrange(4), "col": draw.randrange(4), "priority": draw.randrange(3), "pos": k, "code": f"c{k}", "access": draw.choice([0, 0, 1, 2]), "discovered": flip(), "bridge": flip(), "plaza": flip(), "natural": flip()} for k in range(150)]
    frame = spark.createDataFrame(layers, "row long, col long, priority int, pos long, code string, access int, discovered boolean, bridge boolean, plaza boolean, natural boolean").repartition(3)
    got = {(r.row, r.col): (r.code, r.access, r.discovered, r.path_writes, r.plaza_writes, r.natural_replaced) for r in scanline.overpainted(frame).collect()}
    assert got == plain_paint(layers)
    left = scanline.overpainted(frame, F.col("row") > 1)
    assert {(r.row, r.col) for r in left.collect()} == {k for k in got if k[0] > 1}


def test_tapered_lines(spark):
    line = [(0.0, 0.0), (3.0, 0.0), (3.0, 5.0)]
    frame = spark.createDataFrame([(1, [{"x": x, "y": y} for x, y in line], 1.0, 5.0), (2, [{"x": 1.0, "y": 1.0}] * 2, 1.0, 2.0), (3, [], 1.0, 2.0), (4, None, 1.0, 2.0)], "id long, line array<struct<x:double,y:double>>, start double, end double")
    pieces = [(r.ax, r.ay, r.bx, r.by, r.width) for r in scanline.tapered_pieces(frame, ["id"]).orderBy("ay", "ax").collect()]
    assert pieces[:2] == [(0.0, 0.0, 1.5, 0.0, 1.0), (1.5, 0.0, 3.0, 0.0, 2.0)] and len(pieces) == 5 and pieces[-1][4] == 5.0
    got = {(r.row, r.col) for r in scanline.line_cells(scanline.tapered_pieces(frame, ["id"]), ["id"]).collect()}

    def near(ax, ay, bx, by, x, y):
        t = max(0.0, min(1.0, ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2)))
        return math.hypot(ax + t * (bx - ax) - x, ay + t * (by - ay) - y)

    assert got == {(y, x) for y in range(-5, 12) for x in range(-6, 12) if any(near(*p[:4], x + 0.5, y + 0.5) <= p[4] / 2 for p in pieces)}
