"""Control points, fits, consensus and promotion on pages with known answers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from evidara.operators import registration as R

WORDS = "id int, pos int, text string, x double, y double, x0 double, x1 double"
AREA = (400_000.0, 300_000.0, 420_000.0, 320_000.0)


def word(i, pos, text, x, y):
    return (i, pos, text, float(x), float(y), x - 10.0, x + 10.0)


def ground(x, y, turn=0.0, scale=0.5):
    c, s = math.cos(turn) * scale, math.sin(turn) * scale
    return 405_000 + c * x + s * y, 310_000 + s * x - c * y


def test_labels(spark):
    texts = ["400100", "12,345", " 4 0 0 1 0 0 ", "9999", "1300001", "400100.5", "E400100", "", None, "1:500"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select(R.label_value(F.col("t")).alias("v")).collect()
    assert [r.v for r in rows] == [400100.0, 12345.0, 400100.0, None, None, 400100.5, None, None, None, None]


def test_grid_points_need_repeated_labels_on_both_axes(spark):
    full = [word(1, k, str(v), x, y) for k, (v, x, y) in enumerate([(400000, 100, 10), (400000, 104, 500), (400100, 300, 10), (400100, 300, 500), (310000, 5, 400), (310000, 700, 404), (310100, 5, 200), (310100, 700, 200), (999999, 50, 50)])]
    near = [word(2, k, str(v), x, y) for k, (v, x, y) in enumerate([(400000, 100, 10), (400000, 100, 60), (400100, 300, 10), (400100, 300, 500), (310000, 5, 400), (310000, 700, 400), (310100, 5, 200), (310100, 700, 200)])]
    north = [word(3, k, str(v), x, y) for k, (v, x, y) in enumerate([(800000, 100, 10), (800000, 100, 500), (800100, 300, 10), (800100, 300, 500), (310000, 5, 400), (310000, 700, 400), (310100, 5, 200), (310100, 700, 200)])]
    got = R.grid_points(spark.createDataFrame(full + near + north, WORDS), ["id"]).collect()
    points = sorted((r.swapped, r.x, r.y, r.easting, r.northing) for r in got if r.id == 1)
    plain = [(102.0, 402.0, 400000.0, 310000.0), (102.0, 200.0, 400000.0, 310100.0), (300.0, 402.0, 400100.0, 310000.0), (300.0, 200.0, 400100.0, 310100.0)]
    assert points == sorted([(False, *p) for p in plain] + [(True, x, y, n, e) for x, y, e, n in plain])
    assert not [r for r in got if r.id == 2] and {r.swapped for r in got if r.id == 3} == {True}


def test_pairs_are_neighbours_in_reading_order(spark):
    rows = [word(1, 0, "400000", 100, 100), word(1, 1, "310000", 150, 104), word(1, 2, "400100", 100, 200), word(1, 3, "310000", 150, 200), word(1, 4, "400000", 100, 300), word(1, 5, "310100", 150, 300), word(1, 6, "400300", 100, 400), word(1, 7, "310100", 400, 400)]
    got = R.pair_points(spark.createDataFrame(rows + [word(2, 0, "400000", 1, 1), word(2, 1, "310000", 30, 1)], WORDS), ["id"]).collect()
    assert sorted((r.x, r.y, r.easting, r.northing) for r in got if not r.swapped) == [(125.0, 102.0, 400000.0, 310000.0), (125.0, 200.0, 400100.0, 310000.0), (125.0, 300.0, 400000.0, 310100.0)]
    assert {r.id for r in got} == {1} and sum(r.swapped for r in got) == 3


def candidate(i, points):
    return [(i, "m", False, float(x), float(y), float(e), float(n)) for x, y, e, n in points]


def test_fits_and_their_gates(spark):
    draw = random.Random(3)
    spots = [(draw.uniform(0, 800), draw.uniform(0, 500)) for _ in range(9)]
    rows = candidate(1, [(x, y, *ground(x, y, 0.3)) for x, y in spots]) + candidate(2, [(x, y, *ground(x, y)) for x, y in spots[:2]]) + candidate(3, [(x, x, *ground(x, x)) for x, _ in spots])
    rows += candidate(4, [(x, y, e + draw.uniform(-9, 9), n) for x, y in spots for e, n in [ground(x, y)]]) + candidate(5, [(x, y, 405_000 + 0.5 * x, 310_000 + 4 * y) for x, y in spots]) + candidate(6, [(x, y, 405_000 + x + 0.9 * y, 310_000 + y) for x, y in spots])
    rows += candidate(7, [(x, y, 405_000 + 9 * x, 310_000 + 9 * y) for x, y in spots]) + candidate(8, [(x, y, 100_000 + x, 310_000 + y) for x, y in spots]) + candidate(9, [(x, y, *ground(x, y)) for x, y in spots])
    pages = spark.createDataFrame([(i, None if i == 9 else 842.0, 595.0) for i in range(1, 10)], "id int, width double, height double")
    frame = spark.createDataFrame(rows, "id int, method string, swapped boolean, x double, y double, easting double, northing double").repartition(3)
    fits = R.fitted(frame, ["id", "method", "swapped"], pages, ["id"], AREA)
    got = {r.id: r for r in fits.collect()}
    assert [got[i].reason for i in range(1, 10)] == [None, "fewer-than-three-control-points", "control-points-are-collinear", "control-point-rmse-exceeds-limit", "anisotropic-scale-exceeds-limit", "affine-axes-too-skewed", "extent-exceeds-limit", "outside-of-the-area", "missing-page-dimensions"]
    c, s = math.cos(0.3) / 2, math.sin(0.3) / 2
    assert [got[1][k] for k in "abcdef"] == pytest.approx([c, s, 405_000, s, -c, 310_000], abs=1e-5) and got[1].rmse < 0.01 and got[1].points == 9
    assert [r.id for r in R.best_fits(fits, ["id"]).collect()] == [1]


def test_consensus_takes_the_first_strongest_anchor(spark):
    m = 1 / 111_000
    rows = [("a", 1, 1, "d1", 0.0, 50.0, 0.9), ("a", 2, 2, "d2", 0.0, 50 + 100 * m, 0.9), ("a", 3, 3, "d3", 0.0, 50 + 230 * m, 0.9), ("a", 4, 4, "d4", 0.0, 50 + 90 * m, 0.5), ("a", 5, 5, "d5", 0.0, 50 + 3000 * m, 0.9), ("a", 6, 6, "d6", None, 50.0, 0.9)]
    rows += [("b", 7, 1, "d1", 0.0, 50.0, 0.9), ("b", 8, 2, "d1", 0.0, 50.0, 0.9), ("c", 9, 2, "d1", 0.0, 50.0, 0.9), ("c", 10, 1, "d2", 0.0, 50 + 130 * m, 0.72), ("c", 11, 3, "d2", 0.0, 51.0, 0.9), ("c", 12, 4, "d3", 0.0, 51.0, 0.9)]
    frame = spark.createDataFrame(rows, "app string, id int, pos int, document string, lon double, lat double, confidence double").repartition(3)
    agreed = R.consensus(frame)
    assert sorted(r.id for r in agreed.collect()) == [1, 2, 3, 9, 10]
    docs = spark.createDataFrame([("a", i, "accepted" if i == 1 else "rejected", "embedded" if i == 1 else None) for i in (1, 2, 3, 5)], "app string, id int, status string, method string")
    fits = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("a", 2, "x"), ("a", 3, "x"), ("a", 5, None)], "app string, id int, reason string")
    got = {r.id: (r.status, r.method, r.upgraded) for r in R.promoted(docs, agreed, fits).collect()}
    assert got == {1: ("accepted", "embedded", False), 2: ("accepted", "automatic-linework-consensus", True), 3: ("rejected", None, False), 5: ("rejected", None, False)}
