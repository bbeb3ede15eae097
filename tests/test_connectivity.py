"""Connected lines, labels of shapes and files of manifests."""

import hashlib
import math
import random

from evidara.operators import spatial
from evidara.operators.graph import line_components
from evidara.sources import readers


def test_line_components(spark):
    lines = {1: [(0, 0), (10, 0), (10, 10)], 2: [(10.2, 10.1), (20, 20)], 3: [(50, 50), (51, 50)], 4: [(51, 50)], 5: [], 6: None, 7: [(0, 0), (10, 0)], 8: [(90, 90), (90.1, 90)]}
    frame = spark.createDataFrame([(i, v and [{"x": float(x), "y": float(y)} for x, y in v]) for i, v in lines.items()], "id int, line array<struct<x:double,y:double>>")
    got = {r.component: tuple(r)[1:] for r in line_components(frame).collect()}
    # the repeated segment of 7 counts as another edge, and a segment within one node is a loop of it
    assert got == {1: (3, False, 4, 4, 1), 3: (2, False, 2, 1, 2), 5: (1, True, 0, 0, 0), 6: (1, True, 0, 0, 0), 8: (1, True, 1, 1, 0)}
    assert line_components(frame.where("false")).count() == 0


def plain_distance(points, closed, x, y):
    sides = list(zip(points, points[1:], strict=False)) + ([(points[-1], points[0])] if closed and len(points) > 2 else [])
    odd = False
    for (ax, ay), (bx, by) in zip(points, points[-1:] + points[:-1], strict=True):
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            odd = not odd
    if closed and odd:
        return 0.0
    best = math.inf
    for (ax, ay), (bx, by) in sides:
        size = (bx - ax) ** 2 + (by - ay) ** 2
        t = max(0, min(1, ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / size)) if size else 0
        best = min(best, math.hypot(ax + t * (bx - ax) - x, ay + t * (by - ay) - y))
    return best


def test_shape_labels_match_all_pairs(spark):
    draw = random.Random(4)
    shapes = {i: ([(draw.uniform(0, 600), draw.uniform(0, 400)) for _ in range(draw.randint(1, 6))], draw.random() < 0.5) for i in range(60)}
    labels = {i: (draw.uniform(0, 600), draw.uniform(0, 400), draw.choice([None, 0, 60, 100])) for i in range(40)}
    a = spark.createDataFrame([(i, [{"x": x, "y": y} for x, y in p], c) for i, (p, c) in shapes.items()] + [(99, [], True)], "shape_id int, points array<struct<x:double,y:double>>, closed boolean")
    b = spark.createDataFrame([(i, 100 - i, *v) for i, v in labels.items()], "label_id int, pos int, x double, y double, priority int")
    got = {r.shape_id: (r.label_id, round(r.distance, 6)) for r in spatial.shape_labels(a, b).collect()}
    want = {}
    for i, (points, closed) in shapes.items():
        near = [(d - 0.08 * (p or 0), 100 - k, k, d) for k, (x, y, p) in labels.items() if (d := plain_distance(points, closed, x, y)) <= 56]
        if near:
            best = min(near)
            want[i] = (best[2], round(best[3], 6))
    assert got == want and len(want) > 20


def test_files_are_checked_against_their_manifest(spark, tmp_path):
    data = {"a.pdf": b"%PDF-1", "b.png": b"\x89PNG", "c.pdf": b"%PDF-2"}
    for name, content in data.items():
        (tmp_path / name).write_bytes(content)
    sha = {n: hashlib.sha256(c).hexdigest() for n, c in data.items()}
    rows = [("u1", "files/a.pdf", 6, sha["a.pdf"].upper()), ("u2", "b.png", 5, sha["b.png"]), ("u3", "x/c.pdf", 6, sha["a.pdf"]), ("u4", "gone.pdf", 1, "f"), ("u5", "a.pdf", None, sha["a.pdf"]), ("u6", None, 1, None)]
    found = readers.file_faults(spark.createDataFrame(rows, "url string, file string, bytes long, sha256 string"), readers.read_files(spark, str(tmp_path)))
    assert {r.url: r.fault for r in found.collect()} == {"u2": "bytes", "u3": "sha256", "u4": "missing", "u5": "bytes", "u6": "missing"}


def test_tables_of_cuts_can_be_released(spark):
    import os

    from evidara.session import cut, drop, release

    a, b = cut(spark.range(3)), cut(spark.range(4))
    paths = [f.cut_path.removeprefix("file:") for f in (a, b)]
    assert a.count() == 3 and all(map(os.path.exists, paths))
    drop(a)
    assert [os.path.exists(p) for p in paths] == [False, True]
    release()
    assert not os.path.exists(paths[1])
