"""SVG drawings with nested groups and path data against a plain reader in Python."""

import math
import re

import pytest

from evidara.operators import drawings as D
from evidara.operators import junctions as J


def plain_numbers(text):
    return [float(v) for v in re.findall(D.NUMBER, text)]


def mul(m, n):
    return (m[0] * n[0] + m[2] * n[1], m[1] * n[0] + m[3] * n[1], m[0] * n[2] + m[2] * n[3], m[1] * n[2] + m[3] * n[3], m[0] * n[4] + m[2] * n[5] + m[4], m[1] * n[4] + m[3] * n[5] + m[5])


def plain_transform(text):
    out = (1, 0, 0, 1, 0, 0)
    for kind, inner in re.findall(r"(?i)(matrix|translate|scale|rotate)\s*\(([^)]*)\)", text or ""):
        n = plain_numbers(inner)
        r = math.radians(n[0]) if n else 0
        c, s = math.cos(r), math.sin(r)
        one = {"matrix": n, "translate": (1, 0, 0, 1, n[0], n[1] if len(n) > 1 else 0), "scale": (n[0], 0, 0, n[1] if len(n) > 1 else n[0], 0, 0)}.get(kind.lower()) or mul(mul((1, 0, 0, 1, n[1], n[2]), (c, s, -s, c, 0, 0)), (1, 0, 0, 1, -n[1], -n[2])) if len(n) != 1 or kind.lower() != "rotate" else (c, s, -s, c, 0, 0)
        out = mul(out, one)
    return out


def plain_path(data, tolerance=1.0):
    tokens = re.findall(rf"[a-zA-Z]|{D.NUMBER}", re.sub(r"(?<=[0-9.])[eE](?=[-+]?[0-9])", "e", data or ""))
    parts, pen, begin, control, active, i = [], (0.0, 0.0), None, None, None, 0
    command = None
    while i < len(tokens):
        if tokens[i].isalpha():
            command, i = tokens[i], i + 1
        if command is None or command.upper() not in {*D.TAKES, "Z"}:
            break
        op, rel = command.upper(), command.islower()
        n = tokens[i : i + D.TAKES.get(op, 0)]
        if len(n) < D.TAKES.get(op, 0) or any(v.isalpha() for v in n):
            break
        n, i = [float(v) for v in n], i + len(n)
        at = lambda k: (n[k] + rel * pen[0], n[k + 1] + rel * pen[1])  # noqa: B023, E731
        if op == "M":
            pen = begin = at(0)
            active = [[pen], False, False]
            parts.append(active)
            control, command = None, "l" if rel else "L"
            continue
        if active is None:
            active = [[pen], False, False]
            parts.append(active)
        if op == "Z":
            if begin is not None and math.dist(pen, begin) > 1e-9:
                active[0].append(begin)
            active[1], pen, active, control, command = True, begin or pen, None, None, None
            continue
        if op in "LHVA":
            end = at(0) if op == "L" else at(5) if op == "A" else (n[0] + rel * pen[0], pen[1]) if op == "H" else (pen[0], n[0] + rel * pen[1])
            active[0].append(end)
            active[2] |= op == "A"
            pen, control = end, None
            continue
        mirror = (2 * pen[0] - control[0], 2 * pen[1] - control[1]) if control else pen
        points = [pen, *{"C": lambda: [at(0), at(2), at(4)], "S": lambda: [mirror, at(0), at(2)], "Q": lambda: [at(0), at(2)], "T": lambda: [mirror, at(0)]}[op]()]  # noqa: B023
        low, high = (4, 128) if len(points) == 4 else (3, 96)
        steps = min(high, max(low, math.ceil(sum(map(math.dist, points, points[1:])) / max(0.25, tolerance))))
        d = len(points) - 1
        active[0] += [tuple(sum(math.comb(d, k) * (1 - g / steps) ** (d - k) * (g / steps) ** k * p[axis] for k, p in enumerate(points)) for axis in (0, 1)) for g in range(1, steps + 1)]
        active[2], pen, control = True, points[-1], points[-2]
    return [p for p in parts if len(p[0]) >= 2]


PATHS = [
    "M1 2 L3,4 h5 v-1 l1 1 2 2z m1,1 c1 0 2 1 3 3 s1 1 2 2 q1 1 2 0 t3 3 a1 1 0 0 1 4 4 L1e1.5", "M0 0 10 0 10 10 Z", "m1 1 1 1 1 1", "L 5 5", "S 1 2 3 4 T 9 9", "M0 0 C 1 1 2 2", "M0 0 L1 1 X 3 3 L 4 4", "M0 0 L1 1 Z 5 5 L 9 9", "", "5 5 L 1 1",
    "M 0 0 T 5 5 T 10 0 S 3 3 4 4", "M.5-.5L-1.5.25", "M0 0 L 100 0 Q 300 300 0 400 C 500 0 900 900 2 2 Z l 3 3", "M1 1 z", "M1 1 L2 2 z z", "h5 5 5", "M0,0 A 1 1 0 0 1 2 2 3 3", "M 1e2 1E-1 L 2e+1 3",
]


@pytest.mark.parametrize("data", PATHS)
def test_paths_match_a_plain_reader(spark, data):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([(data,)], "d string").withColumn("m", D.path_moves(F.col("d"))).select(D.path_parts(F.col("m"), 1.0).alias("p")).first()
    want = plain_path(data)
    assert [(len(p.points), p.closed, p.curved) for p in row.p] == [(len(p[0]), p[1], p[2]) for p in want]
    for got, (points, *_) in zip(row.p, want, strict=True):
        assert [v for p in got.points for v in p] == pytest.approx([v for p in points for v in p])


def test_nested_groups_styles_and_shapes(spark):
    svg = """<svg><g transform="translate(10,20) rotate(90 5 5)"><g transform='scale(2 3)'><path d="M1 2 L3,4" stroke="red" style="stroke: blue; opacity: .25"/></g><rect x="1" y="2" width="3" height="4" style="fill: none"/></g></g></g>
    <polygon points="0,0 1,0 1,1 9" visibility="hidden"/><polyline points="0 0 0 0 5 5 7"/><LINE x2='4'/><rect width="0" height="5"/><polygon points="0,0 1,0 1,1 9" transform="matrix(1 2 3 4 5 6) scale(2) rotate(30)"/><path d="M0 0 L0 0"/><line x2="5" opacity="0"/></svg>"""
    rows = D.shapes(spark.createDataFrame([(1, svg, "k"), (2, None, "k"), (3, "", "k"), (4, "<svg></g><line x2='1'/>", "k")], "id int, svg string, tag string"), ["id"]).orderBy("id", "place").collect()
    outer = plain_transform("translate(10,20) rotate(90 5 5)")
    want = [
        (1, 0, "path", mul(outer, plain_transform("scale(2 3)")), [(1, 2), (3, 4)], False, "red", None, 0.25), (1, 1, "rect", outer, [(1, 2), (4, 2), (4, 6), (1, 6), (1, 2)], True, None, "none", 1.0), (1, 3, "polyline", (1, 0, 0, 1, 0, 0), [(0, 0), (5, 5)], False, None, None, 1.0),
        (1, 4, "line", (1, 0, 0, 1, 0, 0), [(0, 0), (4, 0)], False, None, None, 1.0), (1, 6, "polygon", plain_transform("matrix(1 2 3 4 5 6) scale(2) rotate(30)"), [(0, 0), (1, 0), (1, 1)], True, None, None, 1.0), (4, 0, "line", (1, 0, 0, 1, 0, 0), [(0, 0), (1, 0)], False, None, None, 1.0),
    ]
    assert [(r.id, r.place, r.kind, r.closed, r.stroke, r.fill, r.opacity) for r in rows] == [(w[0], w[1], w[2], w[5], *w[6:]) for w in want]
    for r, (_, _, _, m, points, *_) in zip(rows, want, strict=True):
        assert [v for p in r.points for v in p] == pytest.approx([v for x, y in points for v in (m[0] * x + m[2] * y + m[4], m[1] * x + m[3] * y + m[5])])


# -- junctions ---------------------------------------------------------------------------------------------------


def plain_splice(line, targets, near=0.2, same=0.15):
    points = list(line)
    found = []
    for k, (tx, ty) in enumerate(targets):
        if any(math.dist(p, (tx, ty)) < same for p in line):
            continue
        best = None
        for i, (a, b) in enumerate(zip(line, line[1:], strict=False)):
            size = math.dist(a, b) ** 2
            t = max(0.0, min(1.0, ((tx - a[0]) * (b[0] - a[0]) + (ty - a[1]) * (b[1] - a[1])) / (size or 1.0)))
            d = math.dist((a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])), (tx, ty))
            best = min(best or (d, i, t), (d, i, t))
        if best and best[0] <= near:
            found.append((best[1], best[2], k, (tx, ty)))
    taken = []
    for i, t, _, p in sorted(found):
        if all(math.dist(p, q) >= same for _, q in taken):
            taken.append((i, p))
    for i, p in reversed(taken):
        points.insert(i + 1, p)
    return points


def test_splices_do_not_depend_on_order(spark):
    lines = {1: [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0)], 2: [(0.0, 5.0), (3.0, 5.0)], 3: [(1.0, 1.0)], 4: []}
    targets = {1: [(5.0, 0.1), (2.0, 0.0), (10.05, 4.0), (9.95, 0.1), (2.1, 0.05), (5.0, 3.0), (10.0, 8.0), (2.6, 0.0)], 2: [(1.5, 5.2), (0.1, 5.0)], 3: [(1.0, 1.0)], 9: [(0.0, 0.0)]}
    frame = spark.createDataFrame([(i, [{"x": x, "y": y} for x, y in line]) for i, line in lines.items()], "id int, line array<struct<x:double,y:double>>")
    rows = [(i, k, x, y) for i, ts in targets.items() for k, (x, y) in enumerate(ts)]
    for order in (rows, rows[::-1]):
        got = {r.id: [tuple(p) for p in r.line] for r in J.spliced(frame, spark.createDataFrame(order, "id int, pos int, x double, y double"), "id").collect()}
        assert got == {i: plain_splice(line, targets.get(i, [])) for i, line in lines.items()}
