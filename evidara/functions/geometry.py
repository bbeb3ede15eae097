"""Plane geometry over arrays of points (x, y), as native columns and as SQL for the twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def point(x, y) -> Column:
    c = lambda v: (v if isinstance(v, Column) else F.lit(v)).cast("double")
    return F.struct(c(x).alias("x"), c(y).alias("y"))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once a row, however often `use` names it."""
    return F.transform(F.array(value), use)[0]


def ring(x: Column, y: Column, offsets) -> Column:
    """A ring of points at fixed offsets from (x, y)."""
    return F.array(*(point(x + dx, y + dy) for dx, dy in offsets))


def sql_ring(x: str, y: str, offsets) -> str:
    return "[" + ", ".join(f"{{'x': ({x} + {dx})::DOUBLE, 'y': ({y} + {dy})::DOUBLE}}" for dx, dy in offsets) + "]"


def turned(points: Column) -> Column:
    """The points with the last one first: each point's forerunner in a ring."""
    return F.concat(F.slice(points, F.size(points), F.lit(1)), F.slice(points, F.lit(1), F.size(points) - 1))


def inside(points: Column, x: Column, y: Column) -> Column:
    """Whether (x, y) lies in the ring, by the even-odd rule."""

    def crossing(a: Column, b: Column) -> Column:
        rise = F.when(b["y"] == a["y"], F.lit(1e-12)).otherwise(b["y"] - a["y"])
        return ((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / rise + a["x"])

    return F.size(F.filter(F.zip_with(points, turned(points), crossing), lambda v: v)) % 2 == 1


def sql_inside(points: str, x: str, y: str) -> str:
    a, b = f"{points}[i]", f"{points}[CASE WHEN i = 1 THEN len({points}) ELSE i - 1 END]"
    return f"(len(list_filter(range(1, len({points}) + 1), lambda i: (({a}.y > {y}) <> ({b}.y > {y})) AND {x} < ({b}.x - {a}.x) * ({y} - {a}.y) / CASE WHEN {b}.y = {a}.y THEN 1e-12 ELSE {b}.y - {a}.y END + {a}.x)) % 2 = 1)"


def inside_rings(rings: Column, x: Column, y: Column) -> Column:
    """Whether (x, y) lies in the first ring and in none of the others, the holes."""
    return inside(rings[0], x, y) & ~F.exists(F.slice(rings, F.lit(2), F.size(rings)), lambda hole: inside(hole, x, y))


def signed_area(points: Column) -> Column:
    """Twice the area halved: positive if the ring turns left."""
    return F.aggregate(F.zip_with(turned(points), points, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"]), F.lit(0.0), lambda s, v: s + v) / 2


def sql_signed_area(points: str) -> str:
    a, b = f"{points}[CASE WHEN i = 1 THEN len({points}) ELSE i - 1 END]", f"{points}[i]"
    return f"(list_sum(list_transform(range(1, len({points}) + 1), lambda i: {a}.x * {b}.y - {b}.x * {a}.y)) / 2)"


def length(points: Column) -> Column:
    """The length of the line through the points."""
    steps = F.zip_with(F.slice(points, F.lit(1), F.size(points) - 1), F.slice(points, F.lit(2), F.size(points)), lambda a, b: F.sqrt(F.pow(b["x"] - a["x"], 2) + F.pow(b["y"] - a["y"], 2)))
    return F.aggregate(steps, F.lit(0.0), lambda s, v: s + v)


def sql_length(points: str) -> str:
    return f"coalesce(list_sum(list_transform(range(2, len({points}) + 1), lambda i: sqrt(pow({points}[i].x - {points}[i - 1].x, 2) + pow({points}[i].y - {points}[i - 1].y, 2)))), 0.0)"


def nearest_share(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """How far along the segment from a to b, from 0 to 1, its point nearest to p lies."""
    dx, dy = bx - ax, by - ay
    size = dx * dx + dy * dy
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * dx + (py - ay) * dy) / F.when(size == 0, F.lit(1.0)).otherwise(size)))


def curve_steps(points: list[Column], tolerance: float) -> Column:
    """As many steps as the control polygon of a curve has tolerances, within bounds for its degree."""
    low, high = (4, 128) if len(points) == 4 else (3, 96)
    return F.greatest(F.lit(low), F.least(F.lit(high), F.ceil(length(F.array(*points)) / max(0.25, tolerance)).cast("int")))


def curve(points: list[Column], steps: Column) -> Column:
    """A Bezier curve of degree 2 or 3 as a line: the first point, then `steps` points, a column so that it is worked out once."""
    weights = (1, 3, 3, 1) if len(points) == 4 else (1, 2, 1)
    degree = len(points) - 1

    def at(t: Column) -> Column:
        u = 1 - t
        part = lambda axis: sum((w * F.pow(u, F.lit(degree - k)) * F.pow(t, F.lit(k)) * points[k][axis] for k, w in enumerate(weights)), F.lit(0.0))
        return point(part("x"), part("y"))

    return F.concat(F.array(points[0]), F.transform(F.transform(F.sequence(F.lit(1), steps), lambda i: i / steps), at))


#: Ellipsoids, datum shift (metres, arc seconds, parts per million) and projection of the British National Grid.
WGS84, AIRY = (6378137.0, 6356752.3141), (6377563.396, 6356256.909)
SHIFT = {"tx": -446.448, "ty": 125.157, "tz": -542.060, "rx": -0.1502, "ry": -0.2470, "rz": -0.8421, "s": 20.4894}
GRID = {"f": 0.9996012717, "lat": 49.0, "lon": -2.0, "north": -100000.0, "east": 400000.0}


def british_grid(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Easting and northing of a WGS84 point: datum shift by Helmert's formula, then the transverse Mercator series."""
    rad = 3.141592653589793 / 180
    lam, phi = lon * rad, lat * rad
    a, b = WGS84
    e2 = 1 - b * b / (a * a)
    nu = a / F.sqrt(1 - e2 * F.sin(phi) * F.sin(phi))
    x, y, z = nu * F.cos(phi) * F.cos(lam), nu * F.cos(phi) * F.sin(lam), (1 - e2) * nu * F.sin(phi)
    rx, ry, rz = (SHIFT[k] * rad / 3600 for k in ("rx", "ry", "rz"))
    scale = 1 + SHIFT["s"] * 1e-6
    x2, y2, z2 = SHIFT["tx"] + x * scale - y * rz + z * ry, SHIFT["ty"] + x * rz + y * scale - z * rx, SHIFT["tz"] - x * ry + y * rx + z * scale
    a, b = AIRY
    e2 = 1 - b * b / (a * a)

    def grid(p: Column) -> Column:
        flat = F.sqrt(p["x"] * p["x"] + p["y"] * p["y"])
        # each step gains five digits or so, and steps after the limit change nothing
        turn = lambda v, _: F.atan2(p["z"] + e2 * (a / F.sqrt(1 - e2 * F.sin(v) * F.sin(v))) * F.sin(v), flat)
        return F.struct(F.atan2(p["y"], p["x"]).alias("lam"), F.aggregate(F.sequence(F.lit(1), F.lit(12)), F.atan2(p["z"], flat * (1 - e2)), turn).alias("phi"))

    found = F.transform(F.transform(F.array(F.struct(x2.alias("x"), y2.alias("y"), z2.alias("z"))), grid), projected)[0]
    return found["e"], found["n"]


def projected(p: Column) -> Column:
    """(e, n) of (lam, phi) on the Airy ellipsoid."""
    rad = 3.141592653589793 / 180
    a, b = AIRY
    e2, n = 1 - b * b / (a * a), (a - b) / (a + b)
    phi, s, c, t = p["phi"], F.sin(p["phi"]), F.cos(p["phi"]), F.tan(p["phi"])
    root = 1 - e2 * s * s
    nu, rho = a * GRID["f"] / F.sqrt(root), a * GRID["f"] * (1 - e2) / (root * F.sqrt(root))
    eta = nu / rho - 1
    d, m = phi - GRID["lat"] * rad, phi + GRID["lat"] * rad
    arc = b * GRID["f"] * ((1 + n + 1.25 * n**2 + 1.25 * n**3) * d - (3 * n + 3 * n**2 + 2.625 * n**3) * F.sin(d) * F.cos(m) + (1.875 * n**2 + 1.875 * n**3) * F.sin(2 * d) * F.cos(2 * m) - 35 / 24 * n**3 * F.sin(3 * d) * F.cos(3 * m))
    l = p["lam"] - GRID["lon"] * rad  # noqa: E741
    l2, t2, c3 = l * l, t * t, c * c * c
    north = arc + GRID["north"] + nu / 2 * s * c * l2 + nu / 24 * s * c3 * (5 - t2 + 9 * eta) * l2 * l2 + nu / 720 * s * c3 * c * c * (61 - 58 * t2 + t2 * t2) * l2 * l2 * l2
    east = GRID["east"] + nu * c * l + nu / 6 * c3 * (nu / rho - t2) * l * l2 + nu / 120 * c3 * c * c * (5 - 18 * t2 + t2 * t2 + 14 * eta - 58 * t2 * eta) * l * l2 * l2
    return F.struct(east.alias("e"), north.alias("n"))


def area_km2(south: Column, west: Column, north: Column, east: Column) -> Column:
    """The area of a box of degrees on a sphere of 111.32 km a degree."""
    return F.abs((east - west) * 111.32 * F.cos((south + north) / 2 * 3.141592653589793 / 180) * (north - south) * 111.32)
