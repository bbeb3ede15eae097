"""Shapes of SVG drawings as native columns: nested groups with their matrices, styles, and path data with curves.

Two ordered folds carry what order decides. Over a drawing's tags it is the stack of matrices, over a path's steps the pen, the
start of the part and the last control point; curves are then cut into lines step by step, as each step knows its own points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidara.functions import geometry as G

NUMBER = r"[-+]?(?:\d*\.\d+|\d+\.?)(?:[eE][-+]?\d+)?"
TAGS = r"(?i)</?g\b[^>]*>|<(?:path|polyline|polygon|line|rect)\b[^>]*>"
#: A path command with what follows it; an e inside a number is no command.
COMMAND = r"[a-zA-Z&&[^eE]](?:[^a-zA-Z]|(?<=[0-9.])[eE](?=[-+]?[0-9]))*|[eE]"
#: Numbers that each command takes.
TAKES = {"M": 2, "L": 2, "H": 1, "V": 1, "C": 6, "S": 4, "Q": 4, "T": 2, "A": 7}

array_of = lambda kind: F.array().cast(f"array<{kind}>")
MATRIX = "struct<a:double,b:double,c:double,d:double,e:double,f:double>"


def matrix(*values) -> Column:
    return F.struct(*((v if isinstance(v, Column) else F.lit(float(v))).cast("double").alias(n) for n, v in zip("abcdef", values, strict=True)))


IDENTITY = (1, 0, 0, 1, 0, 0)


def times(m: Column, n: Column) -> Column:
    """The matrix that applies n, then m."""
    return matrix(m["a"] * n["a"] + m["c"] * n["b"], m["b"] * n["a"] + m["d"] * n["b"], m["a"] * n["c"] + m["c"] * n["d"], m["b"] * n["c"] + m["d"] * n["d"], m["a"] * n["e"] + m["c"] * n["f"] + m["e"], m["b"] * n["e"] + m["d"] * n["f"] + m["f"])


def applied(m: Column, p: Column) -> Column:
    return G.point(m["a"] * p["x"] + m["c"] * p["y"] + m["e"], m["b"] * p["x"] + m["d"] * p["y"] + m["f"])


def numbers(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(NUMBER), F.lit(0)), lambda v: v.try_cast("double"))


def attribute(tag: Column, name: str) -> Column:
    """The value of the first attribute whose name ends so at a word's edge, in either kind of quotes; null without one."""
    pattern = rf"""(?i)\b{name}\s*=\s*(?:"([^"]*)"|'([^']*)')"""
    return F.when(F.rlike(tag, F.lit(pattern)), F.concat(F.regexp_extract(tag, pattern, 1), F.regexp_extract(tag, pattern, 2)))


def styled(tag: Column, name: str) -> Column:
    """The value of a style: of the attribute of its own, else from `style`."""
    inline = rf"(?i)(?:^|;)\s*{name}\s*:\s*([^;]*)"
    style = F.coalesce(attribute(tag, "style"), F.lit(""))
    return F.coalesce(attribute(tag, name), F.when(F.rlike(style, F.lit(inline)), F.trim(F.regexp_extract(style, inline, 1))))


def transform_matrix(text: Column) -> Column:
    """The product of a transform's matrix, translate, scale and rotate (about a centre or the origin), from left to right."""

    def one(p: Column) -> Column:
        kind, n = p["kind"], p["n"]
        at = lambda i, default: F.coalesce(F.get(n, F.lit(i)), default if isinstance(default, Column) else F.lit(float(default)))
        turn = at(0, 0) * 3.141592653589793 / 180
        cos, sin, cx, cy = F.cos(turn), F.sin(turn), F.when(F.size(n) >= 3, at(1, 0)).otherwise(0.0), F.when(F.size(n) >= 3, at(2, 0)).otherwise(0.0)
        rotated = matrix(cos, sin, -sin, cos, cx - cx * cos + cy * sin, cy - cx * sin - cy * cos)
        return F.when(kind == "translate", matrix(1, 0, 0, 1, at(0, 0), at(1, 0))).when(kind == "scale", matrix(at(0, 1), 0, 0, at(1, at(0, 1)), 0, 0)).when(kind == "rotate", rotated).when(F.size(n) >= 6, matrix(*(at(i, 0) for i in range(6)))).otherwise(matrix(*IDENTITY))

    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?i)(?:matrix|translate|scale|rotate)\s*\([^)]*\)"), F.lit(0))
    parts = F.transform(found, lambda t: F.struct(F.lower(F.regexp_extract(t, r"^([a-zA-Z]+)", 1)).alias("kind"), numbers(F.regexp_extract(t, r"\(([^)]*)\)", 1)).alias("n")))
    return F.aggregate(F.transform(parts, one), matrix(*IDENTITY), times)


def elements(drawings: DataFrame, keys: list[str], svg: str = "svg") -> DataFrame:
    """(keys, place, tag, matrix) for every shape's tag of a drawing, in order from 0; matrix is that of its groups and its own.

    A group's matrix counts until its end; an end without a group changes nothing. Null and empty drawings have no shapes.
    """
    tags = F.regexp_extract_all(F.coalesce(F.col(svg), F.lit("")), F.lit(TAGS), F.lit(0))
    read = F.transform(tags, lambda t: F.struct(t.alias("tag"), transform_matrix(attribute(t, "transform")).alias("own"), F.when(F.rlike(t, F.lit("(?i)^</g")), -1).when(F.rlike(t, F.lit(r"(?i)^<g\b")), 1).otherwise(0).alias("step")))
    start = F.struct(F.array(matrix(*IDENTITY)).alias("stack"), array_of(f"struct<tag:string,matrix:{MATRIX}>").alias("out"))

    def step(s: Column, t: Column) -> Column:
        m = times(F.element_at(s["stack"], -1), t["own"])
        down = F.when(F.size(s["stack"]) > 1, F.slice(s["stack"], F.lit(1), F.greatest(F.size(s["stack"]) - 1, F.lit(1)))).otherwise(s["stack"])
        stack = F.when(t["step"] > 0, F.concat(s["stack"], F.array(m))).when(t["step"] < 0, down).otherwise(s["stack"])
        return F.struct(stack.alias("stack"), F.when(t["step"] == 0, F.concat(s["out"], F.array(F.struct(t["tag"].alias("tag"), m.alias("matrix"))))).otherwise(s["out"]).alias("out"))

    # an outer explode, as Spark would work out the array once more to test that a plain one has rows
    found = drawings.select(*keys, F.posexplode_outer(F.aggregate(read, start, step)["out"]).alias("place", "e")).where("place IS NOT NULL")
    return found.select(*keys, "place", "e.tag", "e.matrix")


def path_steps(data: Column) -> Column:
    """Path data as an array of (op, relative, n): one for each set of numbers; what can't be read is (!), after which nothing counts."""

    def read(command: Column) -> Column:
        letter, n = command["letter"], command["n"]
        op = F.upper(letter)
        made = lambda name, values: F.struct(name.alias("op"), (letter != op).alias("relative"), values.alias("n"))
        bad = F.array(made(F.lit("!"), array_of("double")))
        takes = F.coalesce(F.element_at(F.create_map(*(F.lit(v) for pair in TAKES.items() for v in pair)), op), F.lit(0))
        whole = F.when(takes > 0, F.floor(F.size(n) / F.greatest(takes, F.lit(1)))).otherwise(0).cast("int")
        sets = F.when(whole > 0, F.transform(F.sequence(F.lit(0), F.greatest(whole - 1, F.lit(0))), lambda i: made(F.when((op == "M") & (i > 0), F.lit("L")).otherwise(op), F.slice(n, i * takes + 1, F.greatest(takes, F.lit(1)))))).otherwise(array_of("struct<op:string,relative:boolean,n:array<double>>"))
        closed = F.concat(F.array(made(F.lit("Z"), array_of("double"))), F.when(F.size(n) > 0, bad).otherwise(array_of("struct<op:string,relative:boolean,n:array<double>>")))
        rest = F.when((whole == 0) | (F.size(n) != whole * takes), bad).otherwise(array_of("struct<op:string,relative:boolean,n:array<double>>"))
        return F.when(op == "Z", closed).when(takes == 0, bad).otherwise(F.concat(sets, rest))

    text = F.coalesce(data, F.lit(""))
    commands = F.transform(F.regexp_extract_all(text, F.lit(COMMAND), F.lit(0)), lambda c: F.struct(F.substring(c, 1, 1).alias("letter"), numbers(c).alias("n")))
    # numbers before any command can't be read
    return F.when(F.rlike(text, F.lit(r"^[^a-zA-Z]*\d")), array_of("struct<op:string,relative:boolean,n:array<double>>")).otherwise(F.flatten(F.transform(commands, read)))


STEP = "struct<part:int,op:string,p0:struct<x:double,y:double>,c1:struct<x:double,y:double>,c2:struct<x:double,y:double>,p:struct<x:double,y:double>>"


def path_moves(data: Column) -> Column:
    """Path data as an array of (part, op, p0, c1, c2, p): each step's pen before and after, with the control points of curves.

    S and T mirror the last control point, or take the pen if the last step had none. Z goes to the part's start, and what follows it
    begins a part of its own there. An arc is its chord.
    """
    nothing = F.lit(None).cast("struct<x:double,y:double>")
    start = F.struct(G.point(0, 0).alias("pen"), nothing.alias("begin"), nothing.alias("control"), F.lit(-1).alias("part"), F.lit(False).alias("open"), F.lit(False).alias("ended"), array_of(STEP).alias("out"))

    def step(s: Column, v: Column) -> Column:
        pen, op, n = s["pen"], v["op"], v["n"]
        at = lambda i: F.get(n, F.lit(i))
        base = lambda axis: F.when(v["relative"], pen[axis]).otherwise(0.0)
        spot = lambda i: G.point(base("x") + at(i), base("y") + at(i + 1))
        mirror = F.when(s["control"].isNull(), pen).otherwise(G.point(2 * pen["x"] - s["control"]["x"], 2 * pen["y"] - s["control"]["y"]))
        end = F.when(op.isin("M", "L", "T"), spot(0)).when(op == "H", G.point(base("x") + at(0), pen["y"])).when(op == "V", G.point(pen["x"], base("y") + at(0))).when(op == "C", spot(4)).when(op.isin("S", "Q"), spot(2)).when(op == "A", spot(5)).otherwise(F.coalesce(s["begin"], pen))
        c1 = F.when(op.isin("C", "Q"), spot(0)).when(op.isin("S", "T"), mirror)
        c2 = F.when(op == "C", spot(2)).when(op == "S", spot(0))
        part = F.when((op == "M") | ~s["open"], s["part"] + 1).otherwise(s["part"])
        move = F.struct(part.alias("part"), op.alias("op"), pen.alias("p0"), c1.alias("c1"), c2.alias("c2"), end.alias("p"))
        ended = s["ended"] | (op == "!")
        keep = lambda now, new: F.when(ended, now).otherwise(new)
        return F.struct(
            keep(pen, end).alias("pen"), keep(s["begin"], F.when(op == "M", end).otherwise(s["begin"])).alias("begin"), keep(s["control"], F.when(op.isin("C", "S"), c2).when(op.isin("Q", "T"), c1)).alias("control"), keep(s["part"], part).alias("part"),
            keep(s["open"], op != "Z").alias("open"), ended.alias("ended"), keep(s["out"], F.concat(s["out"], F.array(move))).alias("out"),
        )

    return F.aggregate(path_steps(data), start, step)["out"]


def path_parts(moves: Column, tolerance: float) -> Column:
    """`path_moves`, a column of its own, as an array of (points, closed, curved): the parts of two points or more, with curves as lines
    of about `tolerance`."""

    def added(i: Column, m: Column, first: Column) -> Column:
        begins = F.when(first & (m["op"] != "M"), F.array(m["p0"])).otherwise(array_of("struct<x:double,y:double>"))
        cubic, square = [m["p0"], m["c1"], m["c2"], m["p"]], [m["p0"], m["c1"], m["p"]]
        bend = lambda points: G.once(G.curve_steps(points, tolerance), lambda n: F.slice(G.curve(points, n), F.lit(2), F.lit(1 << 20)))
        shut = (m["op"] == "Z") & (F.sqrt(F.pow(m["p0"]["x"] - m["p"]["x"], 2) + F.pow(m["p0"]["y"] - m["p"]["y"], 2)) <= 1e-9)
        more = F.when(m["op"].isin("C", "S"), bend(cubic)).when(m["op"].isin("Q", "T"), bend(square)).when(shut, array_of("struct<x:double,y:double>")).otherwise(F.array(m["p"]))
        return F.concat(begins, more)

    def one(own: Column) -> Column:
        points = F.flatten(F.transform(own, lambda m, i: added(i, m, i == 0)))
        return F.struct(points.alias("points"), F.exists(own, lambda m: m["op"] == "Z").alias("closed"), F.exists(own, lambda m: m["op"].isin("C", "S", "Q", "T", "A")).alias("curved"))

    count = F.coalesce(F.element_at(F.transform(moves, lambda m: m["part"]), -1), F.lit(-1))
    parts = F.when(F.size(moves) > 0, F.transform(F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(0))), lambda k: F.filter(moves, lambda m: m["part"] == k)), one)).otherwise(array_of("struct<points:array<struct<x:double,y:double>>,closed:boolean,curved:boolean>"))
    return F.filter(parts, lambda p: F.size(p["points"]) >= 2)


def plain_parts(tag: Column) -> Column:
    """The tag of a shape other than a path as an array of (points, closed, curved) in its own coordinates."""
    kind = F.lower(F.regexp_extract(tag, r"^<([a-zA-Z]+)", 1))
    number = lambda name, default: F.coalesce(attribute(tag, name).try_cast("double"), F.lit(default).cast("double"))
    x, y, w, h = number("x", 0.0), number("y", 0.0), number("width", None), number("height", None)
    made = lambda points, closed: F.array(F.struct(points.alias("points"), F.lit(closed).alias("closed"), F.lit(False).alias("curved")))
    none = array_of("struct<points:array<struct<x:double,y:double>>,closed:boolean,curved:boolean>")
    flat = numbers(attribute(tag, "points"))
    pairs = F.when(F.size(flat) >= 2, F.transform(F.sequence(F.lit(0), F.greatest(F.floor(F.size(flat) / 2).cast("int") - 1, F.lit(0))), lambda i: G.point(F.get(flat, 2 * i), F.get(flat, 2 * i + 1)))).otherwise(array_of("struct<x:double,y:double>"))
    box = F.array(G.point(x, y), G.point(x + w, y), G.point(x + w, y + h), G.point(x, y + h), G.point(x, y))
    line = F.array(G.point(number("x1", 0.0), number("y1", 0.0)), G.point(number("x2", 0.0), number("y2", 0.0)))
    return F.when(F.size(pairs) > 0, F.when(kind == "polygon", made(pairs, True)).when(kind == "polyline", made(pairs, False))).when(kind == "line", made(line, False)).when((kind == "rect") & (w > 0) & (h > 0), made(box, True)).otherwise(none)


def shapes(drawings: DataFrame, keys: list[str], svg: str = "svg", tolerance: float = 1.0) -> DataFrame:
    """(keys, place, part, kind, points, closed, curved, stroke, fill, opacity) of every shape that is shown, in the drawing's coordinates.

    Shapes without display, hidden ones and those of opacity 0 don't count; points that repeat the one before go, and shapes of fewer than two
    points. Numbers are read with a sign, a fraction and an exponent; a path ends where it can't be read.
    """
    tag = F.col("tag")
    opacity = F.coalesce(styled(tag, "opacity").try_cast("double"), F.lit(1.0))
    shown = (F.coalesce(styled(tag, "display"), F.lit("")) != "none") & (F.coalesce(styled(tag, "visibility"), F.lit("")) != "hidden") & (opacity != 0)
    # what several expressions use is a column of its own, so that it is worked out once; nothing is filtered on it, as Spark would work it out again for the filter
    found = elements(drawings, keys, svg).where(shown).withColumn("path", F.rlike(tag, F.lit("(?i)^<path"))).withColumn("moves", F.when(F.col("path"), path_moves(attribute(tag, "d"))))
    found = found.withColumn("parts", F.when(F.col("path"), path_parts(F.col("moves"), tolerance)).otherwise(plain_parts(tag)))

    def placed(s: Column, i: Column) -> Column:
        changed = lambda points: F.filter(points, lambda p, j: (j == 0) | (p != F.get(points, j - 1)))
        return F.struct(i.alias("part"), G.once(F.transform(s["points"], lambda p: applied(F.col("matrix"), p)), changed).alias("points"), s["closed"].alias("closed"), s["curved"].alias("curved"))

    parts = F.filter(F.transform("parts", placed), lambda p: F.size(p["points"]) >= 2)
    found = found.select(*keys, "place", "tag", opacity.alias("opacity"), F.explode_outer(parts).alias("s")).where("s IS NOT NULL")
    kind = F.lower(F.regexp_extract(tag, r"^<([a-zA-Z]+)", 1))
    return found.select(*keys, "place", "s.part", kind.alias("kind"), "s.points", "s.closed", "s.curved", styled(tag, "stroke").alias("stroke"), styled(tag, "fill").alias("fill"), "opacity")
