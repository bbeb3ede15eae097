"""Failure budgets, prefix sums, tile covers, tiled coverage and voxel columns against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from evidara.functions import scalars as S
from evidara.operators import coverage as C
from evidara.operators import ranking as R
from evidara.operators import voxels as V


def test_totals_before_match_a_running_sum(spark):
    draw = random.Random(1)
    rows = [(draw.randrange(4), draw.randrange(5), k, draw.choice([None, 0, 3, 10]), draw.randrange(9)) for k in range(200)]
    got = R.totals_before(spark.createDataFrame(rows, "a int, b int, k int, u int, v int").repartition(3), "a", "b", [F.col("k")], ["u", "v"]).collect()
    u = v = 0
    want = {}
    for a, b, k, x, y in sorted(rows, key=lambda r: r[:3]):
        want[k] = (u, v)
        u, v = u + (x or 0), v + y
    assert {r.k: (r.u_before, r.v_before) for r in got} == want and got[0].asDict().keys() == {"a", "b", "k", "u", "v", "u_before", "v_before"}


def plain_downloads(groups, documents, size, most=48, failures=5):
    seen, out, had, used, failed, own = set(), [], 0, 0, 0, dict.fromkeys(groups, 0)
    cap = max(24, min(100, -(-documents // 8)))
    for turn in range(most):
        for g in sorted(groups):
            if had >= documents or used >= size or failed >= cap:
                return out
            if turn >= len(groups[g]) or own[g] >= failures or groups[g][turn][0] in seen:
                continue
            url, size_of, ok = groups[g][turn]
            out.append((g, turn + 1, ok))
            if ok:
                had, used = had + 1, used + size_of
                seen.add(url)
            else:
                own[g], failed = own[g] + 1, failed + 1
    return out


@pytest.mark.parametrize(("documents", "size"), [(40, 10**9), (10_000, 30_000), (10_000, 10**9), (100, 10**9)])
def test_downloads_match_a_plain_loop(spark, documents, size):
    draw = random.Random(documents)
    fails = {f"u{i}": draw.random() < 0.4 for i in range(400)}
    groups = {g: [(u, draw.randrange(2000), not fails[u]) for u in (draw.choice(sorted(fails)) for _ in range(draw.randrange(60)))] for g in range(30)}
    rows = [(g, k, u, n, ok) for g, docs in groups.items() for k, (u, n, ok) in enumerate(docs)]
    # an outcome and a size belong to the url
    sizes = {u: n for _, _, u, n, _ in rows}
    groups = {g: [(u, sizes[u], ok) for u, _, ok in docs] for g, docs in groups.items()}
    frame = spark.createDataFrame([(g, k, u, sizes[u], ok) for g, k, u, _, ok in rows], "g int, k int, url string, bytes int, ok boolean").repartition(3)
    got = R.downloads(frame, "g", "g", [F.col("k")], documents, size, block=7).orderBy("turn", "g").collect()
    assert [(r.g, r.turn, r.ok) for r in got] == plain_downloads(groups, documents, size)
    assert R.failure_cap(8) == 24 and R.failure_cap(400) == 50 and R.failure_cap(10_000) == 100


def test_box_quadkeys(spark):
    box = spark.createDataFrame([(0.1, 0.1, 0.1, 0.1), (-1.0, -1.0, 1.0, 1.0), (-180.0, -90.0, 180.0, 90.0)], "w double, s double, e double, n double")
    got = [r.q for r in box.select(S.box_quadkeys(*(F.col(c) for c in "wsen"), 2).alias("q")).collect()]
    assert got[0] == ["12"] and got[1] == ["03", "12", "21", "30"] and sorted(got[2]) == [a + b for a in "0123" for b in "0123"]


def test_tiles_are_retried_and_bundles_fall_back(spark):
    tiles = spark.createDataFrame([(b, t, 4.0 if t != 3 else 1.0) for b in range(1, 5) for t in (1, 2, 3)], "b int, tile int, requested double")
    attempts = [(1, 1, "scaled", None), (1, 2, "scaled", "x"), (1, 2, "native", None), (1, 3, "scaled", None)]
    attempts += [(b, 1, "scaled", None) for b in (2, 3, 4)] + [(b, 2, "scaled", "x") for b in (2, 3, 4)] + [(b, 2, "native", "y") for b in (2, 3)] + [(b, 3, "scaled", "z") for b in (2, 3, 4)] + [(4, 3, "native", None)]
    settled = C.settled_tiles(tiles, spark.createDataFrame(attempts, "b int, tile int, kind string, error string"), ["b"])
    one = {(r.b, r.tile): (r.used, r.requests, r.reason) for r in settled.collect()}
    assert one[1, 2] == ("native", 2, None) and one[2, 2] == (None, 2, "scaled: x; native: y") and one[4, 2] == (None, 2, "scaled: x; native: no-answer") and one[4, 3] == (None, 1, "z")
    single = spark.createDataFrame([(2, True, True), (3, True, False)], "b int, allowed boolean, single_ok boolean")
    got = {r.b: (r.status, r.tiles, r.failed, r.native, r.requests) for r in C.bundles(settled, ["b"], single).collect()}
    assert got == {1: ("tiled", 3, 0, 1, 4), 2: ("single", 3, 2, 0, 5), 3: ("failed", 3, 2, 0, 5), 4: ("failed", 3, 2, 0, 4)}


def test_gates_of_a_tile(spark):
    rows = [("dtm", 1.0, 0.9, 1.0, 1.0), ("dtm", 2.6, 0.9, 1.0, 1.0), ("dtm", 1.0, 0.9, 2.1, 1.0), ("dtm", 1.0, 0.9, 4.9, 4.0), ("dtm", 1.0, 0.8, 1.0, 1.0), ("vom", 1.0, 0.0, 1.0, 1.0), ("dtm", 1.0, 0.9, None, 1.0)]
    frame = spark.createDataFrame(rows, "role string, t double, c double, r double, q double")
    got = [r.e for r in frame.select(C.attempt_fails(*(F.col(c) for c in ("role", "t", "c", "r", "q"))).alias("e")).collect()]
    assert got == [None, "bounds-mismatch", "resolution-too-coarse", None, "too-little-coverage", None, "no-raster"]


def test_columns_and_registry(spark):
    draw = random.Random(2)
    names = ["minecraft:b", "minecraft:a", "minecraft:c", None, "Odd"]
    rows = [(draw.randrange(3), draw.randrange(-1, 2), draw.randrange(3), k, *(draw.randrange(-4, 20) for _ in range(6)), draw.choice(names[:3])) for k in range(60)]
    frame = spark.createDataFrame(rows, "chunk_x int, chunk_z int, priority int, pos int, x1 int, y1 int, z1 int, x2 int, y2 int, z2 int, block string")
    want = {}
    for cx, cz, p, k, x1, y1, z1, x2, y2, z2, b in rows:
        if 0 <= cx <= 1 and 0 <= cz <= 0:
            for x in range(max(0, min(x1, x2)), min(15, max(x1, x2)) + 1):
                for z in range(max(0, min(z1, z2)), min(15, max(z1, z2)) + 1):
                    want[cx, cz, x, z] = max(want.get((cx, cz, x, z), ((-99,),)), ((max(y1, y2), p, k), b))
    got = {(r.chunk_x, r.chunk_z, r.x, r.z): (r.height, r.block) for r in V.column_tops(V.clipped(frame, (0, 0, 1, 0))).collect()}
    assert got == {k: (t[0], b) for k, (t, b) in want.items()}
    many = spark.createDataFrame([(f"n{k % 700:04}",) for k in range(2000)] + [(None,)], "block string").repartition(5)
    assert [(r.block, r.id) for r in V.registry(many).orderBy("id").collect()] == [(f"n{k:04}", k) for k in range(700)]
    used = spark.createDataFrame([(n,) for n in names for _ in range(2)], "block string")
    assert sorted(map(tuple, V.unknown_blocks(used, spark.createDataFrame([("minecraft:a",)], "block string")).collect())) == [("Odd", 2, False), ("minecraft:b", 2, True), ("minecraft:c", 2, True)]
