"""Work, joins and partitions of queries that have to grow with their tables."""

import os
import random
import re

from pyspark.sql import functions as F

from evidara.operators import drawings, graph, placement, ranking, spatial, voxels
from evidara.operators.graph import connected_components
from evidara.plans import drawing_plans, portal_plans, surface_plans
from evidara.session import cut, shared_folder, spread


def optimized(frame) -> str:
    """The whole optimized plan."""
    spark, name = frame.sparkSession, "spark.sql.maxPlanStringLength"
    before = spark.conf.get(name)
    spark.conf.set(name, "100000000")
    try:
        return frame._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set(name, before)


def test_folds_of_drawings_stand_once_in_the_plan(spark, tmp_path):
    svg = '<svg><g transform="scale(2)"><path d="M0 0 C1 1 2 2 3 3 Q1 1 9 9 Z"/></g></svg>'
    spark.createDataFrame([(1, svg)], "id int, svg string").write.parquet(str(tmp_path / "d"))
    found = drawings.shapes(spark.read.parquet(str(tmp_path / "d")), ["id"])
    # a fold over tags, one over transforms, one over steps, and the lengths of two kinds of curves
    assert optimized(found).count("aggregate(") <= 5
    assert found.count() == 1


def test_a_small_table_is_spread(spark):
    assert spread(spark.range(100).coalesce(1), "id").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_small_groups_are_passed_in_a_row(spark):
    draw = random.Random(7)
    rows = [(f"{g}-{i}", g, draw.randrange(30), draw.randrange(30), 2 + g % 4, draw.randrange(5), i, 3 * g if g % 2 else None) for g in range(12) for i in range(draw.randint(1, 60))]
    frame = spark.createDataFrame(rows, "id string, g int, x int, y int, spacing int, score int, pos int, n int")
    for target in (None, F.col("n"), F.col("pos") - 3):
        in_rounds = {tuple(r) for r in placement.spaced(frame, "g", ["score", "pos"], target).collect()}
        for small in (25, 1000):
            got = [tuple(r) for r in placement.spaced(frame, "g", ["score", "pos"], target, small=small).collect()]
            assert sorted(map(str, got)) == sorted(map(str, in_rounds))
    before = os.listdir(shared_folder(spark).removeprefix("file:"))
    placement.spaced(frame, "g", ["score", "pos"], small=1000).count()
    # no tables of pairs
    assert os.listdir(shared_folder(spark).removeprefix("file:")) == before


def broadcasts(frame) -> bool:
    return "Broadcast" in frame._jdf.queryExecution().executedPlan().toString()


def stored(spark, path, rows, schema):
    """A table on disk, whose size Spark knows."""
    spark.createDataFrame(rows, schema).write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_spatial_joins_are_not_broadcast(spark, tmp_path):
    shapes = stored(spark, tmp_path / "a", [(1, [{"x": 0.0, "y": 0.0}, {"x": 9.0, "y": 9.0}], False), (None, [{"x": 99.0, "y": 0.0}, {"x": 90.0, "y": 9.0}], True)], "shape_id int, points array<struct<x:double,y:double>>, closed boolean")
    labels = stored(spark, tmp_path / "b", [(7, 1, 5.0, 4.0, 3), (8, 2, 99.0, 0.0, None), (9, 3, None, 1.0, 1)], "label_id int, pos int, x double, y double, priority int")
    found = spatial.shape_labels(shapes, labels)
    assert not broadcasts(found)
    # a shape without an id keeps its label
    assert {(r.shape_id, r.label_id) for r in found.collect()} == {(1, 7), (None, 8)}
    left, right = labels.where("x IS NOT NULL").select("x", "y"), labels.selectExpr("x AS x2", "y AS y2")
    assert not broadcasts(spatial.grid_join(left, right, 2.0)) and not broadcasts(spatial.grid_join(left, right, 2.0, "left_anti"))
    box = stored(spark, tmp_path / "c", [(1, 0.0, 0.0, 5.0, 5.0)], "i int, x0 double, y0 double, x1 double, y1 double")
    assert not broadcasts(spatial.box_pairs(box, box.toDF("j", "bx0", "by0", "bx1", "by1"), 4.0, "i", "j"))


def test_connectors_are_not_broadcast(spark, tmp_path):
    stored(spark, tmp_path / "part.parquet", [(i, "b", "n") for i in range(60)], "p_partkey long, p_brand string, p_name string")
    stored(spark, tmp_path / "supplier.parquet", [(i, "s") for i in range(3)], "s_suppkey long, s_name string")
    assert not broadcasts(drawing_plans.path_connectors(spark, str(tmp_path)))


def test_files_are_chosen_before_documents_meet_them(spark, tmp_path):
    # 500 files a key would meet each of its documents
    stored(spark, tmp_path / "part.parquet", [(500 * i, f"name {i}") for i in range(500)], "p_partkey long, p_name string")
    stored(spark, tmp_path / "supplier.parquet", [(700 * i,) for i in range(9)], "s_suppkey long")
    found = portal_plans.cached_files(spark, str(tmp_path))
    assert "max_by" not in optimized(found).split("Join")[0]
    rows = found.collect()
    best = max((500 * i * 37 % 9973, "000000-name_.pdf") for i in range(500))
    assert len(rows) == 9 and {(r.bytes, r.file) for r in rows} == {best}


def test_rounds_of_aliases_are_not_broadcast(spark, tmp_path, monkeypatch):
    plans = []
    monkeypatch.setattr(ranking, "cut", lambda frame: plans.append(broadcasts(frame)) or cut(frame))
    rows = stored(spark, tmp_path / "r", [(i, [i // 2, 100 + i // 3], i % 5) for i in range(40)], "id int, aliases array<int>, score int")
    found = ranking.greedy_by_alias(rows, "id", "aliases", [-F.col("score"), F.col("id")])
    assert found.count() > 5 and len(plans) > 3 and not any(plans)


def test_lines_are_linked_with_their_vertices_first(spark, monkeypatch):
    links = []
    monkeypatch.setattr(graph, "connected_components", lambda edges, **kw: links.append(edges.collect()) or connected_components(edges, **kw))
    lines = spark.createDataFrame([(i, [{"x": 0.0, "y": 0.0}, {"x": float(i), "y": 5.0}, {"x": 0.0, "y": 0.0}]) for i in (9, -3, 4)] + [(5, None)], "id int, line array<struct<x:double,y:double>>")
    got = {tuple(r) for r in graph.line_components(lines).collect()}
    assert got == {(-3, 3, False, 4, 6, 0), (5, 1, True, 0, 0, 0)}
    # one link for each vertex of a line, between lines
    assert sorted((r.u, r.v) for r in links[0]) == [(-3, -3), (-3, -3), (4, -3), (4, 4), (9, -3), (9, 9)]


def test_columns_are_formed_where_their_chunk_is(spark):
    rows = [(0, 0, 1, i, -3, i, 2, 20, 9 - i, 5, b) for i, b in enumerate(["a", None, "b", "a"])]
    frame = spark.createDataFrame(rows, "chunk_x int, chunk_z int, priority int, pos int, x1 int, y1 int, z1 int, x2 int, y2 int, z2 int, block string")
    found = voxels.column_tops(frame)
    sent = re.findall(r"hashpartitioning\(([^)]*)\)", found._jdf.queryExecution().executedPlan().toString())
    assert any("chunk_x" in keys for keys in sent) and not any(re.search(r"\b[xz]#", keys) for keys in sent)
    got = {(r.x, r.z): (r.height, r.block) for r in found.collect()}
    assert len(got) == 16 * 4 and {v for (x, z), v in got.items() if z == 2} == {(9, "a")}


def test_costly_rows_are_spread_and_worked_out_once(spark, tmp_path):
    stored(spark, tmp_path / "customer.parquet", [(i,) for i in range(9)], "c_custkey long")
    stored(spark, tmp_path / "part.parquet", [(i, "n", "b") for i in range(60)], "p_partkey long, p_name string, p_brand string")
    stored(spark, tmp_path / "supplier.parquet", [(i, "s") for i in range(3)], "s_suppkey long, s_name string")
    assert drawing_plans.curve_lengths(spark, str(tmp_path)).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    plan = optimized(drawing_plans.inherited_evidence(spark, str(tmp_path)))
    # once in each of the two uses of the pairs
    assert plan.count("sequence(0, (ny") <= 2


def test_painting_tasks_grow_in_number(spark, tmp_path, monkeypatch):
    stored(spark, tmp_path / "part.parquet", [(i, "b") for i in range(60)], "p_partkey long, p_brand string")
    stored(spark, tmp_path / "supplier.parquet", [(i, "s") for i in range(3)], "s_suppkey long, s_name string")
    monkeypatch.setattr(surface_plans, "SHAPES_A_TASK", 5)
    plan = surface_plans.scanline_paint(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    sent = re.findall(r"hashpartitioning\(row#\w+, col#\w+, (\d+)\)", plan)
    assert sent == ["13"]
