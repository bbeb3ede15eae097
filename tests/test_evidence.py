"""Evidence-fusion operators against DuckDB and hand-made fixtures."""

import gzip
import json
import math
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from evidara import catalog
from evidara.functions import geometry as G
from evidara.functions import scalars as S
from evidara.operators import ranking, raster, spatial
from evidara.operators.graph import connected_components
from evidara.sources import readers, sinks
from evidara.streaming.windows import windowed_counts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind == "f":
            df[c] = df[c].round(6)
    return df.astype(str).sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, duck, name):
    got, want = normal(catalog.QUERIES[name](spark, SF).toPandas()), normal(duck.execute(catalog.ORACLE_SQL[name]).df())
    assert list(got.columns) == list(want.columns) and got.equals(want)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_scalars(spark):
    assert one(spark, S.quadkey(F.lit(3), F.lit(5), 3)) == "213"
    x, y = S.tile_of(F.lit(0.0), F.lit(0.0), 1)
    assert (one(spark, x), one(spark, y)) == (1, 1)
    assert one(spark, S.byte_size(F.lit("23.1MB"))) == math.ceil(23.1 * 1024**2) and one(spark, S.byte_size(F.lit("74.7KB"))) == math.ceil(74.7 * 1024)
    assert one(spark, S.half_up(F.lit(-0.5))) == 0 and one(spark, S.fnv1a(F.lit("a"))) == 0xE40C292C
    assert one(spark, S.canonical_url(F.lit("HTTPS://Ex.Org?b=2&a=1#x"))) == "https://ex.org/?a=1&b=2"
    assert [one(spark, S.is_open_license(F.lit(t))) for t in ("CC-BY 4.0", "CC-BY-NC-4.0", None)] == [True, False, False]


def test_components_of_a_long_path_and_of_nothing(spark):
    edges = spark.range(200).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v")).union(spark.createDataFrame([(500, 500), (700, 701), (None, 3)], "u long, v long"))
    got = dict(connected_components(edges).collect())
    assert all(got[i] == 0 for i in range(201)) and got[500] == 500 and got[701] == 700
    assert connected_components(edges.where("false")).count() == 0


def test_budget_failure_uses_a_place_but_no_bytes(spark):
    rows = spark.createDataFrame([("a", 1, 60), ("a", 2, 90), ("a", 3, 30), ("a", 4, 10)], "g string, i int, size long")
    assert ranking.within_budget(rows, "g", ["i"], "size", 100, 3).first().asDict() == {"g": "a", "taken": 2, "failed": 1, "used": 90}


def test_budget_of_a_large_group_and_null_sizes(spark):
    rows = spark.range(3000).select(F.lit("a").alias("g"), F.col("id").alias("i"), F.when(F.col("id") == 1, None).otherwise(10).alias("size"))
    assert ranking.within_budget(rows, "g", ["i"], "size", 95, 30).first().asDict() == {"g": "a", "taken": 10, "failed": 20, "used": 90}


def test_greedy_aliases_match_a_plain_pass(spark):
    draw = random.Random(3)
    rows = [(i, [None if draw.random() < 0.05 else draw.randrange(120) for _ in range(draw.randint(0, 3))], draw.randrange(20)) for i in range(200)]
    taken, kept = set(), []
    for i, aliases, _ in sorted(rows, key=lambda r: (-r[2], r[0])):
        own = {a for a in aliases if a is not None}
        if not own & taken:
            kept.append(i)
            taken |= own
    found = ranking.greedy_by_alias(spark.createDataFrame(rows, "id int, aliases array<int>, score int"), "id", "aliases", [-F.col("score"), F.col("id")])
    assert sorted(r.id for r in found.collect()) == sorted(kept)


def test_rows_with_nulls_are_matched_by_a_grid(spark):
    left = spark.createDataFrame([(1.0, 1.0, None), (50.0, 50.0, None)], "x double, y double, name string")
    right = spark.createDataFrame([(1.5, 1.0)], "x2 double, y2 double")
    assert [r.x for r in spatial.grid_join(left, right, 2.0, "left_anti").collect()] == [50.0]


def test_geometry_of_known_shapes(spark):
    one = spark.range(1)
    square, hole = G.ring(F.lit(0), F.lit(0), ((0, 0), (10, 0), (10, 10), (0, 10))), G.ring(F.lit(5), F.lit(5), ((-1, -1), (1, -1), (1, 1), (-1, 1)))
    at = lambda x, y: G.inside_rings(F.array(square, hole), F.lit(x), F.lit(y))
    row = one.select(at(2.0, 2.0), at(5.0, 5.0), at(11.0, 2.0), G.signed_area(square), G.length(square), *G.british_grid(F.lit(1.716073973), F.lit(52.658007833))).first()
    assert tuple(row[:5]) == (True, False, False, 100.0, 30.0)
    # a point of the survey's published example, within the datum shift's few metres
    assert abs(row[5] - 651409.8) < 5 and abs(row[6] - 313177.3) < 5


def test_licences_and_sizes_of_texts(spark):
    texts = {"https://creativecommons.org/licenses/by/4.0/?ref=x": True, "See http://creativecommons.org/publicdomain/zero/1.0/": True, "https://creativecommons.org/licenses/by-nc/4.0/": False, "CC_BY 4.0; no derivatives": False, "odbl": True, "": False, "mine": False}
    rows = spark.createDataFrame([(t, b) for t, b in texts.items()], "t string, b boolean").select("t", "b", S.is_open_license(F.col("t")).alias("open")).collect()
    assert all(r.open == r.b for r in rows)
    sizes = spark.createDataFrame([("1.5KB", 1536), ("2 MiB", 2097152), ("1TB", None), ("x", None), ("7", 7)], "t string, n long").select("n", S.byte_size(F.col("t")).alias("got")).collect()
    assert all(r.got == r.n for r in sizes)


def test_reports_and_feature_lines(spark, tmp_path):
    rows = spark.createDataFrame([(1, '{"type":"Point","coordinates":[1,2]}')], "n int, g string")
    sinks.write_report(rows.select("n"), str(tmp_path / "report"))
    assert [r.n for r in spark.read.json(str(tmp_path / "report")).collect()] == [1]
    assert json.loads(sinks.feature_lines(rows, "g", ["n"]).first().value) == {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1, 2]}, "properties": {"n": 1}}


def test_edges(spark):
    lattice = spark.range(180 * 180).select(F.floor(F.col("id") / 180).cast("int").alias("row"), F.pmod("id", F.lit(180)).cast("int").alias("col"))
    assert raster.with_edges(lattice).where("edge").count() == 4 * 179


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "i.csv").write_text('﻿Location,Quad Key,Url\n"A, B",213,u\n,,\n')
    assert [tuple(r) for r in readers.read_csv(spark, str(tmp_path / "i.csv")).collect()] == [("A, B", "213", "u")]
    with gzip.open(tmp_path / "l.json.gz", "wt") as f:
        f.write('{"h": 1.5}\nbroken\n{"h": 2}\n')
    assert [r.h for r in readers.read_json_lines(spark, str(tmp_path / "l.json.gz"), "h double").collect()] == [1.5, 2.0]
    feature = lambda c, **p: {"type": "Feature", "properties": p, "geometry": {"type": "Polygon", "coordinates": c}}
    (tmp_path / "f.json").write_text(json.dumps({"type": "FeatureCollection", "features": [feature([[[0, 0], [2, 0], [2, 1.5]]], name="n"), feature([[[9, 9], [10, 9], [9, 10]]], id="z")]}))
    found = readers.in_box(readers.read_features(spark, str(tmp_path / "f.json")), 1, 1, 3, 3).collect()
    assert [(r.id, r.name, r.east, r.north) for r in found] == [("feature:0", "n", 2.0, 1.5)]
    entry = lambda url, sha: {"url": url, "kind": "document", "bytes": 3, "sha256": sha}
    (tmp_path / "m.json").write_text(json.dumps({"schemaVersion": 1, "status": "ready", "generatedAt": "2026-01-01T00:00:00Z", "entries": [entry("https://a.org/1", "x"), entry("https://a.org/1", "y"), entry("https://b.org/2", "z")]}))
    faults = readers.manifest_faults(readers.read_manifest(spark, str(tmp_path / "m.json")), ["a.org"], "2026-01-01 05:00:00").collect()
    assert sorted((r.url, r.fault) for r in faults) == [("https://a.org/1", "conflict"), ("https://b.org/2", "host")]
    (tmp_path / "bin").mkdir()
    (tmp_path / "bin/a.pdf").write_bytes(b"%PDF-1")
    (tmp_path / "bin/b.pdf").write_bytes(b"%PDF-1")
    files = readers.read_files(spark, str(tmp_path / "bin"))
    sealed = sinks.seal(files)
    assert {r.mime for r in files.collect()} == {"application/pdf"} and [r.copies for r in sealed.collect()] == [2] and sinks.broken(sealed, files).count() == 0
    sinks.write_chunks(spark.createDataFrame([(1, 1, 5), (-1, 17, 6)], "x int, z int, block int"), str(tmp_path / "w"))
    assert {(r.chunk_x, r.chunk_z) for r in spark.read.parquet(str(tmp_path / "w")).collect()} == {(0, 0), (-1, 1)}


def test_stream_gives_the_table_s_counts(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").select("ts", "event_type")
    events.write.parquet(str(tmp_path / "in"))
    stream = windowed_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in")), late="1000 days")
    query = stream.writeStream.outputMode("complete").format("memory").queryName("counted").start()
    query.processAllAvailable()
    query.stop()
    assert sorted(map(tuple, spark.table("counted").collect())) == sorted(map(tuple, windowed_counts(events).collect()))
