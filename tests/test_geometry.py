"""Containment, overlap and reprojection against independent arithmetic."""

import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from callgrid.functions import geometry as g
from callgrid.operators import spatial as sp
from callgrid.sources.readers import rings_from_vertices, rings_from_wkt

RING = "array<struct<x:double,y:double>>"
L_SHAPE = [(0, 0), (4, 0), (4, 1), (1, 1), (1, 4), (0, 4)]
SQUARE = [(0.5, 0.5), (2.5, 0.5), (2.5, 2.5), (0.5, 2.5)]
STAR = [(0, 3), (1, 1), (3, 0), (1, -1), (0, -3), (-1, -1), (-3, 0), (-1, 1)]


def polys(spark, **rings):
    floats = [(name, [(float(x), float(y)) for x, y in ring]) for name, ring in rings.items()]
    return spark.createDataFrame(floats, f"name string, ring {RING}")


def inside(ring, x, y):
    hit = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            hit = not hit
    return hit


@pytest.mark.parametrize("cell", [0.3, 1.0, 5.0, None])
def test_points_in_concave_polygons(spark, cell):
    r = random.Random(1)
    points = [(i, r.uniform(-4, 5), r.uniform(-4, 5)) for i in range(500)] + [(900 + i, float(i % 5), float(i // 5)) for i in range(25)]
    rings = {"l": L_SHAPE, "star": STAR, "square": SQUARE}
    df = spark.createDataFrame(points, "id long, x double, y double")
    got = {(x["id"], x["name"]) for x in sp.point_in_polygon(df, polys(spark, **rings), "x", "y", "ring", cell).collect()}
    assert got == {(i, n) for i, x, y in points for n, ring in rings.items() if inside(ring, x, y)}


def test_shared_border_belongs_to_one(spark):
    tiles = {f"{i}{j}": [(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1)] for i in range(3) for j in range(3)}
    points = [(k, i / 2, j / 2) for k, (i, j) in enumerate((i, j) for i in range(6) for j in range(6))]
    df = spark.createDataFrame(points, "id long, x double, y double")
    found = sp.point_in_polygon(df, polys(spark, **tiles), "x", "y", "ring").groupBy("id").count().collect()
    assert len(found) == 36 and all(r["count"] == 1 for r in found)


def test_left_join_keeps_outside_points_and_limits(spark):
    df = spark.createDataFrame([(1, 0.5, 0.5), (2, 99.0, 99.0), (3, None, 1.0)], "id long, x double, y double")
    got = {r["id"]: r["name"] for r in sp.point_in_polygon(df, polys(spark, l=L_SHAPE), "x", "y", "ring", how="left").collect()}
    assert got == {1: "l", 2: None, 3: None}


def test_merge_join_beyond_the_broadcast_bound(spark):
    spark.conf.set(sp.BROADCAST_BYTES_KEY, "1")
    try:
        df = spark.createDataFrame([(1, 0.5, 0.5), (2, 9.0, 9.0)], "id long, x double, y double")
        got = sp.point_in_polygon(df, polys(spark, l=L_SHAPE), "x", "y", "ring")
        assert "SortMergeJoin" in got._jdf.queryExecution().executedPlan().toString()
        assert [r["id"] for r in got.collect()] == [1]
    finally:
        spark.conf.unset(sp.BROADCAST_BYTES_KEY)


def sampled_overlap(a, b, n=400):
    """Area by counting fine grid points."""
    xs, ys = [p[0] for p in a + b], [p[1] for p in a + b]
    dx, dy = (max(xs) - min(xs)) / n, (max(ys) - min(ys)) / n
    hits = sum(
        inside(a, min(xs) + (i + 0.5) * dx, min(ys) + (j + 0.5) * dy) and inside(b, min(xs) + (i + 0.5) * dx, min(ys) + (j + 0.5) * dy)
        for i in range(n)
        for j in range(n)
    )
    return hits * dx * dy


@pytest.mark.parametrize("other", [SQUARE, STAR, [(3, 3), (5, 3), (4, 5)], SQUARE[::-1]])
def test_overlap_area(spark, other):
    df = polys(spark, a=L_SHAPE).select(F.col("ring").alias("a")).crossJoin(polys(spark, b=other).select(F.col("ring").alias("b")))
    got = df.select(g.overlap_area(g.edges("a"), g.edges("b"))).first()[0]
    assert got == pytest.approx(sampled_overlap(L_SHAPE, other), abs=0.1)


def test_exact_overlaps_and_areas(spark):
    df = polys(spark, l=L_SHAPE, sq=SQUARE)
    area = {r[0]: r[1] for r in df.select("name", g.ring_area("ring")).collect()}
    assert area == {"l": 7.0, "sq": 4.0}
    w = sp.overlap_weights(df.where("name='l'").withColumnRenamed("name", "a"), df.where("name='sq'").withColumnRenamed("name", "b"), "a", "b", "ring")
    assert w.first()["multiplier"] == pytest.approx((2 * 0.5 + 0.5 * 1.5) / 4)


def test_touching_polygons_intersect_with_weight_zero(spark):
    a = polys(spark, a=[(0, 0), (1, 0), (1, 1), (0, 1)]).withColumnRenamed("name", "ka")
    b = polys(spark, touching=[(1, 0), (2, 0), (2, 1), (1, 1)], apart=[(3, 0), (4, 0), (4, 1)], within=[(0.2, 0.2), (0.4, 0.2), (0.4, 0.4)])
    b = b.withColumnRenamed("name", "kb")
    got = {r["kb"]: r["multiplier"] for r in sp.overlap_weights(a, b, "ka", "kb", "ring").collect()}
    assert got == {"touching": pytest.approx(0.0), "within": pytest.approx(1.0)}
    assert {r["kb"] for r in sp.intersects_any(b, a, "kb", "ring", "ka").collect()} == {"touching", "within"}


def test_holes_and_wkt(spark):
    wkt = "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))"
    layer = rings_from_wkt(spark.createDataFrame([("p", wkt)], "name string, w string"), "w")
    df = spark.createDataFrame([(1, 5.0, 5.0), (2, 1.0, 1.0), (3, 11.0, 1.0)], "id long, x double, y double")
    got = sp.point_in_polygon(df, layer, "x", "y", "rings", several=True).collect()
    assert [r["id"] for r in got] == [2]


def test_reprojection(spark):
    """The false origin, and both standard parallels, where the scale is one."""
    p = g.OHIO_SOUTH_FT
    origin = spark.range(1).select(g.lcc_to_lonlat(F.lit(p["x_0"] / p["to_metre"]), F.lit(0.0)).alias("p")).first()["p"]
    assert origin["x"] == pytest.approx(-82.5, abs=1e-9) and origin["y"] == pytest.approx(38.0, abs=1e-9)
    for lat in (p["lat_1"], p["lat_2"]):
        step = 1e-4
        a, b = spark.range(1).select(g.lonlat_to_lcc(F.lit(-82.5 - step), F.lit(lat)), g.lonlat_to_lcc(F.lit(-82.5 + step), F.lit(lat))).first()
        e2 = 2 / p["inverse_flattening"] - 1 / p["inverse_flattening"] ** 2
        n = p["semi_major"] / math.sqrt(1 - e2 * math.sin(math.radians(lat)) ** 2)
        true = math.radians(2 * step) * n * math.cos(math.radians(lat))
        assert (b["x"] - a["x"]) * p["to_metre"] == pytest.approx(true, rel=1e-6)
    back = spark.range(50).select(
        (F.lit(1_350_000.0) + F.col("id") * 3000).alias("x"), (F.lit(380_000.0) + F.col("id") * 2000).alias("y")
    )
    there = back.withColumn("p", g.lcc_to_lonlat("x", "y")).withColumn("q", g.lonlat_to_lcc(F.col("p.x"), F.col("p.y")))
    worst = there.agg(F.max(F.greatest(F.abs(F.col("q.x") - F.col("x")), F.abs(F.col("q.y") - F.col("y"))))).first()[0]
    assert worst < 1e-3


def test_one_polygon_for_each_point_on_the_left(spark):
    """Areas overlap: a row has one of them, the first by name, and rows outside stay."""
    square = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))"
    layer = spark.createDataFrame([("b", square), ("a", square), ("c", "POLYGON ((2 2, 9 2, 9 9, 2 9, 2 2))")], "name string, wkt string")
    layer = rings_from_wkt(layer, "wkt", "rings").select("name", "rings")
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 3.0, 3.0), (3, 8.0, 8.0), (4, 20.0, 1.0), (None, 1.0, 2.0)], "id int, x double, y double")
    got = sp.point_in_polygon(points, layer, "x", "y", "rings", several=True, how="left", key="id").select("id", "name").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, "a"), (2, "a"), (3, "c"), (4, None), (None, "a")], key=repr)
    none = layer.limit(0)
    assert sp.point_in_polygon(points, none, "x", "y", "rings", several=True, how="left", key="id").where("name is null").count() == 5
    assert sp.point_in_polygon(points, none, "x", "y", "rings", several=True).count() == 0


def test_polygons_of_very_different_sizes(spark):
    """A large polygon beside small ones has as many cells as they have, and every answer stays the same."""
    small = [(f"s{i}", [(i, 0), (i + 1, 0), (i + 1, 1), (i, 1)]) for i in range(60)]
    large = [("L", [(0, 0), (1000, 0), (1000, 1000), (0, 1000)])]
    frame = spark.createDataFrame(
        [(n, [{"x": float(x), "y": float(y)} for x, y in r]) for n, r in small + large], "name string, ring array<struct<x: double, y: double>>"
    )
    cells = sp.classified_cells(sp.with_cell_size(sp.with_edges(frame, "ring"))).groupBy("name").count().collect()
    assert max(r["count"] for r in cells) <= 17 * 17 and len(cells) == 61
    points = spark.range(500).selectExpr("id", "(id * 37 % 997) / 10.0D as x", "(id * 61 % 89) / 40.0D as y")
    got = sp.point_in_polygon(points, frame, "x", "y", "ring").groupBy("id").agg(F.sort_array(F.collect_list("name")).alias("n"))
    got = {r["id"]: r["n"] for r in got.collect()}
    for r in points.collect():
        want = ["L"] + [n for n, _ in small if int(n[1:]) < r["x"] < int(n[1:]) + 1 and 0 < r["y"] < 1]
        if r["x"] % 1 and r["y"] % 1 and r["y"] > 0:
            assert got[r["id"]] == sorted(want)
    other = frame.withColumnRenamed("name", "o")
    pairs = sp.overlap_weights(frame, other, "name", "o", "ring").where("name = 'L'").collect()
    assert len(pairs) == 61 and all(abs(r["multiplier"] - 1) < 1e-9 for r in pairs)
    assert sp.intersects_any(frame, other.where("o = 'L'"), "name", "ring", "o").count() == 61


def test_wkt_with_parts_and_holes(spark):
    df = spark.createDataFrame(
        [
            ("m", "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1)), ((10 0, 12 0, 12 2, 10 2, 10 0)))"),
            ("p", "polygon((0 0,4 0,4 4,0 4,0 0))"),
        ],
        "name string, wkt string",
    )
    rings = {r["name"]: r["rings"] for r in rings_from_wkt(df, "wkt").collect()}
    assert [len(r) for r in rings["m"]] == [5, 5, 5] and [len(r) for r in rings["p"]] == [5]
    assert (rings["m"][2][1]["x"], rings["m"][2][1]["y"]) == (12.0, 0.0)
    points = spark.createDataFrame([(1, 1.5, 1.5), (2, 3.0, 3.0), (3, 11.0, 1.0), (4, 7.0, 1.0)], "id int, x double, y double")
    layer = rings_from_wkt(df.where("name = 'm'"), "wkt")
    assert sorted(r["id"] for r in sp.point_in_polygon(points, layer, "x", "y", "rings", several=True).collect()) == [2, 3]
    rows = [("k", p, i, float(x), float(y)) for p, ring in enumerate([[(0, 0), (4, 0), (4, 4)], [(9, 9), (10, 9), (10, 10)]]) for i, (x, y) in enumerate(ring)]
    parts = rings_from_vertices(spark.createDataFrame(rows, "name string, part int, seq int, x double, y double").repartition(3), "name", part="part")
    assert [[(v["x"], v["y"]) for v in r] for r in parts.first()["rings"]] == [[(0, 0), (4, 0), (4, 4)], [(9, 9), (10, 9), (10, 10)]]


def test_first_of_layers(spark):
    """Two layers at once: overlapping areas, parts of a plane without any, a point given twice, points without a place."""
    from callgrid.operators.spatial import first_of_layers, point_in_polygon

    def square(x, y, side):
        return [(float(a), float(b)) for a, b in ((x, y), (x + side, y), (x + side, y + side), (x, y + side))]

    schema = "{} string, ring array<struct<x double, y double>>"
    one = spark.createDataFrame([("b", square(0, 0, 4)), ("a", square(2, 2, 4)), ("c", square(100, 100, 0.5))], schema.format("zone"))
    two = spark.createDataFrame([("t", square(3, 3, 40))], schema.format("tract"))
    points = [(1, 1.0, 1.0), (2, 3.0, 3.5), (3, 5.0, 5.0), (4, 30.0, 30.0), (5, 50.0, 50.0), (6, None, 1.0), (2, 3.0, 3.5), (7, 100.25, 100.25), (2, 1.0, 1.0)]
    df = spark.createDataFrame(points, "id int, x double, y double")
    got = first_of_layers(df, [one, two], "x", "y", "ring", "id")
    assert rows(got, "id", "x", "zone", "tract") == sorted(
        [(1, 1.0, "b", None), (2, 3.0, "a", "t"), (3, 5.0, "a", "t"), (4, 30.0, None, "t"), (7, 100.25, "c", None), (2, 1.0, "b", None)], key=repr
    )
    for layer, name in ((one, "zone"), (two, "tract")):
        alone = point_in_polygon(df, layer, "x", "y", "ring", how="left", key="id").where(f"{name} is not null").distinct()
        assert rows(alone, "id", "x", name) == rows(got.where(f"{name} is not null"), "id", "x", name)
    assert first_of_layers(df, [one.limit(0), two.limit(0)], "x", "y", "ring", "id").collect() == []
    assert first_of_layers(df.limit(0), [one, two], "x", "y", "ring", "id").collect() == []
