"""Geometry expressions and spatial joins on small shapes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cadastra.functions import geo
from cadastra.operators import spatial as X


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in [*points, points[0]]]


def square(x, y, side=1.0):
    return ring((x, y), (x + side, y), (x + side, y + side), (x, y + side))


SHAPES = {
    "a": [[square(0, 0, 2)]],
    "b": [[square(2, 0, 2)]],                     # shares an edge with a
    "holed": [[square(10, 10, 4), square(11, 11, 2)]],
    "inner": [[square(11.5, 11.5, 1)]],           # inside the hole, touches nothing
    "multi": [[square(20, 0)], [square(30, 0)]],
    "big": [[square(-5, -5, 12)]],                # contains a and b
    "tri": [[ring((40, 0), (44, 0), (40, 4))]],
    "cross": [[ring((39, 1), (45, 1), (45, 1.5), (39, 1.5))]],  # crosses tri, no vertex inside it
}


@pytest.fixture(scope="module")
def shapes(spark):
    return spark.createDataFrame(list(SHAPES.items()), f"key string, geometry {geo.GEOMETRY}")


def test_measures(shapes):
    g = F.col("geometry")
    rows = shapes.select(
        "key", geo.area(g).alias("area"), geo.perimeter(g).alias("per"), geo.centroid(g).alias("c"), geo.parts(g).alias("parts"), geo.holes(g).alias("holes"), *geo.bbox(g)
    ).collect()
    got = {r["key"]: r for r in rows}
    assert (got["a"]["area"], got["a"]["per"], tuple(got["a"]["c"])) == (4.0, 8.0, (1.0, 1.0))
    assert (got["holed"]["area"], got["holed"]["holes"], got["holed"]["per"]) == (12.0, 1, 24.0)
    assert tuple(got["holed"]["c"]) == (12.0, 12.0)
    assert (got["multi"]["area"], got["multi"]["parts"], tuple(got["multi"]["c"])) == (2.0, 2, (25.5, 0.5))
    assert got["tri"]["area"] == 8.0 and abs(got["tri"]["c"]["x"] - (40 + 4 / 3)) < 1e-9
    assert (got["big"]["bbox_xmin"], got["big"]["bbox_xmax"], got["big"]["bbox_ymin"], got["big"]["bbox_ymax"]) == (-5, 7, -5, 7)


def test_true_area(spark):
    box = geo.box_polygon(*[F.lit(float(v)) for v in (-180, -90, 180, 90)])
    half = geo.box_polygon(*[F.lit(float(v)) for v in (0, 45, 1, 46)])
    row = spark.range(1).select(geo.area_km2(box).alias("earth"), geo.area_km2(half).alias("cell")).first()
    assert abs(row["earth"] - 510_065_622) < 200          # surface of the ellipsoid
    assert abs(row["cell"] - 8686.9) < 15                  # one degree square at 45.5 north


def test_contains(spark, shapes):
    points = [(1, 1.0, 1.0), (2, 12.0, 12.0), (3, 10.5, 12.0), (4, 2.0, 1.0), (5, 50.0, 50.0), (6, 30.5, 0.5), (7, 2.0, 0.0), (8, None, 1.0)]
    df = spark.createDataFrame(points, "pt int, x double, y double")
    got = {}
    for r in X.point_in_polygon(df, "x", "y", shapes, "key", "geometry").collect():
        got.setdefault(r["pt"], set()).add(r["key"])
    # Point 4 lies on the common edge of a and b, point 7 on their corner: only big holds them.
    assert got == {1: {"a", "big"}, 2: {"inner"}, 3: {"holed"}, 4: {"big"}, 6: {"multi"}, 7: {"big"}}
    first = {r["pt"]: r["key"] for r in X.locate(df, "pt", "x", "y", shapes, "key", "geometry").collect()}
    assert first == {1: "a", 2: "inner", 3: "holed", 4: "big", 6: "multi", 7: "big"}


def test_neighbours(shapes):
    pairs = {(r["key"], r["neighbour"]) for r in X.neighbours(shapes, "key", "geometry").collect()}
    want = {("a", "b"), ("a", "big"), ("b", "big"), ("cross", "tri")}
    assert pairs == want | {(b, a) for a, b in want}


def test_neighbours_need_known_equal_groups(spark, shapes):
    grouped = shapes.withColumn("g", F.when(F.col("key").isin("a", "big"), "x").when(F.col("key") == "b", "y"))
    pairs = {(r["key"], r["neighbour"]) for r in X.neighbours(grouped, "key", "geometry", ["g"]).collect()}
    assert pairs == {("a", "big"), ("big", "a")}


def test_sizes_far_apart(spark):
    rows = [("country", [[square(0, 0, 1000)]])] + [(f"h{i}", [[square(i * 0.5, 3, 0.01)]]) for i in range(40)]
    df = spark.createDataFrame(rows, f"key string, geometry {geo.GEOMETRY}")
    pairs = X.neighbours(df, "key", "geometry").collect()
    assert len(pairs) == 80 and X.cell_index(X.outline_edges(df, "key", "geometry"), "key").count() <= 4 * 41


def test_zonal(spark, shapes):
    pixels = [(1.0, 1.0, 10.4), (1.5, 1.5, 21.0), (1.2, 1.2, -9.0), (1.0, 1.0, 12.0), (20.5, 0.5, 7.9)]
    df = spark.createDataFrame(pixels, "x double, y double, v double")
    got = {r["key"]: tuple(r)[1:] for r in X.zonal_stats(df, "x", "y", "v", shapes, "key", "geometry").collect()}
    assert got["a"] == (10, 21, 14.5) and got["multi"] == (7, 7, 7.9) and got["holed"] == (None, None, None)


def test_binary_round_trip(spark, shapes):
    from cadastra.functions import wkb
    from cadastra.operators.history import stored_geometry

    rows = shapes.withColumn("centre", geo.centroid(F.col("geometry"))).union(
        spark.sql(f"SELECT 'none' AS key, CAST(NULL AS {geo.GEOMETRY}) AS geometry, CAST(NULL AS struct<x:double,y:double>) AS centre")
    )
    stored = stored_geometry(rows)
    assert stored.columns == ["key", "geometry_wkb", "geometry_srid", "centre_wkb", "centre_srid"]
    back = stored.select("key", wkb.from_wkb("geometry_wkb").alias("g"), F.hex("centre_wkb").alias("c"))
    joined = back.join(rows, "key").collect()
    assert len(joined) == len(SHAPES) + 1 and all(r["g"] == r["geometry"] for r in joined)
    # The layout itself: byte order, type, ring count, point count, five points.
    square = stored.filter("key = 'a'").select(F.hex("geometry_wkb")).first()[0]
    assert square[:26] == "01" + "03000000" + "01000000" + "05000000" and len(square) == 2 * 93


def even_odd(rings, x, y):
    """Strictly inside by walking all edges."""
    odd = False
    for points in rings:
        for (ax, ay), (bx, by) in zip(points, points[1:]):
            cross = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
            if cross == 0 and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                return False
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
    return odd


def test_points_equal_a_walk_over_all_edges(spark):
    """Stars with many corners, holes and corners on whole numbers; points on a lattice and at random."""
    import math
    import random

    r = random.Random(7)
    shapes, plain = [], {}
    for n in range(30):
        cx, cy, corners = r.randint(-20, 20), r.randint(-20, 20), r.choice([3, 4, 8, 60, 400])
        rings = []
        for size in (r.choice([1, 3, 12]), 0.3):
            points = []
            for i in range(corners):
                radius = size * r.uniform(0.6, 1.0)
                x, y = cx + radius * math.cos(2 * math.pi * i / corners), cy + radius * math.sin(2 * math.pi * i / corners)
                points.append((round(x), round(y)) if corners == 8 else (x, y))
            rings.append([(float(x), float(y)) for x, y in [*points, points[0]]])
        shapes.append((f"s{n}", [[[{"x": x, "y": y} for x, y in points] for points in rings]]))
        plain[f"s{n}"] = rings
    points = [(i, i % 41 - 20 + 0.0, i // 41 - 20 + 0.0) for i in range(41 * 41)]
    points += [(2000 + i, r.uniform(-22, 22), r.uniform(-22, 22)) for i in range(1500)]
    df = spark.createDataFrame(points, "pt int, x double, y double")
    found = X.point_in_polygon(df, "x", "y", spark.createDataFrame(shapes, f"key string, geometry {geo.GEOMETRY}"), "key", "geometry")
    want = {(pt, key) for pt, x, y in points for key, rings in plain.items() if even_odd(rings, x, y)}
    got = [(x["pt"], x["key"]) for x in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 500


@pytest.fixture(scope="module")
def coast(spark):
    """An outline of 100,000 edges around the origin."""

    def at(i):
        a = F.lit(2 * 3.141592653589793) * i / 100_000
        d = F.lit(100.0) + F.sin(a * 500) * 3
        return F.struct((d * F.cos(a)).alias("x"), (d * F.sin(a)).alias("y"))

    ring = F.transform(F.concat(F.sequence(F.lit(0), F.lit(99_999)), F.array(F.lit(0))), at)
    return spark.range(1).select(F.lit("coast").alias("key"), F.array(F.array(ring)).alias("geometry"))


def test_a_long_outline_costs_a_point_the_edges_of_its_cell(spark, coast):
    edges = X.outline_edges(coast, "key", "geometry")
    index = X.cell_index(edges, "key").cache()
    size = index.agg(F.max(F.size("edges")).alias("most"), F.sum(F.size("edges")).alias("all"), F.count("*").alias("cells")).first()
    # 100,000 edges, each in one or two cells; no cell holds more than a three-hundredth of them.
    assert size["most"] <= 330 and 100_000 <= size["all"] <= 200_000 and size["cells"] <= 60_000
    points = [(1, 0.0, 0.0), (2, 96.9, 0.0), (3, 103.5, 0.0), (4, 70.0, 70.0), (5, 75.0, 75.0), (6, 0.0, -96.0)]
    df = spark.createDataFrame(points, "pt int, x double, y double")
    found = X.points_in_index(df, "x", "y", index, ["key"])
    assert sorted(x["pt"] for x in found.collect()) == [1, 2, 4, 6]


def test_a_shape_with_very_many_neighbours(spark):
    """One large shape and 50,000 small ones along its border: found once each, in many tasks."""
    n = 50_000
    i = F.col("id").cast("double")
    small = spark.range(n).select(F.col("id").alias("key"), geo.box_polygon(i, F.lit(-0.5), i + 0.5, F.lit(0.0)).alias("geometry"))
    large = spark.range(1).select(F.lit(-1).cast("long").alias("key"), geo.box_polygon(F.lit(-1.0), F.lit(0.0), F.lit(n + 1.0), F.lit(9.0)).alias("geometry"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pairs = X.neighbours(small.union(large), "key", "geometry")
        assert pairs.count() == 2 * n
        tasks = pairs.filter("key = -1").groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert pairs.filter("key = -1").select("neighbour").distinct().count() == n and tasks == 4


def test_a_part_inside_another_shape_is_a_neighbour(spark):
    rows = [("outer", [[square(0, 0, 10)]]), ("parts", [[square(50, 50)], [square(4, 4)]]), ("hole", [[square(-5, -5, 30), square(-2, -2, 20)]])]
    df = spark.createDataFrame(rows, f"key string, geometry {geo.GEOMETRY}")
    pairs = {(x["key"], x["neighbour"]) for x in X.neighbours(df, "key", "geometry").collect()}
    assert pairs == {("outer", "parts"), ("parts", "outer")}
