"""Areas of many parts: the tile index against a plain test, bounded edges per tile, GeoJSON text."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from freshet.functions import geometry
from freshet.operators.area_index import points_in_areas, tile_index


def star(rng, cx, cy, size, corners, grid):
    """A closed ring around a place; on a grid, many corners and edges lie on tile borders."""
    ring = []
    for i in range(corners):
        far = size * rng.uniform(0.3, 1)
        px, py = cx + far * math.cos(2 * math.pi * i / corners), cy + far * math.sin(2 * math.pi * i / corners)
        ring.append([float(round(px)), float(round(py))] if grid else [px, py])
    return [*ring, ring[0]]


def held(parts, x, y):
    odd = False
    for ring in (r for part in parts for r in part):
        for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
            on = (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1)
            if on and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return True
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
    return odd


@pytest.mark.parametrize("grid, tile", [(True, 1.0), (True, 3.0), (False, 2.0), (False, 50.0), (True, 0.7)])
def test_index_agrees_with_whole_outlines(spark, grid, tile):
    rng = random.Random(int(10 * tile) + grid)
    areas = {}
    for k in range(12):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            cx, cy, size = rng.uniform(-20, 20), rng.uniform(-20, 20), rng.uniform(2, 12)
            rings = [star(rng, cx, cy, size, rng.randrange(3, 40), grid)]
            if rng.random() < 0.5:
                rings.append(star(rng, cx, cy, size * 0.3, 5, grid))
            parts.append(rings)
        areas[k] = parts
    points = [(i, float(rng.randrange(-30, 30)), float(rng.randrange(-30, 30))) for i in range(300)]
    points += [(300 + i, rng.uniform(-30, 30), rng.uniform(-30, 30)) for i in range(300)]
    points += [(900, None, 1.0), (901, 1.0, None)]
    shapes = spark.createDataFrame(list(areas.items()), f"area int, parts {geometry.PARTS}")
    df = spark.createDataFrame(points, "tx int, lon double, lat double")
    got = points_in_areas(df, shapes, "area", tile=tile, points_per_copy=20)
    assert got.columns == ["tx", "lon", "lat", "area"]
    want = sorted((i, k) for i, x, y in points[:600] for k, parts in areas.items() if held(parts, x, y))
    assert sorted((r.tx, r.area) for r in got.collect()) == want


def test_edges_of_a_tile_do_not_follow_the_outline(spark):
    """A ring of 20,000 edges: every tile holds its own stretch of it, inner tiles hold none."""
    n = 20_000
    ring = [[50 * math.cos(2 * math.pi * i / n), 50 * math.sin(2 * math.pi * i / n)] for i in range(n)]
    shapes = spark.createDataFrame([("a", [[[*ring, ring[0]]]])], f"area string, parts {geometry.PARTS}")
    index = tile_index(shapes, "area", "parts", 1.0).select(F.size("edges").alias("e"), F.size("turns").alias("t"), "inside")
    sizes = index.collect()
    assert max(r.e for r in sizes) < n / 50 and max(r.t for r in sizes) <= 4
    assert sum(r.e for r in sizes) < 1.2 * n
    assert sum(r.e == 0 and r.inside for r in sizes) > 7000


def test_odd_areas(spark, rows):
    square = [[[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 2.0], [0.0, 0.0]]]
    far = [[[p[0] + 5, p[1]] for p in square[0]]]
    shapes = spark.createDataFrame(
        [("a", [square]), ("a", [far]), ("none", None), ("empty", []), (None, [square]), ("b", [square, far])],
        f"area string, parts {geometry.PARTS}",
    )
    df = spark.createDataFrame([(1, 1.0, 1.0), (2, 6.0, 1.0), (3, 3.0, 1.0), (1, 1.0, 1.0)], "id int, lon double, lat double")
    got = points_in_areas(df, shapes, "area", tile=0.5)
    assert rows(got, "id", "area") == [(1, "a"), (1, "a"), (1, "b"), (1, "b"), (2, "a"), (2, "b")]
    assert points_in_areas(df.limit(0), shapes, "area").count() == 0
    assert points_in_areas(df, shapes.limit(0), "area").count() == 0


def test_geojson_of_parts_and_lines(spark):
    square = [[[0.0, 0.0], [3.0, 0.0], [3.0, 4.0], [0.0, 0.0]]]
    texts = [
        json.dumps({"type": "Polygon", "coordinates": square}), json.dumps({"type": "MultiPolygon", "coordinates": [square, square]}),
        json.dumps({"type": "LineString", "coordinates": square[0]}), json.dumps({"type": "MultiLineString", "coordinates": square * 2}),
        json.dumps({"type": "Point", "coordinates": [1, 2]}), '{"type": "Polygon"}', "broken", None,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("g", F.from_json("text", geometry.ANY))
    g = F.col("g")
    got = df.select(
        geometry.parts_geojson(geometry.area_parts(g)).alias("area"), geometry.lines_geojson(geometry.line_parts(g)).alias("line"),
        geometry.parts_perimeter(geometry.area_parts(g)).alias("around"),
    ).collect()
    assert [r.area and json.loads(r.area) for r in got[:2]] == [json.loads(t) for t in texts[:2]]
    assert [r.line and json.loads(r.line) for r in got[2:4]] == [json.loads(t) for t in texts[2:4]]
    assert [r.around for r in got] == [12.0, 24.0] + [None] * 6
    assert all(r.area is None for r in got[2:]) and all(r.line is None for r in (*got[:2], *got[4:]))
