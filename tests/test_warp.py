"""Nearest places against brute force, warped grids without empty cells, overviews of all levels."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from freshet.operators import grid, warp


def xyz(lon, lat):
    a, b = math.radians(lon), math.radians(lat)
    return math.cos(b) * math.cos(a), math.cos(b) * math.sin(a), math.sin(b)


@pytest.mark.parametrize("kind, spacing", [("cap", 1.0), ("scattered", 5.0), ("two", 0.2), ("one", 10.0)])
def test_nearest_places_match_brute_force(spark, kind, spacing):
    rng = random.Random(len(kind))
    if kind == "cap":
        sources = [(rng.uniform(-180, 180), rng.uniform(70, 90)) for _ in range(300)]
    elif kind == "scattered":
        sources = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(200)]
    elif kind == "two":
        sources = [(rng.gauss(x, 0.5), rng.gauss(y, 0.5)) for x, y in ((179, 10), (-60, -89)) for _ in range(60)]
    else:
        sources = [(0.0, 90.0)]
    targets = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(150)] + [(180.0, 0.0), (-180.0, 0.0), (0.0, -90.0)]
    s = spark.createDataFrame([(i, -i, *p) for i, p in enumerate(sources)] + [(-9, 0, None, 1.0)], "s_row int, s_col int, lon double, lat double")
    t = spark.createDataFrame([(i, i, *p) for i, p in enumerate(targets)], "t_row int, t_col int, lon double, lat double")
    got = {r.t_row: (r.s_row, r.km) for r in warp.nearest_places(t, s, spacing).collect()}
    for i, p in enumerate(targets):
        best = min(math.dist(xyz(*p), xyz(*q)) for q in sources)
        assert math.dist(xyz(*p), xyz(*sources[got[i][0]])) == pytest.approx(best, abs=1e-9)
        assert got[i][1] == pytest.approx(2 * warp.EARTH_KM * math.asin(min(1, best / 2)), abs=1e-4)
    assert len(got) == len(targets)
    assert warp.nearest_places(t, s.limit(0), spacing).count() == 0


def test_polar_grid_on_degrees_has_no_empty_cell(spark, rows):
    x, y = (F.col("id") % 20 - 9.5) * 200000, (F.floor(F.col("id") / 20) - 9.5) * 200000
    lon, lat = grid.polar_to_lonlat(x, y, "north")
    cells = spark.range(400).select(
        F.floor(F.col("id") / 20).alias("row"), (F.col("id") % 20).alias("col"), lon.alias("lon"), lat.alias("lat"), F.col("id").alias("v")
    ).withColumn("day", F.explode(F.array(F.lit(1), F.lit(2))))
    target = warp.Grid(-180.0, 90.0, 10.0, 5.0, 6, 36)
    out = warp.warp(cells, ["day"], "v", target, 2.0)
    assert Counter(r.day for r in out.collect()) == {1: 216, 2: 216}
    assert out.select("day", "row", "col").distinct().count() == 432
    near = warp.warp(cells, ["day"], "v", target, 2.0, max_km=100.0)
    assert 0 < near.count() < 432


@pytest.mark.parametrize("policy", ["MEAN", "MODE", "SAMPLE"])
def test_pyramid_matches_single_levels(spark, policy):
    rng = random.Random(3)
    cells = [("g", r, c, rng.choice([None, 1, 2, 3, 3])) for r in range(21) for c in range(13)] + [("h", 5, 700000, 9)]
    df = spark.createDataFrame(cells, "k string, row int, col int, v int")
    got = {(r.k, r.level, r.row, r.col): r.v for r in warp.pyramid(df, ["k"], "v", 4, policy).collect()}
    want = {}
    for level in range(1, 5):
        blocks = defaultdict(list)
        for k, r, c, v in cells:
            if v is not None:
                blocks[k, level, r >> level, c >> level].append((r, c, v))
        for key, held in blocks.items():
            values = [v for *_, v in held]
            if policy == "MEAN":
                want[key] = sum(values) / len(values)
            elif policy == "MODE":
                want[key] = min(set(values), key=lambda v: (-values.count(v), v))
            else:
                code = lambda h: sum(((h[0] >> i & 1) << (2 * i + 1)) | ((h[1] >> i & 1) << 2 * i) for i in range(24))
                want[key] = min(held, key=code)[2]
    assert got == want


def test_pyramid_reads_the_cells_once(spark, tmp_path):
    path = str(tmp_path / "cells")
    spark.range(1000).selectExpr("id % 40 AS row", "id div 40 AS col", "id AS v").write.parquet(path)
    for policy in ("MEAN", "MODE", "SAMPLE"):
        plan = warp.pyramid(spark.read.parquet(path), [], "v", 5, policy)._jdf.queryExecution().executedPlan().toString()
        assert plan.split("Initial Plan")[0].count("FileScan") == 1
        assert plan.count("Expand") >= 1
    with pytest.raises(ValueError):
        warp.pyramid(spark.read.parquet(path), [], "v", 5, "MEDIAN")


def test_z_order_is_reversible(spark):
    df = spark.createDataFrame([(0, 0), (1, 2), (2**31 - 1, 5), (123456, 2**30)], "r long, c long")
    key = warp.z_order(F.col("r"), F.col("c"))
    row, col = warp.from_z_order(F.col("z"))
    assert df.withColumn("z", key).filter((row != F.col("r")) | (col != F.col("c"))).count() == 0
    parent = df.filter(F.shiftright(key, 2) != warp.z_order(F.shiftright("r", 1), F.shiftright("c", 1)))
    assert parent.count() == 0
