"""Operators on small frames; expected rows are written by hand."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.functions.geometry import box, polygon
from freshet.operators import aggregates, calendars, clean, grid, joins, monitor, reshape, retention, spatial, windows
from freshet.operators.ordering import assign_ids, chunk_keys, distributed_row_number


def test_null_keys_are_left_out_of_groups(spark, rows):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", 3)], "k string, v int")
    assert rows(aggregates.count_by(df, ["k"])) == [("a", 2)]


def test_left_join_can_match_nulls(spark, rows):
    left = spark.createDataFrame([("a",), (None,)], "k string")
    right = spark.createDataFrame([(None, 1)], "k string, v int")
    assert rows(joins.left_join(left, right, ["k"])) == [("a", None), (None, None)]
    assert rows(joins.left_join(left, right, ["k"], null_safe=True)) == [("a", None), (None, 1)]


def test_nan_does_not_poison_hourly_means(spark, rows):
    at = dt.datetime(2024, 1, 1, 10)
    df = spark.createDataFrame([("s", at, 1.0), ("s", at, float("nan")), ("s", at, 3.0)], "s string, ts timestamp_ntz, v double")
    assert rows(windows.hourly_mean(df, ["s"], "ts", "v"), "v") == [(2.0,)]


def hours(n, start=dt.datetime(2024, 1, 1)):
    return [("s", start + dt.timedelta(hours=i), float(i)) for i in range(n)]


@pytest.mark.parametrize("n, best", [(7, None), (8, 3.5), (10, 5.5)])
def test_rolling_mean_needs_all_rows(spark, rows, n, best):
    df = spark.createDataFrame(hours(n), "s string, ts timestamp_ntz, v double")
    assert rows(windows.max_rolling_mean(df, ["s"], "ts", "v")) == [("s", best)]


def test_daily_metrics_split_at_noon(spark, rows):
    df = spark.createDataFrame(hours(24), "s string, ts timestamp_ntz, v double")
    got = rows(windows.daily_metrics(df, ["s"], "ts", "v"))
    assert got == [("s", dt.date(2024, 1, 1), 11.0, 5.5, 7.5, 12), ("s", dt.date(2024, 1, 2), 23.0, 17.5, 19.5, 12)]


def test_pct_change_is_positional_and_pads_on_request(spark, rows):
    df = spark.createDataFrame([("k", 1, 1.0), ("k", 2, None), ("k", 3, 2.0)], "k string, t int, v double")
    plain = windows.pct_change(df, ["k"], "t", "v", {"c": 1})
    padded = windows.pct_change(df, ["k"], "t", "v", {"c": 1}, pad=True)
    assert [r["c"] for r in plain.orderBy("t").collect()] == [None, None, None]
    assert [r["c"] for r in padded.orderBy("t").collect()] == [None, 0.0, 1.0]


def test_stitching_across_blocks_and_heading_lines(spark, rows):
    texts = ["head", "1,a", "b", "", "2,c", "3,d", "e", "f", "g"]
    df = spark.createDataFrame([("f", i, t) for i, t in enumerate(texts)], "file string, line_no long, value string")
    got = clean.stitch_records(df, F.col("value").rlike(r"^\d+,"), block=2)
    assert rows(got) == [("f", 1, 3, "1,a b "), ("f", 4, 1, "2,c"), ("f", 5, 4, "3,d e f g")]


def test_reject_reasons_in_order(spark, rows):
    df = spark.createDataFrame([(1, None, None), (2, "x", None), (3, "x", 5), (4, "x", 50)], "id int, a string, b int")
    good, bad = clean.with_reject_counts(df, [("no_a", F.col("a").isNull()), ("no_b", F.col("b").isNull()), ("small", F.col("b") < 10)])
    assert rows(good, "id") == [(4,)]
    assert rows(bad) == [("no_a", 1), ("no_b", 1), ("small", 1)]


def test_cleaning(spark, rows):
    df = spark.createDataFrame([("1.5", " "), ("ie", "x"), ("abc", None), ("--", "")], "n string, t string")
    cleaned = clean.coerce_numeric(clean.null_sentinels(clean.blank_to_null(df), ["n"]), ["n"])
    assert rows(cleaned) == [(1.5, None), (None, "x"), (None, None), (None, None)]
    assert clean.coercion_losses(df, ["n"]).first()[0] == 3
    assert rows(clean.deny(df, "t", ["x"]), "n") == [("--",), ("1.5",), ("abc",)]
    assert clean.where_text(df, "n", "like", "ie").count() == 1
    assert clean.normalize_names(df.toDF(" A/B c", "Longer Name Here"), max_len=10).columns == ["a_b_c", "longer_nam"]


def test_empty_rows_and_columns(spark, rows):
    df = spark.createDataFrame([("", 0, None), (None, 1, None), ("x", 0, None)], "a string, b int, c string")
    assert clean.drop_empty_columns(df).columns == ["a", "b"]
    assert rows(clean.drop_empty_rows(df)) == [("x", 0, None), (None, 1, None)]


def test_conform_unify_paths(spark, rows):
    df = spark.createDataFrame([(None, "east", 1), ("west", None, 2)], "`Region` string, `Region of Incident` string, n int")
    unified = clean.unify_headers(df, {"Region": ["Region", "Region of Incident"]})
    assert rows(unified, "Region", "n") == [("east", 1), ("west", 2)]
    schema = T.StructType.fromDDL("n bigint, missing double, Region string")
    assert clean.conform(unified, schema).columns == ["n", "missing", "Region"]
    nested = spark.createDataFrame(
        [(1, [("A", "x "), ("B", None)], None)],
        "id int, c array<struct<n: string, t: string>>, d struct<e: struct<f: string>>",
    )
    paths = {"names": ["c", "*", "n"], "first": ["c", 0, "t"], "far": ["c", 7, "t"], "deep": ["d", "e", "f"]}
    assert rows(clean.extract_paths(nested, paths)) == [("A, B", "x", None, None)]


def test_aggregates(spark, rows):
    df = spark.createDataFrame([("k", 2, "b", None), ("k", 1, "a", "x"), ("k", 3, "c", "y")], "k string, o int, t string, attr string")
    assert rows(aggregates.dedupe(df, ["k"], ["o"], "last")) == [("k", 3, "c", "y")]
    assert rows(aggregates.mean_first(df, ["k"], {"m": F.avg("o")}, ["attr"], ["o"])) == [("k", 2.0, "x")]
    numbered = aggregates.numbered_concat(df, ["k"], ["o"], {"commodity": F.col("t")}, "[{num}] {commodity}")
    assert rows(numbered) == [("k", "[1] a;\n[2] b;\n[3] c")]
    assert rows(aggregates.concat_by(df, ["k"], ["o"], F.col("t"), firsts=["attr"])) == [("k", "x", "a; b; c")]
    assert rows(aggregates.pivot_counts(df, "k", "t", ["a", "z"])) == [("k", 1, 0, 1)]
    with pytest.raises(ValueError):
        aggregates.assert_uniform(df, ["k", "t"])
    aggregates.assert_uniform(df, ["k"])
    assert aggregates.uniformity(df, ["attr"]).first()[0] is False


def test_unknown_values_mark_the_month(spark, rows):
    df = spark.createDataFrame([("A", "B", 2024, 2, "5"), ("A", "C", 2024, 2, "*")], "o string, a string, y int, m int, v string")
    got = rows(aggregates.aggregate_roles(df, ["o", "a"], "y", "m", "v"), "uid", "value", "some_stats_confidential")
    assert got == [("A_2024-02-28_o", 5.0, True), ("B_2024-02-28_a", 5.0, False), ("C_2024-02-28_a", 0.0, True)]


def test_completeness(spark, rows):
    data = [("d1", v, s) for v in "ab" for s in range(2)] + [("d2", "a", 0), ("d2", "b", 0), ("d2", "b", 1)]
    df = spark.createDataFrame(data, "d string, v string, s int")
    assert rows(aggregates.complete_dates(df, ["d"], "v", 2, "s", 2)) == [("d1", 2)]
    assert rows(aggregates.complete_dates(df, ["d"], "v", 2)) == [("d1", 2), ("d2", 2)]
    years = spark.createDataFrame([(2000 + i % 2 * 20, 1) for i in range(19)], "y int, v int")
    assert rows(aggregates.usable_years(years, "y", ["v"], 10, 10, 2021)) == [(2000, 10), (2020, 9)]


def brute_gaps(existing, end, n):
    return {end - dt.timedelta(days=i) for i in range(n)} - existing


def brute_tail(existing, end, n):
    out = set()
    for i in range(n):
        day = end - dt.timedelta(days=i)
        if day in existing:
            break
        out.add(day)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_gaps_match_a_walk(spark, rows, seed):
    rng = random.Random(seed)
    end = dt.date(2024, 3, 5)
    existing = {end - dt.timedelta(days=rng.randrange(2, 60)) for _ in range(rng.choice([0, 5, 30]))}
    df = spark.createDataFrame([(d,) for d in existing], "d date")
    assert {r[0] for r in rows(calendars.missing_dates(df, "d", "2024-03-05", 40))} == brute_gaps(existing, end, 40)
    assert {r[0] for r in rows(calendars.missing_tail(df, "d", "2024-03-05", 45))} == brute_tail(existing, end, 45)


def test_month_steps_do_not_drift(spark, rows):
    none = spark.createDataFrame([], "d date")
    got = [r[0] for r in rows(calendars.missing_dates(none, "d", "2024-03-31", 3, "1 month"))]
    assert sorted(got) == [dt.date(2024, 1, 31), dt.date(2024, 2, 29), dt.date(2024, 3, 31)]


@pytest.mark.parametrize("n", [0, 1, 5, 30, 31, 60, 99, 100, 150])
def test_large_budget_equals_top_n(spark, n):
    rng = random.Random(n)
    start = dt.datetime(2024, 1, 1)
    # one day holds a third of the rows and one time a fifth of them
    times = [start + dt.timedelta(hours=rng.randrange(24)) for _ in range(30)]
    times += [start + dt.timedelta(days=3)] * 20 + [start + dt.timedelta(days=rng.randrange(9)) for _ in range(45)] + [None] * 5
    df = spark.createDataFrame(list(enumerate(times)), "id int, ts timestamp_ntz")
    for nulls in ("last", "first"):
        newest = F.desc_nulls_first("ts") if nulls == "first" else F.desc_nulls_last("ts")
        want = df.orderBy(newest, F.desc("id")).limit(n)
        got = retention.keep_newest(df, "ts", n, "id", nulls)
        assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in want.collect())


def test_row_numbers_with_one_large_group(spark):
    df = spark.range(500).select(F.when(F.col("id") % 3 == 0, F.col("id") % 5).alias("g"), "id")
    got = distributed_row_number(df, [F.desc("id")], ["g"]).collect()
    groups = {}
    for r in got:
        groups.setdefault(r["g"], []).append((r["row_number"], r["id"]))
    assert sum(map(len, groups.values())) == 500
    for members in groups.values():
        members.sort()
        assert [n for n, _ in members] == list(range(1, len(members) + 1))
        assert [i for _, i in members] == sorted((i for _, i in members), reverse=True)
    ids = assign_ids(df, ["id"], 10).orderBy("id").collect()
    assert [r["uid"] for r in ids] == list(range(11, 511))


def test_chunks(spark, rows):
    df = spark.createDataFrame([("s", f"n{i}") for i in range(5)] + [("s", "n1")], "s string, n string")
    assert rows(chunk_keys(df, "s", "n", 2)) == [("s", 0, 2, "n0,n1"), ("s", 1, 2, "n2,n3"), ("s", 2, 1, "n4")]


def test_hours_round_trip(spark, rows):
    df = spark.createDataFrame([("n", dt.date(2024, 2, 28), *[float(h) for h in range(1, 25)])], "id string, d date, " + ", ".join(f"H{h} double" for h in range(1, 25)))
    long = reshape.unpivot_hours(df, ["id"], "d")
    assert long.agg(F.max("ts")).first()[0] == dt.datetime(2024, 2, 29)
    back = long.select("id", F.to_date(F.col("ts") - F.expr("INTERVAL 1 HOUR")).alias("d"), (F.hour(F.col("ts") - F.expr("INTERVAL 1 HOUR")) + 1).alias("h"), "value")
    assert rows(reshape.pivot_hours(back, ["id", "d"], "h", "value")) == rows(df)
    assert rows(reshape.unpivot_mean(df, ["id"])) == [("n", 12.5)]


def test_asof_and_dimension_growth(spark, rows):
    day = lambda d: dt.date(2024, 1, d)
    df = spark.createDataFrame([(1, day(10)), (2, day(5)), (3, None)], "id int, d date")
    have = spark.createDataFrame([(day(8),), (day(1),), (day(11),)], "h date")
    got = joins.asof_available(df, have, "d", 3)
    assert sorted((r["id"], r["available"]) for r in got.collect()) == [(1, day(8)), (2, None), (3, None)]
    dim = spark.createDataFrame([("a", 1)], "k string, v int")
    facts = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    source = spark.createDataFrame([("b", 2), ("c", 3)], "k string, v int")
    assert rows(joins.grow_dimension(facts, dim, source, "k")) == [("a", 1), ("b", 2)]


def holds(ring, x, y):
    odd, edge = False, False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
        edge |= cross == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2)
        if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            odd = not odd
    return odd or edge


@pytest.mark.parametrize("tile", [0.7, 3.0, 50.0])
def test_points_in_polygons_match_brute_force(spark, tile):
    rng = random.Random(5)
    rings = {}
    for i in range(12):
        pts = [(float(rng.randrange(-20, 20)), float(rng.randrange(-20, 20))) for _ in range(rng.randrange(3, 7))]
        rings[i] = [*pts, pts[0]]
    points = [(i, float(rng.randrange(-22, 22)), float(rng.randrange(-22, 22))) for i in range(200)]
    shapes = spark.createDataFrame([(i, ("Polygon", [[list(p) for p in r]])) for i, r in rings.items()], "area int, geometry struct<type: string, coordinates: array<array<array<double>>>>")
    df = spark.createDataFrame([*points, (999, None, 1.0)], "id int, lon double, lat double")
    got = sorted((r["id"], r["area"]) for r in spatial.points_in_polygons(df, shapes, tile=tile, points_per_copy=50).collect())
    assert got == sorted((i, a) for i, x, y in points for a, ring in rings.items() if holds(ring, x, y))


def test_simplify_keeps_within_tolerance(spark):
    ring = [[float(i), 0.05 * (i % 2)] for i in range(11)] + [[10.0, 5.0], [0.0, 0.0]]
    df = spark.createDataFrame([(1, [ring]), (2, None)], "id int, rings array<array<array<double>>>")
    got = {r["id"]: r["rings"] for r in spatial.simplify(df, "rings", 0.1).collect()}
    assert got[2] is None
    assert [tuple(p) for p in got[1][0]] == [(0.0, 0.0), (10.0, 0.0), (10.0, 5.0), (0.0, 0.0)]


def cells(spark, array):
    data = [(1, r, c, float(array[r, c])) for r in range(array.shape[0]) for c in range(array.shape[1])]
    return spark.createDataFrame(data, "k int, row int, col int, value double")


def test_grids_match_numpy(spark):
    rng = np.random.default_rng(1)
    array = rng.integers(0, 4, (6, 8)).astype(float)
    df = cells(spark, array)
    blocks = array.reshape(3, 2, 4, 2).transpose(0, 2, 1, 3).reshape(3, 4, 4)
    mean = {(r["row"], r["col"]): r["value"] for r in grid.overview(df, ["k"], 2, "value").collect()}
    mode = {(r["row"], r["col"]): r["value"] for r in grid.overview(df, ["k"], 2, "value", "MODE").collect()}
    for r in range(3):
        for c in range(4):
            values, counts = np.unique(blocks[r, c], return_counts=True)
            assert mean[r, c] == blocks[r, c].mean()
            assert mode[r, c] == values[counts.argmax()]
    placed = df.withColumns({"lon": F.col("col") + 0.5, "lat": F.lit(5.5) - F.col("row")})
    finer = {(r["row"], r["col"]): r["value"] for r in grid.regrid(placed, ["k"], (0.0, 6.0), (1.0, 1.0), (0.4, 0.25), "value").collect()}
    assert len(finer) == 24 * 20
    for (r, c), value in finer.items():
        assert value == array[int((r + 0.5) * 0.25), int((c + 0.5) * 0.4)]


def test_grid_mean_needs_every_file(spark, rows):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 2.0), (1, None)], "col int, value double")
    assert rows(grid.cell_mean(df, ["col"], "value", 10.0)) == [(0, 20.0), (1, None)]
    assert rows(grid.cell_mean(df, ["col"], "value", 1.0, 4)) == [(0, None), (1, None)]
    assert rows(grid.cell_max(df, ["col"], "value")) == [(0, 3.0), (1, 2.0)]


def test_polar_pole_and_known_corner(spark):
    # corner of the northern 25 km grid as its documentation gives it: 31.10 N, 168.35 E
    x, y = F.lit(-3850000.0), F.lit(5850000.0)
    lon, lat = grid.polar_to_lonlat(x, y)
    got = spark.range(1).select(lon, lat).first()
    assert got[1] == pytest.approx(30.98, abs=0.02) and got[0] == pytest.approx(168.35, abs=0.02)


def test_freshness(spark, rows):
    now = "2024-06-01 00:00:00"
    at = lambda d: dt.datetime(2024, 6, 1) - dt.timedelta(days=d)
    registry = spark.createDataFrame(
        [("ok", "x", "Daily", at(4)), ("late", "x", "daily", at(5)), ("why", "x", "daily", at(5)), ("nowhy", "x", "daily", at(5)),
         ("back", "x", "daily", at(1)), ("slow", "bio.037 chl", "daily", at(50))],
        "dataset_id string, name string, frequency string, last_updated timestamp_ntz",
    )
    known = spark.createDataFrame(
        [("why", "04/01/2024", "down"), ("nowhy", "05/31/2024", None), ("back", "05/31/2024", "x")],
        "dataset_id string, last_check string, reason string",
    )
    got = rows(monitor.freshness(registry, known, now), "dataset_id", "status", "recheck")
    assert got == [
        ("back", "recovered", False), ("late", "outdated", False), ("nowhy", "outdated", False), ("ok", "ok", False),
        ("slow", "ok", False), ("why", "explained", True),
    ]


def test_rollout(spark, rows):
    catalog = spark.createDataFrame([("d", 2019, "2019 use"), ("d", 2020, "2020 use")], "dataset string, year int, title string")
    data = spark.createDataFrame([("d", y) for y in (2019, 2020, 2021, 2022)], "dataset string, year int")
    got = rows(monitor.rollout_years(catalog, data, "dataset", "year", ["title"]), "year", "title", "default")
    assert got == [(2019, "2019 use", False), (2020, "2020 use", False), (2021, "2021 use", False), (2022, "2022 use", True)]
    layers = spark.createDataFrame([(0, "x"), (1, "y"), (5, "z")], "order int, shown string")
    dates = spark.createDataFrame([("b",), ("a",), ("a",)], "date string")
    assert rows(monitor.assign_by_order(layers, dates)) == [(0, "a"), (1, "b"), (5, "z")]


def test_box_and_polygon(spark):
    shape = spark.range(1).select(box(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(2.0)).alias("b"), polygon(F.array()).alias("p")).first()
    assert len(shape["b"]["coordinates"][0]) == 5 and shape["p"]["type"] == "Polygon"
