"""Streams and batches give the same tables; repeats change nothing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from freshet.operators.retention import keep_newest
from freshet.operators.windows import latest_per
from freshet.sinks.targets import Target
from freshet.streaming import incremental as inc
from freshet.streaming import streams

SCHEMA = "id int, p string, ts timestamp_ntz, v int"
T0 = dt.datetime(2024, 1, 1)


def at(hours):
    return T0 + dt.timedelta(hours=hours)


DAYS = [
    [(1, "a", at(1), 1), (2, "b", at(2), 2), (2, "b", at(2), 2)],
    [(3, "a", at(25), 3), (1, "a", at(1), 1)],
    [(4, "b", at(49), 4), (5, "a", at(50), 5), (3, "a", at(25), 3), (1, "a", at(1), 1)],
    [(1, "a", at(1), 1)],
]


@pytest.fixture
def files(spark, tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    for i, day in enumerate(DAYS):
        spark.createDataFrame(day, SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"raw{i}"))
        source = next((tmp_path / f"raw{i}").glob("*.parquet"))
        (path / f"day{i}.parquet").write_bytes(source.read_bytes())
    return str(path)


def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def test_files_are_read_once(spark, files, tmp_path, rows):
    args = (spark, files, schema(spark), str(tmp_path / "out"), str(tmp_path / "ck"))
    streams.ingest_files(*args, file_id="f", denied=["day1.parquet"])
    streams.ingest_files(*args, file_id="f", denied=["day1.parquet"])
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 8 and rows(out.select("f").distinct()) == [("day0.parquet",), ("day2.parquet",), ("day3.parquet",)]


def test_insert_if_new_batches_equal_one_load_and_stream(spark, files, tmp_path, rows):
    frames = [spark.createDataFrame(day, SCHEMA) for day in DAYS]
    target = Target(spark, str(tmp_path / "t"), schema(spark), "id")
    target.ensure()
    for frame in frames:
        target.append(inc.insert_if_new(frame, target.read(), "id", ["ts"]))
    everything = frames[0].unionByName(frames[1]).unionByName(frames[2])
    empty = spark.createDataFrame([], SCHEMA)
    whole = rows(inc.insert_if_new(everything, empty, "id", ["ts"]))
    assert rows(target.read()) == whole
    target.append(inc.insert_if_new(everything, target.read(), "id", ["ts"]))
    assert rows(target.read()) == whole
    stream = streams.file_stream(spark, files, schema(spark), max_files=1)
    new = streams.unseen(stream, "ts", "id", "30 days")
    assert rows(streams.run_to_frame(new, "t"), "id") == [(r[0],) for r in whole]


def test_late_rows_per_parameter(spark, rows):
    df = spark.createDataFrame([(1, "a", at(5), 0), (2, "a", at(6), 0), (3, "b", at(1), 0)], SCHEMA)
    stored = spark.createDataFrame([(0, "a", at(5), 0)], SCHEMA)
    assert rows(inc.drop_late(df, inc.high_marks(stored, "p", "ts"), "p", "ts"), "id") == [(2,), (3,)]


def test_until_known(spark, rows):
    df = spark.createDataFrame([(i, "a", at(-i), 0) for i in range(6)] + [(9, "b", at(0), 0)], SCHEMA)
    df = df.withColumn("age", F.col("id"))
    known = spark.createDataFrame([(3,), (5,)], "id int")
    assert rows(inc.until_known(df, ["p"], ["age"], known, "id", strict=True), "id") == [(0,), (1,), (2,), (9,)]
    assert rows(inc.until_known(df, ["p"], ["age"], known, "id"), "id") == [(0,), (1,), (2,), (4,), (9,)]


@pytest.mark.parametrize("known, want", [([], [1, 2, 4]), ([2], [1]), ([1], []), ([4], [1, 2])])
def test_backfill_stops_at_a_slice_without_news(spark, rows, known, want):
    df = spark.createDataFrame([(1, "a", at(-1), 0), (2, "a", at(-24 * 8), 0), (4, "a", at(-24 * 15), 0), (5, "a", at(-24 * 40), 0)], SCHEMA)
    target = spark.createDataFrame([(k,) for k in known], "id int")
    got = inc.backfill_slices(df, target, "ts", "id", ["ts"], 7, "2024-01-01")
    assert [r[0] for r in rows(got, "id")] == want


def test_noon_windows_close_behind_the_watermark(spark, files, rows):
    stream = streams.file_stream(spark, files, schema(spark), max_files=1)
    out = streams.window_agg(stream, "ts", ["p"], [F.count(F.lit(1)).alias("n")], "1 hour")
    got = rows(streams.run_to_frame(out, "w").select(F.to_date("window_end").alias("d"), "p", "n"))
    # the fourth copy of row 1 comes after its window was given out
    assert got == [(dt.date(2024, 1, 1), "a", 3), (dt.date(2024, 1, 1), "b", 2), (dt.date(2024, 1, 2), "a", 2)]


def test_stream_upserts_equal_batch(spark, files, tmp_path, rows):
    stream = streams.file_stream(spark, files, schema(spark), max_files=1)
    target = Target(spark, str(tmp_path / "t"), schema(spark), "id", "ts")
    streams.upsert_stream(
        stream, target, ["p"], str(tmp_path / "ck"),
        lambda batch: latest_per(batch.unionByName(target.read()), ["p"], "ts", "id"),
        lambda df: keep_newest(df, "ts", 10, "id"),
    )
    assert rows(target.read()) == [(4, "b", at(49), 4), (5, "a", at(50), 5)]


def test_modes_runs_and_keys(spark, rows, one):
    t = lambda s: F.lit(s).cast("timestamp_ntz")
    got = one(
        none=inc.load_mode(F.lit(None).cast("timestamp_ntz"), "2024-01-20"), old=inc.load_mode(t("2024-01-01"), "2024-01-20"),
        new=inc.load_mode(t("2024-01-15"), "2024-01-20"),
    )
    assert got == {"none": "full", "old": "full", "new": "incremental"}
    df = spark.createDataFrame([(1, "a", at(0), 1), (2, "a", at(0), 2)], SCHEMA)
    assert rows(inc.replace_run(df, "v"), "id") == [(2,)]
    assert rows(inc.stale_keys(df, ["id"], "ts", 3, "2024-04-02"), "id") == [(1,), (2,)]
    assert inc.stale_keys(df, ["id"], "ts", 3, "2024-04-01").count() == 0
