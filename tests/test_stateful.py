"""State that moves within a stream: look-backs that end by themselves, marks, runs, trailing sums, repeated batches."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from freshet.streaming import stateful, streams

SCHEMA = "id long, p string, ts timestamp_ntz, v long"
T0 = dt.datetime(2024, 1, 1)


def at(days, hours=1):
    return T0 + dt.timedelta(days=days, hours=hours)


@pytest.fixture
def feed(spark, tmp_path):
    """A stream of one file per batch; more batches can be landed later."""

    def land(*batches):
        for rows in batches:
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        return streams.file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], SCHEMA).schema, max_files=1)

    return land


def test_look_back_ends_without_new_rows(spark, feed, tmp_path):
    stateful.use_timers(spark)
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def run(*batches):
        stateful.run_updates(stateful.look_back(feed(*batches), ["p"], "ts", "v", 3, "1 hour"), out, check)
        rows = stateful.newest_version(spark.read.parquet(out), ["p"]).collect()
        return {r.p: (r.n, r.total, r.high) for r in rows}

    first = [(1, "a", at(0), 5), (2, "a", at(1), 7), (3, "b", at(0), 1), (4, None, at(0), 1), (5, "a", None, 1), (6, "a", at(1), None)]
    assert run(first) == {"a": (2, 12, 7), "b": (1, 1, 1)}
    # day 0 ends for both keys by the rows of c alone
    assert run([(7, "c", at(3, 3), 1)]) == {"a": (1, 7, 7), "c": (1, 1, 1)}
    assert run([(8, "c", at(9), 2), (9, "a", at(0), 99)]) == {"c": (1, 2, 2)}


def test_marks_move_with_what_is_added(spark, feed, tmp_path, rows):
    load = stateful.MarkedLoad(spark, str(tmp_path / "load"), spark.createDataFrame([], SCHEMA).schema, "p", "ts")
    check = str(tmp_path / "check")
    stateful.load_newer(feed([(1, "a", at(2), 0), (2, "a", at(1), 0)], [(3, "a", at(2), 0), (4, "a", at(3), 0), (5, "b", at(0), 0)]), load, check)
    assert rows(load.rows(), "id", "batch") == [(1, 0), (2, 0), (4, 1), (5, 1)]
    stateful.load_newer(feed([(6, "a", at(3), 0), (7, "b", at(1), 0), (8, None, at(9), 0), (9, "b", None, 0)]), load, check)
    assert rows(load.rows(), "id", "batch") == [(1, 0), (2, 0), (4, 1), (5, 1), (7, 2)]
    assert rows(load.state(2)) == [("a", at(3)), ("b", at(1))]


def test_runs_that_retention_took_do_not_come_back(spark, feed, tmp_path, rows):
    load = stateful.MarkedLoad(spark, str(tmp_path / "load"), spark.createDataFrame([], SCHEMA).schema, "p", "ts")
    old = [(1, "a", at(0), 0), (2, "a", at(5), 0), (2, "a", at(6), 0), (3, "b", at(0), 0)]
    stateful.load_runs(feed(old, [(4, "a", at(12), 0)], [*old, (5, "a", at(0), 0), (6, "a", at(7), 0), (7, "b", at(0), 0)]), load, str(tmp_path / "check"), "id", 8)
    assert rows(load.rows(), "id", "batch") == [(1, 0), (2, 0), (3, 0), (4, 1), (6, 2), (7, 2)]
    assert rows(stateful.retained(load, 2), "id") == [(2,), (3,), (4,), (6,), (7,)]


def test_a_batch_that_is_run_again_changes_nothing(spark, feed, tmp_path, rows):
    """Without its commit a batch is repeated: it reads the state before it and writes the same."""
    load = stateful.MarkedLoad(spark, str(tmp_path / "load"), spark.createDataFrame([], SCHEMA).schema, "p", "ts")
    check = tmp_path / "check"
    stream = feed([(1, "a", at(2), 0)], [(2, "a", at(1), 0), (3, "a", at(4), 0)])
    stateful.load_newer(stream, load, str(check))
    before = rows(load.rows(), "id", "batch")
    again = tmp_path / "again"
    again.mkdir()
    for name in ("metadata", "offsets", "sources", "commits"):
        source = check / name
        if source.is_file():
            (again / name).write_bytes(source.read_bytes())
            continue
        for f in source.rglob("*"):
            if f.is_file() and not (name == "commits" and f.name.lstrip(".").startswith("1")):
                place = again / f.relative_to(check)
                place.parent.mkdir(parents=True, exist_ok=True)
                place.write_bytes(f.read_bytes())
    stateful.load_newer(stream, load, str(again))
    assert rows(load.rows(), "id", "batch") == before == [(1, 0), (3, 1)]


def test_trailing_sums_by_differences(spark, feed, tmp_path, rows):
    parts = spark.createDataFrame([("a", dt.date(2024, 1, d), d) for d in (1, 2, 5, 8, 9, 20)] + [("b", dt.date(2024, 1, 3), 7)], "k string, day date, n long")
    got = stateful.trailing_sums(parts, ["k"], "day", ["n"], 4)
    assert sorted(rows(got.select("k", F.dayofmonth("day"), "n"))) == [("a", 1, 1), ("a", 2, 3), ("a", 5, 7), ("a", 8, 13), ("a", 9, 17), ("a", 20, 20), ("b", 3, 7)]
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    batches = [[(i, "a", at(d), d + 1) for i, d in enumerate(days)] for days in ((0, 0, 1), (2, 4), (5, 30))]
    sums = stateful.trailing_stream(feed(*batches), str(tmp_path / "t"), str(tmp_path / "check"), ["p"], "ts", "v", 3, "1 hour")
    assert sorted(rows(sums.select(F.dayofmonth("day"), "n", "total"))) == [(1, 2, 2), (2, 3, 4), (3, 4, 7), (5, 2, 8), (6, 2, 11)]
    last = max(int(p.name.split("=")[1]) for p in (tmp_path / "t" / "state").iterdir())
    assert spark.read.parquet(str(tmp_path / "t" / "state" / f"batch={last}")).count() <= 3


def test_a_key_reads_and_writes_its_state_once():
    calls, held = [], []

    class State:
        def get(self):
            calls.append("get")
            return held[-1] if held else None

        def update(self, value):
            calls.append("update")
            held.append(value)

    class Handle:
        def registerTimer(self, at):
            calls.append(("register", at))

        def deleteTimer(self, at):
            calls.append(("delete", at))

    class Times:
        def __init__(self, day):
            self.day = day

        def getCurrentWatermarkInMs(self):
            return self.day * 86_400_000

    look = stateful.LookBack(["k"], 7)
    look.handle, look.state = Handle(), State()
    frame = pd.DataFrame({"day": range(10, 16), "n": 1, "total": 5, "high": 5})
    (out,) = look.handleInputRows((1,), iter([frame]), Times(10))
    assert calls == ["get", ("register", 17 * 86_400_000), "update"] and out.to_dict("records") == [
        {"k": 1, "version": 1, "n": 6, "total": 30, "high": 5, "oldest": 10}
    ]
    calls.clear()
    (out,) = look.handleExpiredTimer((1,), Times(17), None)
    assert calls == ["get", ("delete", 17 * 86_400_000), ("register", 18 * 86_400_000), "update"]
    assert out.to_dict("records") == [{"k": 1, "version": 2, "n": 5, "total": 25, "high": 5, "oldest": 11}]
    (out,) = look.handleExpiredTimer((1,), Times(40), None)
    assert out["n"].tolist() == [0] and out["high"].isna().all() and held[-1][1] == -1
