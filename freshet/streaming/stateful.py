"""Rules whose state moves within a stream.

Two mechanisms.  Look-backs keep keyed state with timers, so that a summary is
given out anew when its oldest day ends, though no row of its key has come.
Loads with marks write a small state table per batch, named by the number of
the batch: a batch that is run again reads the state before it and writes the
same rows and the same state, and no key is held by one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.window import Window

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_DAY_MS = 86_400_000
_STATE = "version long, timer long, day array<bigint>, n array<bigint>, total array<bigint>, high array<bigint>"


class LookBack(StatefulProcessor):
    """Per key one partial state for each day, and a timer for the end of the oldest."""

    def __init__(self, keys: Sequence[str], days: int):
        self.keys, self.days = list(keys), days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", _STATE)

    def _read(self, first: int) -> tuple[int, int, dict[int, tuple]]:
        """Version, time of the timer (-1: none), and the days from ``first`` on; one call reads all of a key."""
        held = self.state.get()
        if held is None:
            return 0, -1, {}
        version, timer, *columns = held
        return version, timer, {day: tuple(part) for day, *part in zip(*columns, strict=True) if day >= first}

    def _summary(self, key, version: int, timer: int, days: dict[int, tuple]) -> Iterator[pd.DataFrame]:
        due = (min(days) + self.days) * _DAY_MS if days else -1
        if due != timer:
            if timer >= 0:
                self.handle.deleteTimer(timer)
            if due >= 0:
                self.handle.registerTimer(due)
        n, total, high = ([p[i] for p in days.values()] for i in range(3))
        self.state.update((version + 1, due, list(days), n, total, high))
        out = {k: [v] for k, v in zip(self.keys, key, strict=True)}
        out |= {"version": [version + 1], "n": [sum(n)], "total": [sum(total)]}
        out |= {c: pd.array([v], "Int64") for c, v in (("high", max(high, default=None)), ("oldest", min(days, default=None)))}
        yield pd.DataFrame(out)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = timerValues.getCurrentWatermarkInMs() // _DAY_MS - self.days + 1
        version, timer, days = self._read(first)
        for frame in rows:
            for day, n, total, high in zip(*(frame[c].tolist() for c in ("day", "n", "total", "high")), strict=True):
                if day >= first:
                    old = days.get(day, (0, 0, high))
                    days[day] = (old[0] + n, old[1] + total, max(old[2], high))
        yield from self._summary(key, version, timer, days)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._summary(key, *self._read(timerValues.getCurrentWatermarkInMs() // _DAY_MS - self.days + 1))

    def close(self) -> None:
        pass


def _day_parts(stream: DataFrame, keys: Sequence[str], ts: str, value: str) -> DataFrame:
    """Rows of each Arrow batch added up per key and day, so that a hot key is small before it is shuffled."""
    kinds = [stream.schema[k] for k in keys]
    out = T.StructType([*kinds, *T._parse_datatype_string("day long, n long, total long, high long, at timestamp").fields])

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            parts = frame.groupby([*keys, "day"], as_index=False, dropna=True).agg(
                n=("value", "size"), total=("value", "sum"), high=("value", "max"), at=("at", "max")
            )
            yield parts[out.names]

    rows = stream.filter(F.col(ts).isNotNull() & F.col(value).isNotNull()).select(
        *keys, F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long").alias("day"),
        F.col(value).cast("long").alias("value"), F.col(ts).cast("timestamp").alias("at"),
    )
    return rows.mapInPandas(add, out)


def look_back(stream: DataFrame, keys: Sequence[str], ts: str, value: str, days: int, delay: str) -> DataFrame:
    """Summaries of the last ``days`` days per key, given out when a row comes and when a day ends.

    ``value`` is a whole number.  A day ends when the watermark, ``delay`` behind
    the newest time, has passed the end of the look-back that starts with it.
    Each output row replaces the earlier ones of its key: the one with the
    largest ``version`` holds.  A key whose days have all ended has ``n`` 0.
    Rows without key, time or value, and those whose day has ended, do not count.
    The state has one value per key, with an entry for each day.  The session's state store must be
    RocksDB, see :func:`use_timers`.
    """
    kinds = ", ".join(f"{k} {stream.schema[k].dataType.simpleString()}" for k in keys)
    parts = _day_parts(stream, keys, ts, value).withWatermark("at", delay)
    return parts.groupBy(*keys).transformWithStateInPandas(
        LookBack(keys, days), f"{kinds}, version long, n long, total long, high long, oldest long", "Update", "EventTime"
    )


def use_timers(spark: SparkSession) -> None:
    """Keep stream state in RocksDB, which timers need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)


def run_updates(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Write each batch of an updating stream to a folder of its own, until all input is used."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    _run(stream, checkpoint, write, "update")


def _run(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    writer = stream.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def newest_version(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row of each key that holds, without keys that have ended."""
    last = updates.groupBy(*keys).agg(F.max("version").alias("version"))
    return updates.join(last, [*keys, "version"]).filter("n > 0")


class MarkedLoad:
    """Rows of a stream and the state of the load, below ``base``.

    ``rows/batch=<n>`` has the rows that batch n added, ``state/batch=<n>`` the
    state after it: one row per parameter (``by``) and time of the kept rows'
    runs.  ``base`` and the checkpoint of the stream belong together.
    """

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType, by: str, run: str):
        self.spark, self.base, self.schema, self.by, self.run = spark, base.rstrip("/"), schema, by, run
        self.state_schema = T.StructType([schema[by], schema[run]])

    def rows(self) -> DataFrame:
        """All rows added so far, with the number of their batch."""
        schema = T.StructType([*self.schema.fields, T.StructField("batch", T.IntegerType())])
        return self.spark.read.schema(schema).parquet(f"{self.base}/rows")

    def state(self, batch: int) -> DataFrame:
        """The state after a batch; empty before the first."""
        if batch < 0:
            return self.spark.createDataFrame([], self.state_schema)
        return self.spark.read.schema(self.state_schema).parquet(f"{self.base}/state/batch={batch}")

    def marks(self, batch: int) -> DataFrame:
        """Oldest and newest kept time per parameter after a batch, under the name ``_by``."""
        return self.state(batch).groupBy(F.col(self.by).alias("_by")).agg(F.min(self.run).alias("_oldest"), F.max(self.run).alias("_newest"))

    def marked(self, df: DataFrame, batch: int) -> DataFrame:
        """Rows with the marks before the batch."""
        return df.join(self.marks(batch - 1), F.col(self.by) == F.col("_by"), "left")

    def added(self, batch: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.base}/rows/batch={batch}")


def load_newer(stream: DataFrame, load: MarkedLoad, checkpoint: str) -> None:
    """Add the rows newer than the newest row of their parameter that an earlier batch added; then the marks move.

    Rows of one batch do not shut each other out.  A parameter without rows so
    far has no mark.  Rows without parameter or time are left out.
    """
    by, ts = load.by, load.run

    def add(batch: DataFrame, number: int) -> None:
        known = batch.filter(F.col(by).isNotNull() & F.col(ts).isNotNull())
        new = load.marked(known, number).filter(F.col("_newest").isNull() | (F.col(ts) > F.col("_newest")))
        new.select(*load.schema.names).write.mode("overwrite").parquet(f"{load.base}/rows/batch={number}")
        both = load.state(number - 1).unionByName(load.added(number).select(by, ts))
        both.groupBy(by).agg(F.max(ts).alias(ts)).write.mode("overwrite").parquet(f"{load.base}/state/batch={number}")

    _run(stream, checkpoint, add)


def load_runs(stream: DataFrame, load: MarkedLoad, checkpoint: str, id_col: str, keep_days: int) -> None:
    """Add rows with unknown ids that are not older than the oldest run kept of their parameter.

    Runs older than ``keep_days`` days before the newest one of their parameter
    are no longer kept, and so the oldest mark moves and what retention took
    away does not come back.  A parameter without runs takes all rows.  Of rows with
    the same id in a batch the first by run is added.  Rows without id, parameter
    or time are left out.
    """
    by, run = load.by, load.run

    def add(batch: DataFrame, number: int) -> None:
        known = batch.filter(F.col(by).isNotNull() & F.col(run).isNotNull() & F.col(id_col).isNotNull())
        fits = load.marked(known, number).filter(F.col("_oldest").isNull() | (F.col(run) >= F.col("_oldest")))
        fits = fits.select(*load.schema.names)
        if number:
            stored = load.rows().filter(F.col("batch") < number).select(id_col)
            fits = fits.join(stored, id_col, "left_anti").select(*load.schema.names)
        first = fits.groupBy(id_col).agg(F.min(run).alias("_first"))
        rest = [c for c in load.schema.names if c != id_col]
        once = fits.join(first, id_col).filter(F.col(run) == F.col("_first")).groupBy(id_col).agg(F.min(F.struct(*rest)).alias("_row"))
        once.select(id_col, "_row.*").select(*load.schema.names).write.mode("overwrite").parquet(f"{load.base}/rows/batch={number}")
        runs = load.state(number - 1).unionByName(load.added(number).select(by, run)).distinct()
        newest = runs.groupBy(F.col(by).alias("_by")).agg(F.max(run).alias("_newest"))
        kept = runs.join(newest, F.col(by) == F.col("_by")).filter(F.col(run) >= F.col("_newest") - F.make_dt_interval(F.lit(keep_days)))
        kept.select(by, run).write.mode("overwrite").parquet(f"{load.base}/state/batch={number}")

    _run(stream, checkpoint, add)


def retained(load: MarkedLoad, batch: int) -> DataFrame:
    """Added rows whose run is kept after the batch."""
    rows = load.rows().filter(F.col("batch") <= batch)
    return rows.join(load.state(batch), [load.by, load.run], "left_semi").select(*load.schema.names)


def trailing_sums(parts: DataFrame, keys: Sequence[str], day: str, values: Sequence[str], days: int) -> DataFrame:
    """For each key and day of ``parts`` the sums over the last ``days`` days, by differences.

    ``parts`` has one row per key and day.  A day's values are added on that day
    and taken back ``days`` days later, so a row is used twice, not once for each
    day of the window.
    """
    enters = parts.select(*keys, F.col(day).alias("_day"), *values, F.lit(True).alias("_own"))
    leaves = parts.select(*keys, F.date_add(day, days).alias("_day"), *[(-F.col(v)).alias(v) for v in values], F.lit(False).alias("_own"))
    moved = enters.unionByName(leaves).groupBy(*keys, "_day").agg(*[F.sum(v).alias(v) for v in values], F.bool_or("_own").alias("_own"))
    so_far = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    sums = moved.select(*keys, F.col("_day").alias(day), *[F.sum(v).over(so_far).alias(v) for v in values], "_own")
    return sums.filter("_own").drop("_own")


def trailing_stream(
    stream: DataFrame, base: str, checkpoint: str, keys: Sequence[str], ts: str, value: str, days: int, delay: str
) -> DataFrame:
    """Per key and closed day the count and sum of the last ``days`` days, written by batch; all rows so far.

    A day is closed once the watermark, ``delay`` behind the newest time, has
    passed its end; only days with rows of their own are given out.  The stream
    keeps one count and sum per key and open day, the state table below ``base``
    one per key and day of the last ``days`` closed days.
    """
    spark = stream.sparkSession
    daily = (
        stream.filter(F.col(ts).isNotNull() & F.col(value).isNotNull()).withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
        .groupBy(F.window(ts, "1 day"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
        .select(*keys, F.to_date("window.start").alias("day"), "n", "total")
    )
    schema = daily.schema

    def add(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/daily/batch={number}")
        new = spark.read.schema(schema).parquet(f"{base}/daily/batch={number}")
        old = spark.read.schema(schema).parquet(f"{base}/state/batch={number - 1}") if number else spark.createDataFrame([], schema)
        both = old.unionByName(new)
        sums = trailing_sums(both, keys, "day", ["n", "total"], days)
        sums.join(new.select(*keys, "day"), [*keys, "day"], "left_semi").write.mode("overwrite").parquet(f"{base}/sums/batch={number}")
        newest = both.agg(F.max("day")).first()[0]
        kept = both if newest is None else both.filter(F.col("day") > F.date_sub(F.lit(newest), days))
        kept.write.mode("overwrite").parquet(f"{base}/state/batch={number}")

    _run(daily, checkpoint, add)
    return spark.read.schema(schema).parquet(f"{base}/sums")
