"""Set operations, calendars and gaps in them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def minus(a: DataFrame, b: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Distinct keys of ``a`` that ``b`` lacks."""
    keys = [on] if isinstance(on, str) else list(on)
    return a.select(*keys).distinct().join(b.select(*keys), keys, "left_anti")


def affected_keys(new: DataFrame, stale: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with new facts or with an expired summary."""
    return new.select(*keys).unionByName(stale.select(*keys)).distinct()


def _date(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def calendar(spark: SparkSession, start, end, step: str = "1 day") -> DataFrame:
    """Dates from ``start`` to ``end``, both literals or scalar columns."""
    dates = F.sequence(_date(start), _date(end), F.expr(f"INTERVAL {step}"))
    return spark.range(1).select(F.explode(dates).alias("date"))


def back_from(spark: SparkSession, end, n: int, step: str = "1 day") -> DataFrame:
    """``n`` dates that end on ``end``, newest first, with their position.

    Every date is counted from ``end``, so month steps do not drift.
    """
    count, unit = int(step.split()[0]), step.split()[1].lower().rstrip("s")
    k = (F.col("pos") * F.lit(count)).cast("int")
    last = _date(end)
    moved = {
        "day": lambda: F.date_sub(last, k),
        "week": lambda: F.date_sub(last, k * 7),
        "month": lambda: F.add_months(last, -k),
        "year": lambda: F.add_months(last, -k * 12),
    }[unit]()
    return spark.range(n).select(F.col("id").alias("pos")).select("pos", moved.alias("date"))


def _existing(existing: DataFrame, date: str) -> DataFrame:
    return existing.select(F.col(date).cast("date").alias("date")).distinct()


def missing_dates(
    existing: DataFrame, date: str, end, n: int, step: str = "1 day", weekday: int | None = None
) -> DataFrame:
    """Those of the last ``n`` calendar dates that do not exist yet.

    ``weekday`` (0 is Monday) keeps one day of the week.
    """
    wanted = back_from(existing.sparkSession, end, n, step).select("date")
    if weekday is not None:
        wanted = wanted.filter(F.weekday("date") == weekday)
    return wanted.join(_existing(existing, date), "date", "left_anti")


def missing_per_group(existing: DataFrame, group: str, date: str, end) -> DataFrame:
    """Days without data between a group's first date and ``end``."""
    have = existing.select(group, F.col(date).cast("date").alias("date")).distinct()
    spans = have.groupBy(group).agg(F.min("date").alias("_from")).filter(F.col("_from") <= _date(end))
    wanted = spans.select(group, F.explode(F.sequence("_from", _date(end))).alias("date"))
    return wanted.join(have, [group, "date"], "left_anti")


def missing_tail(existing: DataFrame, date: str, end, n: int, step: str = "1 day") -> DataFrame:
    """Dates after the newest existing one, walking back from ``end`` at most ``n`` steps.

    ``n`` is the number of steps to take into an empty target.
    """
    wanted = back_from(existing.sparkSession, end, n, step)
    have = _existing(existing, date)
    known = wanted.join(have, "date", "left_semi").select(F.min("pos"))
    return wanted.filter(F.col("pos") < F.coalesce(known.scalar(), F.lit(n))).select("date")


def missing_anniversaries(existing: DataFrame, date: str, month: int, since: int, until: int, day: int = 1) -> DataFrame:
    """The same day of the same month in every year that does not exist yet."""
    years = existing.sparkSession.range(since, until + 1)
    wanted = years.select(F.make_date(F.col("id").cast("int"), F.lit(month), F.lit(day)).alias("date"))
    return wanted.join(_existing(existing, date), "date", "left_anti")
