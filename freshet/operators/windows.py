"""Moving aggregates.

Each window runs over rows that are aggregated per key and hour, day or month
first, so its partitions are bounded by the calendar and not by the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import noon_day
from .aggregates import pick_by, with_keys
from .numbering import number_rows
from .selection import By


def latest_per(df: DataFrame, keys: Sequence[str], ts: str, tie: str, where: Column | None = None) -> DataFrame:
    """Newest row of each group; ``tie`` decides between rows of the same time."""
    return pick_by(with_keys(df if where is None else df.filter(where), keys), keys, [ts, tie], "last")


def hourly_mean(df: DataFrame, keys: Sequence[str], ts: str, value: str) -> DataFrame:
    """One value per key and hour; NaN does not count."""
    clean = F.when(~F.isnan(value), F.col(value))
    hour = F.date_trunc("hour", ts).cast("timestamp_ntz")
    return with_keys(df, keys).groupBy(*keys, hour.alias("hour")).agg(F.avg(clean).alias(value))


def max_rolling_mean(
    df: DataFrame, keys: Sequence[str], ts: str, value: str, rows: int = 8, min_periods: int = 8,
    name: str = "max_rolling_mean",
) -> DataFrame:
    """Largest mean of ``rows`` rows in time order that hold ``min_periods`` values."""
    frame = Window.partitionBy(*keys).orderBy(ts).rowsBetween(1 - rows, 0)
    full = F.when(F.count(value).over(frame) >= min_periods, F.avg(value).over(frame))
    return (
        with_keys(df, keys).withColumn("_mean", full).groupBy(*keys).agg(F.max("_mean").alias(name))
    )


def daily_metrics(df: DataFrame, keys: Sequence[str], ts: str, value: str, rows: int = 8) -> DataFrame:
    """Largest hour, mean, and largest 8-hour mean per key and noon-to-noon day."""
    hours = hourly_mean(df, keys, ts, value).withColumn("day", noon_day(F.col("hour")))
    frame = Window.partitionBy(*keys, "day").orderBy("hour").rowsBetween(1 - rows, 0)
    full = F.when(F.count(value).over(frame) >= rows, F.avg(value).over(frame))
    return (
        hours.withColumn("_rolling", full)
        .groupBy(*keys, "day")
        .agg(
            F.max(value).alias("max_1h"),
            F.avg(value).alias("mean_24h"),
            F.max("_rolling").alias("max_8h"),
            F.count(value).alias("hours"),
        )
    )


def pct_change(
    df: DataFrame, keys: Sequence[str], ts: str, value: str, periods: Mapping[str, int], pad: bool = False
) -> DataFrame:
    """Change against the row so many places earlier, as a fraction.

    ``pad`` fills a missing value with the one before it first.
    """
    frame = Window.partitionBy(*keys).orderBy(ts)
    base = F.col(value)
    if pad:
        df = df.withColumn(
            "_padded", F.last(value, ignorenulls=True).over(frame.rowsBetween(Window.unboundedPreceding, 0))
        )
        base = F.col("_padded")
    changes = {n: F.try_divide(base, F.lag(base, k).over(frame)) - 1 for n, k in periods.items()}
    return df.withColumns(changes).drop("_padded")


def change_by_date(
    df: DataFrame, keys: Sequence[str], date: str, value: str, days: Mapping[str, int]
) -> DataFrame:
    """Change against the row exactly so many days earlier; null where there is none.

    A frame of one day number holds the earlier row, so no self-join is needed.
    """
    number = F.datediff(F.col(date), F.lit("1970-01-01").cast("date"))
    out = df.withColumn("_day", number)
    for name, back in days.items():
        frame = Window.partitionBy(*keys).orderBy("_day").rangeBetween(-back, -back)
        out = out.withColumn(name, F.try_divide(F.col(value), F.max(value).over(frame)) - 1)
    return out.drop("_day")


def with_position(df: DataFrame, file: str, order: Sequence[By | str], name: str = "position") -> DataFrame:
    """0-based position of a row in its file, for files of any length."""
    numbered = number_rows(df, order, [file], "_number")
    return numbered.withColumn(name, F.col("_number") - 1).drop("_number")


def trailing_mean(
    df: DataFrame, keys: Sequence[str], date: str, total: str, count: str, days: int = 30,
    name: str = "trailing_mean",
) -> DataFrame:
    """Mean of the ``days`` days that end on each date with data.

    Input is one row per key and date with a sum and a count.
    """
    frame = (
        Window.partitionBy(*keys)
        .orderBy(F.datediff(F.col(date), F.lit("1970-01-01").cast("date")))
        .rangeBetween(1 - days, 0)
    )
    mean = F.try_divide(F.sum(total).over(frame).cast("double"), F.sum(count).over(frame).cast("double"))
    return df.withColumn(name, mean)
