"""Wide to long, long to wide, and list columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of the 24 hour columns.
HOURS = [f"H{h}" for h in range(1, 25)]


def unpivot_hours(df: DataFrame, ids: Sequence[str], date: str, hours: Sequence[str] = HOURS) -> DataFrame:
    """One row per hour column with its time; ``H24`` is midnight of the next day."""
    long = df.unpivot([*ids, date], list(hours), "_hour", "value")
    hour = F.substring("_hour", 2, 2).cast("int")
    ts = F.col(date).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour)
    return long.select(*ids, ts.alias("ts"), "value")


def unpivot_mean(df: DataFrame, ids: Sequence[str], hours: Sequence[str] = HOURS, name: str = "value") -> DataFrame:
    """Mean of the hour columns of each row; missing hours do not count.  No shuffle."""
    values = F.filter(F.array(*[F.col(h).cast("double") for h in hours]), lambda v: v.isNotNull())
    total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
    return df.select(*ids, F.try_divide(total, F.size(values)).alias(name))


def pivot_hours(df: DataFrame, keys: Sequence[str], hour: str, value: str, prefix: str = "H") -> DataFrame:
    """One row per key with a column per hour 1 to 24, zero for missing hours."""
    columns = [
        F.coalesce(F.max(F.when(F.col(hour) == h, F.col(value))), F.lit(0)).alias(f"{prefix}{h}")
        for h in range(1, 25)
    ]
    return df.groupBy(*keys).agg(*columns)


def explode_members(df: DataFrame, list_col: str, name: str) -> DataFrame:
    """One row per member of a list column."""
    return df.withColumn(name, F.explode(list_col)).drop(list_col)


def split_cell(df: DataFrame, cols: Sequence[str], sep: str = ";") -> DataFrame:
    """Parallel lists in text cells, such as ids and units, as one row per position."""
    lists = [F.transform(F.split(c, rf"\Q{sep}\E"), lambda x: F.trim(x)).alias(c) for c in cols]
    kept = [c for c in df.columns if c not in cols]
    zipped = df.select(*kept, F.arrays_zip(*lists).alias("_z"))
    return zipped.select(*kept, F.posexplode("_z").alias("position", "_m")).select(
        *kept, "position", *[F.col(f"_m.{c}").alias(c) for c in cols]
    )


def flatten_lists(df: DataFrame, col: str, name: str) -> DataFrame:
    """Members of a list of lists."""
    return explode_members(df.withColumn(col, F.flatten(col)), col, name)
