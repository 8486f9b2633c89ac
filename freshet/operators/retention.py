"""Row, age, date and version budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import as_time
from .selection import By, first_rows

def keep_newest(df: DataFrame, ts: str, n: int, tie: str, nulls: str = "last") -> DataFrame:
    """The newest ``n`` rows; the unique column ``tie`` decides between rows of the same time.

    The last row to keep is found by counting, see :func:`selection.first_rows`, and
    a filter keeps the rows up to it.  Unknown times come before or after all others.
    """
    return first_rows(df, [By(ts, True, nulls == "first"), By(tie, True)], n)


def drop_older(df: DataFrame, ts: str, cutoff) -> DataFrame:
    """Rows from ``cutoff`` on."""
    return df.filter(F.col(ts) >= as_time(cutoff))


def dropped_count(df: DataFrame, ts: str, cutoff) -> DataFrame:
    """One row: how many rows :func:`drop_older` leaves out."""
    return df.filter(F.col(ts) < as_time(cutoff)).agg(F.count(F.lit(1)).alias("dropped"))


def keep_newest_dates(df: DataFrame, group: Sequence[str], date: str, n: int, distinct_col: Column | None = None) -> DataFrame:
    """Rows of the newest ``n`` dates of each group.

    Dates are ranked on the distinct dates of a group, and rows are kept by a
    semi-join.
    """
    rank = Window.partitionBy(*group).orderBy(F.desc(date))
    kept = (
        df.select(*group, date).distinct()
        .withColumn("_rank", F.row_number().over(rank))
        .filter(F.col("_rank") <= n)
        .drop("_rank")
    )
    return df.join(kept, [*group, date], "left_semi")


def keep_versions(df: DataFrame, version: str, n: int, exempt: Sequence[str] = ()) -> DataFrame:
    """Rows of the newest ``n`` versions and of the exempt ones."""
    versions = df.select(version).distinct()
    kept = versions.orderBy(F.desc(version)).limit(n)
    if exempt:
        kept = kept.union(versions.filter(F.col(version).isin(*exempt)))
    return df.join(kept, version, "left_semi")


def newest(df: DataFrame, ts: str, tie: str) -> DataFrame:
    """The one newest row."""
    return df.orderBy(F.desc_nulls_last(ts), F.desc(tie)).limit(1)


def first_by_priority(df: DataFrame, group: Sequence[str], key: str, priorities: Sequence[str]) -> DataFrame:
    """Per group, the row whose key comes first in the list; other keys do not count."""
    order = F.array_position(F.array(*[F.lit(p) for p in priorities]), F.col(key))
    rest = [c for c in df.columns if c not in group]
    return (
        df.withColumn("_order", order)
        .filter(F.col("_order") > 0)
        .groupBy(*group)
        .agg(F.min_by(F.struct(*rest), F.struct("_order", *rest)).alias("_row"))
        .select(*group, "_row.*")
    )


def cap_new(df: DataFrame, order: Sequence[By | str], budget: int, target: DataFrame | None = None) -> DataFrame:
    """The first new rows in order, as many as ``budget`` leaves room for beside the rows of ``target``.

    ``order`` should end with a unique column.  Rows are selected by counting;
    none is sorted or written.
    """
    stored = 0 if target is None else target.count()
    return first_rows(df, [By(o) if isinstance(o, str) else o for o in order], budget - stored)
