"""Rules for adding only what is new, on batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import as_time
from ..operators.aggregates import pick_by
from ..operators.joins import join_per_key
from ..runtime import durable


def insert_if_new(df: DataFrame, target: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Rows with an id that the target lacks, the first of each id in ``order``.

    Repeated ids are reduced first, so the join sees each id once.
    """
    return pick_by(df, [key], order, "first").join(target.select(key), key, "left_anti").select(*df.columns)


def high_marks(target: DataFrame, by: str, ts: str) -> DataFrame:
    """Newest stored time per parameter."""
    return target.groupBy(by).agg(F.max(ts).alias("high_mark"))


def drop_late(df: DataFrame, marks: DataFrame, by: str, ts: str) -> DataFrame:
    """Rows newer than the newest stored time of their parameter."""
    joined = join_per_key(df, marks, [by])
    return joined.filter(F.col("high_mark").isNull() | (F.col(ts) > F.col("high_mark"))).drop("high_mark")


def until_known(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], known: DataFrame, id_col: str, strict: bool = False
) -> DataFrame:
    """Unknown rows; with ``strict`` only those of each group before its first known id in ``order``.

    The position of the first known row is an aggregate, so no group is sorted.
    """
    if not strict:
        return df.join(known.select(id_col), id_col, "left_anti").select(*df.columns)
    place = F.struct(*order)
    first = (
        df.join(known.select(id_col), id_col, "left_semi")
        .groupBy(*keys)
        .agg(F.min(place).alias("_first_known"))
    )
    marked = join_per_key(df, first, keys)
    return marked.filter(F.col("_first_known").isNull() | (place < F.col("_first_known"))).drop("_first_known")


def backfill_slices(
    df: DataFrame, target: DataFrame, ts: str, key: str, order: Sequence[str], days: int, now
) -> DataFrame:
    """New rows in slices of ``days`` days back from ``now``, up to the first slice without any.

    The new rows are written once, so they are looked for once.
    """
    age = F.timestamp_diff("SECOND", F.col(ts), as_time(now))
    fresh = insert_if_new(df, target, key, order).withColumn(
        "slice", F.floor(age / (days * 86400)).cast("bigint")
    )
    fresh = durable(fresh.filter(F.col("slice") >= 0), "fresh")
    gapless = Window.orderBy("slice")
    filled = (
        fresh.select("slice").distinct()
        .withColumn("_n", F.row_number().over(gapless) - 1)
        .agg(F.count_if(F.col("_n") == F.col("slice")))
    )
    return fresh.filter(F.col("slice") < filled.scalar())


def stale_keys(summary: DataFrame, keys: Sequence[str], date: str, months: int, now) -> DataFrame:
    """Keys of summaries whose oldest entry is out of the look-back."""
    return summary.filter(F.col(date) < F.add_months(as_time(now).cast("date"), -months)).select(*keys)


def recompute_affected(
    facts: DataFrame, affected: DataFrame, keys: Sequence[str], summarize
) -> DataFrame:
    """Summaries of the affected keys only."""
    touched = affected.select(*keys).distinct()
    return summarize(join_per_key(facts, touched, keys, "left_semi"))


def replace_run(df: DataFrame, run_col: str) -> DataFrame:
    """Rows of the newest forecast run."""
    return df.filter(F.col(run_col) == df.select(F.max(run_col)).scalar())


def load_mode(last_full: Column, now, days: int = 10) -> Column:
    """``full`` if there was no load yet or the last one is too old, else ``incremental``."""
    due = last_full.isNull() | (F.timestamp_diff("DAY", last_full, as_time(now)) > days)
    return F.when(due, "full").otherwise("incremental")
