"""Joins.

Sides are never broadcast by hint: Spark broadcasts a side whose size is known
to be below the session's limit, also at run time, and splits skewed keys of
the others.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _on(left: str, right: str, keys: Sequence[tuple[str, str]], null_safe: bool = False) -> Column:
    pairs = [(F.col(f"{left}.{a}"), F.col(f"{right}.{b}")) for a, b in keys]
    return reduce(lambda x, y: x & y, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def _keyed(df: DataFrame, dim: DataFrame, keys, how: str, null_safe: bool = False) -> DataFrame:
    """Join on differently named keys; the right-hand keys are left out."""
    pairs = [(k, k) if isinstance(k, str) else k for k in keys]
    surplus = {b for _, b in pairs}
    kept = [F.col(f"r.{c}") for c in dim.columns if c not in surplus]
    joined = df.alias("l").join(dim.alias("r"), _on("l", "r", pairs, null_safe), how)
    return joined.select("l.*", *kept)


def join_per_key(df: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join rows to the one row per key that an aggregate gave.

    Spark can split a hot key at run time only if both sides are shuffled for
    the join.  An aggregate is already partitioned by its keys and would be
    joined as it is; a hash of the keys as one more join key has its few rows
    shuffled once more, and so lets the many rows of a hot key be split.
    """
    hashed = {"_hash": F.xxhash64(*keys)}
    joined = df.withColumns(hashed).join(per_key.withColumns(hashed), [*keys, "_hash"], how)
    return joined.drop("_hash")


def join_chain(df: DataFrame, dims: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Inner joins to one dimension after the other."""
    for dim, left, right in dims:
        df = _keyed(df, dim, [(left, right)], "inner")
    return df


def left_join(df: DataFrame, dim: DataFrame, keys, null_safe: bool = False) -> DataFrame:
    return _keyed(df, dim, keys, "left", null_safe)


def right_join(df: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All members of ``dim``, with the rows of ``df`` where there are any.

    Members with rows are an inner join, of which Spark can split a hot key on
    either side; those without are added.
    """
    keys = list(keys)
    found = df.join(dim, keys)
    without = dim.join(df.select(*keys).distinct(), keys, "left_anti")
    return found.unionByName(without, allowMissingColumns=True)


def outer_join_measures(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Measures of several frames side by side on their common keys.

    Each frame has one row per key, and names of its own for its measures; equal
    keys meet, also where a part is null.  The frames are stacked and aggregated
    once, so there is one shuffle however many they are.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    measures = [c for f in frames for c in f.columns if c not in keys]
    return stacked.groupBy(*keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in measures])


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the smallest by the other columns, whatever order the rows came in."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    return df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def semi_join(df: DataFrame, keys_df: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(keys_df, on, "left_semi")


rows_for_ids = semi_join


def new_rows(df: DataFrame, target: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key is not in the target; keys may have several columns."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.join(target.select(*keys), keys, "left_anti")


def lookup(
    df: DataFrame, dim: DataFrame, key: str, dim_key: str, value: str, on_miss: str = "null"
) -> DataFrame:
    """Add ``value`` of the dimension, the smallest where a key has several; misses give null or drop the row."""
    how = {"null": "left", "drop": "inner"}[on_miss]
    found = dim.select(F.col(dim_key).alias(key), value).groupBy(key).agg(F.min(value).alias(value))
    return join_per_key(df, found, [key], how).select(*df.columns, value)


def grow_dimension(facts: DataFrame, dim: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The dimension plus the members of ``source`` that facts mention and it lacks, see :func:`one_per_key`."""
    unseen = facts.select(key).distinct().join(dim.select(key), key, "left_anti")
    added = one_per_key(source.join(unseen, key, "left_semi"), [key])
    return dim.unionByName(added, allowMissingColumns=True)


def asof_available(
    df: DataFrame, available: DataFrame, date: str, max_steps: int, name: str = "available"
) -> DataFrame:
    """Newest available date at or up to ``max_steps`` days before each row's date.

    Each distinct wanted date meets its few candidate dates by equality, so no
    range join is needed.
    """
    wanted = df.select(F.col(date).alias("_want")).filter("_want is not null").distinct()
    candidates = wanted.select(
        "_want", F.explode(F.sequence(F.date_sub("_want", max_steps), F.col("_want"))).alias("_have")
    )
    found = (
        candidates.join(available.select(F.col(available.columns[0]).alias("_have")).distinct(), "_have")
        .groupBy(F.col("_want").alias(date))
        .agg(F.max("_have").alias(name))
    )
    return join_per_key(df, found, [date]).select(*df.columns, name)


def expand_template(templates: DataFrame, periods: DataFrame, on: str) -> DataFrame:
    """A copy of a dataset's template row for each of its missing periods."""
    return templates.join(periods, on)


def available_targets(targets: DataFrame, available: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Requested items that can be had."""
    keys = [on] if isinstance(on, str) else list(on)
    return targets.join(available.select(*keys), keys, "left_semi")
