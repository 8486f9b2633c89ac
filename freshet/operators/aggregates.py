"""Aggregation.  Rows with a null key are left out, as data frames leave them out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_time, date_from_parts, month_end_365
from ..functions.keys import uid
from ..functions.units import classify, percent_difference, percent_of
from .joins import join_per_key

# Text of one alert in a summary, and the separator between them.
ALERT_TEXT = "[{num}] {commodity} markets were at a '{alps}' level as of {date}"
ALERT_SEPARATOR = ";\n"


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return with_keys(df, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def pivot_counts(df: DataFrame, key: str, kind: str, values: Sequence[str], total: str = "total") -> DataFrame:
    """One count column per value of ``kind``, zero where absent, and their total."""
    counts = [F.count_if(F.col(kind) == v).alias(v) for v in values]
    wide = with_keys(df, [key]).groupBy(key).agg(*counts)
    return wide.withColumn(total, reduce(lambda a, b: a + b, [F.col(f"`{v}`") for v in values]))


def stats_by(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Named aggregates, such as mean, largest and smallest value, per group."""
    return with_keys(df, keys).groupBy(*keys).agg(*[c.alias(n) for n, c in measures.items()])


def mean_first(
    df: DataFrame, keys: Sequence[str], means: Mapping[str, Column], firsts: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Means of measures and the first non-null value of attributes in ``order``."""
    first = [
        F.min_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c)
        for c in firsts
    ]
    return with_keys(df, keys).groupBy(*keys).agg(*[c.alias(n) for n, c in means.items()], *first)


def with_group_value(df: DataFrame, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    """Put a group's aggregate on each of its rows.

    Aggregating and joining back needs no sort of whole groups in one task:
    the aggregate is combined before the shuffle, and the join splits a hot key.
    """
    totals = with_keys(df, keys).groupBy(*keys).agg(value.alias(name))
    return join_per_key(df, totals, keys)


def share_of_total(
    df: DataFrame, keys: Sequence[str], value: Column, total: Column,
    total_name: str = "total", name: str = "share",
) -> DataFrame:
    """Group total and each row's percentage of it."""
    out = with_group_value(df, keys, total, total_name)
    return out.withColumn(name, percent_of(value, F.col(total_name)))


def deviation_from_mean(
    df: DataFrame, keys: Sequence[str], value: Column, mean: Column,
    mean_name: str = "mean", name: str = "deviation",
) -> DataFrame:
    """Group mean and each row's percentage difference from it."""
    out = with_group_value(df, keys, mean, mean_name)
    return out.withColumn(name, percent_difference(value, F.col(mean_name)))


def pick_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "first") -> DataFrame:
    """The whole row of each group that is first or last in ``order``.

    ``order`` should end with a unique column.  The choice is an aggregate, so
    a large group is reduced before the shuffle.
    """
    pick = F.min_by if keep == "first" else F.max_by
    rest = [c for c in df.columns if c not in keys]
    best = pick(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "first") -> DataFrame:
    return pick_by(df, keys, order, keep)


def first_per(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    return pick_by(df, [key], order, "first")


def first_occurrence(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    return pick_by(df, [key], order, "first")


def distinct(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*cols) if cols else df).distinct()


def sum_with_unknown(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Sum in which text that is no number counts as zero and marks the group confidential."""
    number = F.col(value).try_cast("double")
    return with_keys(df, keys).groupBy(*keys).agg(
        F.sum(F.coalesce(number, F.lit(0.0))).alias("value"),
        F.bool_or(number.isNull()).alias("some_stats_confidential"),
    )


def aggregate_roles(df: DataFrame, roles: Sequence[str], year: str, month: str, value: str) -> DataFrame:
    """Totals per place and month for each role a place can have, keyed and stacked.

    Roles are unpivoted before one aggregation, so the facts are read once.
    """
    stacked = df.select(
        year, month, value,
        F.explode(
            F.array(*[F.struct(F.lit(r).alias("value_type"), F.col(r).alias("country")) for r in roles])
        ).alias("_role"),
    ).select("_role.*", year, month, value)
    totals = sum_with_unknown(stacked, ["country", "value_type", year, month], value)
    date = month_end_365(F.col(year), F.col(month))
    return totals.select(
        uid("country", F.date_format(date, "yyyy-MM-dd"), "value_type").alias("uid"),
        date.alias("date"), "country", "value_type", "value", "some_stats_confidential",
    )


def numbered_concat(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], pieces: Mapping[str, Column],
    template: str = ALERT_TEXT, sep: str = ALERT_SEPARATOR, name: str = "text",
    also: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Numbered lines of a group joined into one text.

    ``template`` holds ``{num}`` and the names of ``pieces``.  The group is to
    be small already, such as the latest row per commodity of a market.
    ``also`` adds aggregates of the same groups.
    """
    also = also or {}
    item = F.struct(*order, *[c.cast("string").alias(f"_{n}") for n, c in pieces.items()])
    items = F.sort_array(F.collect_list(item))

    def line(row: Column, i: Column) -> Column:
        text = F.replace(F.lit(template), F.lit("{num}"), (i + 1).cast("string"))
        for piece in pieces:
            text = F.replace(text, F.lit("{" + piece + "}"), row[f"_{piece}"])
        return text

    return (
        with_keys(df, keys).groupBy(*keys)
        .agg(items.alias("_items"), *[c.alias(n) for n, c in also.items()])
        .select(*keys, F.array_join(F.transform("_items", line), sep).alias(name), *also)
    )


def concat_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], text: Column, sep: str = "; ",
    firsts: Sequence[str] = (), name: str = "text",
) -> DataFrame:
    """Texts of a group in order, and attributes of its first row."""
    items = F.sort_array(F.collect_list(F.struct(*order, text.alias("_text"))))
    first = [F.min_by(F.col(c), F.struct(*order)).alias(c) for c in firsts]
    return (
        with_keys(df, keys).groupBy(*keys).agg(items.alias("_items"), *first)
        .withColumn(name, F.array_join(F.transform("_items", lambda i: i["_text"]), sep))
        .select(*keys, *firsts, name)
    )


def summarize_alerts(
    df: DataFrame, keys: Sequence[str], level: Column, date: str, order: Sequence[str],
    pieces: Mapping[str, Column], name: str = "text",
) -> DataFrame:
    """Numbered text of a group, its highest level with its class, and the oldest date.

    All come from one aggregation.
    """
    worst = {"highest_pewi": F.max(level), "oldest_interaction_date": F.min(date)}
    out = numbered_concat(df, keys, order, pieces, name=name, also=worst)
    return out.withColumn("highest_alps", classify(F.col("highest_pewi")))


def most_recent(df: DataFrame, ts: str, where: Column | None = None, clamp=None) -> DataFrame:
    """One row with the newest time, not after ``clamp``."""
    newest = F.max(ts)
    if clamp is not None:
        newest = F.least(newest, as_time(clamp))
    return (df if where is None else df.filter(where)).agg(newest.alias("most_recent"))


def most_recent_ymd(df: DataFrame, year: str, month: str, day: str) -> DataFrame:
    """Newest date of three number columns; rows that name no date do not count."""
    return df.agg(F.max(date_from_parts(F.col(year), F.col(month), F.col(day))).alias("most_recent"))


def usable_years(
    df: DataFrame, year: str, cols: Sequence[str], min_rows: int = 10, keep_recent: int | None = 10, now_year: int | None = None
) -> DataFrame:
    """Years with enough complete rows.

    Years not more than ``keep_recent`` before ``now_year`` are kept with fewer rows.
    """
    counts = with_keys(df, [year, *cols]).groupBy(year).agg(F.count(F.lit(1)).alias("n_rows"))
    keep = F.col("n_rows") >= min_rows
    if keep_recent is not None and now_year is not None:
        keep = keep | (F.col(year) >= now_year - keep_recent)
    return counts.filter(keep)


def complete_dates(df: DataFrame, keys: Sequence[str], var: str, n_vars: int, step: str | None = None, steps: int = 1) -> DataFrame:
    """Dates on which at least ``n_vars`` variables have all their ``steps``.

    Two levels of grouping, so that no set of variables is collected.
    """
    per_var = df.groupBy(*keys, var).agg((F.count_distinct(step) if step else F.lit(1)).alias("_steps"))
    return (
        per_var.filter(F.col("_steps") >= steps)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_vars"))
        .filter(F.col("n_vars") >= n_vars)
    )


def usable_runs(df: DataFrame, keys: Sequence[str], at_least: int | None = None, exactly: int | None = None) -> DataFrame:
    """Groups with at least or exactly so many files."""
    counts = count_by(df, keys)
    return counts.filter(F.col("n") == exactly if exactly is not None else F.col("n") >= at_least)


def uniformity(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: whether each column has a single value.  Nulls count as a value."""
    return df.agg(
        *[
            ((F.min(c).eqNullSafe(F.max(c))) & ((F.count(c) == 0) | (F.count(c) == F.count(F.lit(1))))).alias(c)
            for c in cols
        ]
    )


def assert_uniform(df: DataFrame, cols: Sequence[str]) -> None:
    mixed = [c for c, same in uniformity(df, cols).first().asDict().items() if not same]
    if mixed:
        raise ValueError(f"more than one value in {', '.join(mixed)}")


def run_metrics(before: DataFrame, incoming: DataFrame, key: str, after: DataFrame | None = None) -> DataFrame:
    """One row with the number of existing, new and already known rows of a run.

    With ``after``, the rows that the run left, also how many it dropped.
    """
    known = before.select(key).distinct().withColumn("_known", F.lit(True))
    counts = join_per_key(incoming, known, [key]).agg(
        F.count_if(F.col("_known").isNull()).alias("new_rows"),
        F.count_if(F.col("_known").isNotNull()).alias("known_rows"),
    )
    existing = before.select(F.count(F.lit(1))).scalar()
    out = counts.select(existing.alias("existing_rows"), "new_rows", "known_rows")
    if after is None:
        return out
    left = after.select(F.count(F.lit(1))).scalar()
    return out.withColumn("dropped_rows", F.col("existing_rows") + F.col("new_rows") - left)


def unique_sorted(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(col)
