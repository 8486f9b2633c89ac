"""Row numbers and ids over a total order, without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..runtime import durable
from .numbering import number_rows
from .selection import By

_SLICE_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def distributed_row_number(
    df: DataFrame,
    order_by: Sequence[Column | str],
    partition_by: Sequence[str] = (),
    name: str = "row_number",
    partitions: int | None = None,
) -> DataFrame:
    """``row_number()`` for groups of any size, down to one group with all rows.

    Rows are range-partitioned and sorted by group and order, so a large group
    is spread over many tasks.  A row's number is its position in its slice
    plus the rows of its group in earlier slices; only those counts, one per
    group and slice, are summed in a window.  The sorted rows are written once,
    so that counts and rows come from the same slices.  ``order_by`` should end
    with a unique column.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in (*partition_by, *order_by)]
    placed = (
        df.repartitionByRange(*([partitions] if partitions else []), *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = durable(placed, "ordered").withColumn(
        "_slice", F.shiftright("_place", _SLICE_BITS)
    )
    counts = placed.groupBy(*partition_by, "_slice").agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = (
        Window.partitionBy(*partition_by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    counts = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    left, right = placed.alias("l"), counts.alias("r")
    same = reduce(
        lambda a, b: a & b,
        [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in partition_by],
        F.col("l._slice") == F.col("r._slice"),
    )
    number = F.col("l._place") - F.col("r._first") + F.col("r._before") + 1
    return left.join(right, same).select(*[F.col(f"l.{c}") for c in df.columns], number.alias(name))


def assign_ids(
    df: DataFrame, order_by: Sequence[By | str], start: Column | int = 0, name: str = "uid"
) -> DataFrame:
    """Dense ids after ``start`` in the given order, which should end with a unique column."""
    start = start if isinstance(start, Column) else F.lit(start)
    numbered = number_rows(df, order_by, name="_number")
    return numbered.withColumn(name, (F.col("_number") + start).cast("bigint")).drop("_number")


def next_ids(target: DataFrame, id_col: str) -> Column:
    """Largest id in the target, zero if it is empty, for :func:`assign_ids`."""
    return target.select(F.coalesce(F.max(id_col), F.lit(0))).scalar()


def chunk_keys(df: DataFrame, group: str, key: str, n: int, sep: str = ",") -> DataFrame:
    """Distinct keys of a group in chunks of ``n``, each joined into one text."""
    numbered = number_rows(df.select(group, key).distinct(), [key], [group], "_number")
    return (
        numbered.withColumn("chunk", F.floor((F.col("_number") - 1) / n).cast("bigint"))
        .groupBy(group, "chunk")
        .agg(F.count(F.lit(1)).alias("n_keys"), F.sort_array(F.collect_list(key)).alias("_keys"))
        .select(group, "chunk", "n_keys", F.array_join("_keys", sep).alias("keys"))
    )
