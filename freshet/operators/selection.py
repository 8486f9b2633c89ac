"""The row at a given place of an order, found by counting.

The order's columns are settled one after the other.  A column is narrowed step
by step: its range is cut into equal stretches, the rows of each are counted, and
the stretch that holds the wanted row is cut again, until one value is left; the
next column then only tells apart rows with that value.  What reaches the driver
is one count per stretch, so a time that half of all rows share costs no more than any
other, and nothing is sorted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Stretches per step.
STRETCHES = 1 << 12
#: Characters of a text that are compared in a step.
_SEGMENT = 6

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TIMES = (T.TimestampType, T.TimestampNTZType)


@dataclass
class By:
    """A column of an order; nulls come last unless ``nulls_first``."""

    name: str
    descending: bool = False
    nulls_first: bool = False


def _number(col: Column, kind: T.DataType) -> Column:
    """A number in the same order, equal for equal values."""
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.to_utc_timestamp(col.cast("timestamp"), F.current_timezone()))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("bigint")
    if isinstance(kind, T.BooleanType):
        return col.cast("int").cast("bigint")
    if isinstance(kind, _WHOLE):
        return col.cast("bigint")
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return col.cast("double")
    raise TypeError(f"cannot order by {kind.simpleString()}")


def _text_number(col: Column, segment: int) -> Column:
    """A number for some bytes of a text, in the order of texts; 0 for bytes beyond its end."""
    raw = col.cast("binary")

    def byte(i: int) -> Column:
        code = F.conv(F.hex(F.substring(raw, segment * _SEGMENT + i + 1, 1)), 16, 10)
        return F.coalesce(F.when(code != "", code).cast("bigint") + 1, F.lit(0))

    total = F.lit(0).cast("bigint")
    for i in range(_SEGMENT):
        total = total * 257 + byte(i)
    return total


def _stretch(value: Column, low: Any, high: Any) -> Column:
    """Number of the stretch that holds a value between two bounds."""
    if isinstance(low, float):
        if high - low == float("inf"):
            part = (value / 2 - low / 2) / (high / 2 - low / 2)
        else:
            part = (value - low) / (high - low)
        return F.least(F.floor(part * STRETCHES), F.lit(STRETCHES - 1))
    if high - low >= 1 << 62:
        wide = (value.cast("decimal(38,0)") - F.lit(str(low)).cast("decimal(38,0)")) / F.lit(str(-(-(high - low + 1) // STRETCHES))).cast("decimal(38,0)")
        return F.floor(wide).cast("bigint")
    step = -(-(high - low + 1) // STRETCHES)
    return F.floor((value - F.lit(low)) / step)


def _narrow(rows: DataFrame, value: str, plain: str, rank: int, descending: bool) -> tuple[Any, int, int, bool]:
    """The value of the row with this rank, rows before it, rows with it, and whether ``plain`` is one value there."""
    low, high = rows.agg(F.min(value), F.max(value)).first()
    kept = rows
    before = 0
    while True:
        if low == high:
            count, least, most = kept.filter(F.col(value) == F.lit(low)).agg(F.count(F.lit(1)), F.min(plain), F.max(plain)).first()
            return low, before, count, least == most
        at = _stretch(F.col(value), low, high)
        counts = kept.groupBy(at.alias("at")).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high")).collect()
        for r in sorted(counts, key=lambda r: r["at"], reverse=descending):
            if before + r["n"] >= rank:
                low, high = r["low"], r["high"]
                kept = rows.filter(F.col(value).between(F.lit(low), F.lit(high)))
                break
            before += r["n"]


def _first_of(rows: DataFrame, by: By, rank: int) -> tuple[Column, Column, int, int]:
    """Conditions for the rows before and with the value of the row with this rank, and how many those are."""
    kind, col = rows.schema[by.name].dataType, F.col(by.name)
    empty = col.isNull()
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        odd = F.isnan(col) | (F.abs(col) == float("inf"))
    else:
        odd = F.lit(False)
    classes = rows.groupBy(empty.alias("empty"), F.when(odd, col).alias("odd")).agg(F.count(F.lit(1)).alias("n")).collect()

    def place(r) -> tuple:
        if r["empty"]:
            return (-1 if by.nulls_first else 2, 0.0)
        value = r["odd"]
        if value is None:
            return (0, 0.0)
        top = 2.0 if value != value else 1.0 if value > 0 else -1.0
        return (0, -top if by.descending else top)

    before, sooner = 0, F.lit(False)
    for r in sorted(classes, key=place):
        if r["empty"]:
            same = empty
        elif r["odd"] is not None:
            same = ~empty & (F.isnan(col) if r["odd"] != r["odd"] else (col == F.lit(r["odd"])))
        else:
            same = ~empty & ~odd
        if before + r["n"] < rank:
            before, sooner = before + r["n"], sooner | same
            continue
        if r["empty"] or r["odd"] is not None:
            return sooner, same, before, r["n"]
        kept, left, segment = rows.filter(same), rank - before, 0
        while True:
            text = isinstance(kind, T.StringType)
            number = _text_number(col, segment) if text else _number(col, kind)
            value, earlier, count, single = _narrow(kept.select(number.alias("v"), col.alias("p")), "v", "p", left, by.descending)
            nearer = number > F.lit(value) if by.descending else number < F.lit(value)
            sooner, same = sooner | (same & nearer), same & (number == F.lit(value))
            before, left = before + earlier, left - earlier
            if single or not text:
                return sooner, same, before, count
            kept, segment = kept.filter(number == F.lit(value)), segment + 1


def first_condition(df: DataFrame, order: Sequence[By], n: int) -> Column | None:
    """The condition that holds for the first ``n`` rows in an order of columns; none if there are no more than that.

    The order should end with a unique column: rows that no column tells apart
    from the last one all meet it.  The counting runs when this is called, with one
    aggregation per step: about four for a time, one or two for numbers close to
    each other, and further columns are only looked at where earlier ones tie.
    """
    if n <= 0:
        return F.lit(False)
    keys = df.select(*dict.fromkeys(b.name for b in order))
    if keys.count() <= n:
        return None
    kept, same, rank = F.lit(False), F.lit(True), n
    rows = keys
    for by in order:
        sooner, here, before, count = _first_of(rows, by, rank)
        kept, same, rank = kept | (same & sooner), same & here, rank - before
        if rank == count:
            break
        rows = rows.filter(here)
    return F.coalesce(kept | same, F.lit(False))


def first_rows(df: DataFrame, order: Sequence[By], n: int) -> DataFrame:
    """The first ``n`` rows in an order of columns, as a filter on ``df``, see :func:`first_condition`."""
    condition = first_condition(df, order, n)
    return df if condition is None else df.filter(condition)
