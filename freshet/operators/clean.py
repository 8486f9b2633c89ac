"""Projection, filtering, cleaning and reject accounting."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.dates import as_time

# Tokens that stand for a missing number, and header spellings
# that name the same column.
MISSING_TOKENS = ("--", "ie", "NA")
INCIDENT_HEADERS = {
    "Region": ["Region", "Region of Incident"],
    "Location of death": ["Location of death", "Location of Incident"],
    "Incident Date": ["Incident Date", "Website Date"],
    "Number Dead": ["Number Dead", "Number of Dead"],
    "Total Number of Dead and Missing": [
        "Total Number of Dead and Missing",
        "Total Number Dead and Missing",
    ],
}


def _name(col: str) -> Column:
    return F.col("`" + col.replace("`", "``") + "`")


def _texts(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def conform(df: DataFrame, schema: T.StructType, missing=None) -> DataFrame:
    """Columns of ``schema`` in its order and types; absent ones hold ``missing``."""
    present = set(df.columns)
    return df.select(
        *[
            (_name(f.name) if f.name in present else F.lit(missing)).try_cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def normalize_names(df: DataFrame, lower: bool = True, max_len: int | None = None) -> DataFrame:
    """Trimmed names with ``_`` for blanks and slashes, in lower case, cut to ``max_len``."""

    def clean(name: str) -> str:
        name = re.sub(r"[ /]", "_", name.strip())
        return (name.lower() if lower else name)[:max_len]

    return df.toDF(*[clean(c) for c in df.columns])


def unify_headers(df: DataFrame, synonyms: Mapping[str, Sequence[str]]) -> DataFrame:
    """One column for several spellings; the first non-null one where a file has more."""
    taken = {s for spellings in synonyms.values() for s in spellings}
    merged = []
    for name, spellings in synonyms.items():
        found = [_name(s) for s in spellings if s in df.columns]
        if found:
            merged.append(F.coalesce(*found).alias(name))
    return df.select(*[_name(c) for c in df.columns if c not in taken], *merged)


def extract_paths(df: DataFrame, paths: Mapping[str, Sequence[str | int]], sep: str = ", ") -> DataFrame:
    """Fields picked out of nested columns.

    A path is a list of field names, list positions (from 0) and ``"*"``, which
    joins the members of a list.  Missing branches give null; text is trimmed on
    the right.
    """

    def walk(col: Column, steps: Sequence[str | int]) -> Column:
        for i, step in enumerate(steps):
            if step == "*":
                rest = steps[i + 1 :]
                return F.array_join(F.transform(col, lambda m: walk(m, rest).cast("string")), sep)
            col = F.get(col, F.lit(step)) if isinstance(step, int) else col.getField(step)
        return col

    out = df.select(*[walk(_name(p[0]), p[1:]).alias(name) for name, p in paths.items()])
    texts = set(_texts(out))
    return out.select(*[F.rtrim(c).alias(c) if c in texts else F.col(c) for c in out.columns])


def flatten_structs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fields of struct columns as columns; the structs are dropped."""
    return df.select("*", *[f"{c}.*" for c in cols]).drop(*cols)


def blank_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = _texts(df) if cols is None else cols
    return df.withColumns({c: F.when(F.trim(_name(c)) != "", _name(c)) for c in cols})


def null_sentinels(df: DataFrame, cols: Sequence[str], tokens: Sequence = MISSING_TOKENS) -> DataFrame:
    return df.withColumns({c: F.when(~_name(c).isin(*tokens), _name(c)) for c in cols})


def drop_sentinels(df: DataFrame, col: str, tokens: Sequence = MISSING_TOKENS) -> DataFrame:
    """Leave out rows whose value is missing or a token for missing."""
    return df.filter(_name(col).isNotNull() & ~_name(col).isin(*tokens))


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(_name(c)), _name(c)) for c in floats})


def coerce_numeric(df: DataFrame, cols: Sequence[str], to: str = "double") -> DataFrame:
    """Numbers of text columns; text that is no number becomes null."""
    return df.withColumns({c: F.trim(_name(c)).try_cast(to) for c in cols})


def coercion_losses(df: DataFrame, cols: Sequence[str], to: str = "double") -> DataFrame:
    """One row with the number of values per column that are no numbers."""
    return df.agg(
        *[
            F.count_if(_name(c).isNotNull() & F.trim(_name(c)).try_cast(to).isNull()).alias(c)
            for c in cols
        ]
    )


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [_name(c).isNotNull() for c in cols]))


def valid_date(df: DataFrame, col: str, fmt: str) -> DataFrame:
    return df.filter(F.try_to_timestamp(_name(col), F.lit(fmt)).isNotNull())


def max_age(df: DataFrame, ts: str, days: int, now) -> DataFrame:
    """Rows not older than ``days`` before ``now``."""
    return df.filter(_name(ts) >= as_time(now) - F.make_dt_interval(F.lit(days)))


def time_slice(df: DataFrame, ts: str, start, end, value: str | None = None, coords: Sequence[str] = ()) -> DataFrame:
    """Rows in ``[start, end)``, with a value of at least zero and with coordinates."""
    df = df.filter((_name(ts) >= as_time(start)) & (_name(ts) < as_time(end)))
    if value is not None:
        df = df.filter(_name(value) >= 0)
    return require(df, coords) if coords else df


def allow(df: DataFrame, col: str, values: Sequence | DataFrame) -> DataFrame:
    """Rows whose value is in a list or in the first column of a frame."""
    if isinstance(values, DataFrame):
        return df.join(values.select(_name(values.columns[0]).alias(col)), col, "left_semi")
    return df.filter(_name(col).isin(*values))


def deny(df: DataFrame, col: str, values: Sequence | DataFrame) -> DataFrame:
    """Rows whose value is not in a list or frame; rows without a value stay."""
    if isinstance(values, DataFrame):
        return df.join(values.select(_name(values.columns[0]).alias(col)), col, "left_anti")
    return df.filter(_name(col).isNull() | ~_name(col).isin(*values))


TEXT_TESTS: dict[str, Callable[[Column, str], Column]] = {
    "startswith": lambda c, v: c.startswith(v),
    "endswith": lambda c, v: c.endswith(v),
    "contains": lambda c, v: c.contains(v),
    "not contains": lambda c, v: ~c.contains(v),
    "like": lambda c, v: c.like(v) if re.search("[%_]", v) else c == v,
    "rlike": lambda c, v: c.rlike(v),
    "==": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
}


def where_text(df: DataFrame, col: str, op: str, value: str) -> DataFrame:
    return df.filter(TEXT_TESTS[op](_name(col), value))


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Leave out columns without any value: one pass that yields a single row of counts."""
    filled = df.agg(*[F.count(_name(c)).alias(c) for c in df.columns]).first()
    return df.select(*[_name(c) for c, n in zip(df.columns, filled) if n])


def drop_empty_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Leave out rows in which every value is null, blank, zero or false."""

    def holds(field: T.StructField) -> Column:
        col = _name(field.name)
        if isinstance(field.dataType, T.StringType):
            return F.coalesce(col != "", F.lit(False))
        if isinstance(field.dataType, T.NumericType):
            return F.coalesce(col != 0, F.lit(False))
        if isinstance(field.dataType, T.BooleanType):
            return F.coalesce(col, F.lit(False))
        return col.isNotNull()

    fields = [f for f in df.schema if cols is None or f.name in cols]
    return df.filter(reduce(lambda a, b: a | b, [holds(f) for f in fields]))


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Add absent columns and fill nulls of present ones."""
    return df.withColumns(
        {
            c: F.coalesce(_name(c), F.lit(v)) if c in df.columns else F.lit(v)
            for c, v in defaults.items()
        }
    )


def with_constants(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.lit(v) for c, v in constants.items()})


def with_reject_reason(df: DataFrame, rules: Sequence[tuple[str, Column]], name: str = "reject_reason") -> DataFrame:
    """Name of the first rule a row breaks; null for good rows.

    A rule is a reason and the condition under which a row is rejected.
    """
    reason = None
    for label, broken in rules:
        reason = (F if reason is None else reason).when(F.coalesce(broken, F.lit(False)), label)
    return df.withColumn(name, reason)


def with_reject_counts(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the number of rejected rows per reason."""
    marked = with_reject_reason(df, rules)
    good = marked.filter("reject_reason is null").drop("reject_reason")
    rejects = (
        marked.filter("reject_reason is not null")
        .groupBy("reject_reason")
        .agg(F.count(F.lit(1)).alias("rejected"))
    )
    return good, rejects


def split_by(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Rows for which ``predicate`` holds, and all others."""
    holds = F.coalesce(predicate, F.lit(False))
    return df.filter(holds), df.filter(~holds)


def stitch_records(
    lines: DataFrame,
    is_start: Column,
    file: str = "file",
    line_no: str = "line_no",
    value: str = "value",
    sep: str = " ",
    block: int = 100_000,
) -> DataFrame:
    """Join continuation lines to the record that starts last before them.

    Lines are handled in blocks of ``block`` lines of a file, so that no window
    holds a whole file; the last start of the earlier blocks is carried over.
    Lines before the first start belong to no record and are left out.
    """
    number = F.col(line_no)
    marked = lines.withColumn("_block", F.floor(number / block)).withColumn(
        "_start", F.when(is_start, number)
    )
    blocks = marked.groupBy(file, "_block").agg(F.max("_start").alias("_last"))
    earlier = Window.partitionBy(file).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(file, "_block", F.max("_last").over(earlier).alias("_carried"))
    within = (
        Window.partitionBy(file, "_block").orderBy(number).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        marked.join(carried, [file, "_block"])
        .withColumn("record", F.coalesce(F.max("_start").over(within), "_carried"))
        .filter("record is not null")
        .groupBy(file, "record")
        .agg(F.sort_array(F.collect_list(F.struct(number.alias("n"), F.col(value).alias("v")))).alias("_l"))
        .select(
            file,
            F.col("record").alias("first_line"),
            F.size("_l").alias("lines"),
            F.array_join(F.transform("_l", lambda x: x["v"]), sep).alias(value),
        )
    )
