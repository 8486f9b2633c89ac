"""Key building and key parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator and null text of composite keys, and the hour format
# used in forecast keys.
KEY_SEPARATOR = "_"
NULL_TEXT = "None"
KEY_HOUR_FORMAT = "yyyyMMdd'T'HH"


def _parts(cols, null_text):
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return parts if null_text is None else [F.coalesce(p, F.lit(null_text)) for p in parts]


def uid(*cols: Column | str, sep: str = KEY_SEPARATOR, null_text: str | None = None) -> Column:
    """Join key parts with ``sep``.

    A null part makes the whole key null, so that a record without a key is
    visible as such.  ``null_text`` prints a text for a null part instead.
    """
    parts = _parts(cols, null_text)
    pieces = [parts[0]]
    for part in parts[1:]:
        pieces += [F.lit(sep), part]
    return F.concat(*pieces)


def uid_md5(*cols: Column | str, sep: str = KEY_SEPARATOR, null_text: str | None = None) -> Column:
    """Hex MD5 of :func:`uid`."""
    return F.md5(uid(*cols, sep=sep, null_text=null_text))


def forecast_uid(created: Column, at: Column, station: Column) -> Column:
    """Key of a forecast value: creation hour, forecast hour and station."""
    return uid(
        F.date_format(created, KEY_HOUR_FORMAT), F.date_format(at, KEY_HOUR_FORMAT), station
    )


def storm_uid(name: Column, ts_text: Column) -> Column:
    """Name plus a time text whose ``-``, blank and ``:`` become underscores."""
    return uid(name, F.translate(ts_text, "- :", "___"))


def part(col: Column, sep: str, index: int) -> Column:
    """The ``index``-th part (from 1, negative from the end) of a key text."""
    return F.split_part(col, F.lit(sep), F.lit(index))


def date_in_name(col: Column, pattern: str, fmt: str) -> Column:
    """Date taken from a key or file name; null when the name holds none."""
    text = F.nullif(F.regexp_extract(col, pattern, 1), F.lit(""))
    return F.try_to_timestamp(text, F.lit(fmt)).cast("date")


def zfill(col: Column, width: int) -> Column:
    """Pad with zeros on the left without ever cutting longer text."""
    text = col.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)
