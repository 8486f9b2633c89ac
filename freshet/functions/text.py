"""Text expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def squeeze(col: Column) -> Column:
    """Remove all whitespace."""
    return F.regexp_replace(col, r"\s+", "")


def title(col: Column) -> Column:
    """Upper case for every letter that follows a non-letter, lower case elsewhere."""
    letters = F.split(F.lower(col), "")
    start = F.struct(F.lit("").alias("text"), F.lit(False).alias("inside"))

    def step(acc, ch):
        letter = ch.rlike(r"^\p{L}$")
        return F.struct(
            F.concat(acc["text"], F.when(acc["inside"], ch).otherwise(F.upper(ch))).alias("text"),
            letter.alias("inside"),
        )

    return F.aggregate(letters, start, step, lambda acc: acc["text"])


def strip_tags(col: Column, *tags: str) -> Column:
    """Remove the opening and closing forms of the given tags, or of all tags."""
    names = "|".join(tags) if tags else "[a-zA-Z][^>]*"
    return F.regexp_replace(col, f"</?(?:{names})>", "")


def split_section(col: Column, markers: tuple[str, ...] = ("Source:", "Sources:")) -> tuple[Column, Column]:
    """Text before and after the first marker that occurs; paragraph tags removed."""
    head, tail = col, F.lit(None).cast("string")
    for marker in reversed(markers):
        found = F.instr(col, marker) > 0
        pieces = F.split(col, rf"\Q{marker}\E")
        head = F.when(found, F.element_at(pieces, 1)).otherwise(head)
        tail = F.when(found, F.element_at(pieces, 2)).otherwise(tail)
    return strip_tags(head, "p"), strip_tags(tail, "p")


def split_paren(col: Column) -> tuple[Column, Column]:
    """``Name (Place) ...`` to its name and place."""
    name = F.trim(F.regexp_extract(col, r"^([^()]*)", 1))
    place = F.nullif(F.trim(F.regexp_extract(col, r"^[^()]*\(([^()]*)", 1)), F.lit(""))
    return name, place


def anchor_text(col: Column) -> Column:
    """Text in front of the first link."""
    return F.substring_index(col, '<a href="', 1)


def anchor_href(col: Column) -> Column:
    """Target of the first link; null without one."""
    return F.nullif(F.regexp_extract(col, '<a href="([^"]*)', 1), F.lit(""))


def after_first(col: Column, sep: str) -> Column:
    """What follows the first ``sep``, or the whole text."""
    return F.element_at(F.split(col, rf"\Q{sep}\E", 2), -1)


def find_text(col: Column, pattern: str, group: int = 0) -> Column:
    """First match of ``pattern``; null without one."""
    return F.when(col.rlike(pattern), F.regexp_extract(col, pattern, group))


def sub_text(col: Column, pattern: str, new: str) -> Column:
    return F.regexp_replace(col, pattern, new)


def roll_text(col: Column, old: Column | str, new: Column | str) -> Column:
    """Replace a period's text, such as an old year in a title, by another."""
    old = F.lit(old) if isinstance(old, str) else old
    new = F.lit(new) if isinstance(new, str) else new
    return F.replace(col, old, new)


def fill_template(template: Column, values: Mapping[str, Column]) -> Column:
    """Replace ``{name}`` marks in a template by column values."""
    out = template
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value.cast("string"))
    return out


def parse_latlon(col: Column, sep: str = " ") -> tuple[Column, Column]:
    """``(lat, lon)`` or ``lat lon`` to two doubles; null where not numeric."""
    pieces = F.split(F.trim(F.translate(col, "(),", "")), rf"\Q{sep}\E+")
    return F.get(pieces, F.lit(0)).try_cast("double"), F.get(pieces, F.lit(1)).try_cast("double")


def join_list(col: Column, sep: str = ", ") -> Column:
    return F.array_join(F.transform(col, lambda x: x.cast("string")), sep)


def py_bool(col: Column) -> Column:
    """``True``/``False`` text of a boolean."""
    return F.initcap(col.cast("string"))


def parse_bool(col: Column) -> Column:
    """Boolean of a ``True``/``False`` text; null for any other text."""
    return F.trim(col).try_cast("boolean")
