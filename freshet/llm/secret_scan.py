"""Secret scans: known forms, and strings whose sliding-window entropy is high for their characters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality_rules import let

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
#: Character classes of a candidate: pattern, least bits per character in some window.
CLASSES = (("^[0-9a-fA-F-]+$", 3.2), ("^[A-Za-z0-9]+$", 3.7), ("^[A-Za-z0-9+/_-]+$", 3.9))
#: Parts of strings that are known not to be secrets.
ALLOWED = r"(?i)example|sample|dummy|placeholder|changeme|your[_-]|abcdef|012345|^[A-Za-z/_-]+$|^[0-9-]+$"
WINDOW = 20


def match_spans(text: Column, pattern: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """Leftmost non-overlapping matches as structs (start, order, end, kind, value), in code points.

    The text between matches and the matches themselves have known lengths, so
    places follow by adding them up.  ``value`` is the text of ``group``; a
    match with a shorter value than ``least`` is dropped after matching.
    """
    order = KINDS.index(kind)
    span = "struct<start:int,order:int,end:int,kind:string,value:string>"
    parts = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), lambda x: F.length(x)).alias("gap"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda x: F.length(x)).alias("len"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )

    def add(state: Column, part: Column) -> Column:
        start = state["at"] + part["gap"]
        end = start + F.coalesce(part["len"], F.lit(0))
        item = F.struct(
            start.alias("start"), F.lit(order).alias("order"), end.alias("end"), F.lit(kind).alias("kind"),
            part["value"].alias("value"),
        )
        keep = part["len"].isNotNull() & (F.length(part["value"]) >= least)
        return F.struct(
            end.alias("at"),
            F.when(keep, F.concat(state["found"], F.array(item))).otherwise(state["found"]).alias("found"),
        )

    none = F.array().cast(f"array<{span}>")
    start = F.struct(F.lit(0).alias("at"), none.alias("found"))
    found = F.aggregate(parts, start, add, lambda s: s["found"])
    return F.when(text.rlike(pattern), found).otherwise(none)


def peak_entropy(value: Column, window: int = WINDOW) -> Column:
    """Highest Shannon entropy, in bits per character, of a window of the string.

    Counts per character are kept while the window moves: one character comes
    in, one goes out, and the sum of c*log2(c) changes by those two terms.
    """
    term = lambda c: F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))

    def step(state: Column, i: Column, text: Column) -> Column:
        into = F.ascii(F.substring(text, i, F.lit(1)))
        out = F.when(i > window, F.ascii(F.substring(text, i - window, F.lit(1)))).otherwise(F.lit(-1))

        def moved(counts: Column) -> Column:
            less = F.get(counts, out)
            had = F.get(counts, into) - F.when(into == out, F.lit(1)).otherwise(F.lit(0))
            total = (
                state["sum"] - F.coalesce(term(less) - term(less - 1), F.lit(0.0)) + term(had + 1) - term(had)
            )
            width = F.least(i, F.lit(window)).cast("double")
            bits = F.when(i >= F.least(F.length(text), F.lit(window)), F.log2(width) - total / width).otherwise(F.lit(0.0))
            return F.struct(
                F.transform(counts, lambda c, k: c + (k == into).cast("int") - (k == out).cast("int")).alias("counts"),
                total.alias("sum"), F.greatest(state["best"], bits).alias("best"),
            )

        return let(state["counts"], moved)

    start = F.struct(
        F.array_repeat(F.lit(0), 128).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best")
    )
    return let(value, lambda text: F.aggregate(
        F.sequence(F.lit(1), F.length(text)), start, lambda s, i: step(s, i, text), lambda s: s["best"]
    ))


def is_secret(value: Column, window: int = WINDOW) -> Column:
    """High entropy for the narrowest class of characters that holds the string; not on the allow list."""
    least = F.lit(99.0)
    for pattern, bits in reversed(CLASSES):
        least = F.when(value.rlike(pattern), F.lit(bits)).otherwise(least)
    return F.when(value.rlike(ALLOWED), F.lit(False)).otherwise(peak_entropy(value, window) >= least)


def find_secrets(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with two columns of spans: ``base`` (the known forms) and ``spans`` (with those of high entropy).

    A span is (start, order, end, kind, value), in code points, end exclusive,
    sorted by start and then by the order of :data:`KINDS`.  Null or empty text
    has none.  A high-entropy string that touches a span of a known form is not
    reported again.  Columns of ``docs`` named base or spans are replaced; all
    others are kept, and equal rows stay separate rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lower = F.lower(text)
    word = F.lit(False)
    for part in ("password", "passwd", "secret", "token", "apikey", "api_key"):
        word = word | lower.contains(part)
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string,value:string>>")
    base = F.sort_array(F.concat(
        F.when(word, match_spans(text, ASSIGN, "assign", 2, 8)).otherwise(none),
        F.when(text.contains("AKIA"), match_spans(text, ACCESS, "access", 0, 16)).otherwise(none),
        match_spans(text, HEX, "hex"),
    ))
    touching = lambda s: F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    more = F.filter(
        match_spans(text, CANDIDATE, "entropy"), lambda s: ~touching(s) & is_secret(s["value"], window)
    )
    return docs.withColumn("base", base).withColumn("spans", F.sort_array(F.concat(F.col("base"), more)))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
    )), ",")
