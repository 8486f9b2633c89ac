"""Quality rules: word and line counts of a text, and lines that many documents of a host share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import durable

GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.transform(F.array(value), body)[0]


def word_list(text: Column) -> Column:
    return F.filter(F.split(text, GAP), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """How many words stand in a 3-word window that the text has twice or more.

    Windows are sorted by hash, those with an equal neighbour are put back in
    order of place, and each adds the words that the next one does not cover.
    """

    def windows(w: Column) -> Column:
        each = F.transform(w, lambda x: F.xxhash64(x))
        two = lambda h: F.zip_with(h, F.slice(h, 2, F.size(h)), lambda a, b: F.xxhash64(a, b))
        three = let(each, lambda h: F.zip_with(two(h), F.slice(h, 3, F.size(h)), lambda a, b: F.xxhash64(a, b)))
        placed = F.transform(F.slice(three, 1, F.size(w) - 2), lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.sort_array(placed)

    def places(s: Column) -> Column:
        near = lambda p, k: F.coalesce(F.get(s, k)["h"] == p["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, lambda p, k: near(p, k - 1) | near(p, k + 1)), lambda p: p["i"]))

    def covered(p: Column) -> Column:
        steps = F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3)))
        return F.aggregate(steps, F.lit(0), lambda total, n: total + n)

    count = let(let(windows(words), places), covered)
    return F.when(F.size(words) < 3, F.lit(0)).otherwise(count)


def text_counts(docs: DataFrame) -> DataFrame:
    """Word, symbol, line and repetition counts beside each row, and its lines as hash and word count.

    The new columns are n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, _text and _lines.  Null text counts as empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    normal = lambda x: F.lower(F.trim(F.regexp_replace(x, GAP, " ")))
    facts = F.struct(
        let(word_list(text), lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("repeated"))).alias("w"),
        let(lines, lambda x: F.struct(
            (F.size(x) - F.size(F.array_distinct(x))).alias("again"),
            F.transform(x, lambda y: F.struct(
                F.xxhash64(normal(y)).alias("line"), F.regexp_count(y, F.lit(WORD)).alias("words")
            )).alias("each"),
        )).alias("l"),
        F.length(F.regexp_replace(text, GAP, "")).alias("chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).alias("symbols"),
    )
    long = lambda c: F.col(c).cast("bigint")
    return docs.select(
        "doc_id", "source", F.xxhash64(text).alias("_text"), facts.alias("_facts")
    ).select(
        "doc_id", "source", "_text", long("_facts.w.n").alias("n_words"), long("_facts.chars").alias("word_chars"),
        long("_facts.symbols").alias("n_symbols"), long("_facts.l.again").alias("n_dup_lines"),
        long("_facts.w.repeated").alias("n_repeat_words"), F.col("_facts.l.each").alias("_lines"),
    )


def apply_rules(
    docs: DataFrame,
    min_words: int = 50,
    max_repeat_percent: int = 50,
    min_documents: int = 10,
    max_share: float = 0.005,
    max_documents: int = 10_000,
    min_left: float = 0.25,
) -> DataFrame:
    """The counts of each document, and whether it is kept.

    A line, in lower case with single spaces, is frequent on its host (the
    source) if more than ``min_documents`` different texts have it, and these are
    more than ``max_share`` of the host's different texts or more than
    ``max_documents``, whatever the size of the host.  Frequent lines are
    removed; a document of which less than ``min_left`` of the words is left is
    depleted.  Copies of a text count as one document, so a text is not removed
    for having been copied.  Columns: doc_id, source, the counts of
    :func:`text_counts`, n_words_left, base_failed, depleted, kept.

    One row out per row in, equal rows too.  Null or empty text has counts of
    zero and fails; a null source is a host of its own; other columns are
    ignored.
    """
    rows = text_counts(docs).withColumn("_row", F.monotonically_increasing_id())
    rows = durable(rows.withColumn("_host", F.xxhash64(F.col("source").isNull(), "source")), "counts")
    texts = rows.groupBy("_host", "_text").agg(F.max(F.col("_row")).alias("_row"))
    once = rows.join(texts.select("_row"), "_row", "left_semi")
    hosts = texts.groupBy("_host").agg(F.count(F.lit(1)).alias("_texts"))
    found = (
        once.select("_host", F.explode(F.array_distinct(F.col("_lines.line"))).alias("line"))
        .groupBy("_host", "line").agg(F.count(F.lit(1)).alias("_having"))
        .filter(F.col("_having") > min_documents)
    )
    limit = F.least(max_share * F.col("_texts"), F.lit(max_documents))
    frequent = found.join(hosts, "_host").filter(F.col("_having") > limit).select("_host", "line")
    removed = (
        rows.select("_row", "_host", F.inline("_lines"))
        .groupBy("_row", "_host", "line").agg(F.sum("words").alias("words"))
        .join(frequent, ["_host", "line"], "left_semi")
        .groupBy("_row").agg(F.sum("words").alias("_removed"))
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    left = F.col("n_words") - F.coalesce("_removed", F.lit(0))
    return (
        rows.drop("_text", "_host", "_lines")
        .join(removed, "_row", "left")
        .withColumn("n_words_left", left.cast("bigint"))
        .withColumn("base_failed", failed)
        .withColumn("depleted", F.col("n_words_left") < min_left * F.col("n_words"))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
        .drop("_row", "_removed")
    )
