"""Spelling variants: words one edit apart, grouped under the most frequent spelling.

Candidates come from partition-and-enumerate signatures.  The letters of a word
are a set of dimensions (letter, number of its occurrence), so a word is a binary
vector; one replaced letter changes two dimensions, one more letter adds one.
The dimensions are dealt to a few parts.  If at most ``k`` dimensions differ, at
most ``k`` parts differ, so some choice of all but ``k`` parts is equal: a
signature is such a choice with the letters in it, and near words share one.

Letters alone do not tell anagrams apart, so a signature also carries the half
of the word that the one edit leaves alone, and the lengths of the pair that it
is for.  Words with equal signatures are joined and verified by edit distance.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import durable

RUN = "[a-zÀ-ÿ]+"
#: Parts of the dimensions for words of one length (two dimensions differ) and for a longer word (one differs).
REPLACED_PARTS, INSERTED_PARTS = 4, 3


def lower_ascii(col: Column | str) -> Column:
    """Lower case of A to Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per run of letters, lower-cased, as ``run`` beside all other columns' struct ``row``."""
    others = [c for c in docs.columns if c != text]
    found = F.regexp_extract_all(lower_ascii(text), F.lit(RUN), F.lit(0))
    return docs.select(F.struct(*others).alias("row"), F.explode(found).alias("run"))


def dropped_letter(run: Column, code: Column, every: int) -> Column:
    """The run without its letter number ``code % length`` where ``every`` divides ``code``; null code changes nothing."""
    size = F.length(run)
    at = (code % size).cast("int")
    changed = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, size))
    return F.when(code % every == 0, changed).otherwise(run)


def word_counts(words: DataFrame, word: str, min_length: int, min_count: int) -> DataFrame:
    """Words of at least that length and how often they occur, if often enough."""
    kept = words.select(F.col(word).alias("word")).filter(F.length("word") >= min_length)
    return kept.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def _signatures(letters: Column, tag: str, length: Column, halves: dict[str, Column], parts: int, differ: int) -> Column:
    """Hashes of all choices of ``parts - differ`` parts, each with one half."""

    def choice(kept: tuple[int, ...]) -> Column:
        inside = F.filter(letters, lambda d: F.pmod(d["hash"], F.lit(parts)).isin(*kept))
        return F.array_join(F.transform(inside, lambda d: d["letter"]), "")

    return F.array(*[
        F.xxhash64(F.lit(f"{tag}{side}{kept}"), length, half, choice(kept))
        for kept in combinations(range(parts), parts - differ)
        for side, half in halves.items()
    ])


def _letters(word: Column) -> Column:
    """Sorted letters with a hash of letter and occurrence, the dimensions of the word."""
    ordered = F.array_sort(F.split(word, ""))
    return F.transform(ordered, lambda c, i: F.struct(
        c.alias("letter"), F.xxhash64(c, i + 1 - F.array_position(ordered, c)).alias("hash")
    ))


def _keyed(words: DataFrame, tag: str, length: Column, left: int | Column, parts: int, differ: int) -> DataFrame:
    """Words with each signature: ``left`` letters are the first half, the last ``length - left`` the second."""
    halves = {"p": F.substring("word", F.lit(1), left), "s": F.expr("right(word, _rest)")}
    keyed = words.withColumn("_rest", length - left).withColumn("_letters", _letters(F.col("word")))
    return keyed.select("word", "n", F.explode(_signatures(F.col("_letters"), tag, length, halves, parts, differ)).alias("key"))


def near_pairs(words: DataFrame) -> DataFrame:
    """Unordered pairs (a, b) of words one inserted, deleted or replaced code point apart, with their counts.

    ``words`` has distinct ``word`` and ``n``.  Each pair is given once.  A word
    has up to twelve signatures, which Spark does not count when it sizes a side
    of the joins, so these are told to sort and merge.
    """
    words = words.select("word", "n")
    size = F.length("word")
    half = F.floor(size / 2).cast("int")
    same = _keyed(words, "r", size, half, REPLACED_PARTS, 2)
    short = _keyed(words, "i", size, half, INSERTED_PARTS, 1)
    long = _keyed(words, "i", size - 1, F.floor((size - 1) / 2).cast("int"), INSERTED_PARTS, 1)
    columns = ["a", "n_a", "b", "n_b"]
    first, second = ([F.col("word").alias(x), F.col("n").alias(f"n_{x}"), "key"] for x in "ab")
    one_edit = F.levenshtein("a", "b", 1) == 1
    replaced = same.select(*first).join(same.select(*second).hint("merge"), "key").filter((F.col("a") < F.col("b")) & one_edit)
    inserted = short.select(*first).join(long.select(*second).hint("merge"), "key").filter(one_edit)
    return replaced.select(*columns).unionByName(inserted.select(*columns)).dropDuplicates(["a", "b"])


def _roots(links: DataFrame, most: int, factor: int) -> DataFrame:
    """The last form that each linked word reaches.

    A form occurs at least ``factor`` times as often as its word, so chains are
    no longer than the logarithm of the largest count; each round doubles the
    steps taken.
    """
    longest = max(1, math.ceil(math.log(max(most, factor)) / math.log(factor)) + 1)
    root = links.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(longest)) + 1):
        root = durable(root, "roots")
        further = root.select(F.col("word").alias("_via"), F.col("root").alias("_far"))
        root = root.join(further, F.col("root") == F.col("_via"), "left").select(
            "word", F.coalesce("_far", "root").alias("root")
        )
    return root


def group_variants(words: DataFrame, factor: int = 5) -> DataFrame:
    """Each word with its ``form``, ``root``, ``n``, ``n_near`` and ``form_n``.

    ``words`` has ``word`` and ``n``; a word given in several rows counts as one
    with their sum, null words and words without a count are left out, other
    columns are ignored.  A word's form is its near word of largest ``n`` (ties:
    the smallest in code-point order) if that is at least ``factor`` times its
    own, else null; its root is the end of the chain of forms, the word itself
    if it has none.  Words without a near word have ``n_near`` 0.  An empty table
    gives no rows.
    """
    if factor < 2:
        raise ValueError("factor must be at least 2")
    words = words.filter(F.col("word").isNotNull() & (F.col("n") > 0)).groupBy("word").agg(F.sum("n").alias("n"))
    words = durable(words, "words")
    pairs = durable(near_pairs(words), "pairs")
    both = [
        pairs.select(F.col(x).alias("word"), F.col(y).alias("other"), F.col(f"n_{y}").alias("other_n"))
        for x, y in ("ab", "ba")
    ]
    near = reduce(DataFrame.unionByName, both)
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("first"),
    )
    found = words.join(best, "word", "left").withColumn("form_n", -F.col("first.less"))
    enough = F.col("form_n") >= factor * F.col("n")
    found = durable(found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(enough, F.col("first.other")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n"),
    ), "forms")
    most = words.agg(F.max("n")).first()[0] or 0
    roots = _roots(found.filter("form IS NOT NULL").select("word", "form"), most, factor)
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
