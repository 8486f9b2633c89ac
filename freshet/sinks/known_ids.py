"""Known ids of a very large target, kept as Bloom filters beside its parts.

An id sets a few bits in one block of 512.  The filter is a table with one row
per block, built by one aggregation when a part is written and combined over
parts by or-ing blocks; so it grows and shuffles like any table, at a few bits
per id.  A new id whose bits are not all set is surely unknown, and only
the others are compared with the ids themselves.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import pick_by
from ..runtime import durable
from .partitioned import child_folders

WORDS = 8
BITS_SET = 6
#: Ids per block for which about one unknown id in a hundred looks known.
IDS_PER_BLOCK = 48


def _bits(key: Column) -> list[tuple[Column, Column]]:
    """Word and mask of each bit that an id sets in its block."""
    found = []
    for i in range(BITS_SET):
        at = F.shiftrightunsigned(F.xxhash64(key, F.lit(1)), 9 * i).bitwiseAND(F.lit(511))
        found.append((F.floor(at / 64).cast("int"), at.bitwiseAND(F.lit(63)).cast("int")))
    return found


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block")


def filter_blocks(ids: DataFrame, key: str, blocks: int) -> DataFrame:
    """One row per block with set bits: ``block`` and its words ``w0`` to ``w7``.  Null ids set none."""
    bits = _bits(F.col(key))

    def word(n: int) -> Column:
        masks = [F.when(w == n, F.expr("1L")).otherwise(F.expr("0L")) for w, _ in bits]
        shifted = [F.call_function("shiftleft", m, b) for m, (_, b) in zip(masks, bits, strict=True)]
        return reduce(lambda a, b: a.bitwiseOR(b), shifted)

    known = ids.filter(F.col(key).isNotNull()).select(_block(F.col(key), blocks), *[word(n).alias(f"w{n}") for n in range(WORDS)])
    return known.groupBy("block").agg(*[F.bit_or(f"w{n}").alias(f"w{n}") for n in range(WORDS)])


def may_be_known(df: DataFrame, key: str, blocks_of: DataFrame, blocks: int, name: str = "maybe") -> DataFrame:
    """``df`` with whether each id's bits are all set; false is certain, true is not."""
    joined = df.withColumn("_block", _block(F.col(key), blocks)).join(blocks_of, F.col("_block") == F.col("block"), "left")
    words = F.array(*[F.col(f"w{n}") for n in range(WORDS)])
    hit = reduce(
        lambda a, b: a & b,
        [F.call_function("shiftright", F.get(words, w), b).bitwiseAND(F.lit(1)) == 1 for w, b in _bits(F.col(key))],
    )
    return joined.select(*df.columns, F.coalesce(F.col("block").isNotNull() & hit, F.lit(False)).alias(name))


class KnownIds:
    """Filters of a target's parts below ``path``; ``expected`` ids in all fix the number of blocks."""

    def __init__(self, spark: SparkSession, path: str, key: str, expected: int):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.blocks = max(1, -(-expected // IDS_PER_BLOCK))

    def add(self, ids: DataFrame, part: str) -> None:
        """Write the filter of a part; a part written again replaces its filter."""
        filter_blocks(ids, self.key, self.blocks).write.mode("overwrite").parquet(f"{self.path}/part={part}")

    def read(self) -> DataFrame:
        """The filter of all parts."""
        if not child_folders(self.spark, self.path, "part="):
            return filter_blocks(self.spark.createDataFrame([], f"`{self.key}` bigint"), self.key, self.blocks)
        parts = self.spark.read.parquet(self.path).drop("part")
        return parts.groupBy("block").agg(*[F.bit_or(f"w{n}").alias(f"w{n}") for n in range(WORDS)])


def insert_new_filtered(df: DataFrame, target: DataFrame, known: KnownIds, order: Sequence[str]) -> DataFrame:
    """Rows with an id that the target lacks, the first of each id in ``order``.

    Ids that the filter does not know are new.  The few others are looked up in
    the target: its ids are only matched with these, not shuffled for all new rows, where
    Spark finds these few enough to broadcast.  Rows with a null id are kept, once.
    """
    key = known.key
    marked = durable(may_be_known(pick_by(df, [key], order, "first"), key, known.read(), known.blocks, "_maybe"), "marked")
    likely = marked.filter("_maybe")
    stored = target.select(key).join(likely.select(key), key, "left_semi").distinct()
    return marked.filter("NOT _maybe").unionByName(likely.join(stored, key, "left_anti").select(*marked.columns)).select(*df.columns)
