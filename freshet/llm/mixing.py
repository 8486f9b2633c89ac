"""Mixing sources to target weights: blocks, multinomial shards, index permutations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.ordering import distributed_row_number
from ..runtime import durable

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 64
SHARD_SLOTS = 1024
WEIGHTS = (5, 2, 1)
ROWS_PER_BUCKET = 4096
#: Rounds of the index permutation.
ROUNDS = 16


def running_total(df: DataFrame, group: str, bucket: str, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Sum of ``value`` over the earlier rows of a group, without one task holding the group.

    Rows are ordered by bucket and ``order``; windows run inside one bucket and
    over the one row per bucket.
    """
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(value).over(before(Window.partitionBy(group, bucket).orderBy(*order))), F.lit(0))
    buckets = (
        df.groupBy(group, bucket)
        .agg(F.sum(value).alias("_in"))
        .withColumn("_earlier", F.coalesce(F.sum("_in").over(before(Window.partitionBy(group).orderBy(bucket))), F.lit(0)))
        .drop("_in")
    )
    return (
        df.withColumn("_inside", inside)
        .join(buckets, [group, bucket])
        .withColumn(name, F.col("_inside") + F.col("_earlier"))
        .drop("_inside", "_earlier")
    )


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: int = 2
) -> DataFrame:
    """One row per source: number, size and target words.

    ``sizes`` has ``source`` and ``size``.  Sources in code point order, null
    last, take the weights in turn.  A target stops at ``most`` times its
    source's size, and the excess is shared again by weight until none is above.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    totals = distributed_row_number(totals, [F.col("source").asc_nulls_last()], name="number")
    number = F.col("number") - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (number % len(weights) + 1).cast("int"))
    totals = durable(totals.select(number.alias("number"), "source", "source_size", weight.alias("weight")), "sources")
    cap = F.col("source_size") * most
    total = totals.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * share
    rate, capped = 0.0, -1
    while True:
        above = F.lit(rate) * F.col("weight") > cap
        row = totals.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("open"),
            F.coalesce(F.sum(above.cast("int")), F.lit(0)).alias("capped"),
        ).first()
        if row.capped == capped or not row.open:
            break
        capped, rate = row.capped, max(0.0, (total - row.held) / row.open)
    target = F.least(cap.cast("double"), F.lit(rate) * F.col("weight"))
    return totals.withColumn("target", target)


def _picked(slots: DataFrame, seed: int) -> DataFrame:
    """Slots (number, epoch, index, blocks) with the ``block`` that they pick.

    The indices of a source's blocks go through a pseudorandom permutation for
    each epoch, a swap-or-not network: each round pairs every place x with k - x modulo the
    number of blocks, k being the round's key, and swaps the pair or not by a
    keyed bit of the larger of the two.  Every round is a permutation for any
    number of blocks, so no place is walked to or left out.
    """
    slots = slots.withColumn("_key", F.xxhash64(F.lit(seed), "number", "epoch")).withColumn("block", F.col("index").cast("bigint"))
    for i in range(ROUNDS):
        other = F.pmod(F.pmod(F.xxhash64("_key", F.lit(i)), F.col("blocks")) - F.col("block"), F.col("blocks"))
        slots = slots.withColumn("_other", other)
        swapped = F.xxhash64("_key", F.lit(i), F.greatest("block", "_other"), F.lit("bit")).bitwiseAND(F.lit(1)) == 1
        slots = slots.withColumn("block", F.when(swapped, F.col("_other")).otherwise(F.col("block")))
    return slots.drop("_key", "_other")


def slots_of(sources: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 17) -> DataFrame:
    """Which block of which source stands in which output shard.

    Every shard draws its source counts from a multinomial over the sources'
    slots.  A source that has been drawn often enough gives up its later draws;
    the slots that are then missing make up closing shards.  The n-th slot of a
    source goes through the permutation of its epoch to a block, so no block is
    taken more often than there are epochs.  Columns: shard, number, block, words.
    """
    n_blocks = F.ceil(F.col("source_size") / block_words).cast("bigint")
    goal = F.floor(F.col("target") + 0.5).cast("bigint")
    rounds = F.floor(goal / F.col("source_size")).cast("bigint")
    rest = goal - rounds * F.col("source_size")
    plan = sources.filter("source_size > 0 and target > 0").select(
        "number", n_blocks.alias("blocks"), (rounds * n_blocks + F.ceil(rest / block_words)).cast("bigint").alias("slots"),
        (rest % block_words).alias("part"), F.floor(F.col("number") / 1000).alias("bucket"), F.lit(0).alias("all"),
    ).filter("slots > 0")
    plan = durable(running_total(plan, "all", "bucket", ["number"], "slots", "low").drop("all", "bucket"), "slots")
    total, n_sources = plan.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count(F.lit(1))).first()
    step = max(1, total // (16 * n_sources + 1))
    spread = plan.withColumn(
        "bin", F.explode(F.sequence(F.floor(F.col("low") / step), F.floor((F.col("low") + F.col("slots") - 1) / step)))
    )
    spark = sources.sparkSession
    draws = spark.range(total).select(
        F.floor(F.col("id") / shard_slots).alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(1, total))).alias("draw"),
    ).withColumn("bin", F.floor(F.col("draw") / step))
    drawn = (
        draws.join(spread, "bin")
        .filter("draw >= low and draw < low + slots")
        .groupBy("shard", "number").agg(F.count(F.lit(1)).alias("n"))
    )
    drawn = drawn.join(plan.select("number", "slots"), "number")
    drawn = durable(
        running_total(drawn.withColumn("bucket", F.floor(F.col("shard") / 1000)), "number", "bucket", ["shard"], "n", "first"),
        "draws",
    )
    closing = (
        plan.select("number", "slots")
        .join(drawn.groupBy("number").agg(F.sum("n").alias("had")), "number", "left")
        .withColumn("had", F.coalesce("had", F.lit(0)))
        .filter("had < slots")
        .select(
            (F.lit((total - 1) // shard_slots + 1) + F.floor(F.col("had") / shard_slots)).alias("shard"),
            "number", F.col("had").alias("first"), F.col("slots").alias("end"),
        )
    )
    runs = drawn.select(
        "shard", "number", "first", F.least(F.col("first") + F.col("n"), F.col("slots")).alias("end")
    ).filter("first < end").unionByName(closing)
    placed = runs.withColumn("slot", F.explode(F.sequence(F.col("first"), F.col("end") - 1))).select("shard", "number", "slot")
    placed = placed.join(plan.select("number", "blocks", "slots", "part"), "number")
    partial = (F.col("part") > 0) & (F.col("slot") == F.col("slots") - 1)
    placed = placed.select(
        "shard", "number", F.floor(F.col("slot") / F.col("blocks")).alias("epoch"), (F.col("slot") % F.col("blocks")).alias("index"),
        "blocks", F.when(partial, F.col("part")).otherwise(F.lit(block_words)).alias("words"),
    )
    # written, so that no filter of a later join is carried through the rounds
    return durable(_picked(placed, seed).select("shard", "number", "block", "words"), "mix")


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.5,
    most: int = 2,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = 17,
) -> tuple[DataFrame, DataFrame]:
    """Mix the words of all documents to the targets of their sources.

    Gives two frames.  The first has one row per row of ``docs``: doc_id,
    source, size (words), source_size, target and taken (words in the mix,
    repeats counted).  The second has the mix itself: shard, number of the
    source, block, words taken from the start of the block.  A source's words
    stand in one sequence by bucket and doc_id; blocks of ``block_words`` are
    cut from it.  Null text has size 0; a null source is a source of its own;
    rows that are alike are separate rows; other columns are ignored.  No rows
    give no rows.  Equal input and parameters give equal results.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    rows = durable(docs.select("doc_id", "source", size.alias("size")), "sizes")
    sources = durable(source_targets(rows, weights, share, most), "targets")
    n = rows.count()
    known = rows.alias("r").join(sources.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source"))).select(
        "r.*", "s.number", "s.source_size", "s.target"
    )
    buckets = n // ROWS_PER_BUCKET + 1
    known = known.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size"), F.lit(buckets)))
    known = running_total(known, "number", "bucket", ["doc_id", "size"], "size", "at")
    slots = slots_of(sources, block_words, shard_slots, seed)
    uses = slots.groupBy("number", "block", "words").agg(F.count(F.lit(1)).alias("times"))
    start = F.col("block") * block_words
    covered = F.greatest(
        F.lit(0), F.least(F.col("at") + F.col("size"), start + F.col("words")) - F.greatest(F.col("at"), start)
    )
    identity = ["doc_id", "source", "size", "source_size", "target", "number", "at"]
    spread = known.filter("size > 0").withColumn(
        "block", F.explode(F.sequence(
            F.floor(F.col("at") / block_words), F.floor((F.col("at") + F.col("size") - 1) / block_words)
        ))
    )
    taken = (
        spread.join(uses, ["number", "block"], "left")
        .withColumn("taken", F.coalesce(covered * F.col("times"), F.lit(0)))
        .groupBy(*identity).agg(F.sum("taken").alias("taken"))
        .drop("number", "at")
    )
    empty = known.filter("size = 0").drop("bucket", "number", "at").withColumn("taken", F.lit(0).cast("bigint"))
    return taken.withColumn("taken", F.col("taken").cast("bigint")).unionByName(empty), slots
