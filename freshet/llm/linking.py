"""Connected components of a link table, by Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import durable


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a and b, long); root is the smallest node reachable.

    Large-star and small-star steps take turns: every node hands its larger
    neighbours, then its smaller ones, to the smallest neighbour, until the
    links are stars.  Each round is written to the shared folder, so a lost
    executor costs one round and plans stay short.  Null ends and loops are left out.
    """
    ends = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = durable(ends.filter("a <> b and a is not null and b is not null").distinct(), "links")
    before = None
    while True:
        state = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(state) == before or not state[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = tuple(state)
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
        )).alias("link")).select("link.*").filter("a <> b").distinct()
        links = durable(small, "links")
