"""Filters of known ids lose no new row and keep most from the exact join."""

import pytest
from pyspark.sql import functions as F

from freshet.sinks.known_ids import KnownIds, filter_blocks, insert_new_filtered, may_be_known
from freshet.streaming.incremental import insert_if_new


@pytest.mark.parametrize("key", ["id", "cast(id as string)"])
def test_filter_has_no_false_no_and_few_false_yes(spark, tmp_path, key):
    ids = spark.range(20_000).selectExpr(f"{key} AS k")
    known = KnownIds(spark, str(tmp_path / "f"), "k", 20_000)
    assert may_be_known(ids, "k", known.read(), known.blocks).filter("maybe").count() == 0
    known.add(ids.filter("cast(k as long) < 7000"), "a")
    known.add(ids.filter("cast(k as long) >= 6000"), "b")
    known.add(ids.filter("cast(k as long) >= 6000"), "b")
    assert may_be_known(ids, "k", known.read(), known.blocks).filter("NOT maybe").count() == 0
    others = spark.range(100_000, 140_000).selectExpr(f"{key} AS k")
    assert may_be_known(others, "k", known.read(), known.blocks).filter("maybe").count() < 40_000 * 0.03
    assert known.read().count() <= known.blocks


def test_only_likely_rows_reach_the_exact_join(spark, tmp_path, rows):
    target = spark.range(5_000).selectExpr("id * 3 AS id", "'old' AS v")
    known = KnownIds(spark, str(tmp_path / "f"), "id", 5_000)
    known.add(target, "0")
    feed = spark.range(9_000).selectExpr("id AS id", "concat('n', id) AS v")
    feed = feed.unionByName(feed.filter("id % 5 = 0").withColumn("v", F.lit("z"))).unionByName(spark.createDataFrame([(None, "null")], "id long, v string"))
    likely = may_be_known(feed, "id", known.read(), known.blocks).filter("maybe AND id % 3 <> 0").count()
    assert likely < 0.03 * 6_000 * 1.2
    got = insert_new_filtered(feed, target, known, ["v"])
    want = insert_if_new(feed, target, "id", ["v"])
    assert got.columns == want.columns and rows(got) == rows(want) and got.count() == 6_001
    assert insert_new_filtered(feed.limit(0), target, known, ["v"]).count() == 0


def test_blocks_are_a_hash_aggregate(spark):
    plan = filter_blocks(spark.range(10), "id", 4)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
