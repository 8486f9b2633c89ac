"""Targets keep their rows through failures and repeats."""

import pytest
from pyspark.sql import functions as F

from freshet.sinks import outputs, targets
from freshet.sinks.targets import Target

SCHEMA = "id int, v string"


@pytest.fixture
def target(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    t = Target(spark, str(tmp_path / "t"), df.schema, "id")
    assert not t.exists() and t.ensure().count() == 0 and t.exists()
    t.append(df)
    return t


def test_append_adds_only_its_rows(spark, target, rows, tmp_path):
    target.append(spark.createDataFrame([(3, "c")], SCHEMA))
    assert rows(target.read()) == [(1, "a"), (2, "b"), (3, "c")]
    assert sorted(p.name for p in (tmp_path / "t" / "full=1").iterdir()) == ["part=0", "part=1", "part=2"]


def test_unfinished_writes_are_not_seen(spark, target, rows, tmp_path):
    broken = tmp_path / "t" / "full=2" / "part=0"
    spark.createDataFrame([(9, "x")], SCHEMA).write.parquet(str(broken))
    (broken / "_SUCCESS").unlink()
    assert rows(target.read()) == [(1, "a"), (2, "b")]
    target.reload(spark.createDataFrame([(5, "e")], SCHEMA))
    assert rows(target.read()) == [(5, "e")]
    assert rows(Target(spark, target.path, target.schema, "id").read()) == [(5, "e")]


def test_changes(spark, target, rows):
    assert target.delete_where(F.col("v") == "zz") == 0
    target.upsert(spark.createDataFrame([(2, "B"), (3, "C")], SCHEMA))
    assert rows(target.read()) == [(1, "a"), (2, "B"), (3, "C")]
    target.upsert(spark.createDataFrame([(2, "B"), (3, "C")], SCHEMA))
    assert target.read().count() == 3
    target.patch_columns(spark.createDataFrame([(1, None), (3, "P")], SCHEMA), ["v"])
    assert rows(target.read()) == [(1, "a"), (2, "B"), (3, "P")]
    assert target.delete_where(F.col("id") == 1) == 1
    target.insert_if_new(spark.createDataFrame([(3, "no"), (4, "x"), (4, "y")], SCHEMA), ["v"])
    assert rows(target.read()) == [(2, "B"), (3, "P"), (4, "x")]
    target.delete_orphans(spark.createDataFrame([(3,)], "id int"))
    assert rows(target.read()) == [(3, "P")]
    target.truncate()
    assert target.read().count() == 0


def test_uniqueness(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], SCHEMA)
    with pytest.raises(ValueError):
        targets.assert_unique(df, "id")
    targets.assert_unique(df, "v")


def test_catalogue_tables(spark, rows):
    df = spark.createDataFrame([(1, "a")], SCHEMA)
    assert targets.ensure_table(spark, "keep_me", df.schema, "id").count() == 0
    targets.append_table(df, "keep_me")
    assert rows(targets.ensure_table(spark, "keep_me", df.schema, "id")) == [(1,)]
    assert "keep_me" in targets.tables(spark) and targets.table_exists(spark, "keep_me")
    targets.truncate_table(spark, "keep_me")
    assert spark.table("keep_me").count() == 0
    targets.replace_table(df.withColumn("w", F.lit(2)), "keep_me")
    assert rows(spark.table("keep_me")) == [(1, "a", 2)]
    targets.drop_table(spark, "keep_me")
    assert not targets.table_exists(spark, "keep_me")


def test_partition_of_a_catalogue_table_is_dropped(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, c string")
    df.write.partitionBy("c").format("parquet").saveAsTable("by_c")
    outputs.drop_partition(spark, "by_c", c="a")
    assert rows(spark.table("by_c")) == [(2, "b")]
    targets.drop_table(spark, "by_c")


def test_outputs(spark, rows, tmp_path):
    df = spark.createDataFrame([(i, "hot" if i % 3 else "cold") for i in range(60)], "id int, p string")
    outputs.route(df, "p", str(tmp_path / "r"))
    assert sorted(p.name for p in (tmp_path / "r").glob("p=*")) == ["p=cold", "p=hot"]
    assert spark.read.parquet(str(tmp_path / "r")).count() == 60
    outputs.overwrite_partitions(spark.createDataFrame([(7, "cold")], "id int, p string"), str(tmp_path / "r"), ["p"])
    back = spark.read.parquet(str(tmp_path / "r"))
    assert rows(back.filter("p = 'cold'"), "id") == [(7,)] and back.count() == 41
    outputs.upsert_partitions(spark, str(tmp_path / "r"), spark.createDataFrame([(7, "cold"), (8, "cold")], "id int, p string"), ["id"], ["p"])
    assert rows(spark.read.parquet(str(tmp_path / "r")).filter("p = 'cold'"), "id") == [(7,), (8,)]
    outputs.write_version(df, str(tmp_path / "v"), "20240101")
    assert spark.read.parquet(str(tmp_path / "v")).select("v").distinct().count() == 1
    outputs.export_csv(df, str(tmp_path / "c"))
    assert any(p.suffix == ".gz" for p in (tmp_path / "c").iterdir())
