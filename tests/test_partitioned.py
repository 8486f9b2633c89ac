"""Changes of a partitioned target rewrite the touched partitions only."""

import pytest
from pyspark.sql import functions as F

from freshet.sinks import outputs
from freshet.sinks.partitioned import PartitionedTarget, child_folders, remove_versions
from freshet.sinks.targets import Target


@pytest.fixture
def target(spark, tmp_path):
    rows = spark.range(60).selectExpr("id", "CASE WHEN id < 55 THEN concat('p ', id div 20, '/%') END AS p", "id * 2 AS v")
    made = PartitionedTarget(spark, str(tmp_path / "t"), rows.schema, "p", "id")
    made.append(rows)
    return made


def files(target):
    """Files per partition."""
    found = {}
    for r in target.read().select("p", F.col("_metadata.file_path").alias("f")).distinct().collect():
        found.setdefault(r.p, set()).add(r.f)
    return found


def changed(target, change):
    """Partitions whose files are others after the change, and what the change returned."""
    before = files(target)
    n = change()
    after = files(target)
    return {p for p in before.keys() | after.keys() if before.get(p) != after.get(p)}, n


def test_only_touched_partitions_change(spark, target):
    first, second, third = (f"p {i}/%" for i in range(3))
    assert changed(target, lambda: target.delete_where(F.col("id").isin(1, 2))) == ({first}, 2)
    assert changed(target, lambda: target.delete_where(F.col("id") < 0)) == (set(), 0)
    assert changed(target, lambda: target.delete_ids(spark.createDataFrame([(25,), (99,)], "id long"))) == ({second}, 1)
    new = spark.createDataFrame([(26, second, -1), (100, second, -2)], "id long, p string, v long")
    assert changed(target, lambda: target.upsert(new, moves=False)) == ({second}, 1)
    moved = spark.createDataFrame([(100, "new", -3)], "id long, p string, v long")
    assert changed(target, lambda: target.upsert(moved)) == ({second, "new"}, 1)
    patch = spark.createDataFrame([(45, 7), (46, None), (500, 1)], "id long, v long")
    assert changed(target, lambda: target.patch_columns(patch, ["v"])) == ({third}, 2)
    assert changed(target, lambda: target.delete_where(F.col("p").isNull())) == ({None}, 5)
    assert changed(target, lambda: target.delete_orphans(target.read().filter("id <> 30"))) == ({second}, 1)
    rows = {r.id: (r.p, r.v) for r in target.read().collect()}
    assert set(rows) == set(range(55)) - {1, 2, 25, 30} | {100}
    assert rows[26] == (second, -1) and rows[100] == ("new", -3) and rows[45] == (third, 7) and rows[46] == (third, 92)
    assert changed(target, lambda: target.keep_newest("id", 12, "id"))[0] == {first, second, third}
    assert sorted(r.id for r in target.read().collect()) == [*range(44, 55), 100]
    assert target.keep_newest("id", 12, "id") == 0


def test_nothing_stored_yet(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a")], "id long, p string")
    made = PartitionedTarget(spark, str(tmp_path / "t"), rows.schema, "p", "id")
    assert made.read().count() == 0 and made.delete_ids(rows) == 0 and made.keep_newest("id", 1, "id") == 0
    assert made.upsert(rows) == 0 and made.upsert(rows) == 1
    assert made.read().count() == 1
    assert made.delete_where(F.lit(True)) == 1 and made.read().count() == 0


def test_versions_and_generations_go(spark, tmp_path):
    base = str(tmp_path / "v")
    for day in range(1, 6):
        outputs.write_version(spark.range(day), base, f"2024010{day}")
    assert remove_versions(spark, base, 2, ["20240102"]) == ["20240101", "20240103"]
    assert child_folders(spark, base, "v=") == ["v=20240102", "v=20240104", "v=20240105"]
    assert remove_versions(spark, base, 9) == [] and remove_versions(spark, str(tmp_path / "none"), 1) == []
    target = Target(spark, str(tmp_path / "t"), spark.range(1).schema, "id")
    for n in range(5):
        target.upsert(spark.range(n, n + 3), keep=lambda rows: rows.filter("id <> 2"))
    assert len(child_folders(spark, str(tmp_path / "t"), "full=")) == 2
    assert sorted(r.id for r in target.read().collect()) == [0, 1, 3, 4, 5, 6]
