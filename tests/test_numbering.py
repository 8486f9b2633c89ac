"""Row numbers by buckets are those of one window; no row is written and no bucket is hot."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from freshet.operators.numbering import _codes, number_rows
from freshet.operators.selection import By


@pytest.mark.parametrize("descending, nulls_first", [(False, True), (True, False), (True, True)])
def test_numbers_of_one_window(spark, descending, nulls_first):
    rng = random.Random(7)
    rows = [
        (rng.choice(["a", "b", None]), rng.choice([None, 1.5, 1.5, 1.5, float("nan"), rng.gauss(0, 9)]), rng.choice(["x", "x", "é", None, str(i)]),
         rng.choice([dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, i % 60)]), i)
        for i in range(700)
    ]
    df = spark.createDataFrame(rows, "g string, v double, t string, ts timestamp_ntz, id int")
    order = [By("v", descending, nulls_first), By("t", not descending, nulls_first), By("ts"), By("id", descending)]
    side = lambda b: getattr(F.col(b.name), ("desc" if b.descending else "asc") + "_nulls_" + ("first" if b.nulls_first else "last"))()
    for groups in ([], ["g"]):
        plain = F.row_number().over(Window.partitionBy(*groups).orderBy(*map(side, order)))
        want = {r.id: r.n for r in df.withColumn("n", plain).collect()}
        for buckets in (2, 16, 64):
            got = {r.id: r.n for r in number_rows(df, order, groups, "n", buckets).collect()}
            assert got == want
    assert number_rows(df.limit(0), order).count() == 0


def test_a_hot_value_is_spread_and_nothing_written(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(60_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 5 ELSE id END AS v", "repeat('x', 100) AS wide").write.parquet(path)
    df = spark.read.parquet(path)
    sample = [tuple(r) for r in df.select("v", "id").sample(0.05, 17).collect()]
    kinds = [df.schema[c].dataType for c in ("v", "id")]
    code, _ = _codes(sample, [By("v"), By("id")], kinds, 64)
    assert df.groupBy(code.alias("b")).count().agg(F.max("count")).first()[0] < 60_000 / 25
    numbered = number_rows(df, ["v", "id"])
    assert {f for f in numbered.inputFiles()} == {f for f in df.inputFiles()}
    ends = numbered.agg(F.min("row_number"), F.max("row_number"), F.count_distinct("row_number")).first()
    assert tuple(ends) == (1, 60_000, 60_000)
