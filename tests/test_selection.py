"""Rows selected by counting are those that sorting gives."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from freshet.operators.retention import cap_new, keep_newest
from freshet.operators.selection import By, first_rows

KINDS = {
    "long": lambda r: r.choice([None, 0, -(2**63), 2**63 - 1, r.randrange(-5, 5), r.randrange(-(2**62), 2**62)]),
    "int": lambda r: r.randrange(3), "boolean": lambda r: r.choice([True, False, None]),
    "double": lambda r: r.choice([None, float("nan"), float("inf"), -float("inf"), 0.0, 1e308, -1e308, 5e-324, r.gauss(0, 1)]),
    "string": lambda r: r.choice([None, "", "a", "a\0", "é漢", "abcdefg" * r.randrange(5), "abcdef" + chr(r.randrange(90, 300))]),
    "date": lambda r: r.choice([None, dt.date(1, 1, 1), dt.date(2024, 1, r.randrange(1, 9))]),
    "timestamp_ntz": lambda r: r.choice([None, dt.datetime(1960, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 0, r.randrange(3))]),
    "decimal(9,2)": lambda r: r.choice([None, 0]),
}


def placed(value, by):
    """Sort key of a value: nulls at their side, NaN the largest number."""
    if value is None:
        return (-1 if by.nulls_first else 1, 0, 0)
    if isinstance(value, str):
        value = tuple(value.encode()) + (-1,)
        return (0, 0, tuple(-b for b in value) if by.descending else value)
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        value = value.toordinal()
    if isinstance(value, dt.datetime):
        value = (value - dt.datetime(2000, 1, 1)) // dt.timedelta(microseconds=1)
    top = 1 if value != value else 0
    value = 0 if top else value
    return (0, -top if by.descending else top, -value if by.descending else value)


@pytest.mark.parametrize("kind", sorted(set(KINDS) - {"decimal(9,2)"}))
@pytest.mark.parametrize("descending, nulls_first", [(True, False), (False, True)])
def test_any_type_and_ties(spark, kind, descending, nulls_first):
    rng = random.Random(len(kind))
    rows = [(KINDS[kind](rng), rng.choice("xy"), i) for i in range(120)]
    df = spark.createDataFrame(rows, f"k {kind}, t string, id int").repartition(3).cache()
    order = [By("k", descending, nulls_first), By("t", True), By("id")]
    want = sorted(rows, key=lambda r: [placed(v, b) for v, b in zip(r, order, strict=True)])
    for n in (0, 1, 17, 60, 119, 120, 500):
        got = {r.id for r in first_rows(df, order, n).collect()}
        assert got == {r[2] for r in want[:n]}, n


def test_half_of_the_rows_in_one_second(spark):
    """A hot second and many unknown times: nothing is sorted, and few steps read the rows."""
    second = F.lit("2024-05-05 10:00:00").cast("timestamp_ntz")
    df = spark.range(200_000).select(
        "id", F.when(F.col("id") % 2 == 0, second).when(F.col("id") % 10 == 1, None).otherwise(
            F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id").cast("decimal(18,6)"))
        ).alias("ts"),
    )
    kept = keep_newest(df, "ts", 30_000, "id")
    assert kept.count() == 30_000
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Sort", "Window", "Exchange", "Subquery"))
    rows = kept.agg(F.min("id"), F.max("id"), F.count_distinct("ts")).first()
    assert tuple(rows) == (140_000, 199_998, 1)
    assert keep_newest(df, "ts", 5, "id", nulls="first").agg(F.min("id")).first()[0] == 199_951


def test_caps_write_nothing(spark):
    df = spark.range(1000).withColumn("v", (F.col("id") * 7919 % 1000).cast("double"))
    target = spark.range(990)
    plan = cap_new(df, [By("v", True), "id"], 1000, target)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "FileScan" not in plan
    assert sorted(r.v for r in cap_new(df, [By("v", True), "id"], 1000, target).collect()) == [float(x) for x in range(990, 1000)]
    assert cap_new(df, ["id"], 900, target).count() == 0
