"""Plans that hold at scale: what is scanned, shuffled and joined how."""

import re

import pytest

from freshet.catalogue import QUERIES

DATA = "/root/testdata/sf0.001"
STREAMS = {name for name in QUERIES if name.startswith("stream_")}


@pytest.fixture(scope="module")
def plans(spark):
    """Physical plans without broadcasts and without run-time changes."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        return {
            name: query(spark, DATA)._jdf.queryExecution().executedPlan().toString()
            for name, query in QUERIES.items()
            if name not in STREAMS
        }
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def test_no_cross_or_loop_joins(plans):
    assert not [n for n, p in plans.items() if "CartesianProduct" in p or "NestedLoopJoin" in p]


def test_no_forced_broadcasts(plans):
    assert not [n for n, p in plans.items() if "BroadcastExchange" in p]


def test_no_row_at_a_time_python(plans):
    assert not [n for n, p in plans.items() if "BatchEvalPython" in p]


def test_python_only_where_there_is_no_expression(plans):
    used = {n for n, p in plans.items() if re.search("ArrowEvalPython|MapInPandas|MapInArrow|FlatMapGroups", p)}
    assert used == {
        "binary_points", "simplified_outlines", "zip_members", "html_tables", "json_one_document", "geojson_one_document",
    }


@pytest.mark.parametrize(
    "name, columns",
    [
        ("station_daily_metrics", {"ts", "event_type", "value"}),
        ("trailing_30d_mean", {"ts", "event_type", "value"}),
        ("dedupe_keep_last", {"event_id", "user_id", "event_type", "value"}),
        ("coverage_semi", {"o_custkey", "o_orderstatus"}),
        ("page_links", {"html"}),
    ],
)
def test_scans_read_only_what_is_used(plans, name, columns):
    read = [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^\n]*)>", plans[name])]
    assert columns in read


def test_filters_reach_the_scan(plans):
    assert "GreaterThanOrEqual(o_orderdate" in plans["new_rows_anti"]
    assert "IsNotNull(event_type)" in plans["station_daily_metrics"]
    assert "EqualTo(l_returnflag,R)" in plans["left_join_to_aggregate"]


def test_windows_without_groups_run_on_count_tables_only(plans):
    """A single-task window may only see one row per day or per slice."""
    for name, plan in plans.items():
        for keys in re.findall(r"Window \[.*?windowspecdefinition\((\S+)", plan):
            if "Exchange SinglePartition" in plan and not re.search(r"Exchange hashpartitioning", plan):
                assert re.match(r"_slice|_day|slice|_split|file", keys), (name, keys)


def test_aggregates_combine_before_the_shuffle(plans):
    for name in ("latest_per_key", "dedupe_keep_last", "grid_mosaic", "type_pivot_totals", "role_totals_unknown"):
        assert "partial_" in plans[name]


def test_refining_a_grid_needs_no_shuffle(spark):
    from freshet.operators.grid import refine

    df = spark.range(4).selectExpr("cast(id as int) row", "cast(id as int) col", "id value")
    assert "Exchange" not in refine(df, 3)._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_split_when_totals_are_joined_back(spark):
    from pyspark.sql import functions as F

    from freshet.operators.aggregates import with_group_value

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "500KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "500KB",
        "spark.sql.shuffle.partitions": "32",
    }
    old = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 100_000)
        df = spark.range(0, 600_000, 1, 8).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("p"))
        joined = with_group_value(df, ["k"], F.count(F.lit(1)), "n").agg(F.sum("n"), F.count("p"))
        assert joined.collect()[0][1] == 600_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
