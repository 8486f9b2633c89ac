"""Row, age, date and version budgets."""

from pyspark.sql import functions as F

from ..operators.retention import (
    cap_new,
    drop_older,
    dropped_count,
    first_by_priority,
    keep_newest,
    keep_newest_dates,
    keep_versions,
    newest,
)
from ..operators.selection import By
from .registry import day_text, query, table, time_text


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 500
""")
def keep_newest_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return keep_newest(orders, "o_orderdate", 500, "o_orderkey").select(
        "o_orderkey", day_text("o_orderdate").alias("day")
    )


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 777
""")
def keep_newest_by_day_counts(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    kept = keep_newest(events, "ts", 777, "event_id")
    return kept.withColumn("ts", time_text("ts"))


@query("""
SELECT o_orderkey FROM orders
ORDER BY CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END DESC NULLS FIRST, o_orderkey DESC LIMIT 700
""")
def keep_newest_nulls_first(spark, sf_dir):
    date = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", date.alias("date"))
    return keep_newest(orders, "date", 700, "o_orderkey", nulls="first").select("o_orderkey")


@query("""
SELECT event_id FROM events WHERE (event_type, CAST(ts AS DATE)) IN (
  SELECT (event_type, d) FROM (
    SELECT event_type, d, row_number() OVER (PARTITION BY event_type ORDER BY d DESC) AS n
    FROM (SELECT DISTINCT event_type, CAST(ts AS DATE) AS d FROM events)) WHERE n <= 3)
""")
def keep_dates_per_collection(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", F.to_date("ts").alias("day"))
    return keep_newest_dates(events, ["event_type"], "day", 3).select("event_id")


@query("""
WITH v AS (SELECT *, strftime(o_orderdate, '%Y%m') AS v FROM orders)
SELECT o_orderkey, v AS version FROM v WHERE v IN ('199501', '199712')
OR v IN (SELECT DISTINCT v FROM v ORDER BY v DESC LIMIT 2)
""")
def keep_versions_with_exempt(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("version")
    )
    return keep_versions(orders, "version", 2, ["199501", "199712"])


@query("""
SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-06-01'
UNION ALL SELECT -count(*) AS o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '2000-06-01'
""")
def age_filter(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    kept = drop_older(orders, "o_orderdate", "2000-06-01").select("o_orderkey")
    dropped = dropped_count(orders, "o_orderdate", "2000-06-01")
    return kept.unionByName(dropped.select((-F.col("dropped")).alias("o_orderkey")))


@query("""
SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1
""")
def newest_item(spark, sf_dir):
    return newest(table(spark, sf_dir, "events"), "ts", "event_id").select("event_id", "event_type")


@query("""
SELECT user_id, event_type, day FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY list_position(['purchase', 'click', 'view'], event_type)) AS n
  FROM (SELECT DISTINCT user_id, strftime(ts, '%Y-%m-%d') AS day, event_type FROM events
        WHERE event_type IN ('purchase', 'click', 'view')))
WHERE n = 1
""")
def first_priority(spark, sf_dir):
    runs = table(spark, sf_dir, "events").select("user_id", day_text("ts").alias("day"), "event_type").distinct()
    return first_by_priority(runs, ["user_id", "day"], "event_type", ["purchase", "click", "view"])


@query("SELECT event_id FROM events ORDER BY value DESC, event_id LIMIT 250")
def ingest_cap(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return cap_new(events, [By("value", True), "event_id"], 250).select("event_id")


@query("""
SELECT event_id FROM events WHERE event_type <> 'view' ORDER BY ts, event_id
LIMIT (SELECT greatest(0, 5000 - count(*)) FROM events WHERE event_type = 'view')
""")
def ingest_cap_numbered(spark, sf_dir):
    """New events as far as a budget leaves room beside the stored ones."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    stored, new = events.filter("event_type = 'view'"), events.filter("event_type <> 'view'")
    return cap_new(new, ["ts", "event_id"], 5000, stored).select("event_id")
