"""Moving aggregates, positions and ids."""

from pyspark.sql import functions as F

from ..functions.dates import noon_day
from ..functions.units import exact_mean, exact_sum, fixed
from ..operators.ordering import assign_ids, chunk_keys
from ..operators.windows import (
    change_by_date,
    daily_metrics,
    latest_per,
    max_rolling_mean,
    pct_change,
    trailing_mean,
    with_position,
)
from ..operators.selection import By
from .registry import day_text, query, table, time_text


@query("""
WITH hours AS (
  SELECT event_type, date_trunc('hour', ts) AS hour, avg(value) AS v
  FROM events GROUP BY 1, 2),
rolled AS (
  SELECT event_type, CAST(hour + INTERVAL 12 HOUR AS DATE) AS day, hour, v,
         CASE WHEN count(v) OVER w >= 8 THEN avg(v) OVER w END AS r
  FROM hours
  WINDOW w AS (PARTITION BY event_type, CAST(hour + INTERVAL 12 HOUR AS DATE)
               ORDER BY hour ROWS BETWEEN 7 PRECEDING AND CURRENT ROW))
SELECT event_type, strftime(day, '%Y-%m-%d') AS day, round(max(v), 8) AS max_1h,
       round(avg(v), 8) AS mean_24h, round(max(r), 8) AS max_8h, count(v) AS hours
FROM rolled GROUP BY event_type, day
""")
def station_daily_metrics(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    out = daily_metrics(events, ["event_type"], "ts", "value")
    rounded = {c: F.round(c, 8) for c in ("max_1h", "mean_24h", "max_8h")}
    return out.withColumns(rounded).withColumn("day", day_text("day"))


@query("""
WITH days AS (
  SELECT user_id, CAST(ts AS DATE) AS day, sum(CAST(round(value * 100) AS BIGINT))::DOUBLE / 100.0::DOUBLE AS v
  FROM events GROUP BY 1, 2),
rolled AS (
  SELECT user_id, CASE WHEN count(v) OVER w >= 5 THEN avg(v) OVER w END AS r FROM days
  WINDOW w AS (PARTITION BY user_id ORDER BY day ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
SELECT user_id, round(max(r), 8) AS best FROM rolled GROUP BY user_id
""")
def rolling_mean_max(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    days = events.groupBy("user_id", F.to_date("ts").alias("day")).agg(exact_sum("value").alias("v"))
    out = max_rolling_mean(days, ["user_id"], "day", "v", 5, 5, "best")
    return out.select("user_id", F.round("best", 8).alias("best"))


@query("""
SELECT user_id, event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n
      FROM events)
WHERE n = 1
""")
def latest_per_key(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    latest = latest_per(events, ["user_id", "event_type"], "ts", "event_id")
    return latest.withColumn("ts", time_text("ts"))


@query("""
WITH m AS (
  SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month,
         sum(CAST(round(o_totalprice * 100) AS BIGINT))::DOUBLE / 100.0::DOUBLE AS total
  FROM orders GROUP BY 1, 2)
SELECT o_custkey, month, total,
       total / nullif(lag(total, 1) OVER w, 0) - 1 AS change_1,
       total / nullif(lag(total, 2) OVER w, 0) - 1 AS change_2,
       total / nullif(lag(total, 3) OVER w, 0) - 1 AS change_3
FROM m WINDOW w AS (PARTITION BY o_custkey ORDER BY month)
""")
def price_change_123(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    months = orders.groupBy("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        exact_sum("o_totalprice").alias("total")
    )
    periods = {"change_1": 1, "change_2": 2, "change_3": 3}
    return pct_change(months, ["o_custkey"], "month", "total", periods)


@query("""
WITH d AS (
  SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS day, count(*)::DOUBLE AS n FROM orders GROUP BY 1, 2)
SELECT a.o_orderpriority, strftime(a.day, '%Y-%m-%d') AS day, a.n,
       a.n / b.n - 1 AS last_week, a.n / c.n - 1 AS last_year
FROM d a
LEFT JOIN d b ON a.o_orderpriority = b.o_orderpriority AND b.day = a.day - 7
LEFT JOIN d c ON a.o_orderpriority = c.o_orderpriority AND c.day = a.day - 364
""")
def change_against_dates(spark, sf_dir):
    days = table(spark, sf_dir, "orders").groupBy(
        "o_orderpriority", F.to_date("o_orderdate").alias("day")
    ).agg(F.count(F.lit(1)).cast("double").alias("n"))
    out = change_by_date(days, ["o_orderpriority"], "day", "n", {"last_week": 7, "last_year": 364})
    return out.withColumn("day", day_text("day"))


@query("""
WITH d AS (
  SELECT event_type, CAST(ts AS DATE) AS day, sum(CAST(round(value * 100) AS BIGINT)) AS s, count(*) AS n
  FROM events GROUP BY 1, 2)
SELECT a.event_type, strftime(a.day, '%Y-%m-%d') AS day, sum(b.s)::DOUBLE / sum(b.n)::DOUBLE / 100.0::DOUBLE AS mean_30d
FROM d a JOIN d b ON a.event_type = b.event_type AND b.day BETWEEN a.day - 29 AND a.day
GROUP BY a.event_type, a.day
""")
def trailing_30d_mean(spark, sf_dir):
    days = table(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.sum(fixed("value")).alias("s"), F.count(F.lit(1)).alias("n")
    )
    out = trailing_mean(days, ["event_type"], "day", "s", "n", 30, "mean")
    return out.select("event_type", day_text("day").alias("day"), (F.col("mean") / 100.0).alias("mean_30d"))


@query("""
SELECT event_type, strftime(CAST(ts + INTERVAL 12 HOUR AS DATE), '%Y-%m-%d') AS day, count(*) AS n,
       sum(CAST(round(value * 100) AS BIGINT))::DOUBLE / (count(*)::DOUBLE * 100) AS mean, max(value) AS max
FROM events GROUP BY 1, 2
""")
def noon_window(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.groupBy("event_type", day_text(noon_day(F.col("ts"))).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), exact_mean("value").alias("mean"), F.max("value").alias("max")
    )


@query("""
SELECT conv_id, turn, role, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) - 1 AS position
FROM conversations
""")
def position_in_group(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return with_position(turns, "role", ["conv_id", "turn"])


@query("""
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) + 1000 AS uid FROM orders
""")
def surrogate_ids(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return assign_ids(orders, [By("o_orderdate", True), "o_orderkey"], 1000).select("o_orderkey", "uid")


@query("""
WITH k AS (SELECT DISTINCT s_nationkey, s_suppkey FROM supplier),
c AS (SELECT s_nationkey, s_suppkey,
             CAST(floor((row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1) / 3) AS BIGINT) AS chunk
      FROM k)
SELECT s_nationkey, chunk, count(*) AS n_keys, string_agg(CAST(s_suppkey AS VARCHAR), ',' ORDER BY s_suppkey) AS keys
FROM c GROUP BY 1, 2
""")
def key_chunks(spark, sf_dir):
    return chunk_keys(table(spark, sf_dir, "supplier"), "s_nationkey", "s_suppkey", 3)
