"""Missing dates and set operations."""

from pyspark.sql import functions as F

from ..operators.calendars import (
    affected_keys,
    calendar,
    minus,
    missing_anniversaries,
    missing_dates,
    missing_per_group,
    missing_tail,
    union_all,
)
from .registry import day_text, query, table


def _days(df):
    return df.select(day_text("date").alias("date"))


@query("""
SELECT strftime(d, '%Y-%m-%d') AS date FROM (
  SELECT CAST(unnest(generate_series(DATE '2001-10-01' - 2499, DATE '2001-10-01', INTERVAL 1 DAY)) AS DATE) AS d)
WHERE d NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderpriority = '1-URGENT')
""")
def missing_days(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    return _days(missing_dates(urgent, "o_orderdate", "2001-10-01", 2500))


@query("""
SELECT strftime(d, '%Y-%m-%d') AS date FROM (
  SELECT CAST(unnest(generate_series(DATE '2001-12-01' - INTERVAL 83 MONTH, DATE '2001-12-01', INTERVAL 1 MONTH)) AS DATE) AS d)
WHERE d NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderpriority = '5-LOW')
""")
def missing_months(spark, sf_dir):
    low = table(spark, sf_dir, "orders").filter("o_orderpriority = '5-LOW'")
    return _days(missing_dates(low, "o_orderdate", "2001-12-01", 84, "1 month"))


@query("""
SELECT strftime(d, '%Y-%m-%d') AS date FROM (
  SELECT CAST(unnest(generate_series((SELECT CAST(max(o_orderdate) AS DATE) FROM orders) + 1, DATE '2001-09-15', INTERVAL 1 DAY)) AS DATE) AS d)
""")
def missing_days_at_end(spark, sf_dir):
    return _days(missing_tail(table(spark, sf_dir, "orders"), "o_orderdate", "2001-09-15", 400))


@query("""
SELECT strftime(d, '%Y-%m-%d') AS date FROM (
  SELECT CAST(unnest(generate_series(DATE '2001-10-01' - 2499, DATE '2001-10-01', INTERVAL 1 DAY)) AS DATE) AS d)
WHERE isodow(d) = 2 AND d NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'P')
""")
def weekday_gaps(spark, sf_dir):
    pending = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    return _days(missing_dates(pending, "o_orderdate", "2001-10-01", 2500, weekday=1))


@query("""
SELECT strftime(d, '%Y-%m-%d') AS date FROM (SELECT make_date(y, 9, 1) AS d FROM range(1979, 2003) t(y))
WHERE d NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)
""")
def anniversaries(spark, sf_dir):
    return _days(missing_anniversaries(table(spark, sf_dir, "orders"), "o_orderdate", 9, 1979, 2002))


@query("""
WITH h AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events),
w AS (SELECT user_id, CAST(unnest(generate_series(min(d), DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS d FROM h GROUP BY 1)
SELECT user_id, strftime(d, '%Y-%m-%d') AS date FROM w WHERE (user_id, d) NOT IN (SELECT (user_id, d) FROM h)
""")
def missing_days_per_station(spark, sf_dir):
    gaps = missing_per_group(table(spark, sf_dir, "events"), "user_id", "ts", "2024-01-30")
    return gaps.select("user_id", day_text("date").alias("date"))


@query("""
SELECT strftime(d, '%Y-%m-%d') AS date, count(o_orderkey) AS n FROM (
  SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '1996-12-31', INTERVAL 7 DAY)) AS DATE) AS d)
LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d GROUP BY d
""")
def weekly_calendar(spark, sf_dir):
    weeks = calendar(spark, "1995-01-01", "1996-12-31", "7 days")
    orders = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"), "o_orderkey")
    counts = weeks.join(orders, "date", "left").groupBy("date").agg(F.count("o_orderkey").alias("n"))
    return counts.withColumn("date", day_text("date"))


@query("""
SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'
EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
""")
def key_difference(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    pending = orders.filter("o_orderstatus = 'P' and o_orderpriority in ('1-URGENT', '2-HIGH')")
    return minus(orders.filter("o_orderstatus = 'F'"), pending, "o_custkey")


@query("""
SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-01'
UNION SELECT o_custkey FROM orders GROUP BY 1 HAVING min(o_orderdate) >= TIMESTAMP '1996-01-01'
""")
def new_and_stale_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    new = orders.filter(F.col("o_orderdate") >= F.lit("2001-07-01").cast("timestamp_ntz"))
    stale = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("oldest")).filter(
        F.col("oldest") >= F.lit("1996-01-01").cast("timestamp_ntz")
    )
    return affected_keys(new, stale, ["o_custkey"])


@query("""
SELECT source, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM (
  SELECT 'documents' AS source, doc_id AS id FROM documents UNION ALL SELECT 'pages', page_id FROM pages
  UNION ALL SELECT 'benchmark', item_id FROM benchmark) GROUP BY 1
""")
def union_of_batches(spark, sf_dir):
    frames = [
        table(spark, sf_dir, name).select(F.lit(name).alias("source"), F.col(key).alias("id"))
        for name, key in (("documents", "doc_id"), ("pages", "page_id"), ("benchmark", "item_id"))
    ]
    return union_all(frames).groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids")
    )
