"""Streams whose state moves over several batches."""

from pyspark.sql import functions as F

from ..functions.units import fixed
from ..runtime import shared_dir
from ..sources import paged
from ..streaming import stateful, streams
from .registry import day_text, query, table


def _landed(spark, df, batch, label):
    """Rows landed as one file per batch, in the order of the batches; a stream of them, one file at a time."""
    base = shared_dir(spark, label)
    names = [c for c in df.columns if c != batch]
    for number in range(4):
        df.filter(F.col(batch) == number).select(*names).coalesce(1).write.mode("append").parquet(f"{base}/in")
    return base, streams.file_stream(spark, f"{base}/in", df.select(*names).schema, max_files=1)


def _week(ts):
    """Batch number of a time in January 2024: four stretches of eight days."""
    return F.least(F.lit(3), F.floor((F.dayofmonth(ts) - 1) / 8) + F.when(F.month(ts) > 1, 3).otherwise(0)).cast("int")


WEEK_SQL = "CAST(least(3, (day(ts) - 1) // 8 + CASE WHEN month(ts) > 1 THEN 3 ELSE 0 END) AS INTEGER)"


@query("""
WITH e AS (SELECT user_id, CAST(ts AS DATE) AS d, CAST(round(value * 100) AS BIGINT) AS v FROM events),
w AS (SELECT CAST(max(ts) - INTERVAL 1 DAY AS DATE) AS now FROM events)
SELECT user_id, count(*) AS n, CAST(sum(v) AS BIGINT) AS total, max(v) AS high, min(date_diff('day', DATE '1970-01-01', d)) AS oldest
FROM e, w WHERE d > now - 7 GROUP BY 1
""")
def stream_expired_lookback(spark, sf_dir):
    """Seven-day summaries per user; days end by the watermark, also for users without new rows."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", fixed("value").alias("v"), _week("ts").alias("batch"))
    base, stream = _landed(spark, events, "batch", "lookback")
    stateful.use_timers(spark)
    stateful.run_updates(stateful.look_back(stream, ["user_id"], "ts", "v", 7, "1 day"), f"{base}/out", f"{base}/checkpoint")
    updates = spark.read.parquet(f"{base}/out")
    return stateful.newest_version(updates, ["user_id"]).select("user_id", "n", "total", "high", "oldest")


@query(f"""
WITH f AS (SELECT {WEEK_SQL} AS batch, event_id, user_id, ts FROM events
  UNION ALL SELECT {WEEK_SQL} + 1, event_id + 1000000000, user_id, ts FROM events WHERE event_id % 5 = 0 AND {WEEK_SQL} < 3),
m AS (SELECT *, max(ts) OVER (PARTITION BY user_id ORDER BY batch RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM f)
SELECT event_id, batch FROM m WHERE high IS NULL OR ts > high
""")
def stream_moving_marks(spark, sf_dir):
    """Each batch brings late copies of the batch before; the marks move with what is added."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", _week("ts").alias("batch"))
    late = events.filter("event_id % 5 = 0 AND batch < 3").select(
        (F.col("event_id") + 1_000_000_000).alias("event_id"), "user_id", "ts", (F.col("batch") + 1).alias("batch")
    )
    base, stream = _landed(spark, events.unionByName(late), "batch", "marks")
    load = stateful.MarkedLoad(spark, base, stream.schema, "user_id", "ts")
    stateful.load_newer(stream, load, f"{base}/checkpoint")
    return load.rows().select("event_id", "batch")


def _runs_sql():
    steps = ["a_0 AS (SELECT DISTINCT * FROM f WHERE batch = 0)"]
    for k in range(1, 4):
        before = " UNION ALL ".join(f"SELECT * FROM a_{i}" for i in range(k))
        steps.append(f"""s_{k} AS (SELECT * FROM ({before}) QUALIFY run >= max(run) OVER (PARTITION BY kind) - 10),
o_{k} AS (SELECT kind, min(run) AS oldest FROM s_{k} GROUP BY 1),
a_{k} AS (SELECT DISTINCT f.* FROM f LEFT JOIN o_{k} USING (kind) WHERE batch = {k} AND (oldest IS NULL OR run >= oldest)
  AND id NOT IN (SELECT id FROM ({before})))""")
    return f"""
WITH e AS (SELECT {WEEK_SQL} AS batch, event_id, event_type AS kind, CAST(ts AS DATE) AS run FROM events),
f AS (SELECT batch, event_id AS id, kind, run FROM e
  UNION ALL SELECT batch + 1, event_id, kind, run FROM e WHERE event_id % 4 = 1 AND batch < 3
  UNION ALL SELECT batch + shift, event_id + shift * 1000000000, kind, run FROM e, (SELECT unnest([1, 2]) AS shift) WHERE event_id % 4 = 0 AND batch + shift < 4),
{", ".join(steps)}
SELECT id AS event_id, batch FROM ({" UNION ALL ".join(f"SELECT * FROM a_{i}" for i in range(4))})
"""


@query(_runs_sql())
def forecasts_after_oldest(spark, sf_dir):
    """Runs of the last ten days are kept; older ones that come again are cut off, known ids are left out."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.to_date("ts").alias("run"), _week("ts").alias("batch")
    )
    again = events.filter("id % 4 = 1 AND batch < 3").withColumn("batch", F.col("batch") + 1)
    late = events.filter("id % 4 = 0").withColumn("shift", F.explode(F.array(F.lit(1), F.lit(2)))).filter("batch + shift < 4").select(
        (F.col("id") + F.col("shift") * 1_000_000_000).alias("id"), "kind", "run", (F.col("batch") + F.col("shift")).alias("batch")
    )
    base, stream = _landed(spark, events.unionByName(again).unionByName(late), "batch", "runs")
    load = stateful.MarkedLoad(spark, base, stream.schema, "kind", "run")
    stateful.load_runs(stream, load, f"{base}/checkpoint", "id", 10)
    return load.rows().select(F.col("id").alias("event_id"), "batch")


@query("""
WITH d AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS day, count(*) AS n, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS total
           FROM orders GROUP BY 1, 2)
SELECT o_orderpriority, strftime(day, '%Y-%m-%d') AS day,
  CAST(sum(n) OVER w AS BIGINT) AS n, CAST(sum(total) OVER w AS BIGINT) AS total
FROM d WHERE day + 1 <= (SELECT max(o_orderdate) - INTERVAL 2 DAY FROM orders)
WINDOW w AS (PARTITION BY o_orderpriority ORDER BY day RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)
""")
def stream_trailing_month(spark, sf_dir):
    """Thirty-day counts and sums per priority and day, from one partial state per priority and day."""
    orders = table(spark, sf_dir, "orders")
    first, last = orders.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    part = F.floor(F.datediff("o_orderdate", F.lit(first)) * 4 / (F.datediff(F.lit(last), F.lit(first)) + 1)).cast("int")
    rows = orders.select("o_orderpriority", "o_orderdate", fixed("o_totalprice").alias("v"), part.alias("batch"))
    base, stream = _landed(spark, rows, "batch", "trailing")
    sums = stateful.trailing_stream(stream, base, f"{base}/checkpoint", ["o_orderpriority"], "o_orderdate", "v", 30, "2 days")
    return sums.select("o_orderpriority", day_text("day").alias("day"), "n", "total")


@query("""
SELECT CAST(dense_rank() OVER (ORDER BY o_orderkey // 500) - 1 AS INTEGER) AS page, count(*) AS n, max(o_orderkey) AS newest, count(*) FILTER (o_orderstatus = 'F') AS finished
FROM orders GROUP BY o_orderkey // 500
""")
def stream_pages(spark, sf_dir):
    """Pages land in two goes; the second run goes on where the first stopped."""
    orders = table(spark, sf_dir, "orders").withColumn("block", F.expr("o_orderkey div 500"))
    numbers = orders.select("block").distinct().withColumn("page", F.expr("count(1) OVER (ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"))
    record = F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    pages = orders.join(numbers, "block").groupBy("page").agg(F.to_json(F.collect_list(record)).alias("value"))
    pages = pages.withColumn("value", F.concat(F.lit('{"results":'), "value", F.lit("}")))
    base = shared_dir(spark, "pages")
    half = numbers.count() // 2
    for landed in (F.col("page") < half, F.col("page") >= half):
        pages.filter(landed).repartition("page").write.mode("append").partitionBy("page").text(f"{base}/in")
        stream = paged.stream_pages(spark, f"{base}/in", "id bigint, status string", "results", page_pattern=r"page=(\d+)/.*\.txt$")
        streams.run_available(stream, f"{base}/rows", f"{base}/checkpoint")
    rows = spark.read.schema(stream.schema).parquet(f"{base}/rows")
    return rows.groupBy("page").agg(
        F.count(F.lit(1)).alias("n"), F.max("id").alias("newest"), F.count_if(F.col("status") == "F").alias("finished")
    )
