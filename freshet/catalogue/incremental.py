"""Loading only what is new, in batches and in streams; monitoring."""

from pyspark.sql import functions as F

from ..functions.units import exact_sum, fixed
from ..operators import monitor
from ..operators.windows import latest_per
from ..sinks.known_ids import KnownIds, insert_new_filtered
from ..sinks.targets import Target, upsert_rows
from ..runtime import durable, shared_dir
from ..streaming import incremental as inc
from ..streaming import streams
from .registry import day_text, query, table, time_text

MIDDLE = "2024-01-15 00:00:00"


def _halves(spark, sf_dir):
    """Events stored before the middle, and a feed that overlaps them by five days."""
    events = table(spark, sf_dir, "events")
    stored = events.filter(F.col("ts") < F.lit(MIDDLE).cast("timestamp_ntz"))
    feed = events.filter(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz"))
    return stored, feed


@query("""
SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-15'
""")
def insert_new_ids(spark, sf_dir):
    stored, feed = _halves(spark, sf_dir)
    twice = feed.unionByName(feed.filter("event_id % 2 = 0"))
    return inc.insert_if_new(twice, stored, "event_id", ["ts"]).select("event_id", "user_id")


@query("""
SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-15'
""")
def insert_new_ids_filtered(spark, sf_dir):
    """The same, with filters of the stored ids, one for each of two parts."""
    stored, feed = _halves(spark, sf_dir)
    known = KnownIds(spark, shared_dir(spark, "known"), "event_id", stored.count())
    known.add(stored.filter("event_type = 'view'"), "view")
    known.add(stored.filter("event_type <> 'view'"), "other")
    twice = feed.unionByName(feed.filter("event_id % 2 = 0"))
    return insert_new_filtered(twice, stored, known, ["ts"]).select("event_id", "user_id")


@query("""
WITH m AS (SELECT user_id, max(ts) AS high FROM events WHERE ts < TIMESTAMP '2024-01-15' AND event_type = 'view' GROUP BY 1)
SELECT event_id FROM events e LEFT JOIN m ON e.user_id = m.user_id
WHERE e.ts >= TIMESTAMP '2024-01-10' AND (high IS NULL OR e.ts > high)
""")
def late_rows_dropped(spark, sf_dir):
    stored, feed = _halves(spark, sf_dir)
    marks = inc.high_marks(stored.filter("event_type = 'view'"), "user_id", "ts")
    return inc.drop_late(feed, marks, "user_id", "ts").select("event_id")


@query("""
WITH k AS (SELECT user_id, max(ts) AS known FROM events WHERE ts < TIMESTAMP '2024-01-15' AND event_id % 3 = 0 GROUP BY 1)
SELECT event_id FROM events e LEFT JOIN k ON e.user_id = k.user_id WHERE known IS NULL OR ts > known
""")
def newest_until_known(spark, sf_dir):
    """Newest first, each station up to its first known id."""
    stored, _ = _halves(spark, sf_dir)
    events = table(spark, sf_dir, "events").withColumn("age", -F.unix_micros(F.col("ts").cast("timestamp")))
    known = stored.filter("event_id % 3 = 0").select("event_id")
    return inc.until_known(events, ["user_id"], ["age", "event_id"], known, "event_id", strict=True).select("event_id")


@query("""
SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-15' OR event_id % 3 <> 0
""")
def all_unknown(spark, sf_dir):
    stored, _ = _halves(spark, sf_dir)
    known = stored.filter("event_id % 3 = 0").select("event_id")
    events = table(spark, sf_dir, "events")
    return inc.until_known(events, ["user_id"], ["ts"], known, "event_id").select("event_id")


@query("""
WITH n AS (
  SELECT event_id, CAST(floor((epoch_us(TIMESTAMP '2024-02-01') - epoch_us(ts)) / 1000000 / (3 * 86400)) AS BIGINT) AS slice
  FROM events WHERE NOT (ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-20')),
s AS (SELECT DISTINCT slice FROM n),
g AS (SELECT min(slice + 1) AS stop FROM s WHERE slice + 1 NOT IN (SELECT slice FROM s))
SELECT slice, count(*) AS n FROM n WHERE slice < (SELECT stop FROM g) GROUP BY 1
""")
def backfill_in_slices(spark, sf_dir):
    """Three-day slices back from February, up to the stored stretch in January."""
    events = table(spark, sf_dir, "events")
    stored = events.filter(
        (F.col("ts") >= F.lit("2024-01-08").cast("timestamp_ntz"))
        & (F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    )
    new = inc.backfill_slices(events, stored, "ts", "event_id", ["ts"], 3, "2024-02-01")
    return new.groupBy("slice").agg(F.count(F.lit(1)).alias("n"))


def _customer_summary(orders):
    """Orders and newest status of each customer."""
    return orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), exact_sum("o_totalprice").alias("total"), F.min("o_orderdate").alias("oldest"),
        F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("o_orderstatus"),
    )


@query("""
WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-05-01'
           UNION SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '2001-05-01' GROUP BY 1 HAVING min(o_orderdate) < TIMESTAMP '1995-02-01'),
s AS (SELECT o_custkey, count(*) AS n, sum(CAST(round(o_totalprice * 100) AS BIGINT))::DOUBLE / 100 AS total,
             last(o_orderstatus ORDER BY o_orderdate, o_orderkey) AS status FROM orders
      WHERE o_custkey IN (SELECT o_custkey FROM a) OR o_orderdate < TIMESTAMP '2001-05-01' GROUP BY 1)
SELECT o_custkey, n, total, status FROM s
""")
def affected_recompute(spark, sf_dir):
    """Summaries of the customers with new orders or an expired look-back, put into the old summaries."""
    orders = table(spark, sf_dir, "orders")
    new = orders.filter(F.col("o_orderdate") >= F.lit("2001-05-01").cast("timestamp_ntz"))
    old = _customer_summary(orders.filter(F.col("o_orderdate") < F.lit("2001-05-01").cast("timestamp_ntz")))
    stale = inc.stale_keys(old, ["o_custkey"], "oldest", 75, "2001-05-01")
    affected = new.select("o_custkey").unionByName(stale).distinct()
    fresh = inc.recompute_affected(orders, affected, ["o_custkey"], _customer_summary)
    merged = upsert_rows(old, fresh, ["o_custkey"])
    return merged.select("o_custkey", "n", "total", F.col("o_orderstatus").alias("status"))


@query("""
SELECT event_id FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)
""")
def newest_run_only(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("run"))
    return inc.replace_run(events, "run").select("event_id")


@query("""
SELECT o_custkey, CASE WHEN max(o_orderdate) FILTER (o_orderstatus = 'F') IS NULL
  OR date_diff('day', max(o_orderdate) FILTER (o_orderstatus = 'F'), TIMESTAMP '2001-08-01') > 300 THEN 'full' ELSE 'incremental' END AS mode
FROM orders GROUP BY 1
""")
def load_modes(spark, sf_dir):
    finished = F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")))
    last = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(finished.alias("last"))
    return last.select("o_custkey", inc.load_mode(F.col("last"), "2001-08-01", 300).alias("mode"))


@query("""
WITH r AS (SELECT o_custkey AS id, max(o_orderdate) AS u, CASE o_custkey % 3 WHEN 0 THEN 'weekly' WHEN 1 THEN '6 months' ELSE 'annual' END AS f
           FROM orders GROUP BY 1),
a AS (SELECT id, date_diff('day', u, TIMESTAMP '2001-09-01') AS age,
             CASE WHEN id % 10 = 4 THEN 120 WHEN f = 'weekly' THEN 10 WHEN f = 'annual' THEN 410 ELSE 210 END AS allowed FROM r)
SELECT id AS dataset_id, age AS age_days, CAST(allowed AS INTEGER) AS allowed_days,
       CASE WHEN age > allowed AND id % 7 = 0 AND id % 2 = 0 THEN 'explained' WHEN age > allowed THEN 'outdated'
            WHEN id % 7 = 0 THEN 'recovered' ELSE 'ok' END AS status,
       id % 7 = 0 AND id % 5 = 0 AS recheck
FROM a
""")
def dataset_freshness(spark, sf_dir):
    """Customers as datasets that are updated by their newest order."""
    key = F.col("dataset_id")
    registry = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("dataset_id")).agg(
        F.max("o_orderdate").alias("last_updated")
    )
    registry = registry.withColumn(
        "frequency", F.when(key % 3 == 0, "Weekly").when(key % 3 == 1, "6 months").otherwise("annual ")
    ).withColumn("name", F.when(key % 10 == 4, "cli.041 ice").otherwise("other"))
    known = registry.filter(key % 7 == 0).select(
        "dataset_id",
        F.when(key % 5 == 0, "06/30/2001").otherwise("08/30/2001").alias("last_check"),
        F.when(key % 2 == 0, "source is down").alias("reason"),
    )
    return monitor.freshness(registry, known, "2001-09-01").drop("name")


@query("""
WITH n AS (SELECT o_custkey, max(o_orderdate) AS d FROM orders GROUP BY 1),
r AS (SELECT o_custkey, max(o_orderdate) AS d FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)
SELECT n.o_custkey, strftime(n.d, '%Y-%m-%d') AS latest, strftime(r.d, '%Y-%m-%d') AS recorded
FROM n LEFT JOIN r ON n.o_custkey = r.o_custkey WHERE n.d IS DISTINCT FROM r.d
""")
def registry_changes(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    latest = orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("latest"))
    recorded = orders.filter("o_orderstatus <> 'P'").groupBy("o_custkey").agg(F.max("o_orderdate").alias("recorded"))
    out = monitor.registry_updates(latest, recorded, "o_custkey", "latest", "recorded")
    return out.withColumns({c: day_text(c) for c in ("latest", "recorded")})


@query("""
WITH y AS (SELECT DISTINCT o_orderpriority AS dataset, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)
SELECT dataset, year, year || ' totals' AS title, 'orders' AS kind, year = max(year) OVER (PARTITION BY dataset) AS "default" FROM y
""")
def layer_rollout(spark, sf_dir):
    """A catalogue that ends in 1999 gets layers for the later years."""
    years = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("dataset"), F.year("o_orderdate").alias("year")
    ).distinct()
    years = durable(years, "years")
    catalog = years.filter("year <= 1999").withColumn(
        "title", F.concat(F.col("year").cast("string"), F.lit(" totals"))
    ).withColumn("kind", F.lit("orders"))
    return monitor.rollout_years(catalog, years, "dataset", "year", ["title"])


@query("""
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS d, row_number() OVER (ORDER BY CAST(o_orderdate AS DATE)) - 1 AS k
           FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-01'))
SELECT s_suppkey, coalesce(strftime(d, '%Y-%m-%d'), 'kept') AS shown FROM supplier LEFT JOIN d ON s_suppkey = k
""")
def dates_by_layer_order(spark, sf_dir):
    layers = table(spark, sf_dir, "supplier").select("s_suppkey", F.lit("kept").alias("shown"))
    run = table(spark, sf_dir, "orders").filter(
        F.col("o_orderdate") >= F.lit("2001-06-01").cast("timestamp_ntz")
    ).select(day_text("o_orderdate").alias("date"))
    return monitor.assign_by_order(layers, run, "s_suppkey")


def _stream(spark, sf_dir, name="events"):
    """A table as a file stream; the pattern keeps to the one table's files."""
    schema = table(spark, sf_dir, name).schema
    return streams.file_stream(spark, f"{sf_dir.rstrip('/')}/{name}*.parquet", schema)


@query("""
SELECT event_type, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events
""")
def stream_files(spark, sf_dir):
    """New files only: a second run over the same folder adds nothing."""
    schema = table(spark, sf_dir, "events").schema
    base = shared_dir(spark, "ingest")
    source = f"{sf_dir.rstrip('/')}/events*.parquet"
    for _ in range(2):
        streams.ingest_files(spark, source, schema, f"{base}/rows", f"{base}/checkpoint")
    rows = spark.read.schema(schema).parquet(f"{base}/rows")
    return rows.select("event_type", "user_id", time_text("ts").alias("ts"))


@query("""
SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-15'
""")
def stream_unseen(spark, sf_dir):
    """Stored ids are left out by the join, repeated ones by the stream's state."""
    stored, _ = _halves(spark, sf_dir)
    stream = _stream(spark, sf_dir).select("event_id", "ts")
    twice = stream.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    new = streams.unseen(twice, "ts", "event_id", "40 days", stored)
    return streams.run_to_frame(new, "unseen").select("event_id")


@query("""
WITH m AS (SELECT user_id, max(ts) AS high FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1)
SELECT event_id FROM events e LEFT JOIN m ON e.user_id = m.user_id WHERE high IS NULL OR e.ts > high
""")
def stream_late_rows(spark, sf_dir):
    stored, _ = _halves(spark, sf_dir)
    marks = inc.high_marks(stored, "user_id", "ts")
    stream = _stream(spark, sf_dir).select("event_id", "user_id", "ts")
    return streams.run_to_frame(streams.not_late(stream, marks, "user_id", "ts"), "late").select("event_id")


@query("""
SELECT strftime(CAST(ts + INTERVAL 12 HOUR AS DATE), '%Y-%m-%d') AS day, event_type, count(*) AS n,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS hundredths
FROM events GROUP BY 1, 2
HAVING CAST(CAST(any_value(ts) + INTERVAL 12 HOUR AS DATE) AS TIMESTAMP) + INTERVAL 12 HOUR <= (SELECT max(ts) - INTERVAL 2 DAY FROM events)
""")
def stream_noon_windows(spark, sf_dir):
    """Noon-to-noon windows that the watermark has closed."""
    out = streams.window_agg(
        _stream(spark, sf_dir), "ts", ["event_type"],
        [F.count(F.lit(1)).alias("n"), F.sum(fixed("value")).alias("hundredths")], "2 days",
    )
    rows = streams.run_to_frame(out, "windows")
    return rows.select(day_text("window_end").alias("day"), "event_type", "n", "hundredths")


@query("""
WITH w AS (SELECT CAST(unnest(generate_series(CAST(ts AS DATE) - 6, CAST(ts AS DATE), INTERVAL 1 DAY)) AS DATE) AS start, event_type, value FROM events)
SELECT strftime(start, '%Y-%m-%d') AS start, event_type, count(*) AS n, max(value) AS max FROM w GROUP BY 1, 2
HAVING CAST(any_value(start) + 7 AS TIMESTAMP) <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)
""")
def stream_sliding_windows(spark, sf_dir):
    out = streams.window_agg(
        _stream(spark, sf_dir), "ts", ["event_type"],
        [F.count(F.lit(1)).alias("n"), F.max("value").alias("max")], "1 day", "7 days", "1 day", "0 days",
    )
    rows = streams.run_to_frame(out, "sliding")
    return rows.select(day_text("window_start").alias("start"), "event_type", "n", "max")


@query("""
SELECT user_id, event_type, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events)
WHERE n = 1 AND ts >= TIMESTAMP '2024-01-10'
""")
def stream_upsert(spark, sf_dir):
    """Latest row per key kept in a target by upserts of each batch, trimmed by age."""
    cols = ["user_id", "event_type", "event_id", "ts"]
    stream = _stream(spark, sf_dir).select(*cols)
    base = shared_dir(spark, "upsert")
    target = Target(spark, f"{base}/rows", stream.schema, "event_id", "ts")
    streams.upsert_stream(
        stream, target, ["user_id", "event_type"], f"{base}/checkpoint",
        lambda batch: latest_per(batch.unionByName(target.read()), ["user_id", "event_type"], "ts", "event_id"),
        lambda rows: rows.filter(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz")),
    )
    return target.read().select("user_id", "event_type", "event_id")
