"""Aggregates, text summaries, completeness and run metrics."""

from pyspark.sql import functions as F

from ..functions.text import after_first
from ..functions.units import classify, exact_mean, exact_sum
from ..operators.aggregates import (
    aggregate_roles,
    complete_dates,
    concat_by,
    count_by,
    dedupe,
    deviation_from_mean,
    distinct,
    first_occurrence,
    first_per,
    mean_first,
    most_recent,
    most_recent_ymd,
    pivot_counts,
    run_metrics,
    share_of_total,
    stats_by,
    summarize_alerts,
    uniformity,
    unique_sorted,
    usable_runs,
    usable_years,
)
from ..operators.clean import with_defaults
from ..operators.windows import latest_per
from ..operators.joins import new_rows
from ..operators.retention import keep_newest
from .registry import day_text, query, table, time_text

TYPES = ["click", "error", "purchase", "signup", "view"]


@query("""
WITH recent AS (
  SELECT * FROM events WHERE ts > (SELECT max(ts) - INTERVAL 10 DAY FROM events)),
latest AS (
  SELECT user_id, event_type, ts, value / 100 AS pewi
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM recent)
  WHERE n = 1),
lines AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_type) AS k,
         CASE WHEN pewi < 0.25 THEN 'Normal' WHEN pewi < 1 THEN 'Stress' WHEN pewi < 2 THEN 'Alert' ELSE 'Crisis' END AS level
  FROM latest)
SELECT user_id,
       string_agg('[' || k || '] ' || event_type || ' markets were at a ''' || lower(level) || ''' level as of '
                  || strftime(ts, '%Y-%m-%d'), ';' || chr(10) ORDER BY event_type) AS text,
       max(pewi) AS highest_pewi,
       CASE WHEN max(pewi) < 0.25 THEN 'Normal' WHEN max(pewi) < 1 THEN 'Stress' WHEN max(pewi) < 2 THEN 'Alert' ELSE 'Crisis' END AS highest_alps,
       strftime(min(ts), '%Y-%m-%d') AS oldest_interaction_date
FROM lines GROUP BY user_id
""")
def numbered_alerts(spark, sf_dir):
    events = table(spark, sf_dir, "events").drop("props")
    since = events.select(F.max("ts") - F.expr("INTERVAL 10 DAYS")).scalar()
    latest = latest_per(events, ["user_id", "event_type"], "ts", "event_id", F.col("ts") > since)
    latest = latest.withColumn("pewi", F.col("value") / 100)
    pieces = {
        "commodity": F.col("event_type"),
        "alps": F.lower(classify(F.col("pewi"))),
        "date": day_text("ts"),
    }
    out = summarize_alerts(latest, ["user_id"], F.col("pewi"), "ts", ["event_type"], pieces)
    return out.withColumn("oldest_interaction_date", day_text("oldest_interaction_date"))


@query("""
SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2
""")
def count_per_area_and_type(spark, sf_dir):
    return count_by(table(spark, sf_dir, "events"), ["user_id", "event_type"])


@query("""
SELECT c.c_custkey AS user_id, coalesce(click, 0) AS click, coalesce(error, 0) AS error, coalesce(purchase, 0) AS purchase,
       coalesce(signup, 0) AS signup, coalesce(view, 0) AS view, coalesce(total, 0) AS total, 0 AS riot
FROM customer c LEFT JOIN (
  SELECT user_id, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'error') AS error,
         count(*) FILTER (event_type = 'purchase') AS purchase, count(*) FILTER (event_type = 'signup') AS signup,
         count(*) FILTER (event_type = 'view') AS view, count(*) AS total
  FROM events GROUP BY user_id) e ON c.c_custkey = e.user_id
""")
def type_pivot_totals(spark, sf_dir):
    wide = pivot_counts(table(spark, sf_dir, "events"), "user_id", "event_type", TYPES)
    areas = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return with_defaults(areas.join(wide, "user_id", "left"), {**{t: 0 for t in TYPES}, "total": 0, "riot": 0})


@query("""
SELECT event_type, count(*) AS n, sum(CAST(round(value * 100) AS BIGINT))::DOUBLE / (count(*)::DOUBLE * 100) AS mean,
       min(value) AS min, max(value) AS max
FROM events GROUP BY 1
""")
def stats_per_group(spark, sf_dir):
    measures = {
        "n": F.count(F.lit(1)), "mean": exact_mean("value"), "min": F.min("value"), "max": F.max("value"),
    }
    return stats_by(table(spark, sf_dir, "events"), ["event_type"], measures)


@query("""
SELECT user_id, strftime(ts, '%Y-%m-%d') AS day,
       sum(CAST(round(value * 100) AS BIGINT))::DOUBLE / (count(*)::DOUBLE * 100) AS value,
       first(CASE WHEN event_type <> 'error' THEN event_type END ORDER BY CASE WHEN event_type <> 'error' THEN 0 ELSE 1 END, ts, event_id) AS kind
FROM events GROUP BY 1, 2
""")
def mean_and_first(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("day", day_text("ts"))
    events = events.withColumn("kind", F.when(F.col("event_type") != "error", F.col("event_type")))
    return mean_first(events, ["user_id", "day"], {"value": exact_mean("value")}, ["kind"], ["ts", "event_id"])


@query("""
SELECT o_orderkey, o_custkey, sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (PARTITION BY o_custkey)::DOUBLE / 100 AS total,
       o_totalprice / (sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (PARTITION BY o_custkey)::DOUBLE / 100) * 100 AS share
FROM orders
""")
def share_of_group_total(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    out = share_of_total(orders, ["o_custkey"], F.col("o_totalprice"), exact_sum("o_totalprice"))
    return out.drop("o_totalprice")


@query("""
WITH d AS (
  SELECT l_suppkey, l_returnflag, sum(CAST(l_quantity AS BIGINT))::DOUBLE AS qty FROM lineitem GROUP BY 1, 2),
m AS (SELECT l_returnflag, sum(CAST(qty AS BIGINT))::DOUBLE / count(*)::DOUBLE AS mean FROM d GROUP BY 1)
SELECT l_suppkey, l_returnflag, qty, mean, (qty - mean) / mean * 100 AS deviation FROM d JOIN m USING (l_returnflag)
""")
def deviation_from_group_mean(spark, sf_dir):
    totals = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(
        exact_sum("l_quantity", 0).alias("qty")
    )
    return deviation_from_mean(totals, ["l_returnflag"], F.col("qty"), exact_mean("qty", 0))


@query("""
SELECT user_id, event_type, event_id, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id DESC) AS n FROM events)
WHERE n = 1
""")
def dedupe_keep_last(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")
    return dedupe(events, ["user_id", "event_type"], ["value", "event_id"], "last")


@query("SELECT DISTINCT lang, source, n_chars FROM documents")
def distinct_rows(spark, sf_dir):
    return distinct(table(spark, sf_dir, "documents"), ["lang", "source", "n_chars"])


@query("""
SELECT md5(text) AS digest, min(doc_id) AS doc_id FROM documents GROUP BY text
""")
def first_unseen_text(spark, sf_dir):
    """Texts are compared by digest, so only digests are shuffled."""
    digests = table(spark, sf_dir, "documents").select(
        "doc_id", F.sha2("text", 256).alias("key"), F.md5("text").alias("digest")
    )
    return first_occurrence(digests, "key", ["doc_id"]).select("digest", "doc_id")


@query("""
SELECT conv_id, role, turn FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations) WHERE n = 1
""")
def first_turn(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "role", "turn")
    return first_per(turns, "conv_id", ["turn"])


@query("""
WITH f AS (
  SELECT cn.n_name AS origin, sn.n_name AS asylum, year(o_orderdate) AS y, month(o_orderdate) AS m,
         CASE WHEN l_linenumber = 7 THEN '*' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS v
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey),
r AS (SELECT origin AS country, 'origin' AS value_type, y, m, v FROM f UNION ALL SELECT asylum, 'asylum', y, m, v FROM f),
t AS (SELECT country, value_type, y, m, sum(coalesce(TRY_CAST(v AS DOUBLE), 0)) AS value,
             bool_or(TRY_CAST(v AS DOUBLE) IS NULL) AS some_stats_confidential
      FROM r GROUP BY ALL)
SELECT country || '_' || d || '_' || value_type AS uid, d AS date, country, value_type, value, some_stats_confidential
FROM (SELECT *, strftime(make_date(y, m, [31,28,31,30,31,30,31,31,30,31,30,31][m]), '%Y-%m-%d') AS d FROM t)
""")
def role_totals_unknown(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    orders = orders.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "o_orderkey", "o_orderdate", F.col("n_name").alias("origin")
    )
    supplier = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    supplier = supplier.select("s_suppkey", F.col("n_name").alias("asylum"))
    value = F.when(F.col("l_linenumber") == 7, "*").otherwise(F.col("l_quantity").cast("bigint").cast("string"))
    facts = (
        table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("origin", "asylum", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), value.alias("v"))
    )
    return aggregate_roles(facts, ["origin", "asylum"], "y", "m", "v").withColumn("date", day_text("date"))


@query("""
WITH s AS (
  SELECT c_nationkey, c_mktsegment, count(*) AS n, min(c_custkey) AS first_customer FROM customer GROUP BY 1, 2)
SELECT c_nationkey, string_agg(c_mktsegment || ' (' || n || ')', '; ' ORDER BY c_mktsegment) AS text,
       first(first_customer ORDER BY c_mktsegment) AS first_customer
FROM s GROUP BY 1
""")
def concat_per_country(spark, sf_dir):
    segments = table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.min("c_custkey").alias("first_customer")
    )
    name = F.concat(F.lit("Area: "), F.col("c_mktsegment"))
    text = F.concat(after_first(name, ": "), F.lit(" ("), F.col("n").cast("string"), F.lit(")"))
    return concat_by(segments, ["c_nationkey"], ["c_mktsegment"], text, firsts=["first_customer"])


@query("""
SELECT strftime(least(max(ts), TIMESTAMP '2024-01-20 00:00:00'), '%Y-%m-%d %H:%M:%S.%f') AS most_recent
FROM events WHERE event_type = 'view'
""")
def most_recent_time(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    out = most_recent(events, "ts", F.col("event_type") == "view", "2024-01-20 00:00:00")
    return out.select(time_text("most_recent").alias("most_recent"))


@query("""
SELECT strftime(max(CAST(o_orderdate AS DATE)), '%Y-%m-%d') AS most_recent FROM orders
WHERE day(o_orderdate) + 3 <= day(last_day(o_orderdate))
""")
def most_recent_of_parts(spark, sf_dir):
    parts = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), F.dayofmonth("o_orderdate").alias("d")
    )
    shifted = parts.withColumn("d", F.col("d") + 3)
    out = most_recent_ymd(shifted, "y", "m", "d")
    return out.select(day_text(F.date_sub("most_recent", 3)).alias("most_recent"))


@query("""
SELECT year, n_rows FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_rows FROM orders GROUP BY 1)
WHERE n_rows >= 1500 OR year >= 2001 - 3
""")
def years_with_enough_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    return usable_years(orders, "year", ["o_totalprice", "o_custkey"], 1500, 3, 2001)


@query("""
WITH v AS (SELECT CAST(ts AS DATE) AS day, event_type, count(DISTINCT hour(ts)) AS h FROM events GROUP BY 1, 2)
SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS n_vars FROM v WHERE h >= 20 GROUP BY day HAVING count(*) >= 5
""")
def dates_complete_for_all(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        day_text("ts").alias("day"), "event_type", F.hour("ts").alias("hour")
    )
    return complete_dates(events, ["day"], "event_type", 5, "hour", 20)


@query("""
SELECT user_id, count(*) AS n FROM events GROUP BY 1 HAVING count(*) = 66
UNION ALL SELECT -1 AS user_id, count(*) AS n FROM (SELECT user_id FROM events GROUP BY 1 HAVING count(*) >= 66)
""")
def runs_with_all_files(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    exact = usable_runs(events, ["user_id"], exactly=66)
    enough = usable_runs(events, ["user_id"], at_least=66).agg(F.count(F.lit(1)).alias("n"))
    return exact.unionByName(enough.select(F.lit(-1).cast("bigint").alias("user_id"), "n"))


@query("""
SELECT 'lang' AS name, count(DISTINCT lang) = 1 AS same FROM documents
UNION ALL SELECT 'size' AS name, count(DISTINCT len(embedding)) = 1 AS same FROM embeddings
""")
def uniform_metadata(spark, sf_dir):
    langs = uniformity(table(spark, sf_dir, "documents"), ["lang"])
    grids = table(spark, sf_dir, "embeddings").select(F.size("embedding").alias("size"))
    sizes = uniformity(grids, ["size"])
    return langs.select(F.lit("lang").alias("name"), F.col("lang").alias("same")).unionByName(
        sizes.select(F.lit("size").alias("name"), F.col("size").alias("same"))
    )


@query("""
SELECT (SELECT count(*) FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-15') AS existing_rows,
       count(*) FILTER (CAST(ts AS DATE) > DATE '2024-01-15') AS new_rows,
       count(*) FILTER (CAST(ts AS DATE) <= DATE '2024-01-15') AS known_rows
FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-10'
""")
def counts_of_a_run(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"))
    stored = events.filter(F.col("day") <= F.lit("2024-01-15").cast("date"))
    incoming = events.filter(F.col("day") >= F.lit("2024-01-10").cast("date"))
    return run_metrics(stored, incoming, "event_id")


@query("""
SELECT (SELECT count(*) FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-15') AS existing_rows,
       count(*) FILTER (CAST(ts AS DATE) > DATE '2024-01-15') AS new_rows,
       count(*) FILTER (CAST(ts AS DATE) <= DATE '2024-01-15' AND CAST(ts AS DATE) >= DATE '2024-01-10') AS known_rows,
       greatest(count(*) - 300, 0) AS dropped_rows
FROM events
""")
def counts_with_dropped(spark, sf_dir):
    """The same run with a row budget at its end."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", F.to_date("ts").alias("day"))
    stored = events.filter(F.col("day") <= F.lit("2024-01-15").cast("date"))
    incoming = events.filter(F.col("day") >= F.lit("2024-01-10").cast("date"))
    after = keep_newest(stored.unionByName(new_rows(incoming, stored, "event_id")), "ts", 300, "event_id")
    return run_metrics(stored, incoming, "event_id", after)


@query("SELECT DISTINCT p_type FROM part")
def names_in_order(spark, sf_dir):
    return unique_sorted(table(spark, sf_dir, "part"), "p_type")
