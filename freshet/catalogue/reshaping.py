"""Wide and long forms, and list columns."""

from pyspark.sql import functions as F

from ..functions.units import exact_sum
from ..operators.reshape import (
    explode_members,
    flatten_lists,
    pivot_hours,
    split_cell,
    unpivot_hours,
    unpivot_mean,
)
from .registry import day_text, query, table, time_text

HOURLY_SQL = """
SELECT event_type, CAST(ts AS DATE) AS day, CAST(hour(ts) + 1 AS INTEGER) AS h,
       sum(CAST(round(value * 100) AS BIGINT))::DOUBLE / 100 AS v FROM events GROUP BY 1, 2, 3
"""


def _wide(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_type", F.to_date("ts").alias("day"), (F.hour("ts") + 1).alias("h"), "value"
    )
    hours = events.groupBy("event_type", "day", "h").agg(exact_sum("value").alias("v"))
    return pivot_hours(hours, ["event_type", "day"], "h", "v")


@query(f"""
SELECT event_type, strftime(day, '%Y-%m-%d') AS day,
       {", ".join(f"coalesce(max(v) FILTER (h = {h}), 0)::DOUBLE AS H{h}" for h in range(1, 25))}
FROM ({HOURLY_SQL}) GROUP BY event_type, day
""")
def hour_pivot(spark, sf_dir):
    wide = _wide(spark, sf_dir)
    return wide.select(
        "event_type", day_text("day").alias("day"), *[F.col(f"H{h}").cast("double").alias(f"H{h}") for h in range(1, 25)]
    )


@query(f"""
WITH d AS (SELECT DISTINCT event_type, day FROM ({HOURLY_SQL})), h AS (SELECT CAST(unnest(range(1, 25)) AS INTEGER) AS h)
SELECT d.event_type, strftime(d.day + INTERVAL 1 HOUR * h.h, '%Y-%m-%d %H:%M:%S.%f') AS ts, coalesce(v, 0)::DOUBLE AS value
FROM d CROSS JOIN h LEFT JOIN ({HOURLY_SQL}) x ON x.event_type = d.event_type AND x.day = d.day AND x.h = h.h
""")
def hour_unpivot(spark, sf_dir):
    long = unpivot_hours(_wide(spark, sf_dir), ["event_type"], "day")
    return long.select("event_type", time_text("ts").alias("ts"), F.col("value").cast("double").alias("value"))


@query(f"""
SELECT event_type, strftime(day, '%Y-%m-%d') AS day, round(sum(v) / 24, 8) AS mean FROM ({HOURLY_SQL}) GROUP BY event_type, day
""")
def hour_unpivot_mean(spark, sf_dir):
    out = unpivot_mean(_wide(spark, sf_dir), ["event_type", "day"], name="mean")
    return out.select("event_type", day_text("day").alias("day"), F.round("mean", 8).alias("mean"))


@query("""
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY 1
""")
def members_as_rows(spark, sf_dir):
    words = table(spark, sf_dir, "part").select("p_partkey", F.split("p_name", " ").alias("words"))
    return explode_members(words, "words", "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT s_suppkey, CAST(position AS INTEGER) AS position, trim(id) AS id, trim(unit) AS unit FROM (
  SELECT s_suppkey, unnest([0, 1]) AS position, unnest(string_split(s_suppkey || '; ' || s_nationkey, ';')) AS id,
         unnest(string_split('key;nation', ';')) AS unit FROM supplier)
""")
def config_cells(spark, sf_dir):
    ids = F.concat(F.col("s_suppkey").cast("string"), F.lit("; "), F.col("s_nationkey").cast("string"))
    cells = table(spark, sf_dir, "supplier").select("s_suppkey", ids.alias("id"), F.lit("key;nation").alias("unit"))
    return split_cell(cells, ["id", "unit"])


@query("""
SELECT letter, count(*) AS n FROM (
  SELECT unnest(string_split(w, '')) AS letter FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part))
WHERE letter <> '' GROUP BY 1
""")
def lists_of_lists(spark, sf_dir):
    nested = F.transform(F.split("p_name", " "), lambda w: F.split(w, ""))
    letters = flatten_lists(table(spark, sf_dir, "part").select(nested.alias("letters")), "letters", "letter")
    return letters.filter("letter <> ''").groupBy("letter").agg(F.count(F.lit(1)).alias("n"))
