"""Cleaning, reject accounting and record repair."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import (
    allow,
    blank_to_null,
    coerce_numeric,
    coercion_losses,
    conform,
    deny,
    drop_columns,
    drop_empty_columns,
    drop_empty_rows,
    drop_sentinels,
    extract_paths,
    flatten_structs,
    max_age,
    nan_to_null,
    normalize_names,
    null_sentinels,
    rename,
    rename_all,
    require,
    split_by,
    stitch_records,
    time_slice,
    unify_headers,
    valid_date,
    where_text,
    with_constants,
    with_defaults,
    with_reject_counts,
)
from ..sources.text import parse_json_lines, split_whitespace
from .registry import day_text, query, table


@query("""
SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1
""")
def json_property_counts(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", F.concat("props", F.lit(",")).alias("props"))
    parsed = parse_json_lines(events, "props", "k bigint", strip_trailing_comma=True)
    return parsed.groupBy("record.k").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users")
    )


@query("""
SELECT count(*) FILTER (event_id % 7 = 0) AS bad_lines, count(*) FILTER (event_id % 7 <> 0) AS good_lines FROM events
""")
def json_bad_lines(spark, sf_dir):
    """Every seventh text is broken on purpose; all rows are parsed."""
    broken = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("{"), "props")).otherwise(F.col("props"))
    parsed = parse_json_lines(table(spark, sf_dir, "events").select(broken.alias("line")), "line", "k bigint")
    return parsed.agg(
        F.count_if("is_bad").alias("bad_lines"), F.count_if(~F.col("is_bad")).alias("good_lines")
    )


@query("""
SELECT p_partkey, split_part(p_name, ' ', 1) AS opening, replace(p_name, ' ', ', ') AS words,
       CASE WHEN p_size > 25 THEN split_part(p_name, ' ', 2) END AS second, p_brand AS brand
FROM part
""")
def nested_paths(spark, sf_dir):
    """Names as nested documents; the second branch is missing for small parts."""
    words = F.transform(F.split("p_name", " "), lambda w: F.struct(F.concat(w, F.lit("  ")).alias("text"), w.alias("plain")))
    branch = F.when(F.col("p_size") > 25, F.struct(F.struct(F.element_at(words, 2).alias("word")).alias("inner")))
    docs = table(spark, sf_dir, "part").select(
        "p_partkey", F.struct(words.alias("words"), branch.alias("branch"), F.struct("p_brand").alias("origin")).alias("doc")
    )
    return extract_paths(
        docs,
        {
            "p_partkey": ["p_partkey"],
            "opening": ["doc", "words", 0, "text"],
            "words": ["doc", "words", "*", "plain"],
            "second": ["doc", "branch", "inner", "word", "text"],
            "brand": ["doc", "origin", "p_brand"],
        },
    )


TOKENS = """
SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '--' WHEN 1 THEN 'ie' WHEN 2 THEN ' ' WHEN 3 THEN 'NA'
       ELSE CAST(p_size AS VARCHAR) END AS raw FROM part
"""


def _tokens(spark, sf_dir):
    key = F.col("p_partkey") % 5
    raw = (
        F.when(key == 0, "--").when(key == 1, "ie").when(key == 2, " ").when(key == 3, "NA")
        .otherwise(F.col("p_size").cast("string"))
    )
    return table(spark, sf_dir, "part").select("p_partkey", raw.alias("raw"))


@query(f"""
SELECT p_partkey, TRY_CAST(raw AS DOUBLE) AS value FROM ({TOKENS})
""")
def token_cleaning(spark, sf_dir):
    raw = blank_to_null(_tokens(spark, sf_dir), ["raw"])
    numbers = coerce_numeric(null_sentinels(raw, ["raw"]), ["raw"])
    return rename_all(numbers, ["p_partkey", "value"])


@query(f"""
SELECT count(*) FILTER (raw <> ' ' AND raw NOT IN ('--', 'ie', 'NA')) AS numbers,
       count(*) FILTER (TRY_CAST(raw AS DOUBLE) IS NULL) AS lost FROM ({TOKENS})
""")
def token_losses(spark, sf_dir):
    raw = _tokens(spark, sf_dir)
    lost = coercion_losses(raw, ["raw"]).select(F.lit(0).alias("numbers"), F.col("raw").alias("lost"))
    kept = drop_sentinels(blank_to_null(raw), "raw").agg(F.count(F.lit(1)).alias("numbers"))
    both = lost.unionByName(kept.select("numbers", F.lit(0).alias("lost")))
    return both.agg(F.sum("numbers").alias("numbers"), F.sum("lost").alias("lost"))


@query("""
SELECT vec_id, CASE WHEN embedding[1] < 0 THEN NULL ELSE CAST(embedding[1] AS DOUBLE) END AS first FROM embeddings
""")
def nan_as_null(spark, sf_dir):
    first = F.element_at("embedding", 1).cast("double")
    value = F.when(first < 0, F.lit(float("nan"))).otherwise(first)
    return nan_to_null(table(spark, sf_dir, "embeddings").select("vec_id", value.alias("first")))


REASONS = """
SELECT *, CASE WHEN event_id % 10 = 3 THEN 'no_coordinate' WHEN event_id % 10 = 5 THEN 'no_date'
  WHEN ts < TIMESTAMP '2024-01-08' THEN 'too_old' END AS reason FROM events
"""


@query(f"""
SELECT coalesce(reason, 'good') AS reason, count(*) AS n FROM ({REASONS}) GROUP BY 1
""")
def reject_counts(spark, sf_dir):
    key = F.col("event_id") % 10
    events = table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.when(key != 3, F.concat(F.lit("("), F.col("user_id").cast("string"), F.lit(", 1)"))).alias("place"),
        F.when(key == 5, "n.d.").otherwise(day_text("ts")).alias("date"),
    )
    rules = [
        ("no_coordinate", F.col("place").isNull()),
        ("no_date", F.try_to_timestamp("date", F.lit("yyyy-MM-dd")).isNull()),
        ("too_old", F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz")),
    ]
    good, rejects = with_reject_counts(events, rules)
    good = good.agg(F.count(F.lit(1)).alias("n")).select(F.lit("good").alias("reason"), "n")
    return good.unionByName(rejects.toDF("reason", "n"))


@query(f"""
SELECT event_id FROM ({REASONS}) WHERE reason IS NULL
""")
def reject_filters(spark, sf_dir):
    """The same rules as separate filters."""
    key = F.col("event_id") % 10
    events = table(spark, sf_dir, "events").select(
        "event_id", "ts", F.when(key != 3, F.col("user_id")).alias("place"),
        F.when(key == 5, "n.d.").otherwise(day_text("ts")).alias("date"),
    )
    dated = valid_date(require(events, ["place"]), "date", "yyyy-MM-dd")
    return max_age(dated, "ts", 23, "2024-01-31").select("event_id")


@query("""
SELECT event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-09'
AND value >= 20
""")
def half_open_time_slice(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("above", F.col("value") - 20)
    return time_slice(events, "ts", "2024-01-05 06:00:00", "2024-01-09", "above", ["user_id"]).select(
        "event_id", "value"
    )


@query("""
SELECT p_partkey, p_name, p_type FROM part
WHERE p_name LIKE '%ring' AND p_name NOT LIKE '%red%' AND starts_with(p_brand, 'Brand#1') AND p_type <> 'SMALL'
""")
def text_predicates(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    for col, op, value in (
        ("p_name", "endswith", "ring"), ("p_name", "not contains", "red"),
        ("p_brand", "startswith", "Brand#1"), ("p_type", "!=", "SMALL"), ("p_name", "like", "%ring"),
    ):
        part = where_text(part, col, op, value)
    return part.select("p_partkey", "p_name", "p_type")


@query("""
SELECT p_brand, count(*) AS n FROM part WHERE p_type IN ('SMALL', 'ECONOMY')
AND p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50) GROUP BY 1
""")
def allow_and_deny(spark, sf_dir):
    full = table(spark, sf_dir, "lineitem").filter("l_quantity = 50").select("l_partkey")
    part = deny(allow(table(spark, sf_dir, "part"), "p_type", ["SMALL", "ECONOMY"]), "p_partkey", full)
    return part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT c_custkey AS customer_id, c_name AS full_name, c_mktsegment AS region, CAST(c_nationkey AS BIGINT) AS nation,
       CAST(NULL AS DOUBLE) AS area, 'usd' AS unit, 0 AS rank FROM customer
""")
def conform_to_schema(spark, sf_dir):
    """Header synonyms, clean names, fixed columns and the declared order."""
    raw = rename(
        table(spark, sf_dir, "customer"),
        {"c_custkey": "Customer Id", "c_name": " Full/Name", "c_mktsegment": "Region of Incident"},
    )
    one = unify_headers(raw, {"Region": ["Region", "Region of Incident"]})
    clean = drop_columns(normalize_names(one), ["c_acctbal"])
    named = with_defaults(with_constants(rename(clean, {"c_nationkey": "nation"}), {"unit": "usd"}), {"rank": 0})
    schema = T.StructType(
        [
            T.StructField("customer_id", T.LongType()), T.StructField("full_name", T.StringType()),
            T.StructField("region", T.StringType()), T.StructField("nation", T.LongType()),
            T.StructField("area", T.DoubleType()), T.StructField("unit", T.StringType()),
            T.StructField("rank", T.IntegerType()),
        ]
    )
    return conform(named, schema)


@query("""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE (CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE 0 END) <> 0
""")
def empty_rows_and_columns(spark, sf_dir):
    finished = F.col("o_orderstatus") == "F"
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(finished, F.col("o_custkey")).otherwise(0).alias("o_custkey"),
        F.when(finished, F.col("o_totalprice")).alias("o_totalprice"),
        F.lit(None).cast("string").alias("never"),
        F.struct(F.lit(None).cast("string").alias("nothing")).alias("s"),
    )
    flat = drop_empty_columns(flatten_structs(orders, ["s"]))
    return drop_empty_rows(flat, ["o_custkey"])


@query("""
SELECT CASE WHEN p_size > 40 THEN 'large' ELSE 'other' END AS branch, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS sizes
FROM part GROUP BY 1
""")
def split_by_threshold(spark, sf_dir):
    large, other = split_by(table(spark, sf_dir, "part"), F.col("p_size") > 40)
    counted = [
        df.agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("sizes")).withColumn("branch", F.lit(name))
        for df, name in ((large, "large"), (other, "other"))
    ]
    return counted[0].unionByName(counted[1]).select("branch", "n", "sizes")


@query("""
SELECT count(*) AS n, CAST(sum(length(regexp_replace(line, '\\s+', '', 'g'))) AS BIGINT) AS letters
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE NOT starts_with(line, 'The') AND trim(regexp_replace(line, '\\s+', ' ', 'g')) <> ''
AND len(string_split(trim(regexp_replace(line, '\\s+', ' ', 'g')), ' ')) = 5
""")
def rows_of_five_fields(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("value"))
    rows = split_whitespace(lines, list("abcde"), header_prefix="The")
    return rows.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length(F.concat(*list("abcde")))).alias("letters")
    )


@query("""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS v, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n FROM documents),
m AS (SELECT *, max(CASE WHEN length(v) % 3 = 0 THEN n END) OVER (PARTITION BY doc_id ORDER BY n) AS first_line FROM l)
SELECT doc_id, CAST(first_line AS INTEGER) AS first_line, CAST(count(*) AS INTEGER) AS lines,
       md5(string_agg(v, ' ' ORDER BY n)) AS hash
FROM m WHERE first_line IS NOT NULL GROUP BY 1, 2
""")
def stitched_records(spark, sf_dir):
    """Lines of a text; one whose length is a multiple of three starts a record."""
    lines = table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "value")
    )
    start = F.length("value") % 3 == 0
    records = stitch_records(lines, start, "doc_id", block=20)
    return records.select("doc_id", "first_line", "lines", F.md5("value").alias("hash"))
