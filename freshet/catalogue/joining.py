"""Joins with dimensions, targets, calendars and areas."""

from pyspark.sql import functions as F

from ..functions.geometry import box, from_geojson, perimeter, point, polygon, to_geojson
from ..operators.clean import deny
from ..operators.joins import (
    asof_available,
    available_targets,
    expand_template,
    grow_dimension,
    join_chain,
    left_join,
    lookup,
    new_rows,
    outer_join_measures,
    right_join,
    rows_for_ids,
    semi_join,
)
from ..operators.spatial import count_in_areas, points_in_polygons, simplify
from .registry import day_text, query, table


@query("""
SELECT r_name, p_brand, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY 1, 2
""")
def dimension_join_chain(spark, sf_dir):
    facts = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity")
    joined = join_chain(
        facts,
        [
            (table(spark, sf_dir, "part"), "l_partkey", "p_partkey"),
            (table(spark, sf_dir, "supplier"), "l_suppkey", "s_suppkey"),
            (table(spark, sf_dir, "nation"), "s_nationkey", "n_nationkey"),
            (table(spark, sf_dir, "region"), "n_regionkey", "r_regionkey"),
        ],
    )
    return joined.groupBy("r_name", "p_brand").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("qty")
    )


@query("""
WITH f AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS finished FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2),
o AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS open FROM orders WHERE o_orderstatus = 'O' GROUP BY 1, 2),
p AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS pending FROM orders WHERE o_orderstatus = 'P' GROUP BY 1, 2)
SELECT o_custkey, year, finished, open, pending
FROM f FULL JOIN o USING (o_custkey, year) FULL JOIN p USING (o_custkey, year)
""")
def outer_measures(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    frames = [
        orders.filter(F.col("o_orderstatus") == status)
        .groupBy("o_custkey", "year")
        .agg(F.count(F.lit(1)).alias(name))
        for status, name in (("F", "finished"), ("O", "open"), ("P", "pending"))
    ]
    return outer_join_measures(frames, ["o_custkey", "year"])


@query("""
SELECT c_custkey, c_name, n_name, r_name FROM customer
JOIN nation ON c_nationkey = n_nationkey AND n_name NOT IN ('NATION_3', 'NATION_7')
LEFT JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA'
""")
def lookup_or_drop(spark, sf_dir):
    nations = deny(table(spark, sf_dir, "nation"), "n_name", ["NATION_3", "NATION_7"])
    regions = table(spark, sf_dir, "region").filter("r_name <> 'ASIA'")
    named = lookup(table(spark, sf_dir, "customer"), nations, "c_nationkey", "n_nationkey", "n_name", "drop")
    coded = lookup(named, nations, "c_nationkey", "n_nationkey", "n_regionkey")
    return lookup(coded, regions, "n_regionkey", "r_regionkey", "r_name").select(
        "c_custkey", "c_name", "n_name", "r_name"
    )


@query("""
SELECT c_custkey AS custkey, c_name, n FROM (
  SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1995-07-01' GROUP BY 1)
RIGHT JOIN customer ON o_custkey = c_custkey
""")
def all_members_right_join(spark, sf_dir):
    counts = (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderdate") < F.lit("1995-07-01").cast("timestamp_ntz"))
        .groupBy(F.col("o_custkey").alias("custkey"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    members = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    return right_join(counts, members, ["custkey"]).select("custkey", "c_name", "n")


@query("""
SELECT p_partkey, p_brand, n FROM part LEFT JOIN (
  SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON p_partkey = l_partkey
""")
def left_join_to_aggregate(spark, sf_dir):
    counts = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n")
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return left_join(part, counts, [("p_partkey", "l_partkey")])


@query("""
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (
  SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01')
""")
def new_rows_anti(spark, sf_dir):
    recent = table(spark, sf_dir, "orders").filter(
        F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return new_rows(customers, recent.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("""
SELECT o_orderkey FROM orders o WHERE NOT EXISTS (
  SELECT 1 FROM orders t WHERE t.o_orderpriority = '1-URGENT'
  AND t.o_custkey = o.o_custkey AND t.o_orderstatus = o.o_orderstatus)
""")
def new_rows_two_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    urgent = orders.filter("o_orderpriority = '1-URGENT'")
    return new_rows(orders, urgent, ["o_custkey", "o_orderstatus"]).select("o_orderkey")


@query("""
SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_custkey IN (
  SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE r_name = 'ASIA') GROUP BY 1
""")
def coverage_semi(spark, sf_dir):
    asia = table(spark, sf_dir, "region").filter("r_name = 'ASIA'")
    nations = semi_join(
        table(spark, sf_dir, "nation"), asia.select(F.col("r_regionkey").alias("n_regionkey")), "n_regionkey"
    )
    customers = semi_join(
        table(spark, sf_dir, "customer"), nations.select(F.col("n_nationkey").alias("c_nationkey")), "c_nationkey"
    )
    covered = semi_join(
        table(spark, sf_dir, "orders"), customers.select(F.col("c_custkey").alias("o_custkey")), "o_custkey"
    )
    return covered.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT doc_id, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)
""")
def full_rows_for_ids(spark, sf_dir):
    ids = table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id")
    return rows_for_ids(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), ids, "doc_id")


@query("""
SELECT p_partkey, p_brand FROM part WHERE p_size < 25
   OR p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-06-01')
""")
def dimension_growth(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    facts = table(spark, sf_dir, "lineitem").filter(
        F.col("l_shipdate") >= F.lit("2001-06-01").cast("timestamp_ntz")
    )
    grown = grow_dimension(
        facts.select(F.col("l_partkey").alias("p_partkey")), part.filter("p_size < 25"), part, "p_partkey"
    )
    return grown.select("p_partkey", "p_brand")


@query("""
WITH a AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS have FROM orders WHERE o_orderpriority = '1-URGENT'),
w AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS want FROM orders),
m AS (SELECT want, max(have) AS available FROM w JOIN a ON have BETWEEN want - 2 AND want GROUP BY 1)
SELECT o_orderkey, strftime(available, '%Y-%m-%d') AS available FROM orders LEFT JOIN m ON CAST(o_orderdate AS DATE) = want
""")
def newest_available_before(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    urgent = orders.filter("o_orderpriority = '1-URGENT'").select("day")
    out = asof_available(orders, urgent, "day", 2)
    return out.select("o_orderkey", day_text("available").alias("available"))


@query("""
SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day, user_id FROM events
WHERE event_type = 'view' AND (user_id, CAST(ts AS DATE)) IN (
  SELECT (user_id, CAST(ts AS DATE)) FROM events WHERE event_type = 'click')
""")
def requested_and_available(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", day_text("ts").alias("day"), "event_type")
    views, clicks = events.filter("event_type = 'view'"), events.filter("event_type = 'click'")
    return available_targets(views.select("day", "user_id").distinct(), clicks, ["day", "user_id"])


@query("""
WITH y AS (SELECT o_orderpriority AS dataset, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders GROUP BY 1, 2),
t AS (SELECT o_orderpriority AS dataset, min(o_orderkey) AS template FROM orders GROUP BY 1)
SELECT dataset, template, year FROM t JOIN y USING (dataset) WHERE year > 1998
""")
def templates_for_missing_years(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("dataset"), F.year("o_orderdate").alias("year"), "o_orderkey"
    )
    years = orders.filter("year > 1998").select("dataset", "year").distinct()
    templates = orders.groupBy("dataset").agg(F.min("o_orderkey").alias("template"))
    return expand_template(templates, years, "dataset").select("dataset", "template", "year")


def _areas(nation):
    """A rectangle and a triangle per nation, from its key."""
    x = F.pmod(F.col("n_nationkey") * 37, F.lit(90)).cast("double")
    y = F.pmod(F.col("n_nationkey") * 53, F.lit(90)).cast("double")
    corners = [(0.0, 0.0), (12.0, 0.0), (0.0, 12.0), (0.0, 0.0)]
    ring = F.array(*[F.array(x + a, y + b) for a, b in corners])
    boxes = nation.select(
        F.concat("n_name", F.lit("-box")).alias("area"), box(x, y, x + 7, y + 9).alias("geometry")
    )
    triangles = nation.select(
        F.concat("n_name", F.lit("-triangle")).alias("area"), polygon(F.array(ring)).alias("geometry")
    )
    return boxes.unionByName(triangles)


def _places(events):
    """Whole-degree places, so that many lie on borders."""
    lon = F.pmod(F.col("user_id") * 7 + F.col("event_id"), F.lit(100)).cast("double")
    lat = F.pmod(F.col("user_id") * 11 + F.col("event_id") * 3, F.lit(100)).cast("double")
    return events.select("event_id", "event_type", lon.alias("lon"), lat.alias("lat"))


AREA_SQL = """
WITH p AS (SELECT event_id, event_type, (user_id * 7 + event_id) % 100 AS lon, (user_id * 11 + event_id * 3) % 100 AS lat FROM events),
a AS (SELECT n_name, (n_nationkey * 37) % 90 AS x, (n_nationkey * 53) % 90 AS y FROM nation),
j AS (
  SELECT n_name || '-box' AS area, event_type FROM p JOIN a ON lon BETWEEN x AND x + 7 AND lat BETWEEN y AND y + 9
  UNION ALL
  SELECT n_name || '-triangle', event_type FROM p JOIN a ON lon >= x AND lat >= y AND (lon - x) + (lat - y) <= 12)
SELECT area, event_type, count(*) AS n FROM j GROUP BY 1, 2
"""


@query(AREA_SQL)
def events_in_areas(spark, sf_dir):
    pairs = points_in_polygons(
        _places(table(spark, sf_dir, "events")), _areas(table(spark, sf_dir, "nation")), tile=4.0
    )
    return count_in_areas(pairs, ["area", "event_type"])


@query("""
SELECT n_name || '-box' AS area, 32.0::DOUBLE AS perimeter, FALSE AS large FROM nation
UNION ALL SELECT n_name || '-triangle', round(24 + sqrt(288.0::DOUBLE), 8), TRUE FROM nation
""")
def area_perimeters(spark, sf_dir):
    around = F.round(perimeter(F.col("geometry")), 8)
    return _areas(table(spark, sf_dir, "nation")).select(
        "area", around.alias("perimeter"), (around > 35).alias("large")
    )


@query("""
SELECT event_id, '{"type":"Point","coordinates":[' || ((user_id * 7 + event_id) % 100) || '.0,'
  || ((user_id * 11 + event_id * 3) % 100) || '.0]}' AS geojson FROM events
""")
def points_as_geojson(spark, sf_dir):
    """Written as text, read back and written again."""
    places = _places(table(spark, sf_dir, "events"))
    texts = places.select("event_id", to_geojson(point(F.col("lon"), F.col("lat"))).alias("geojson"))
    return texts.select("event_id", to_geojson(from_geojson(F.col("geojson"))).alias("geojson"))


@query()
def simplified_outlines(spark, sf_dir):
    """Vectors as outlines; the distance test has no short SQL form."""
    outlines = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.array(
            F.transform("embedding", lambda v, i: F.array(i.cast("double"), v.cast("double")))
        ).alias("rings"),
    )
    thin = simplify(outlines, "rings", 0.1)
    return thin.select("vec_id", F.size(F.get("rings", F.lit(0))).alias("points"))
