"""Whole plans, with the test tables in the place of feeds."""

from pyspark.sql import functions as F

from ..functions.keys import uid_md5
from ..operators.clean import rename
from ..plans import areas, countries, events, grids, prices, stations
from ..schemas import schema
from .gridded import EVENT_CELLS_SQL
from .joining import AREA_SQL, _areas, _places
from .registry import day_text, query, table, time_text


@query(AREA_SQL.replace("SELECT area, event_type, count(*) AS n FROM j GROUP BY 1, 2", "") + """
SELECT n_name || kind AS area, coalesce(riots, 0) AS riots, coalesce(battles, 0) AS battles, coalesce(total, 0) AS total
FROM nation CROSS JOIN (SELECT unnest(['-box', '-triangle']) AS kind)
LEFT JOIN (SELECT area, count(*) FILTER (event_type = 'click') AS riots, count(*) FILTER (event_type = 'view') AS battles, count(*) AS total
           FROM j WHERE event_type IN ('click', 'view') GROUP BY area) c ON n_name || kind = c.area
WHERE n_regionkey <> 3
""")
def district_conflicts(spark, sf_dir):
    """Events as conflicts in the areas of four regions; every event comes twice."""
    nation = table(spark, sf_dir, "nation")
    shapes = _areas(nation).withColumnRenamed("area", "objectid")
    region = nation.select("n_name", F.col("n_regionkey").alias("gid_0"))
    districts = shapes.withColumn("n_name", F.split_part("objectid", F.lit("-"), F.lit(1))).join(region, "n_name")
    kinds = F.when(F.col("event_type") == "click", "Riots").when(F.col("event_type") == "view", "Battles")
    found = rename(_places(table(spark, sf_dir, "events")), {"lon": "longitude", "lat": "latitude", "event_id": "event_id_cnty"})
    found = found.withColumn("event_type", kinds).filter("event_type is not null")
    coverage = table(spark, sf_dir, "region").filter("r_regionkey <> 3").select(F.col("r_regionkey").alias("gid_0"))
    out = areas.conflict_by_district(found.unionByName(found), districts, coverage, tile=5.0)
    return out.select(F.col("objectid").alias("area"), "riots", "battles", "total")


@query(f"""
WITH c AS (SELECT e.*, hour(ts) AS h FROM ({EVENT_CELLS_SQL}) e JOIN events USING (event_id)),
ok AS (SELECT var, day FROM c GROUP BY var, day HAVING count(DISTINCT h) >= 20)
SELECT var, strftime(day, '%Y-%m-%d') AS day, row, col,
       CASE var WHEN 'O3' THEN max(v)::DOUBLE * 1000000000.0::DOUBLE WHEN 'NO2' THEN sum(v)::DOUBLE / count(*) * 1000000000.0::DOUBLE
       ELSE sum(v)::DOUBLE / count(*) * 1.0::DOUBLE END AS value
FROM c JOIN ok USING (var, day) GROUP BY var, day, row, col
""")
def daily_air_quality_grids(spark, sf_dir):
    """Cells of days with at least 20 hours of a variable."""
    var = F.when(F.col("event_type") == "click", "NO2").when(F.col("event_type") == "view", "O3").otherwise("PM25_RH35_GCC")
    cells = table(spark, sf_dir, "events").select(
        var.alias("var"), "ts", (F.col("user_id") % 4).cast("int").alias("row"), (F.col("user_id") % 3).cast("int").alias("col"),
        F.round(F.col("value") * 100).cast("bigint").alias("value"),
    )
    out = grids.daily_air_quality(cells, 20, F.hour("ts"))
    return out.select("var", day_text("date").alias("day"), "row", "col", "value")


@query("""
WITH d AS (SELECT o_custkey AS node, CAST(o_orderdate AS DATE) AS day, avg(floor(o_totalprice)) FILTER (o_orderstatus <> 'P') AS pml,
                  avg(floor(o_totalprice)) FILTER (o_orderstatus = 'P') AS losses FROM orders GROUP BY 1, 2),
w AS (SELECT *, pml / nullif(lag(pml) OVER (PARTITION BY node ORDER BY day), 0) - 1 AS change,
             round(avg(pml) OVER (PARTITION BY day), 6) AS syst FROM d)
SELECT node, c_name AS name, pml, losses, change, syst FROM w JOIN customer ON c_custkey = node WHERE day = DATE '1998-10-03'
""")
def node_price_table(spark, sf_dir):
    """Customers as nodes, order values as hourly prices, for one day."""
    hourly = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("node_id"), F.col("o_orderdate").alias("ts"),
        F.floor("o_totalprice").cast("double").alias("value"), "o_orderstatus",
    )
    measures = {"pml": hourly.filter("o_orderstatus <> 'P'"), "losses": hourly.filter("o_orderstatus = 'P'")}
    nodes = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("node_id"), F.col("c_name").alias("name"))
    out = prices.node_prices(measures, nodes, "1998-10-03")
    return out.select(
        F.col("node_id").alias("node"), "name", "pml", "losses", F.col("last_week_pct_change").alias("change"),
        F.round("pml_syst_avg", 6).alias("syst"),
    )


@query("""
WITH a AS (SELECT n_name AS name, CAST(year(o_orderdate) AS INTEGER) AS year, count(*)::DOUBLE AS v FROM orders
           JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderstatus = 'F' GROUP BY 1, 2),
b AS (SELECT n_name AS name, CAST(year(l_shipdate) AS INTEGER) AS year, count(*)::DOUBLE AS v FROM lineitem
      JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2)
SELECT 'C' || n_nationkey AS country_code, name AS country_name, year, year || '-01-01 00:00:00.000000' AS datetime,
       a.v AS finished, b.v AS shipped, CASE WHEN a.v IS NOT NULL THEN 'orders' END AS unit1, CASE WHEN b.v IS NOT NULL THEN 'S.2' END AS code2
FROM a FULL JOIN b USING (name, year) JOIN nation ON n_name = name WHERE n_nationkey < 20
""")
def country_indicators(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))

    def yearly(df, key, date):
        named = df.join(nation, F.col(key) == F.col("n_nationkey"))
        return named.groupBy(F.col("n_name").alias("country_name"), F.year(date).alias("year")).agg(
            F.count(F.lit(1)).cast("double").alias("value")
        )

    codes = nation.select(
        F.col("n_name").alias("name"),
        F.when(F.col("n_nationkey") < 20, F.concat(F.lit("C"), F.col("n_nationkey").cast("string"))).alias("country_code"),
    )
    frames = [
        (yearly(orders, "c_nationkey", "o_orderdate"), "orders", "S.1"),
        (yearly(lines, "s_nationkey", "l_shipdate"), "lines", "S.2"),
    ]
    out = countries.indicators(frames, codes)
    return out.select(
        "country_code", "country_name", "year", time_text("datetime").alias("datetime"),
        F.col("indicator_value_1").alias("finished"), F.col("indicator_value_2").alias("shipped"), "unit1",
        F.col("indicator_code2").alias("code2"),
    )


QUAKE_SQL = """
SELECT *, CAST((user_id * 7) % 90 AS DOUBLE) || '_' || CAST((user_id * 11) % 180 AS DOUBLE) || '_' || CAST(user_id % 9 AS DOUBLE)
       || '_' || strftime(ts, '%Y-%m-%d %H:%M:%S') AS uid FROM events
"""


@query(f"""
SELECT uid, any_value(strftime(ts, '%Y-%m-%d %H:%M:%S')) AS at, any_value(CAST(user_id % 9 AS DOUBLE)) AS depth FROM ({QUAKE_SQL})
WHERE uid NOT IN (SELECT uid FROM ({QUAKE_SQL}) WHERE ts < TIMESTAMP '2024-01-15') GROUP BY uid
""")
def new_earthquakes(spark, sf_dir):
    """Events as earthquakes; those before the middle of January are stored."""
    user = F.col("user_id")
    place = F.array(
        ((user * 11) % 180).cast("double"), ((user * 7) % 90).cast("double"), (user % 9).cast("double")
    )
    feed = table(spark, sf_dir, "events").select(
        F.lit("feed").alias("file"), F.col("event_id").alias("position"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("time"), F.col("value").alias("mag"),
        F.col("event_type").alias("place"), user.alias("sig"),
        F.struct(F.lit("Point").alias("type"), place.alias("coordinates")).alias("geometry"),
    )
    middle = F.unix_millis(F.lit("2024-01-15").cast("timestamp"))
    empty = spark.createDataFrame([], schema("earthquakes"))
    stored = events.earthquakes(feed.filter(F.col("time") < middle), empty, "2024-02-01", history=True)
    new = events.earthquakes(feed, stored, "2024-02-01", history=True)
    return new.select("uid", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("at"), F.col("depth_in_km").alias("depth"))


@query("""
WITH r AS (SELECT *, 'L' || user_id || '_' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS k FROM events),
m AS (SELECT event_type, max(ts) AS high FROM events WHERE ts < TIMESTAMP '2024-01-12' GROUP BY 1)
SELECT md5(k) AS uid, max(CASE WHEN r.event_type = 'view' THEN value / 46.0::DOUBLE * 22.414::DOUBLE * 1.0::DOUBLE * 1.0::DOUBLE / 1000.0::DOUBLE
       ELSE value END) AS ppm
FROM r JOIN m ON r.event_type = m.event_type
WHERE ts >= TIMESTAMP '2024-01-10' AND date_trunc('second', ts) < TIMESTAMP '2024-01-20' AND date_trunc('second', ts) > high AND value >= 0
GROUP BY k HAVING count(*) = 1
""")
def new_sensor_readings(spark, sf_dir):
    """Events as readings of a slice of days; readings up to the twelfth are stored."""
    source = table(spark, sf_dir, "events")
    parameter = F.when(F.col("event_type") == "view", "no2").otherwise(F.col("event_type"))
    feed = source.select(
        F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("utc")).alias("date"),
        parameter.alias("parameter"), "value", F.lit("µg/m³").alias("unit"),
        F.concat(F.lit("L"), F.col("user_id").cast("string")).alias("location"), F.lit("c").alias("city"),
        F.lit("x").alias("country"),
        F.struct(F.lit(1.0).alias("longitude"), F.lit(2.0).alias("latitude")).alias("coordinates"),
        F.lit("a").alias("attribution"),
    )
    stored = source.filter(F.col("ts") < F.lit("2024-01-12").cast("timestamp_ntz")).select(
        uid_md5(F.concat(F.lit("L"), "user_id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("_UID"), parameter.alias("parameter"), F.col("ts").alias("utc")
    )
    new = stations.sensor_readings(feed, stored, "2024-01-10", "2024-01-20")
    return new.select(F.col("_UID").alias("uid"), "ppm")
