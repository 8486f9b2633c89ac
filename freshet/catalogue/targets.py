"""Sinks: what a target holds after a sequence of changes."""

from pyspark.sql import functions as F

from ..operators.retention import keep_newest, keep_versions
from ..runtime import shared_dir
from ..sinks import outputs, targets
from ..sinks.partitioned import PartitionedTarget, remove_versions
from ..sinks.targets import Target, duplicates, patch_rows, upsert_rows
from .registry import query, table

SPLIT = "2000-01-01"


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")


def _since(date):
    return F.col("o_orderdate") >= F.lit(date).cast("timestamp_ntz")


def _target(spark, df, label):
    return Target(spark, shared_dir(spark, label), df.schema, "o_orderkey", "o_orderdate")


@query("""
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderkey % 2 = 0 THEN 'patched' ELSE o_orderstatus END AS status
FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_custkey % 10 <> 3 AND o_orderstatus || o_orderkey % 4 <> 'F1'
""")
def target_lifecycle(spark, sf_dir):
    """Create, append, insert new, patch, delete by condition, by id and by source, one after the other."""
    orders = _orders(spark, sf_dir)
    target = _target(spark, orders, "lifecycle")
    target.ensure()
    target.append(orders.filter(~_since(SPLIT)))
    target.insert_if_new(orders.filter(_since("1999-06-01")), ["o_orderdate"])
    patch = orders.filter(_since(SPLIT) & (F.col("o_orderkey") % 2 == 0))
    target.patch_columns(patch.withColumn("o_orderstatus", F.lit("patched")), ["o_orderstatus"])
    target.delete_where(~_since("1996-01-01"))
    target.delete_ids(orders.filter(F.col("o_custkey") % 10 == 3))
    target.delete_orphans(orders.filter(F.concat("o_orderstatus", (F.col("o_orderkey") % 4).cast("string")) != "F1"))
    return target.read().select("o_orderkey", F.col("o_orderstatus").alias("status"))


@query("""
SELECT o_orderkey, o_totalprice * CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 2 ELSE 1 END AS price FROM orders
""")
def target_upsert(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    target = _target(spark, orders, "target")
    target.reload(orders.filter(~_since("2001-01-01")))
    target.upsert(orders.filter(_since(SPLIT)).withColumn("o_totalprice", F.col("o_totalprice") * 2))
    return target.read().select("o_orderkey", F.col("o_totalprice").alias("price"))


@query("""
SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1000
""")
def target_trimmed(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    target = _target(spark, orders, "trim")
    target.replace(orders)
    target.trim(lambda rows: keep_newest(rows, "o_orderdate", 1000, "o_orderkey"))
    return target.read().select("o_orderkey")


@query("""
SELECT s_suppkey, s_acctbal * CASE WHEN s_suppkey % 3 = 0 THEN 10 ELSE 1 END AS s_acctbal, s_nationkey FROM supplier
""")
def patched_rows(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal", "s_nationkey")
    third = F.col("s_suppkey") % 3 == 0
    changed = supplier.filter(third).withColumn("s_acctbal", F.col("s_acctbal") * 10)
    with_gaps = changed.unionByName(supplier.filter("s_suppkey % 3 = 1").withColumn("s_acctbal", F.lit(None).cast("double")))
    return patch_rows(supplier, with_gaps, "s_suppkey", ["s_acctbal"])


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20)
  THEN 'ended' ELSE o_orderstatus END AS status FROM orders
""")
def last_records_refreshed(spark, sf_dir):
    """Only the last 20 records of the source change stored ones."""
    orders = _orders(spark, sf_dir)
    source = orders.withColumn("o_orderstatus", F.lit("ended"))
    out = patch_rows(orders, source, "o_orderkey", ["o_orderstatus"], 20, "o_orderdate")
    return out.select("o_orderkey", F.col("o_orderstatus").alias("status"))


@query("""
SELECT p_partkey, p_brand, CASE WHEN p_partkey % 4 = 0 THEN 'new' ELSE p_type END AS p_type FROM part
""")
def upserted_rows(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    fresh = part.filter("p_partkey % 4 = 0").withColumn("p_type", F.lit("new"))
    return upsert_rows(part.filter("p_partkey % 8 <> 0"), fresh, ["p_partkey"])


@query("""
SELECT event_type AS parameter, count(*) AS n, max(event_id) AS newest FROM events GROUP BY 1
""")
def routed_by_parameter(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumnRenamed("event_type", "parameter")
    path = shared_dir(spark, "routed")
    outputs.route(events, "parameter", path)
    return spark.read.parquet(path).groupBy("parameter").agg(
        F.count(F.lit(1)).alias("n"), F.max("event_id").alias("newest")
    )


@query("""
SELECT o_orderkey, CASE WHEN year(o_orderdate) = 2000 THEN 'again' ELSE o_orderstatus END AS status FROM orders
WHERE NOT (year(o_orderdate) = 1998)
""")
def partitions_replaced(spark, sf_dir):
    """A run's partition is replaced, other partitions stay, one collection is cleared."""
    orders = _orders(spark, sf_dir).select(
        "o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year")
    )
    path = shared_dir(spark, "partitions")
    outputs.overwrite_partitions(orders, path, ["year"])
    run = orders.filter("year = 2000").withColumn("o_orderstatus", F.lit("again"))
    outputs.overwrite_partitions(run, path, ["year"])
    rows = outputs.clear_collection(spark.read.parquet(path), "year", 1998)
    return rows.select("o_orderkey", F.col("o_orderstatus").alias("status"))


@query("""
SELECT o_orderkey, CASE WHEN year(o_orderdate) >= 2000 AND o_orderkey % 2 = 0 THEN 'again' ELSE o_orderstatus END AS status FROM orders
""")
def partitions_upserted(spark, sf_dir):
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year"))
    path = shared_dir(spark, "partitions")
    outputs.overwrite_partitions(orders.filter("year < 2001"), path, ["year"])
    fresh = orders.filter("year = 2001 or (year = 2000 and o_orderkey % 2 = 0)")
    changed = F.when(F.col("o_orderkey") % 2 == 0, "again").otherwise(F.col("o_orderstatus"))
    outputs.upsert_partitions(spark, path, fresh.withColumn("o_orderstatus", changed), ["o_orderkey", "year"], ["year"])
    return spark.read.parquet(path).select("o_orderkey", F.col("o_orderstatus").alias("status"))


@query("""
WITH s AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year, CASE WHEN year(o_orderdate) = 2000 AND o_orderkey % 2 = 0 THEN 'patched'
  WHEN year(o_orderdate) = 1999 THEN 'again' ELSE o_orderstatus END AS status FROM orders
  WHERE year(o_orderdate) NOT IN (1995, 1996) AND NOT (year(o_orderdate) = 1997 AND o_custkey % 10 = 3)
    AND NOT (year(o_orderdate) = 1998 AND o_orderkey % 4 = 1))
SELECT year, o_orderkey, status FROM s ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 6000
""")
def partitioned_target(spark, sf_dir):
    """Upsert, patch, delete by condition, id and source, and a row budget, each on the partitions it touches."""
    orders = _orders(spark, sf_dir).withColumn("year", F.year("o_orderdate"))
    target = PartitionedTarget(spark, shared_dir(spark, "partitioned"), orders.schema, "year", "o_orderkey")
    target.append(orders.filter("year <> 1999"))
    target.upsert(orders.filter("year = 1999").withColumn("o_orderstatus", F.lit("again")), moves=False)
    target.patch_columns(orders.filter("year = 2000 AND o_orderkey % 2 = 0").withColumn("o_orderstatus", F.lit("patched")), ["o_orderstatus"])
    target.delete_where(F.col("year") < 1997)
    target.delete_ids(orders.filter("year = 1997 AND o_custkey % 10 = 3"))
    target.delete_orphans(orders.filter("NOT (year = 1998 AND o_orderkey % 4 = 1)"))
    target.keep_newest("o_orderdate", 6000, "o_orderkey")
    return target.read().select("year", "o_orderkey", F.col("o_orderstatus").alias("status"))


@query("""
SELECT CAST(year(o_orderdate) AS VARCHAR) AS version, count(*) AS n FROM orders WHERE year(o_orderdate) IN (1995, 2000, 2001) GROUP BY 1
""")
def versions_removed(spark, sf_dir):
    """Version folders but the newest two and an exempt one are deleted."""
    orders = _orders(spark, sf_dir).withColumn("v", F.concat(F.lit("y"), F.year("o_orderdate").cast("string")))
    path = shared_dir(spark, "versions")
    orders.filter("v < 'y2001'").write.partitionBy("v").parquet(path)
    outputs.write_version(orders.filter("v = 'y2001'").drop("v"), path, "y2001")
    remove_versions(spark, path, 2, ["y1995"])
    return spark.read.parquet(path).groupBy(F.substring("v", 2, 4).alias("version")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT CAST(year(o_orderdate) AS VARCHAR) AS version, count(*) AS n FROM orders WHERE year(o_orderdate) IN (1995, 2000, 2001) GROUP BY 1
""")
def versions_kept(spark, sf_dir):
    """A version per year from one partitioned write; the newest two and an exempt one are kept."""
    orders = _orders(spark, sf_dir).withColumn("v", F.concat(F.lit("y"), F.year("o_orderdate").cast("string")))
    path = shared_dir(spark, "versions")
    orders.filter("v < 'y2001'").write.partitionBy("v").parquet(path)
    outputs.write_version(orders.filter("v = 'y2001'").drop("v"), path, "y2001")
    kept = keep_versions(spark.read.parquet(path), "v", 2, ["y1995"])
    return kept.groupBy(F.substring("v", 2, 4).alias("version")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT l_orderkey AS id, count(*) AS n_rows FROM lineitem WHERE l_linenumber = 1 GROUP BY 1 HAVING count(*) > 1
""")
def duplicate_ids(spark, sf_dir):
    first = table(spark, sf_dir, "lineitem").filter("l_linenumber = 1").select(F.col("l_orderkey").alias("id"))
    return duplicates(first, "id")


@query("""
SELECT 'appended' AS step, count(*) AS n, TRUE AS listed FROM region
UNION ALL SELECT 'replaced', count(*), TRUE FROM nation
UNION ALL SELECT 'truncated', 0, TRUE
UNION ALL SELECT 'dropped', NULL, FALSE
""")
def table_housekeeping(spark, sf_dir):
    """A catalogue table created, appended to, replaced, truncated and dropped; rows and listing after each step."""
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    base = shared_dir(spark, "housekeeping")
    space = "housekeeping_" + base[-12:]
    spark.sql(f"CREATE DATABASE {space} LOCATION '{base}'")
    name, steps = f"{space}.areas", []

    def note(step):
        there = targets.table_exists(spark, name)
        listed = "areas" in [t.name for t in spark.catalog.listTables(space)]
        steps.append((step, spark.table(name).count() if there else None, there and listed))

    targets.ensure_table(spark, name, region.schema, "r_regionkey")
    targets.append_table(region, name)
    note("appended")
    targets.replace_table(nation, name)
    note("replaced")
    targets.truncate_table(spark, name)
    note("truncated")
    targets.drop_table(spark, name)
    note("dropped")
    spark.sql(f"DROP DATABASE {space} CASCADE")
    return spark.createDataFrame(steps, "step string, n bigint, listed boolean")
