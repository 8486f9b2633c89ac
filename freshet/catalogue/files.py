"""Readers, on files that Spark writes from the tables."""

from pyspark.sql import functions as F

from ..runtime import shared_dir
from ..sinks.outputs import export_csv
from ..sources import archives, documents, paged, tables, text
from .registry import day_text, query, table


@query("""
SELECT l_returnflag, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty FROM lineitem GROUP BY 1
""")
def csv_export_and_scan(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    path = shared_dir(spark, "csv")
    export_csv(lineitem, path)
    rows = text.read_delimited(spark, path, lineitem.schema, ["l_returnflag", "l_quantity"])
    return rows.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("qty")
    )


@query("""
SELECT o_orderstatus AS file_id, count(*) AS n, max(o_orderkey) AS newest FROM orders GROUP BY 1
""")
def tsv_with_file_id(spark, sf_dir):
    """The folder name stands in for the file's id."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    path = shared_dir(spark, "tsv")
    orders.write.option("header", True).option("sep", "\t").partitionBy("o_orderstatus").csv(path)
    rows = text.read_tsv_with_file_id(spark, f"{path}/o_orderstatus=*", "o_orderkey bigint, o_custkey bigint")
    named = rows.select("o_orderkey", F.regexp_extract(F.input_file_name(), "o_orderstatus=([A-Z])", 1).alias("folder"), "file_id")
    return named.filter(F.col("file_id").startswith("part-")).groupBy(F.col("folder").alias("file_id")).agg(
        F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("newest")
    )


@query("""
SELECT count(*) AS lines, 0::BIGINT AS misplaced, (count(*) FILTER (n >= 1)) - 0 AS below_first
FROM (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n FROM documents)
""")
def numbered_text_lines(spark, sf_dir):
    """Lines of files with their number; each line says what its number should be."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    path = shared_dir(spark, "lines")
    tagged = lines.select(F.concat_ws("|", "doc_id", "n", "line").alias("value"))
    tagged.write.text(path)
    numbered = text.numbered_lines(spark, path).withColumn("doc", F.split_part("value", F.lit("|"), F.lit(1)))
    numbered = numbered.withColumn("n", F.split_part("value", F.lit("|"), F.lit(2)).cast("bigint"))
    per_doc = numbered.groupBy("file", "doc").agg(
        F.count_distinct(F.col("line_no") - F.col("n")).alias("offsets"), F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("n") >= 1).alias("below"),
    )
    return per_doc.agg(
        F.sum("lines").alias("lines"), F.count_if(F.col("offsets") > 1).alias("misplaced"),
        F.sum("below").alias("below_first"),
    )


@query("""
SELECT o_custkey, count(*) AS n, max(o_orderkey) AS newest FROM orders GROUP BY 1
""")
def json_records(spark, sf_dir):
    """A document per 50 order numbers with the orders under ``data``."""
    record = F.struct(F.col("o_orderkey").alias("id"), F.struct("o_custkey").alias("fields"))
    docs = table(spark, sf_dir, "orders").groupBy(F.floor(F.col("o_orderkey") / 50).alias("k")).agg(
        F.collect_list(record).alias("data")
    )
    path = shared_dir(spark, "json")
    docs.select("data").write.json(path)
    rows = documents.read_json_records(
        spark, path, "id bigint, fields struct<o_custkey: bigint>", "data", multi_line=False
    )
    return rows.groupBy("fields.o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("newest"))


@query("""
SELECT user_id, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, CAST(max(n) AS INTEGER) AS last_position FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id // 50 ORDER BY event_id) - 1 AS n FROM events)
GROUP BY 1
""")
def geojson_features(spark, sf_dir):
    """A collection per 50 event numbers."""
    lon, lat = F.col("user_id").cast("double"), F.col("value")
    feature = F.struct(
        F.col("event_id"),
        F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("geometry"),
        F.struct("event_id", "user_id").alias("properties"),
    )
    collections = table(spark, sf_dir, "events").groupBy(F.floor(F.col("event_id") / 50).alias("k")).agg(
        F.sort_array(F.collect_list(feature)).alias("features")
    )
    path = shared_dir(spark, "geojson")
    collections.select("features").write.json(path)
    rows = documents.read_geojson(spark, path, "event_id bigint, user_id bigint", multi_line=False)
    same = rows.filter(F.get("geometry.coordinates", F.lit(0)) == F.col("user_id"))
    return same.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"), F.max("position").alias("last_position")
    )


@query("""
SELECT o_orderstatus, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS ids FROM orders GROUP BY 1
""")
def xml_records(spark, sf_dir):
    path = shared_dir(spark, "xml")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    orders.write.format("xml").option("rowTag", "item").option("rootTag", "channel").save(path)
    rows = documents.read_xml_records(spark, path, "item", "o_orderkey bigint, o_orderstatus string")
    return rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("ids"))


@query("""
SELECT lang, count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars FROM (
  SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE line <> '' GROUP BY 1
""")
def zip_members(spark, sf_dir):
    """Each text packed as a member of an archive inside an archive, then opened again."""
    docs = table(spark, sf_dir, "documents").select(F.concat("lang", F.lit("/"), "doc_id").alias("path"), "text")
    packed = archives.pack_texts(docs, "path", "text", nested=True)
    members = archives.expand_members(packed, suffix=".txt")
    lines = archives.member_lines(members)
    return lines.groupBy(F.split_part("archive", F.lit("/"), F.lit(1)).alias("lang")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.length("value")).alias("chars")
    )


@query("""
SELECT CAST(o_orderkey // 500 AS INTEGER) AS page, count(*) AS n, max(o_orderkey) AS newest FROM orders GROUP BY 1
""")
def paged_source(spark, sf_dir):
    """Pages of 500 orders, then an empty page that ends the source and one that is not to be read."""
    page = F.floor(F.col("o_orderkey") / 500).cast("int")
    orders = table(spark, sf_dir, "orders").select(page.alias("page"), F.struct(F.col("o_orderkey").alias("id")).alias("r"))
    body = F.to_json(F.struct(F.lit(1).alias("meta"), F.collect_list("r").alias("results")))
    pages = orders.groupBy("page").agg(body.alias("value"))
    last = table(spark, sf_dir, "orders").agg((F.floor(F.max("o_orderkey") / 500) + 1).cast("int").alias("page"))
    empty = last.select("page", F.lit('{"results": []}').alias("value"))
    beyond = last.select((F.col("page") + 1).alias("page"), F.lit('{"results": [{"id": -1}]}').alias("value"))
    path = shared_dir(spark, "pages")
    pages.unionByName(empty).unionByName(beyond).repartition("page").write.partitionBy("page").text(path)
    rows = paged.read_pages(spark, path, "id bigint", "results", page_pattern=r"page=(\d+)/.*\.txt$")
    return rows.groupBy("page").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("newest"))


@query("""
SELECT DISTINCT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS date,
       date_trunc('month', o_orderdate) = (SELECT date_trunc('month', max(o_orderdate)) FROM orders) AS newest FROM orders
""")
def dated_files(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("month"))
    path = shared_dir(spark, "dated")
    orders.repartition("month").write.partitionBy("month").parquet(path)
    files = tables.list_dated_files(spark, f"{path}/month=*", r"month=(\d{6})", "yyyyMM")
    newest = tables.newest_file(files).select("path", F.lit(True).alias("_newest"))
    return files.join(newest, "path", "left").select(
        day_text("date").alias("date"), F.coalesce("_newest", F.lit(False)).alias("newest")
    ).distinct()


@query("""
SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2 GROUP BY 1 ORDER BY 1
""")
def dimension_file_and_target(spark, sf_dir):
    """A configuration file joined to columns read back from a catalogue view."""
    path = shared_dir(spark, "dimension")
    nation = table(spark, sf_dir, "nation")
    nation.write.option("header", True).csv(path)
    dim = tables.read_dim(spark, path, nation.schema, "n_nationkey")
    table(spark, sf_dir, "customer").createOrReplaceTempView("freshet_customers")
    customers = tables.target_fields(spark, "freshet_customers", ["c_custkey", "c_nationkey"], "c_custkey is not null")
    joined = tables.scan_splits(customers, 4).join(dim, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.filter("n_regionkey = 2").groupBy("n_name").agg(F.count(F.lit(1)).alias("customers"))
