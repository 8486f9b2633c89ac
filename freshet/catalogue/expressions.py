"""Keys, dates, text, units and geometry expressions on whole tables."""

from pyspark.sql import functions as F

from ..functions import dates, geometry, keys, text, units
from ..sources.web import html_links, html_table_rows, html_tables as table_rows, link_status
from .registry import day_text, query, table, time_text


@query("""
SELECT event_id, event_type || '_' || user_id AS plain, md5(event_type || '_' || user_id || '_' || event_id) AS hashed,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id || '_x' END AS with_null,
       CASE WHEN event_id % 5 = 0 THEN 'None' ELSE CAST(user_id AS VARCHAR) END || '_x' AS null_printed,
       strftime(ts, '%Y%m%dT%H') || '_' || strftime(ts + INTERVAL 6 HOUR, '%Y%m%dT%H') || '_' || user_id AS forecast,
       event_type || '_' || replace(strftime(ts, '%Y_%m_%d %H_%M_%S'), ' ', '_') AS storm,
       lpad(CAST(user_id AS VARCHAR), CAST(greatest(2, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0') AS padded
FROM events
""")
def composite_keys(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    user = F.when(F.col("event_id") % 5 != 0, F.col("user_id"))
    later = F.col("ts") + F.expr("INTERVAL 6 HOURS")
    return events.select(
        "event_id",
        keys.uid("event_type", "user_id").alias("plain"),
        keys.uid_md5("event_type", "user_id", "event_id").alias("hashed"),
        keys.uid(user, F.lit("x")).alias("with_null"),
        keys.uid(user, F.lit("x"), null_text="None").alias("null_printed"),
        keys.forecast_uid(F.col("ts"), later, F.col("user_id")).alias("forecast"),
        keys.storm_uid(F.col("event_type"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("storm"),
        keys.zfill(F.col("user_id"), 2).alias("padded"),
    )


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS date_part, right(o_orderpriority, 3) AS tail,
       strftime(o_orderdate, '%Y-%m-%d') AS from_name
FROM orders
""")
def key_parts(spark, sf_dir):
    name = keys.uid("o_orderpriority", F.date_format("o_orderdate", "yyyyMMdd"), "o_orderkey")
    orders = table(spark, sf_dir, "orders").withColumn("name", name)
    return orders.select(
        "o_orderkey",
        keys.part(F.col("name"), "_", 2).alias("date_part"),
        F.right("o_orderpriority", F.lit(3)).alias("tail"),
        day_text(keys.date_in_name(F.col("name"), r"_(\d{8})_", "yyyyMMdd")).alias("from_name"),
    )


@query("""
SELECT o_orderkey, strftime(o_orderdate - INTERVAL 30 DAY, '%B %d, %Y') || ' - ' || strftime(o_orderdate, '%B %d, %Y') AS days,
       strftime(o_orderdate, '%B %Y') || ' - ' || strftime(o_orderdate + INTERVAL 2 MONTH, '%B %Y') AS months,
       strftime(o_orderdate - INTERVAL 6 HOUR, '%B %d, %Y %H:%M') || ' - ' || strftime(o_orderdate, '%B %d, %Y %H:%M') AS hours,
       'Data of ' || year(o_orderdate) AS title, 'layer ' || o_orderstatus || ' of ' || year(o_orderdate) AS filled
FROM orders
""")
def period_labels(spark, sf_dir):
    date = F.col("o_orderdate")
    year = F.year(date).cast("string")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.range_label(date, 30).alias("days"),
        dates.month_range_label(date, 3).alias("months"),
        dates.hour_range_label(date, 6).alias("hours"),
        text.roll_text(F.lit("Data of 1990"), "1990", year).alias("title"),
        text.fill_template(
            F.lit("layer {status} of {year}"), {"status": F.col("o_orderstatus"), "year": year}
        ).alias("filled"),
    )


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%G0%V') AS week_key,
       strftime(CAST(date_trunc('week', o_orderdate) AS DATE) + 2, '%Y-%m-%d') AS wednesday
FROM orders
""")
def iso_weeks(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("key", dates.iso_week_key(F.to_date("o_orderdate")))
    return orders.select(
        "o_orderkey", F.col("key").alias("week_key"), day_text(dates.iso_week_date(F.col("key"), 3)).alias("wednesday")
    )


@query("""
SELECT o_orderkey, strftime(make_timestamp(year(o_orderdate), 1, 1, 0, 0, 0.0::DOUBLE)
    + to_seconds(CAST(floor((o_custkey % 8) / 8.0::DOUBLE * 86400 * (make_date(year(o_orderdate) + 1, 1, 1) - make_date(year(o_orderdate), 1, 1))) AS BIGINT)),
    '%Y-%m-%d %H:%M:%S') AS ts
FROM orders
""")
def decimal_years(spark, sf_dir):
    value = F.year("o_orderdate") + (F.col("o_custkey") % 8) / F.lit(8.0)
    ts = dates.from_decimal_year(value.cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("ts"))


@query("""
SELECT event_id, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS start,
       CASE WHEN user_id >= 24 THEN (user_id // 24) || CASE WHEN user_id < 48 THEN ' day, ' ELSE ' days, ' END ELSE '' END
       || (user_id % 24) || ':30:00' AS duration
FROM events
""")
def day_of_year_times(spark, sf_dir):
    start = dates.from_day_of_year(F.date_format("ts", "yyyyDDD HHmm"))
    end = start + F.make_dt_interval(F.lit(0), F.col("user_id").cast("int"), F.lit(30))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format(start, "yyyy-MM-dd HH:mm:ss").alias("start"),
        dates.duration_text(start, end).alias("duration"),
    )


@query("""
SELECT event_id, strftime(to_timestamp(epoch_us(ts) // 1000000) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS seconds,
       strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%d %H:%M:%S.%f') AS millis,
       CASE WHEN user_id % 2 = 0 THEN '1970-01-01 00:00:00' ELSE strftime(to_timestamp(user_id) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') END AS filled,
       strftime(DATE '1800-01-01' + CAST(floor(value) AS INTEGER), '%Y-%m-%d') AS cf
FROM events
""")
def epochs_and_offsets(spark, sf_dir):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    odd = F.when(F.col("user_id") % 2 == 1, F.col("user_id"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format(dates.from_epoch(F.floor(millis / 1000)), "yyyy-MM-dd HH:mm:ss").alias("seconds"),
        time_text(dates.from_epoch(millis, "ms")).alias("millis"),
        F.date_format(dates.from_epoch(odd, zero_fill=True), "yyyy-MM-dd HH:mm:ss").alias("filled"),
        day_text(dates.cf_time(F.col("value"), F.lit("days since 1800-01-01 00:00"))).alias("cf"),
    )


@query("""
SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS first_day, strftime(last_day(o_orderdate), '%Y-%m-%d') AS last_day,
       strftime(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH + INTERVAL 14 DAY, '%Y-%m-%d') AS mid_next,
       strftime(o_orderdate + INTERVAL 4 MONTH, '%Y-%m-%d') AS four_on,
       strftime(make_date(year(o_orderdate), month(o_orderdate), [31,28,31,30,31,30,31,31,30,31,30,31][month(o_orderdate)]), '%Y-%m-%d') AS end_365,
       year(o_orderdate) || '-01-01' AS year_start, year(o_orderdate) || '-12-31' AS year_end,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE year(o_orderdate) || '-01-01' END AS start_or_null
FROM orders
""")
def month_windows(spark, sf_dir):
    date = F.to_date("o_orderdate")
    year = F.year(date)
    first, last = dates.month_bounds(date)
    or_zero = F.when(F.col("o_orderstatus") != "P", year).otherwise(0)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        day_text(first).alias("first_day"), day_text(last).alias("last_day"),
        day_text(dates.mid_next_month(date)).alias("mid_next"),
        day_text(dates.step_forward(date, 4)).alias("four_on"),
        day_text(dates.month_end_365(year, F.month(date))).alias("end_365"),
        day_text(dates.year_start(year)).alias("year_start"), day_text(dates.year_end(year)).alias("year_end"),
        day_text(dates.year_start(or_zero)).alias("start_or_null"),
    )


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN strftime(d + INTERVAL 4 MONTH, '%Y-%m-%d') ELSE strftime(d, '%Y-%m-%d') END AS valid_from,
       CASE o_orderstatus WHEN 'F' THEN strftime(d, '%Y-%m-%d') WHEN 'P' THEN strftime(d + INTERVAL 4 MONTH, '%Y-%m-%d')
       ELSE strftime(d + INTERVAL 8 MONTH, '%Y-%m-%d') END AS valid_to,
       CASE WHEN d > DATE '2000-01-01' THEN '1990' || CASE WHEN strftime(d, '-%m-%d') = '-02-29' THEN '-02-28' ELSE strftime(d, '-%m-%d') END
       ELSE strftime(d, '%Y-%m-%d') END AS repaired,
       strftime(d - 7, '%Y-%m-%d') AS last_week,
       strftime(m + CAST((dayofweek(d) - dayofweek(m) + 7) % 7 AS INTEGER), '%Y-%m-%d') AS last_month,
       strftime(y + CAST((dayofweek(d) - dayofweek(y) + 7) % 7 AS INTEGER), '%Y-%m-%d') AS last_year
FROM (SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS d, CAST(o_orderdate - INTERVAL 1 MONTH AS DATE) AS m,
             CAST(o_orderdate - INTERVAL 12 MONTH AS DATE) AS y FROM orders)
""")
def validity_and_comparison_dates(spark, sf_dir):
    date = F.to_date("o_orderdate")
    kind = F.element_at(
        F.create_map(*[F.lit(x) for x in ("F", "CS", "P", "ML1", "O", "ML2")]), F.col("o_orderstatus")
    )
    start, end = dates.scenario_interval(kind, date)
    compare = dates.comparison_dates(date)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", day_text(start).alias("valid_from"), day_text(end).alias("valid_to"),
        day_text(dates.repair_future(date, F.lit(1990), "2000-01-01")).alias("repaired"),
        *[day_text(compare[n]).alias(n) for n in ("last_week", "last_month", "last_year")],
    )


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS slashed, strftime(o_orderdate + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS feed,
       strftime(o_orderdate, '%Y-%m-%d') AS parts, strftime(o_orderdate + INTERVAL 5 DAY, '%Y-%m-%d') AS last_lead,
       strftime(o_orderdate + INTERVAL 1 HOUR * o_custkey, '%Y-%m-%d %H:%M:%S') AS lead_hour,
       CAST(isodow(o_orderdate) - 1 AS INTEGER) AS weekday
FROM orders
""")
def parsed_times(spark, sf_dir):
    date = F.col("o_orderdate")
    mixed = F.when(F.col("o_orderstatus") == "F", F.date_format(date, "MM/dd/yyyy")).otherwise(
        F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    feed = F.concat(F.date_format(date, "E"), F.lit(", "), F.date_format(date, "dd MMM yyyy HH:mm:ss"), F.lit(" -0200"))
    pieces = [F.date_format(date, f) for f in ("yyyy", "M", "d")]
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        day_text(dates.parse_ts(mixed, "MM/dd/yyyy", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("slashed"),
        F.date_format(dates.parse_rfc822(feed), "yyyy-MM-dd HH:mm:ss").alias("feed"),
        day_text(dates.date_from_parts(*pieces)).alias("parts"),
        day_text(F.element_at(dates.lead_dates(date, 5), -1)).alias("last_lead"),
        F.date_format(dates.lead_hour(date, F.col("o_custkey")), "yyyy-MM-dd HH:mm:ss").alias("lead_hour"),
        dates.date_parts(date)["weekday"].alias("weekday"),
    )


@query("""
SELECT event_id, CASE event_type WHEN 'view' THEN value / 1.88::DOUBLE WHEN 'click' THEN value / 1.96::DOUBLE END AS ppb,
       CASE WHEN event_type = 'view' AND user_id % 2 = 0
            THEN value / 46.0::DOUBLE * 22.414::DOUBLE * 1.0::DOUBLE * 1.0::DOUBLE / 1000.0::DOUBLE ELSE value END AS ppm,
       CASE WHEN value < 0.25 THEN 'Normal' WHEN value < 1 THEN 'Stress' WHEN value < 2 THEN 'Alert' ELSE 'Crisis' END AS level,
       CASE WHEN value * 10 BETWEEN 0 AND 500 THEN '0-500' WHEN value * 10 BETWEEN 501 AND 1000 THEN '501-1000'
            WHEN value * 10 BETWEEN 1001 AND 1500 THEN '1001-1500' WHEN value * 10 BETWEEN 1501 AND 2000 THEN '1501-2000'
            WHEN value * 10 BETWEEN 2001 AND 20000 THEN '>2000' END AS price_bin
FROM events
""")
def units_and_classes(spark, sf_dir):
    gas = F.when(F.col("event_type") == "view", "no2").when(F.col("event_type") == "click", "o3")
    unit = F.when(F.col("user_id") % 2 == 0, "µg/m³").otherwise("ppm")
    nitrogen = F.when(F.col("event_type") == "view", "no2").otherwise("bc")
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id",
        units.ugm3_to_ppb(gas, value).alias("ppb"),
        units.ugm3_to_ppm(nitrogen, unit, value).alias("ppm"),
        units.classify(value).alias("level"),
        units.bin_ranges(value * 10).alias("price_bin"),
    )


@query("""
SELECT p_partkey, round_even(p_retailprice / 1000000 * 1000000.0::DOUBLE, 1) AS scaled FROM part
""")
def scaled_and_rounded(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", units.scale_round(F.col("p_retailprice") / 1000000, 1e6, 1).alias("scaled")
    )


@query("""
SELECT p_partkey, replace(p_name, ' ', '') AS squeezed,
       upper(left(split_part(p_name, ' ', 1), 1)) || substr(split_part(p_name, ' ', 1), 2) || '-' ||
       upper(left(split_part(p_name, ' ', 2), 1)) || substr(split_part(p_name, ' ', 2), 2) AS titled,
       split_part(p_name, ' ', 1) AS name, split_part(p_name, ' ', 2) AS place, p_type AS after,
       'about ' || p_name AS description, p_brand AS source,
       CAST(p_partkey % 90 AS DOUBLE) AS lat, CAST(p_size AS DOUBLE) AS lon,
       CASE WHEN p_size > 25 THEN 'True' ELSE 'False' END AS flag, p_size > 25 AS back,
       replace(p_name, ' ', ', ') AS listed, regexp_extract(p_brand, '[0-9]+') AS number,
       regexp_replace(p_brand, '[0-9]', 'x', 'g') AS masked
FROM part
""")
def text_functions(spark, sf_dir):
    name = F.col("p_name")
    paren = F.replace(F.concat(name, F.lit(") - report")), F.lit(" "), F.lit(" ("))
    paren = F.concat(F.split_part(name, F.lit(" "), F.lit(1)), F.lit(" ("), F.split_part(name, F.lit(" "), F.lit(2)), F.lit(") - report"))
    before, place = text.split_paren(paren)
    described = F.concat(
        F.lit("<p>about "), name, F.when(F.col("p_size") > 25, "</p>Source:").otherwise("</p>Sources:"), F.col("p_brand")
    )
    description, source = text.split_section(described)
    lat, lon = text.parse_latlon(
        F.concat(F.lit("("), (F.col("p_partkey") % 90).cast("string"), F.lit(", "), F.col("p_size").cast("string"), F.lit(")"))
    )
    flag = text.py_bool(F.col("p_size") > 25)
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        text.squeeze(name).alias("squeezed"),
        text.title(F.upper(F.replace(name, F.lit(" "), F.lit("-")))).alias("titled"),
        before.alias("name"), place.alias("place"),
        text.after_first(F.concat(name, F.lit(": "), F.col("p_type")), ": ").alias("after"),
        description.alias("description"), source.alias("source"), lat.alias("lat"), lon.alias("lon"),
        flag.alias("flag"), text.parse_bool(flag).alias("back"),
        text.join_list(F.split(name, " ")).alias("listed"),
        text.find_text(F.col("p_brand"), "[0-9]+").alias("number"),
        text.sub_text(F.col("p_brand"), "[0-9]", "x").alias("masked"),
    )


@query("""
WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages)
SELECT link, count(*) AS n FROM l WHERE starts_with(link, '/') AND link LIKE '%th%' GROUP BY 1
""")
def page_links(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    links = html_links(pages, "html", prefix="/", contains="th")
    return links.groupBy("link").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages)
SELECT page_id % 3 AS form, link, count(*) AS n FROM l GROUP BY 1, 2
""")
def page_links_in_all_forms(spark, sf_dir):
    """Links in single or no quotes, after other attributes, beside some in comments and scripts."""
    html, form = F.col("html"), F.col("page_id") % 3
    single = F.regexp_replace(html, '<a href="([^"]*)"', "<A data-href=\"/no\" HREF = '$1' class=x")
    bare = F.regexp_replace(html, '<a href="([^"]*)"', "<a\n  class='a > b' href=$1 rel=next")
    hidden = F.lit("""<!-- <a href="/hidden"> --><script>var a = '<a href="/script">';</script><b data-href="/b">""")
    written = F.concat(hidden, F.when(form == 1, single).when(form == 2, bare).otherwise(html))
    pages = table(spark, sf_dir, "pages").select(form.alias("form"), written.alias("html"))
    return html_links(pages, "html").groupBy("form", "link").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH u AS (SELECT page_id, regexp_extract(html, '(?s)<ul>(.*?)</ul>', 1) AS list FROM pages WHERE html LIKE '%<ul>%'),
r AS (SELECT page_id, unnest(regexp_extract_all(list, '(?s)<li>(.*?)</li>', 1)) AS cell,
             unnest(range(1, len(regexp_extract_all(list, '(?s)<li>(.*?)</li>', 1)) + 1)) AS k FROM u)
SELECT page_id, CAST(k AS INTEGER) AS row_no, regexp_replace(cell, '<[^>]*>', '', 'g') AS label, '<& in' AS more FROM r
""")
def html_tables(spark, sf_dir):
    """Lists laid out as a table with an id, with open cells, entities and a table inside each row."""
    html = F.col("html")
    for old, new in {
        "<ul>": "<table><tr><td>other</td></tr></table><!-- <table id=\"links\"> --><TABLE class=a ID='links'><tr><th>label<th>more",
        "<li>": "<tr><td>", "</li>": "<td>&lt;&amp;<table id=links><tr><td>in</td></tr></table>", "</ul>": "</table>",
    }.items():
        html = F.replace(html, F.lit(old), F.lit(new))
    rows = table_rows(table(spark, sf_dir, "pages").select("page_id", html.alias("html")), "html", "links", header_rows=1)
    return rows.select("page_id", "row_no", F.get("cells", F.lit(0)).alias("label"), F.get("cells", F.lit(1)).alias("more"))


@query("""
WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages),
c AS (SELECT page_id, count(DISTINCT link) AS n, min(link) AS link FROM l WHERE link LIKE '%ing' GROUP BY 1)
SELECT p.page_id, CASE WHEN n IS NULL THEN 'none' WHEN n = 1 THEN 'found' ELSE 'ambiguous' END AS status,
       CASE WHEN n = 1 THEN link END AS link
FROM pages p LEFT JOIN c ON p.page_id = c.page_id
""")
def page_link_status(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return link_status(html_links(pages, "html", suffix="ing"), pages, "page_id")


@query("""
WITH r AS (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1)) AS cell,
                  unnest(range(0, len(regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1)))) AS k FROM pages)
SELECT page_id, CAST(k AS INTEGER) AS row_no, trim(regexp_replace(cell, '<[^>]*>', '', 'g')) AS label FROM r WHERE k >= 1
""")
def page_rows(spark, sf_dir):
    """List items as rows with one cell each; the first is the heading."""
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return html_table_rows(
        pages, "html", ["label"], row_pattern="(?s)<li>(.*?)</li>", cell_pattern=r"(?s)(<a [^>]*>.*?</a>)"
    )


@query("""
SELECT page_id, split_part(html, '<a href="', 1) = '' AS empty_text, length(split_part(html, '<a href="', 1)) AS chars,
       regexp_extract(html, '<a href="([^"]*)', 1) AS href
FROM pages
""")
def page_anchors(spark, sf_dir):
    html = F.col("html")
    return table(spark, sf_dir, "pages").select(
        "page_id", (text.anchor_text(html) == "").alias("empty_text"),
        F.length(text.anchor_text(html)).cast("bigint").alias("chars"), text.anchor_href(html).alias("href"),
    )


@query("""
SELECT o_orderkey, CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 10 WHEN '3-MEDIUM' THEN o_custkey % 9 + 3
  WHEN '4-NOT SPECIFIED' THEN (o_custkey % 9) * 7 + 3 ELSE 2 END AS INTEGER) AS days FROM orders
""")
def frequency_allowances(spark, sf_dir):
    count = (F.col("o_custkey") % 9).cast("string")
    frequency = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "Daily ")
        .when(F.col("o_orderpriority") == "2-HIGH", "weekly")
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(count, F.lit(" days")))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.concat(count, F.lit(" Weeks")))
        .otherwise("now and then")
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.allowed_lag(frequency).cast("int").alias("days"))


@query("""
SELECT event_id, value AS lon, CAST(user_id AS DOUBLE) AS lat, event_id % 3 = 0 AS single FROM events
""")
def binary_points(spark, sf_dir):
    """Points written as hexadecimal binary with Spark's own number formats, then read back."""

    def little_endian(number):
        digits = F.lpad(F.hex(number), 16, "0")
        return F.concat(*[F.substring(digits, 15 - 2 * i, 2) for i in range(8)])

    bits = "java_method('java.lang.Double', 'doubleToRawLongBits', {})"
    lon, lat = F.expr(bits.format("value")), F.expr(bits.format("cast(user_id as double)"))
    hexed = F.concat(
        F.lit("0101000000"), little_endian(lon.cast("bigint")), little_endian(lat.cast("bigint"))
    )
    member = F.array(F.array(F.col("value"), F.col("value")))
    many = F.when(F.col("event_id") % 3 == 0, member).otherwise(F.array_repeat(F.get(member, F.lit(0)), 2))
    shape = F.struct(F.lit("MultiPoint").alias("type"), many.alias("coordinates"))
    return table(spark, sf_dir, "events").select(
        "event_id", geometry.wkb_point(hexed).alias("p"), geometry.unwrap_multipoint(shape).isNotNull().alias("single")
    ).select("event_id", "p.lon", "p.lat", "single")
