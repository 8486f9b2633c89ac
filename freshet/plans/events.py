"""Feeds of events: earthquakes, disasters, volcanoes, spills, smoke, incidents and others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, geometry, keys, text
from ..operators import aggregates, clean
from ..operators.retention import drop_older, keep_newest
from ..schemas import schema
from ..streaming.incremental import backfill_slices, insert_if_new

# Row budgets, ages in days and key time format of the event tables.
EARTHQUAKE_ROWS = 150_000
EARTHQUAKE_SLICE_DAYS = 7
DISASTER_ROWS = 10_000
INCIDENT_DATE = "yyyy-MM-dd"
KEY_TIME = "yyyy-MM-dd HH:mm:ss"


def earthquakes(features: DataFrame, target: DataFrame, now, history: bool = False) -> DataFrame:
    """New earthquakes of a feature feed, in weekly slices back from ``now``."""
    xyz = F.col("geometry.coordinates")
    lon, lat, depth = xyz[0], xyz[1], xyz[2]
    rows = features.withColumns(
        {
            "datetime": dates.from_epoch(F.col("time"), "ms"),
            "depth_in_km": depth,
            "the_geom": geometry.point(lon, lat),
        }
    )
    rows = rows.withColumn("uid", keys.uid(lat, lon, depth, F.date_format("datetime", KEY_TIME)))
    rows = clean.conform(rows, schema("earthquakes"))
    if history:
        return insert_if_new(rows, target, "uid", ["datetime", "place"])
    return backfill_slices(rows, target, "datetime", "uid", ["datetime", "place"], EARTHQUAKE_SLICE_DAYS, now).drop("slice")


def retained(rows: DataFrame, ts: str, cutoff, n: int, tie: str) -> DataFrame:
    """Age budget, then row budget."""
    return keep_newest(drop_older(rows, ts, cutoff), ts, n, tie)


def disasters(records: DataFrame, target: DataFrame) -> DataFrame:
    """One row per disaster and affected country, without those already stored."""
    rows = records.select("id", "fields.*").withColumn("c", F.explode("country"))
    lon, lat = F.col("c.location.lon"), F.col("c.location.lat")
    rows = rows.select(
        geometry.point(lon, lat).alias("the_geom"),
        keys.uid_md5("id", "c.iso3").alias("uid"),
        F.col("id").alias("event_id"),
        F.col("name").alias("event_name"),
        "status",
        dates.parse_ts(F.col("date.created"), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("date"),
        F.coalesce(text.join_list(F.col("related_glide")), F.lit("")).alias("related_glide"),
        text.py_bool(F.col("featured")).alias("featured"),
        F.col("primary_country.iso3").alias("primary_country"),
        F.col("c.name").alias("country_name"),
        F.col("c.shortname").alias("country_shortname"),
        F.col("c.iso3").alias("country_iso3"),
        text.py_bool(F.col("current")).alias("current"),
        text.join_list(F.col("type.id")).alias("event_type_ids"),
        text.join_list(F.col("type.name")).alias("event_types"),
        "url",
        lon.alias("lon"),
        lat.alias("lat"),
    )
    rows = clean.conform(rows, schema("disasters"))
    return insert_if_new(rows, target, "uid", ["event_id"])


def disaster_summaries(rows: DataFrame) -> DataFrame:
    """Current disasters of each country in one text, with the country's first row."""
    current = rows.filter("current = 'True'")
    entry = F.concat(text.after_first(F.col("event_name"), ": "), F.lit(" ("), F.col("url"), F.lit(")"))
    firsts = ["the_geom", "uid", "country_name", "country_shortname"]
    return aggregates.concat_by(
        current, ["country_iso3"], ["date", "event_id"], entry, firsts=firsts, name="interaction"
    )


def volcano_reports(items: DataFrame, target: DataFrame) -> DataFrame:
    """Weekly reports of a feed with ``title``, ``point``, ``pubDate`` and ``description``."""
    name, country = text.split_paren(F.col("title"))
    lat, lon = text.parse_latlon(F.col("point"))
    description, sources = text.split_section(F.col("description"))
    rows = items.withColumns(
        {
            "pubdate": dates.parse_rfc822(F.col("pubDate")),
            "volcano_name": name,
            "country_name": country,
            "the_geom": geometry.point(lon, lat),
            "sources": sources,
            "description": description,
            "_key": keys.uid(lat, lon),
        }
    )
    rows = rows.withColumn("uid", keys.uid("_key", F.date_format("pubdate", KEY_TIME)))
    return insert_if_new(clean.conform(rows, schema("volcano_reports")), target, "uid", ["pubdate"])


def smoke_plumes(features: DataFrame, target: DataFrame) -> DataFrame:
    """Plume outlines keyed by the day of their file and their position in it."""
    start = dates.from_day_of_year(F.col("Start"))
    end = dates.from_day_of_year(F.col("End"))
    day = F.regexp_extract("file", r"(\d{8})", 1)
    rows = features.select(
        F.col("geometry").alias("the_geom"),
        keys.uid(day, F.col("position")).alias("_UID"),
        dates.parse_ts(day, "yyyyMMdd").alias("date"),
        "Satellite",
        start.alias("_start"),
        end.alias("_end"),
        dates.duration_text(start, end).alias("duration"),
        "Density",
    )
    return insert_if_new(clean.conform(rows, schema("smoke_plumes")), target, "_UID", ["_start"])


def spill_records(lines: DataFrame, columns: list[str]) -> DataFrame:
    """Records of a broken CSV: a line that starts with a number and a comma starts a record."""
    filled = lines.filter(F.trim("value") != "")
    joined = clean.stitch_records(
        filled.withColumn("value", F.replace("value", F.lit("\t"))), F.col("value").rlike(r"^\d+,")
    )
    ddl = ", ".join(f"`{c}` string" for c in columns)
    rows = joined.select(F.from_csv("value", F.lit(ddl)).alias("r")).select("r.*")
    rows = clean.blank_to_null(rows)
    lon, lat = F.col("lon").try_cast("double"), F.col("lat").try_cast("double")
    return rows.withColumn("the_geom", geometry.point(lon, lat)).withColumnRenamed("id", "uid")


def incidents(rows: DataFrame, target: DataFrame, oldest) -> tuple[DataFrame, DataFrame]:
    """New incidents, and the rejected rows by reason."""
    unified = clean.unify_headers(rows, clean.INCIDENT_HEADERS)
    named = unified.toDF(*[c.replace(" ", "_") for c in unified.columns])
    date = dates.parse_ts(F.col("Incident_Date"), INCIDENT_DATE)
    named = clean.blank_to_null(named).withColumn("_date", date)
    rules: list[tuple[str, Column]] = [
        ("no_coordinates", F.col("Coordinates").isNull()),
        ("no_date", F.col("_date").isNull()),
        ("too_old", F.col("_date") < dates.as_time(oldest)),
    ]
    good, rejects = clean.with_reject_counts(named, rules)
    lat, lon = text.parse_latlon(F.col("Coordinates"))
    good = good.withColumns({"uid": F.col("Main_ID"), "the_geom": geometry.point(lon, lat), "Incident_Date": F.col("_date")})
    return insert_if_new(good.drop("_date", "Main_ID"), target, "uid", ["Incident_Date"]), rejects


def tsunamis(items: DataFrame) -> DataFrame:
    """Tsunami records with coordinates, numbers and lower-case names."""
    texts = clean.blank_to_null(items)
    numbers = [c for c in ("year", "month", "day", "latitude", "longitude") if c in items.columns]
    typed = clean.coerce_numeric(texts, numbers)
    return clean.normalize_names(clean.require(typed, ["latitude", "longitude"]))


def displacements(records: DataFrame, target: DataFrame, now) -> DataFrame:
    """Displacement figures with a repaired date, and the link apart from the text."""
    popup = F.col("standard_popup_text")
    date = dates.parse_ts(F.col("displacement_date"), "yyyy-MM-dd").cast("date")
    rows = records.withColumns(
        {
            "displacement_date_timestamp": dates.repair_future(date, F.col("year"), now).cast("timestamp_ntz"),
            "the_geom": geometry.point(F.col("longitude"), F.col("latitude")),
            "link": text.anchor_href(popup),
            "standard_popup_text": text.anchor_text(popup),
        }
    )
    return insert_if_new(rows, target, "id", ["displacement_date_timestamp"])


def ratifications(rows: DataFrame) -> DataFrame:
    """A status table that replaces the old one as a whole."""
    return clean.blank_to_null(clean.normalize_names(rows))


def crisis_events(rows: DataFrame, bad_files: list[str]) -> DataFrame:
    """Coded events of tab-separated files, without bad files and places."""
    named = clean.normalize_names(clean.deny(rows, "file_id", bad_files))
    return clean.require(clean.blank_to_null(named), ["latitude", "longitude"])
