"""Station forecasts, sensors and transit stops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import dates, geometry, keys, units
from ..operators import clean, joins
from ..operators.aggregates import distinct
from ..schemas import schema
from ..streaming.incremental import drop_late, high_marks, insert_if_new, replace_run, until_known

# Budgets, and the gases with a conversion.
FORECAST_ROWS = 200_000
SENSOR_ROWS = 300_000
SENSOR_DAYS = 5
GASES = ("o3", "no2")


def station_forecasts(records: DataFrame, target: DataFrame, strict: bool = False) -> DataFrame:
    """Hourly forecasts with converted units; ``strict`` stops at a station's first known id."""
    created, at = F.col("created").cast("timestamp_ntz"), F.col("date").cast("timestamp_ntz")
    rows = records.select(
        keys.forecast_uid(created, at, F.col("station")).alias("uid"),
        F.col("station").cast("string").alias("name"),
        created.alias("created"),
        at.alias("date"),
        F.col("gas.o3").alias("o3_ugm3"),
        F.col("gas.no2").alias("no2_ugm3"),
        F.col("gas.pm25_gcc").alias("pm25_gcc_ugm3"),
        F.col("gas.pm25_gocart").alias("pm25_gocart_ugm3"),
    )
    for gas in GASES:
        ppb = units.ugm3_to_ppb(F.lit(gas), F.col(f"{gas}_ugm3"))
        rows = rows.withColumns({f"{gas}_ppb": ppb, f"{gas}_ppm": ppb / 1000})
    rows = clean.conform(rows, schema("station_forecasts"))
    if strict:
        newest_first = rows.withColumn("_age", -F.unix_micros(F.col("date").cast("timestamp")))
        rows = until_known(newest_first, ["name"], ["_age"], target, "uid", strict=True).drop("_age")
    return insert_if_new(rows, target, "uid", ["date"])


def forecast_metrics(forecasts: DataFrame) -> DataFrame:
    """Daily metrics of the newest run: largest hour, mean and largest 8-hour mean."""
    run = clean.nan_to_null(replace_run(forecasts, "created"))
    day = dates.noon_day(F.col("date"))
    rows = run.withColumn("_day", day)
    frame = Window.partitionBy("name", "_day").orderBy("date").rowsBetween(-7, 0)

    def eight(col: str) -> Column:
        return F.when(F.count(col).over(frame) >= 8, F.avg(col).over(frame))

    rows = rows.withColumns({f"_{c}": eight(c) for c in ("o3_ppb", "o3_ppm", "o3_ugm3")})
    metrics = rows.groupBy("name", "created", "_day").agg(
        *[F.max(f"no2_{u}").alias(f"no2_{u}_max1houravg") for u in ("ppb", "ppm", "ugm3")],
        *[F.avg(f"{p}_ugm3").alias(f"{p}_ugm3_24houravg") for p in ("pm25_gcc", "pm25_gocart")],
        *[F.max(f"_o3_{u}").alias(f"o3_{u}_max8houravg") for u in ("ppb", "ppm", "ugm3")],
    )
    midnight = F.col("_day").cast("timestamp_ntz")
    return metrics.withColumns(
        {"date": midnight, "uid": keys.forecast_uid(F.col("created"), midnight, F.col("name"))}
    ).drop("_day")


def stations_with_new(forecasts: DataFrame, stations: DataFrame, source: DataFrame) -> DataFrame:
    """The station table with the stations that forecasts mention for the first time."""
    return joins.grow_dimension(forecasts, stations, source, "name")


def sensor_readings(records: DataFrame, target: DataFrame, start, end) -> DataFrame:
    """Readings of a time slice, newer than what is stored for their parameter."""
    place = F.col("coordinates")
    value, unit = F.col("value"), F.col("unit")
    rows = records.withColumns(
        {
            "utc": dates.parse_ts(F.col("date.utc"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            "lon": place["longitude"],
            "lat": place["latitude"],
        }
    )
    rows = clean.time_slice(rows, "utc", start, end, "value", ["lon", "lat"])
    rows = drop_late(rows, high_marks(target, "parameter", "utc"), "parameter", "utc")
    rows = rows.withColumns(
        {
            "the_geom": geometry.point(F.col("lon"), F.col("lat")),
            "_UID": keys.uid_md5("location", F.col("date.utc")),
            "ppm": units.ugm3_to_ppm(F.col("parameter"), unit, value),
        }
    )
    return insert_if_new(clean.conform(rows, schema("sensor_readings")), target, "_UID", ["utc"])


def sensor_locations(readings: DataFrame, locations: DataFrame) -> DataFrame:
    """The location table grown by the locations of new readings."""
    source = readings.select(F.md5("location").alias("_UID"), "the_geom", "location", "city", "country")
    return joins.grow_dimension(source, locations, source, "_UID")


def transit_feeds(feeds: DataFrame, names: list[str], parents: list[str]) -> DataFrame:
    """Feeds with their nested columns laid open and renamed by position."""
    flat = clean.drop_empty_columns(clean.flatten_structs(feeds, parents))
    rows = clean.rename_all(flat, names)
    rows = rows.withColumn("updated", dates.from_epoch(F.col("ts"), "s"))
    return distinct(rows.withColumn("the_geom", geometry.point(F.col("lng"), F.col("lat"))))
