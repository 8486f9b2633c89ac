"""Gridded datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..operators import grid
from ..operators.aggregates import complete_dates
from ..operators.joins import join_per_key
from ..operators.monitor import assign_by_order
from ..operators.retention import keep_newest_dates
from ..operators.windows import trailing_mean

# Nodata and packing of the coral and vegetation grids, kept
# dates, and the extents of the sea-ice grids.
CORAL_NODATA = {"bleaching_alert": 251}
GRID_NODATA = -32768
VEGETATION_SCALE = 0.01
COMPOSITE_DAYS = 30
DEPTH_LEVELS = 5
ARCTIC = (-180.0, 50.0, 180.0, 89.75)
ANTARCTIC = (-180.0, -89.75, 180.0, -50.0)

CELL = ["row", "col"]


def daily_air_quality(cells: DataFrame, files_per_day: int = 24, file: Column | None = None) -> DataFrame:
    """Daily metric of each variable from hourly grids, for days from noon to noon with all files.

    ``file`` tells the files of a day apart; by default their time does.
    """
    daily = cells.withColumns({"date": dates.noon_day(F.col("ts")), "_file": F.col("ts") if file is None else file})
    usable = complete_dates(daily, ["var", "date"], "_file", files_per_day).select("var", "date")
    complete = join_per_key(daily, usable, ["var", "date"], "left_semi")
    return grid.apply_metric(complete, ["date", *CELL], "var", "value")


def layer_dates(layers: DataFrame, historical: DataFrame, forecast: DataFrame) -> DataFrame:
    """Layer 0 shows the newest measured date, layer k the k-th forecast date."""
    newest = historical.agg(F.max("date").alias("date")).filter("date is not null")
    return assign_by_order(assign_by_order(layers, newest), forecast, first=1)


def composite(cells: DataFrame, days: int = COMPOSITE_DAYS) -> DataFrame:
    """Mean of the days that end on each date with an image."""
    daily = cells.groupBy("date", *CELL).agg(F.sum("value").alias("_sum"), F.count("value").alias("_n"))
    return trailing_mean(daily, CELL, "date", "_sum", "_n", days, "value").drop("_sum", "_n")


def chlorophyll(cells: DataFrame, keep: int) -> DataFrame:
    return keep_newest_dates(grid.cell_log(cells, "value"), ["var"], "date", keep)


def vegetation(cells: DataFrame) -> DataFrame:
    rows = grid.unpack(cells, "value", VEGETATION_SCALE)
    return rows.withColumn("week", dates.iso_week_key(F.col("date")))


def coral(cells: DataFrame, products: list[str]) -> DataFrame:
    """Products side by side with one nodata value."""
    same = grid.unify_nodata(cells, "var", "value", CORAL_NODATA, GRID_NODATA)
    return grid.stack_bands(same, ["date", *CELL], "var", "value", products)


def nutrients(cells: DataFrame) -> DataFrame:
    return grid.level_mean(cells, ["var", "date", *CELL], "level", "value", DEPTH_LEVELS)


def deforestation_alerts(cells: DataFrame) -> DataFrame:
    """The later tile wins where tiles overlap; only cells with an alert."""
    return grid.mask_positive(grid.mosaic(cells, ["date", *CELL], ["order"], "value"), "value")


def temperature_anomalies(cells: DataFrame) -> DataFrame:
    """Cells on a -180 to 180 grid, dated from a CF time offset."""
    moved = cells.withColumns(
        {"lon": grid.wrap_lon(F.col("lon")), "date": dates.cf_time(F.col("offset"), F.col("units"))}
    )
    return moved.drop("offset", "units")


def sea_ice(cells: DataFrame, hemisphere: str) -> DataFrame:
    """Polar cells with degrees, cut to the hemisphere's extent."""
    lon, lat = grid.polar_to_lonlat(F.col("x"), F.col("y"), hemisphere)
    placed = cells.withColumns({"lon": lon, "lat": lat})
    return grid.clip(placed, ARCTIC if hemisphere == "north" else ANTARCTIC)


def model_run(cells: DataFrame, n_levels: int) -> DataFrame:
    """Forecast cells with band numbers and western longitudes, without the last step."""
    rows = cells.withColumns(
        {
            "band": grid.band_index(F.col("step"), n_levels, F.col("level")),
            "lon": grid.wrap_lon(F.col("lon")),
        }
    )
    return grid.trim_tail(rows, ["run"], "step")


def gridded_anomaly(cells: DataFrame) -> DataFrame:
    return grid.valid_range(cells, "value")
