"""Date series from text files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, units
from ..operators import clean
from ..sources.text import split_whitespace
from ..streaming.incremental import insert_if_new

# Fields of the carbon dioxide and sea level files.
CO2_FIELDS = ["year", "month", "decimal", "average", "average_unc", "trend", "trend_unc"]
SEA_LEVEL_FIELDS = [
    "altimeter", "cycle", "decimal", "observations", "weighted", "gmsl", "gmsl_std",
    "gmsl_smooth", "gmsl_gia", "gmsl_gia_std", "gmsl_gia_smooth", "gmsl_gia_smooth_annual",
]


def carbon_dioxide(lines: DataFrame) -> DataFrame:
    rows = split_whitespace(lines, CO2_FIELDS, comment="#")
    typed = clean.coerce_numeric(rows, CO2_FIELDS)
    return typed.select(dates.from_decimal_year(F.col("decimal")).alias("date"), "average", "average_unc", "trend", "trend_unc")


def sea_level(lines: DataFrame, target: DataFrame) -> DataFrame:
    rows = split_whitespace(lines, SEA_LEVEL_FIELDS, header_prefix="HDR")
    typed = clean.coerce_numeric(rows, SEA_LEVEL_FIELDS)
    typed = typed.withColumn("date", dates.from_decimal_year(F.col("decimal")))
    return insert_if_new(typed, target, "date", ["cycle"])


def land_temperature(lines: DataFrame, target: DataFrame) -> DataFrame:
    """Yearly means; a year stands for its last day."""
    rows = clean.coerce_numeric(split_whitespace(lines, ["year", "mean", "smooth"]), ["year", "mean", "smooth"])
    rows = clean.require(rows, ["year"])
    return insert_if_new(rows.withColumn("date", dates.year_end(F.col("year"))), target, "date", ["year"])


def ice_minimum(rows: DataFrame, target: DataFrame) -> DataFrame:
    dated = rows.select(
        dates.date_from_parts(F.col("year"), F.col("month"), F.col("day")).alias("date"),
        units.scale_round(F.col("extent")).alias("extent"),
    )
    return insert_if_new(dated, target, "date", ["extent"])
