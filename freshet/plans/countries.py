"""Country-year indicators, asylum totals, scenarios and catalogues of their layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, keys
from ..operators import aggregates, clean, joins
from ..schemas import indicator_schema
from ..streaming.incremental import insert_if_new

# Groups of countries that are no countries, the codes of regions
# and the one name that repeats another country.
COUNTRY_GROUPS = [
    "Arab World", "Caribbean small states", "Central Europe and the Baltics", "Early-demographic dividend",
    "East Asia & Pacific", "East Asia & Pacific (IDA & IBRD countries)",
    "East Asia & Pacific (excluding high income)", "Euro area", "Europe & Central Asia",
    "Europe & Central Asia (IDA & IBRD countries)", "Europe & Central Asia (excluding high income)",
    "European Union", "Fragile and conflict affected situations", "Heavily indebted poor countries (HIPC)",
    "High income", "IBRD only", "IDA & IBRD total", "IDA blend", "IDA only", "IDA total",
    "Late-demographic dividend", "Latin America & Caribbean", "Latin America & Caribbean (excluding high income)",
    "Latin America & the Caribbean (IDA & IBRD countries)", "Latin America & the Caribbean (excluding high income)",
    "Least developed countries: UN classification", "Low & middle income", "Low income", "Lower middle income",
    "Macao SAR China", "Middle East & North Africa", "Middle East & North Africa (IDA & IBRD countries)",
    "Middle East & North Africa (excluding high income)", "Middle income", "North America", "Not classified",
    "OECD members", "Other small states", "Pacific island small states", "Post-demographic dividend",
    "Pre-demographic dividend", "Small states", "South Asia", "South Asia (IDA & IBRD)", "Sub-Saharan Africa",
    "Sub-Saharan Africa (IDA & IBRD countries)", "Sub-Saharan Africa (excluding high income)",
    "Upper middle income", "World", "blank (ID 265)", "blank (ID 267)", "blank (ID 268)",
]
WORLD_CODE = "WLD"
REGION_SIGN = "+"
REPEATED_COUNTRY = "OPEC - South America"


def indicators(frames: list[tuple[DataFrame, str, str]], codes: DataFrame) -> DataFrame:
    """Indicators side by side per country and year, for countries with a code.

    A frame has ``country_name``, ``year`` and ``value`` and comes with its unit
    and indicator code.
    """
    sides = []
    for i, (df, unit, code) in enumerate(frames, 1):
        rows = clean.deny(df, "country_name", COUNTRY_GROUPS)
        rows = rows.withColumnRenamed("value", f"indicator_value_{i}")
        sides.append(clean.with_constants(rows, {f"unit{i}": unit, f"indicator_code{i}": code}))
    wide = joins.outer_join_measures(sides, ["country_name", "year"])
    coded = joins.lookup(wide, codes, "country_name", "name", "country_code", "drop")
    coded = coded.filter("country_code is not null")
    coded = coded.withColumn("datetime", dates.year_start(F.col("year")).cast("timestamp_ntz"))
    return clean.nan_to_null(clean.conform(coded, indicator_schema(len(frames))))


def energy_by_country(rows: DataFrame) -> DataFrame:
    """Yearly energy figures of countries, without regions and missing values."""
    named = clean.rename(
        rows,
        {"period": "year", "countryRegionName": "country", "countryRegionId": "geography",
         "value": "yr_data", "unitName": "unit"},
    )
    kept = clean.where_text(clean.where_text(named, "geography", "not contains", REGION_SIGN), "geography", "!=", WORLD_CODE)
    kept = clean.drop_sentinels(clean.where_text(kept, "country", "!=", REPEATED_COUNTRY), "yr_data")
    typed = clean.coerce_numeric(kept.withColumn("year", F.col("year").cast("int")), ["yr_data"])
    return aggregates.distinct(
        typed.withColumn("datetime", dates.year_start(F.col("year")).cast("timestamp_ntz"))
    )


def asylum_totals(rows: DataFrame, target: DataFrame) -> DataFrame:
    """Monthly totals by country of origin and of asylum that are not stored yet."""
    roles = ["country_of_origin", "country_of_asylum"]
    return insert_if_new(
        aggregates.aggregate_roles(rows, roles, "year", "month", "value"), target, "uid", ["date"]
    )


def food_scenarios(areas: DataFrame, target: DataFrame) -> DataFrame:
    """Area classes of a country's scenarios with their validity.

    Input has ``country``, ``scenario``, ``file_date``, ``position``, ``ADMIN0``,
    ``ADMIN1``, ``ifc`` and ``geometry``.
    """
    start, end = dates.scenario_interval(F.col("scenario"), F.col("file_date"))
    rows = areas.select(
        keys.uid("country", F.date_format("file_date", "yyyyMM"), "scenario", "position").alias("_uid"),
        F.col("geometry").alias("the_geom"),
        F.col("ADMIN0").alias("admin0"),
        F.col("ADMIN1").alias("admin1"),
        F.col("scenario").alias("ifc_type"),
        "ifc",
        start.alias("start_date"),
        end.alias("end_date"),
    )
    return insert_if_new(rows, target, "_uid", ["start_date"])


def water_conflicts(rows: DataFrame) -> DataFrame:
    """Conflict records, the first of each title and start year; years before 1 have no date."""
    first = aggregates.dedupe(rows, ["title", "start_year"], ["row_no"], "first")
    year = F.col("start_year").try_cast("int")
    return first.withColumns({"start_dt": dates.year_start(year), "end_dt": dates.year_end(F.col("end_year").try_cast("int"))})
