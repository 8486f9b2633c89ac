"""Protected areas, districts and other polygons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, geometry, keys
from ..operators import aggregates, clean, joins
from ..operators.area_index import points_in_areas
from ..sinks.targets import upsert_rows
from ..streaming.incremental import insert_if_new

# Event types of the district table, the outline length above
# which an area is written apart, and no-take classes of protection.
EVENT_COLUMNS = {
    "Battles": "battles",
    "Protests": "protests",
    "Riots": "riots",
    "Strategic developments": "strategic_developments",
    "Explosions/Remote violence": "explosions_remote_violence",
    "Violence against civilians": "violence_against_civilians",
}
LONG_PERIMETER = 300
FULL_PROTECTION = ["All", "Part"]


def conflict_by_district(events: DataFrame, districts: DataFrame, coverage: DataFrame, tile: float = 1.0) -> DataFrame:
    """Events of each type per district of the covered countries.

    ``objectid`` names a district; its geometry may have one part or many, see
    :func:`geometry.parts_of`.
    """
    covered = joins.semi_join(districts, coverage, "gid_0")
    once = aggregates.dedupe(events, ["event_id_cnty"], ["event_type", "latitude", "longitude"], "first")
    shapes = covered.select("objectid", geometry.parts_of(covered, "geometry").alias("parts"))
    pairs = points_in_areas(once, shapes, "objectid", "longitude", "latitude", tile=tile)
    counts = aggregates.pivot_counts(pairs, "objectid", "event_type", list(EVENT_COLUMNS))
    counts = clean.rename(counts, EVENT_COLUMNS)
    out = joins.left_join(covered, counts, ["objectid"])
    return clean.with_defaults(out, {**{c: 0 for c in EVENT_COLUMNS.values()}, "total": 0})


def protected_areas(features: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New protected areas, those with a long outline apart from the rest."""
    rows = features.withColumns(
        {
            "WDPA_PID": F.trim(F.regexp_replace("WDPA_PID", r"[\r\n]+", "")),
            "legal_status_updated_at": dates.year_start(F.col("STATUS_YR")),
            "perimeter": geometry.parts_perimeter(geometry.parts_of(features, "geometry")),
        }
    )
    new = insert_if_new(rows, target, "WDPA_PID", ["WDPAID"])
    return clean.split_by(new, F.col("perimeter") > LONG_PERIMETER)


def fully_protected(areas: DataFrame) -> DataFrame:
    return clean.allow(areas, "no_take", FULL_PROTECTION)


def nested_areas(records: DataFrame, target: DataFrame) -> DataFrame:
    """Areas of a nested feed put into the target; areas gone from the feed are left out."""
    rows = clean.extract_paths(
        records,
        {
            "id": ["id"],
            "name": ["name"],
            "country_name": ["countries", "*", "name"],
            "iso3": ["countries", "*", "iso_3"],
            "designation": ["designation", "name"],
            "jurisdiction": ["designation", "jurisdiction", "name"],
            "no_take_area": ["no_take_status", "area"],
            "status_date": ["legal_status_updated_at"],
        },
    )
    rows = rows.withColumn("status_date", dates.parse_ts(F.col("status_date"), "MM/dd/yyyy"))
    current = target.join(rows.select("id"), "id", "left_semi")
    return upsert_rows(current, rows, ["id"])


def drought_areas(features: DataFrame, target: DataFrame) -> DataFrame:
    """Weekly drought classes, keyed by the date of the file and the area's number."""
    day = F.regexp_extract("file", r"(\d{8})", 1)
    rows = features.select(
        F.col("geometry").alias("the_geom"),
        keys.uid(day, "OBJECTID").alias("_UID"),
        dates.parse_ts(day, "yyyyMMdd").alias("date"),
        "OBJECTID",
        "DM",
    )
    return insert_if_new(rows, target, "_UID", ["OBJECTID"])
