"""Declared schemas of the tables that the plans keep up to date.

Fixed values: column names and their order, as the tables are served.
"""

from __future__ import annotations

from pyspark.sql import types as T

from .functions.geometry import POINT, POLYGON

DECLARED = {
    "earthquakes": f"""uid string, the_geom {POINT}, depth_in_km double, datetime timestamp_ntz, mag double,
        place string, sig bigint, magType string, nst bigint, dmin double, rms double, gap double,
        tsunami bigint, felt bigint, cdi double, mmi double, net string, alert string""",
    "disasters": f"""the_geom {POINT}, uid string, event_id bigint, event_name string, status string,
        date timestamp_ntz, related_glide string, featured string, primary_country string, country_name string,
        country_shortname string, country_iso3 string, current string, event_type_ids string, event_types string,
        url string, lon double, lat double""",
    "volcano_reports": f"""uid string, the_geom {POINT}, pubdate timestamp_ntz, volcano_name string,
        country_name string, description string, sources string""",
    "station_forecasts": """uid string, name string, created timestamp_ntz, date timestamp_ntz, o3_ugm3 double,
        no2_ugm3 double, pm25_gcc_ugm3 double, pm25_gocart_ugm3 double, o3_ppm double, no2_ppm double,
        o3_ppb double, no2_ppb double""",
    "smoke_plumes": f"""the_geom {POLYGON}, _UID string, date timestamp_ntz, Satellite string,
        _start timestamp_ntz, _end timestamp_ntz, duration string, Density string""",
    "sensor_readings": f"""the_geom {POINT}, _UID string, utc timestamp_ntz, value double, parameter string,
        location string, city string, country string, unit string, attribution string, ppm double""",
    "prices": """uid string, date timestamp_ntz, currency string, mktid int, cmid int, ptid int, umid int, catid int,
        unit string, cmname string, category string, mktname string, admname string, adm1id int, sn string,
        forecast string, mp_price double, trend double, pewi double, alps string""",
    "price_summaries": """uid string, region_id int, market_id int, market_name string, category string,
        market_interaction string, highest_pewi double, highest_alps string, oldest_interaction_date timestamp_ntz""",
}

# Column type of each served type name.
SERVED_TYPES = {
    "text": "string",
    "varchar": "string",
    "numeric": "double",
    "int": "bigint",
    "timestamp": "timestamp_ntz",
    "geometry": POINT,
}


def schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(DECLARED[name])


def indicator_schema(n: int) -> T.StructType:
    """Country-year table with a value, unit and code for each of ``n`` indicators."""
    fields = ["country_code string", "country_name string", "year int", "datetime timestamp_ntz"]
    for i in range(1, n + 1):
        fields += [f"indicator_value_{i} double", f"unit{i} string", f"indicator_code{i} string"]
    return T.StructType.fromDDL(", ".join(fields))


def from_served(columns: dict[str, str]) -> T.StructType:
    """Schema of ordered ``column: served type`` pairs."""
    return T.StructType.fromDDL(", ".join(f"`{c}` {SERVED_TYPES[t]}" for c, t in columns.items()))
