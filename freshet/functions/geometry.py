"""Geometry structs and expressions on them.

A point is ``struct<type, coordinates: array<double>>``; a polygon is
``struct<type, coordinates: array<array<array<double>>>>`` whose first ring is
the outline and whose further rings are holes.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POINT = "struct<type: string, coordinates: array<double>>"
MULTIPOINT = "struct<type: string, coordinates: array<array<double>>>"
POLYGON = "struct<type: string, coordinates: array<array<array<double>>>>"
#: Any geometry, with its coordinates as text; see :func:`area_parts` and :func:`line_parts`.
ANY = "struct<type: string, coordinates: string>"
#: Polygons of an area, each a list of rings; and the lines of a line geometry.
PARTS = "array<array<array<array<double>>>>"
LINES = "array<array<array<double>>>"


def point(lon: Column, lat: Column) -> Column:
    """Point of longitude and latitude; null if either is missing."""
    value = F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))
    return F.when(lon.isNotNull() & lat.isNotNull(), value)


def polygon(rings: Column) -> Column:
    return F.struct(F.lit("Polygon").alias("type"), rings.alias("coordinates"))


def box(west: Column, south: Column, east: Column, north: Column) -> Column:
    """Rectangle as a closed one-ring polygon."""
    ring = F.array(
        F.array(west, south), F.array(east, south), F.array(east, north), F.array(west, north),
        F.array(west, south),
    )
    return polygon(F.array(ring))


def unwrap_multipoint(geom: Column) -> Column:
    """The point of a one-member multipoint; null for other geometries."""
    single = (geom["type"] == "MultiPoint") & (F.size(geom["coordinates"]) == 1)
    only = F.struct(
        F.lit("Point").alias("type"), F.get(geom["coordinates"], F.lit(0)).alias("coordinates")
    )
    return F.when(single, only)


def _edges(ring: Column) -> Column:
    """Consecutive vertex pairs of a closed ring."""
    size = F.size(ring)
    return F.zip_with(
        F.slice(ring, F.lit(1), size - 1),
        F.slice(ring, F.lit(2), size - 1),
        lambda a, b: F.struct(
            a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2")
        ),
    )


def perimeter(geom: Column) -> Column:
    """Length of all rings, in the units of the coordinates."""

    def ring_length(ring: Column) -> Column:
        return F.aggregate(
            _edges(ring),
            F.lit(0.0),
            lambda acc, e: acc + F.sqrt(F.pow(e["x2"] - e["x1"], 2) + F.pow(e["y2"] - e["y1"], 2)),
        )

    return F.aggregate(geom["coordinates"], F.lit(0.0), lambda acc, ring: acc + ring_length(ring))


def bounds(geom: Column) -> dict[str, Column]:
    """West, south, east and north of a polygon's outline."""
    outline = F.get(geom["coordinates"], F.lit(0))
    xs, ys = F.transform(outline, lambda p: p[0]), F.transform(outline, lambda p: p[1])
    return {
        "west": F.array_min(xs), "south": F.array_min(ys),
        "east": F.array_max(xs), "north": F.array_max(ys),
    }


def edges(geom: Column) -> Column:
    """All edges of a polygon's rings."""
    return F.flatten(F.transform(geom["coordinates"], _edges))


def edges_cover(lines: Column, x: Column, y: Column) -> Column:
    """Whether the polygon of these edges holds a point; its boundary counts as inside.

    Even-odd rule, so that holes are outside.
    """

    def on_edge(e: Column) -> Column:
        cross = (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
        return (
            (cross == 0)
            & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
            & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        )

    def crosses(e: Column) -> Column:
        spans = (e["y1"] > y) != (e["y2"] > y)
        at = e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0))
        return spans & (x < at)

    odd = F.size(F.filter(lines, lambda e: F.coalesce(crosses(e), F.lit(False)))) % 2 == 1
    return odd | F.exists(lines, on_edge)


def covers(geom: Column, x: Column, y: Column) -> Column:
    return edges_cover(edges(geom), x, y)


def area_parts(geom: Column) -> Column:
    """Polygons of a Polygon or MultiPolygon read as :data:`ANY`; null for other types and broken coordinates."""
    one = F.from_json(F.concat(F.lit("["), geom["coordinates"], F.lit("]")), PARTS)
    return F.when(geom["type"] == "Polygon", one).when(
        geom["type"] == "MultiPolygon", F.from_json(geom["coordinates"], PARTS)
    )


def parts_of(df: DataFrame, name: str) -> Column:
    """Polygons of a geometry column, whether read as :data:`ANY` or with the nesting of one polygon or of several."""
    kind = df.schema[name].dataType["coordinates"].dataType.simpleString()
    if kind == "string":
        return area_parts(F.col(name))
    coordinates = F.col(name)["coordinates"]
    return coordinates if kind == PARTS else F.when(coordinates.isNotNull(), F.array(coordinates))


def line_parts(geom: Column) -> Column:
    """Lines of a LineString or MultiLineString read as :data:`ANY`; null for other types and broken coordinates."""
    one = F.from_json(F.concat(F.lit("["), geom["coordinates"], F.lit("]")), LINES)
    return F.when(geom["type"] == "LineString", one).when(
        geom["type"] == "MultiLineString", F.from_json(geom["coordinates"], LINES)
    )


def parts_geojson(parts: Column) -> Column:
    """GeoJSON text of an area: a Polygon if it has one part, a MultiPolygon otherwise; null without parts."""
    one = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.get(parts, F.lit(0)).alias("coordinates")))
    many = F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), parts.alias("coordinates")))
    return F.when(F.size(parts) == 1, one).when(F.size(parts) > 1, many)


def lines_geojson(lines: Column) -> Column:
    """GeoJSON text of lines: a LineString if there is one, a MultiLineString otherwise; null without lines."""
    one = F.to_json(F.struct(F.lit("LineString").alias("type"), F.get(lines, F.lit(0)).alias("coordinates")))
    many = F.to_json(F.struct(F.lit("MultiLineString").alias("type"), lines.alias("coordinates")))
    return F.when(F.size(lines) == 1, one).when(F.size(lines) > 1, many)


def parts_perimeter(parts: Column) -> Column:
    """Length of all rings of all parts, in the units of the coordinates."""
    return F.aggregate(parts, F.lit(0.0), lambda acc, rings: acc + perimeter(F.struct(rings.alias("coordinates"))))


def parts_edges(parts: Column) -> Column:
    """All edges of all rings of an area."""
    return F.flatten(F.transform(F.flatten(parts), _edges))


def from_geojson(col: Column, schema: str = POINT) -> Column:
    return F.from_json(col, schema)


def to_geojson(geom: Column) -> Column:
    return F.to_json(geom)


def wkb_point(hex_col: Column) -> Column:
    """Longitude and latitude of a hexadecimal well-known-binary point.

    Both byte orders and the extended form with a reference-system number are
    read; other geometries and broken text give null.
    """
    layout = np.dtype([("head", "V5"), ("lon", "<f8"), ("lat", "<f8")])

    def one(text):
        try:
            raw = bytes.fromhex(text)
            order = "<" if raw[0] == 1 else ">"
            (kind,) = struct.unpack_from(order + "I", raw, 1)
            if kind & 0xFF != 1:
                return (None, None)
            return struct.unpack_from(order + "dd", raw, 9 if kind & 0x20000000 else 5)
        except (TypeError, ValueError, IndexError, struct.error):
            return (None, None)

    @F.pandas_udf("struct<lon: double, lat: double>")
    def decode(texts: pd.Series) -> pd.DataFrame:
        """Plain little-endian points of a batch at once, others one by one."""
        out = pd.DataFrame({"lon": np.nan, "lat": np.nan}, index=texts.index, dtype="float64")
        plain = texts.str.fullmatch(r"0101000000[0-9A-Fa-f]{32}").fillna(False).astype(bool)
        found = np.frombuffer(bytes.fromhex("".join(texts[plain])), layout)
        out.loc[plain, "lon"], out.loc[plain, "lat"] = found["lon"], found["lat"]
        rest = texts[~plain]
        out.loc[~plain, ["lon", "lat"]] = np.array([one(t) for t in rest], dtype="float64").reshape(-1, 2)
        return out

    return decode(hex_col)
