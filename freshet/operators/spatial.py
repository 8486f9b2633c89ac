"""Joins and generalisation of geometries."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import parts_of
from .area_index import POINTS_PER_COPY, points_in_areas


def points_in_polygons(
    points: DataFrame,
    polygons: DataFrame,
    x: str = "lon",
    y: str = "lat",
    geometry: str = "geometry",
    tile: float = 1.0,
    points_per_copy: int = POINTS_PER_COPY,
) -> DataFrame:
    """Each point with the other columns of each polygon that holds it; boundaries count as inside.

    A polygon may have many parts, see :func:`parts_of`.  The pairs come from the
    tile index of :func:`points_in_areas`, in which rows are named by a hash of
    all their columns; equal rows of ``polygons`` give pairs of their own.
    """
    added = [c for c in polygons.columns if c != geometry]
    area = max([*points.columns, *polygons.columns], key=len) + "_"
    whole = F.to_json(F.struct(*polygons.columns), {"ignoreNullFields": "false"})
    named = polygons.withColumn(area, F.sha2(whole.cast("binary"), 256))
    shapes = named.select(area, parts_of(named, geometry).alias("parts")).dropDuplicates([area])
    pairs = points_in_areas(points, shapes, area, x, y, tile=tile, points_per_copy=points_per_copy)
    return pairs.join(named.select(area, *added), area).select(*points.columns, *added)


def _simplify_line(points: np.ndarray, tolerance: float) -> np.ndarray:
    """Points of a line that stay when those within ``tolerance`` of the rest are left out."""
    keep = np.zeros(len(points), dtype=bool)
    keep[[0, -1]] = True
    spans = [(0, len(points) - 1)]
    while spans:
        first, last = spans.pop()
        if last - first < 2:
            continue
        start, chord = points[first], points[last] - points[first]
        rel = points[first + 1 : last] - start
        length = float(chord @ chord)
        along = np.clip(rel @ chord / length, 0, 1) if length else np.zeros(len(rel))
        away = np.linalg.norm(rel - along[:, None] * chord, axis=1)
        worst = int(away.argmax())
        if away[worst] > tolerance:
            middle = first + 1 + worst
            keep[middle] = True
            spans += [(first, middle), (middle, last)]
    return points[keep]


def simplify(df: DataFrame, rings: str, tolerance: float) -> DataFrame:
    """Polygon rings with fewer points, none further than ``tolerance`` from the original line.

    Each ring is handled on its own; shared borders of neighbours are not kept
    equal.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(rings)
            field = batch.schema.field(place)
            thin = [
                shape
                and [_simplify_line(np.array(ring, dtype=float), tolerance).tolist() for ring in shape]
                for shape in batch.column(place).to_pylist()
            ]
            yield batch.set_column(place, field, pa.array(thin, field.type))

    return df.mapInArrow(run, df.schema)


def count_in_areas(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of points per area and class of a join result."""
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
