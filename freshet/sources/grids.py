"""Gridded arrays as cell tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.grid import cell_coords


def grid_to_cells(df: DataFrame, array_col: str, bounds_col: str = "bounds") -> DataFrame:
    """One row per cell of ``array<array<double>>`` grids.

    ``bounds_col`` is a struct of west, south, east and north.  Row 0 lies in
    the north and column 0 in the west.
    """
    kept = [c for c in df.columns if c not in (array_col, bounds_col)]
    rows, cols = F.size(array_col), F.size(F.get(F.col(array_col), F.lit(0)))
    cells = (
        df.withColumn("_rows", rows)
        .withColumn("_cols", cols)
        .select(*kept, bounds_col, "_rows", "_cols", F.posexplode(array_col).alias("row", "_line"))
        .select(*kept, bounds_col, "_rows", "_cols", "row", F.posexplode("_line").alias("col", "value"))
    )
    lat, lon = cell_coords(
        F.col("row"), F.col("col"), F.col(bounds_col), F.col("_rows"), F.col("_cols")
    )
    return cells.select(*kept, "row", "col", lat.alias("lat"), lon.alias("lon"), "value")


def levels_to_cells(
    df: DataFrame, array_col: str, bounds_col: str = "bounds", step_col: str = "step"
) -> DataFrame:
    """Cells of ``array<array<array<array<double>>>>`` in time, level, row, column order."""
    kept = [c for c in df.columns if c not in (array_col, bounds_col)]
    layers = df.select(
        *kept, bounds_col, F.posexplode(array_col).alias(step_col, "_step")
    ).select(*kept, bounds_col, step_col, F.posexplode("_step").alias("level", "_grid"))
    return grid_to_cells(layers, "_grid", bounds_col)
