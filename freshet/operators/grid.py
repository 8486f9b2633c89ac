"""Grids as cell tables.

A cell is identified by collection or variable, time, level, row and column.
Aggregates over time or levels combine on the map side, so a shuffle moves one
row per cell and input part.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Ellipsoid and origin of the polar grids, and unit factors and
# metrics of the air-quality variables.
POLAR_AXIS = 6378273.0
POLAR_ECCENTRICITY_SQUARED = 0.006693883
POLAR_TRUE_LATITUDE = 70.0
POLAR_NORTH_MERIDIAN = -45.0
POLAR_SOUTH_MERIDIAN = 0.0
UNIT_FACTORS = {"NO2": 1e9, "O3": 1e9, "PM25_RH35_GCC": 1.0}
METRICS = {"NO2": "daily_avg", "O3": "daily_max", "PM25_RH35_GCC": "daily_avg"}


def _mean_of_all(value: str, n_files: int | Column | None) -> Column:
    """Sum over the number of files; null if a file has no value for the cell."""
    n = F.count(F.lit(1)) if n_files is None else F.lit(n_files)
    return F.when(F.count(value) == n, F.sum(value).cast("double") / n)


def cell_mean(df: DataFrame, keys: Sequence[str], value: str, factor: float = 1.0, n_files: int | Column | None = None) -> DataFrame:
    return df.groupBy(*keys).agg((_mean_of_all(value, n_files) * factor).alias(value))


def cell_max(
    df: DataFrame, keys: Sequence[str], value: str, factor: float = 1.0, every_file: bool = False
) -> DataFrame:
    """Largest value; with ``every_file`` null if a file has no value for the cell."""
    largest = F.max(value).cast("double") * factor
    if every_file:
        largest = F.when(F.count(value) == F.count(F.lit(1)), largest)
    return df.groupBy(*keys).agg(largest.alias(value))


METRIC_COLUMNS: dict[str, Callable[[str], Column]] = {
    "daily_avg": lambda value: _mean_of_all(value, None),
    "daily_max": lambda value: F.max(value).cast("double"),
}


def apply_metric(
    df: DataFrame, keys: Sequence[str], var: str, value: str,
    metrics: Mapping[str, str] = METRICS, factors: Mapping[str, float] = UNIT_FACTORS,
) -> DataFrame:
    """The registered metric of each variable in one aggregation; other variables are left out."""
    out = None
    for name, metric in metrics.items():
        column = METRIC_COLUMNS[metric](value) * factors.get(name, 1.0)
        out = (F if out is None else out).when(F.col(var) == name, column)
    return df.filter(F.col(var).isin(*metrics)).groupBy(var, *keys).agg(out.alias(value))


def level_mean(df: DataFrame, keys: Sequence[str], level: str, value: str, levels: int = 5) -> DataFrame:
    """Mean of the first ``levels`` depth levels; null where one of them has no value."""
    mean = F.when(F.count(value) == levels, F.avg(value))
    return df.filter(F.col(level) < levels).groupBy(*keys).agg(mean.alias(value))


def cell_log(df: DataFrame, value: str) -> DataFrame:
    return df.withColumn(value, F.when(F.col(value) > 0, F.ln(value)))


def unify_nodata(df: DataFrame, product: str, value: str, nodata: Mapping[str, float], out: float | None = None) -> DataFrame:
    """One nodata value, or null, for the different ones of several products."""
    is_nodata = F.lit(False)
    for name, marker in nodata.items():
        is_nodata = is_nodata | ((F.col(product) == name) & (F.col(value) == marker))
    return df.withColumn(value, F.when(is_nodata, F.lit(out)).otherwise(F.col(value)))


def unpack(df: DataFrame, value: str, scale: float, offset: float = 0.0) -> DataFrame:
    """Packed numbers to measurements; negative ones are nodata."""
    return df.withColumn(value, F.when(F.col(value) >= 0, F.col(value) * scale + offset))


def valid_range(df: DataFrame, value: str, low: float = -40, high: float = 40) -> DataFrame:
    return df.withColumn(value, F.when(F.col(value).between(low, high), F.col(value)))


def mask_positive(df: DataFrame, value: str) -> DataFrame:
    return df.filter(F.col(value) > 0)


def mosaic(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """The last valid value of each cell."""
    last = F.max_by(value, F.struct(*order))
    return df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(last.alias(value))


def stack_bands(df: DataFrame, keys: Sequence[str], var: str, value: str, variables: Sequence[str]) -> DataFrame:
    """One column per variable for each cell."""
    bands = [F.max(F.when(F.col(var) == v, F.col(value))).alias(v) for v in variables]
    return df.groupBy(*keys).agg(*bands)


def wrap_lon(lon: Column) -> Column:
    """0 to 360 degrees to -180 to 180."""
    return F.pmod(lon + 180, F.lit(360.0)) - 180


def shift_columns(col: Column, n_cols: int) -> Column:
    """Column number that goes with :func:`wrap_lon` for a full circle."""
    return F.pmod(col + n_cols // 2, F.lit(n_cols))


def flip_rows(row: Column, n_rows: int) -> Column:
    return F.lit(n_rows - 1) - row


def clip(df: DataFrame, bbox: tuple[float, float, float, float], lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Cells whose centre lies in west, south, east, north."""
    west, south, east, north = bbox
    return df.filter(F.col(lon).between(west, east) & F.col(lat).between(south, north))


def coarsen(
    df: DataFrame, keys: Sequence[str], origin: tuple[float, float], xres: float, yres: float,
    value: str, lon: str = "lon", lat: str = "lat",
) -> DataFrame:
    """Target cells of ``xres`` by ``yres`` from a west-north origin, each with its nearest source value."""
    west, north = origin
    col = F.floor((F.col(lon) - west) / xres)
    row = F.floor((F.lit(north) - F.col(lat)) / yres)
    dx = F.col(lon) - (west + (col + 0.5) * xres)
    dy = F.col(lat) - (north - (row + 0.5) * yres)
    nearest = F.min_by(value, F.struct((dx * dx + dy * dy).alias("d"), F.col(lat), F.col(lon)))
    return df.groupBy(*keys, row.alias("row"), col.alias("col")).agg(nearest.alias(value))


def refine(df: DataFrame, factor: int, row: str = "row", col: str = "col") -> DataFrame:
    """Cells split into ``factor`` by ``factor`` cells of the same value, without a shuffle."""

    def split(name: str) -> Column:
        first = F.col(name) * factor
        return F.explode(F.sequence(first, first + (factor - 1)))

    return df.withColumn(row, split(row)).withColumn(col, split(col))


def regrid(
    df: DataFrame, keys: Sequence[str], origin: tuple[float, float], source: tuple[float, float],
    target: tuple[float, float], value: str, lon: str = "lon", lat: str = "lat",
) -> DataFrame:
    """Nearest neighbour to a coarser or finer grid of the same origin.

    A finer target cell takes the source cell that holds its centre: each source
    cell lists the target rows and columns whose centres it holds.
    """
    (xs, ys), (xt, yt) = source, target
    if xt >= xs and yt >= ys:
        return coarsen(df, keys, origin, xt, yt, value, lon, lat)
    west, north = origin

    def covered(start: Column, width: float, step: float) -> Column:
        first = F.ceil(start / step - 0.5)
        last = F.ceil((start + width) / step - 0.5) - 1
        return F.explode(F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>")))

    return (
        df.withColumn("row", covered(F.lit(north) - F.col(lat) - ys / 2, ys, yt))
        .withColumn("col", covered(F.col(lon) - west - xs / 2, xs, xt))
        .select(*keys, "row", "col", value)
    )


def polar_to_lonlat(x: Column, y: Column, hemisphere: str = "north") -> tuple[Column, Column]:
    """Polar stereographic metres to degrees.

    Inverse ellipsoidal formulas with a series for the latitude, as published
    for map projections (Snyder 1987, chapter 21 and equation 3-5).
    """
    sign = 1.0 if hemisphere == "north" else -1.0
    meridian = POLAR_NORTH_MERIDIAN if hemisphere == "north" else POLAR_SOUTH_MERIDIAN
    e2 = POLAR_ECCENTRICITY_SQUARED
    e = math.sqrt(e2)
    phi = math.radians(POLAR_TRUE_LATITUDE)
    sin_phi = math.sin(phi)
    t_true = math.tan(math.pi / 4 - phi / 2) / ((1 - e * sin_phi) / (1 + e * sin_phi)) ** (e / 2)
    m_true = math.cos(phi) / math.sqrt(1 - e2 * sin_phi**2)
    rho = F.sqrt(x * x + y * y)
    chi = math.pi / 2 - 2 * F.atan(rho * (t_true / (POLAR_AXIS * m_true)))
    series = (
        (e2 / 2 + 5 * e2**2 / 24 + e2**3 / 12, 2),
        (7 * e2**2 / 48 + 29 * e2**3 / 240, 4),
        (7 * e2**3 / 120, 6),
    )
    lat = chi
    for weight, multiple in series:
        lat = lat + weight * F.sin(chi * multiple)
    lon = F.degrees(F.atan2(x * sign, -y * sign)) * sign + meridian
    return wrap_lon(lon), F.degrees(lat) * sign


def band_index(step: Column, n_levels: int, level: Column) -> Column:
    """Band number of a level in a file of several steps."""
    return step * n_levels + level


def cell_coords(row: Column, col: Column, bounds: Column, n_rows: Column, n_cols: Column) -> tuple[Column, Column]:
    """Latitude and longitude of a cell's centre."""
    lat = bounds["north"] - (row + 0.5) * (bounds["north"] - bounds["south"]) / n_rows
    lon = bounds["west"] + (col + 0.5) * (bounds["east"] - bounds["west"]) / n_cols
    return lat, lon


def grid_slice(df: DataFrame, **equal) -> DataFrame:
    """Cells of one date, level or band; partition columns prune the scan."""
    for name, value in equal.items():
        df = df.filter(F.col(name) == value)
    return df


def trim_tail(df: DataFrame, keys: Sequence[str], step: str, n: int = 1) -> DataFrame:
    """Leave out the last ``n`` steps of each run."""
    rank = Window.partitionBy(*keys).orderBy(F.desc(step))
    tail = df.select(*keys, step).distinct().withColumn("_rank", F.row_number().over(rank))
    return df.join(tail.filter(F.col("_rank") > n).drop("_rank"), [*keys, step], "left_semi")


def grid_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min(value).alias("min"), F.max(value).alias("max"),
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("stddev"),
    )


def overview(df: DataFrame, keys: Sequence[str], factor: int, value: str, policy: str = "MEAN") -> DataFrame:
    """Blocks of ``factor`` by ``factor`` cells as one cell.

    ``MODE`` takes the most frequent value, the smallest of several; ``SAMPLE``
    the upper left cell that has a value.
    """
    block = [F.floor(F.col(c) / factor).alias(c) for c in ("row", "col")]
    if policy == "MEAN":
        return df.groupBy(*keys, *block).agg(F.avg(value).alias(value))
    if policy == "SAMPLE":
        first = F.min_by(value, F.struct("row", "col"))
        return df.filter(F.col(value).isNotNull()).groupBy(*keys, *block).agg(first.alias(value))
    if policy != "MODE":
        raise ValueError(f"unknown policy {policy}")
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, *block, value)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    best = F.max_by(value, F.struct("_n", (-F.col(value)).alias("_v")))
    return counts.groupBy(*keys, "row", "col").agg(best.alias(value))
