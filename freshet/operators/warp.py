"""Grids of any projection on each other, and all overviews of a grid at once."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..runtime import durable

EARTH_KM = 6371.0
#: Halvings of the bucket size between two rounds.
BITS = 2
#: Bits of a row or column number in a Z-order key.
KEY_BITS = 31


@dataclass
class Grid:
    """A regular grid in degrees, row 0 in the north."""

    west: float
    north: float
    xres: float
    yres: float
    n_rows: int
    n_cols: int


def _on_sphere(lon: Column, lat: Column) -> dict[str, Column]:
    """Coordinates on the unit sphere; straight distances order places as distances along the ground do."""
    a, b = F.radians(lon), F.radians(lat)
    return {"x": F.cos(b) * F.cos(a), "y": F.cos(b) * F.sin(a), "z": F.sin(b)}


def _parents(level: int, name: str) -> tuple[Column, Column]:
    """A place's cube at a level, and the cube BITS levels above it, as one number each."""

    def number(at: int) -> Column:
        x, y, z = (F.least(F.floor((F.col(c) + 1) / (2 / 2**at)), F.lit(2**at - 1)) for c in "xyz")
        return (x * 2**at + y) * 2**at + z

    return number(level).alias(name), number(level - BITS).alias(f"{name}_up")


def _gap(level: int, beyond: bool) -> Column:
    """Squared distance of the nearest, or the farthest, places of two cubes, in cube sides."""

    def axis(a: Column, b: Column) -> Column:
        apart = F.abs(a - b)
        apart = apart + 1 if beyond else F.greatest(apart - 1, F.lit(0))
        return apart * apart

    side = 2**level

    def parts(c: Column) -> list[Column]:
        return [F.floor(c / (side * side)), F.floor(c / side) % side, c % side]

    return reduce(lambda x, y: x + y, [axis(a, b) for a, b in zip(parts(F.col("t")), parts(F.col("s")), strict=True)])


def nearest_places(targets: DataFrame, sources: DataFrame, spacing: float) -> DataFrame:
    """For each target (``t_row``, ``t_col``) the nearest source (``s_row``, ``s_col``) on the sphere, and ``km``.

    Both have ``lon`` and ``lat``.  Cubes of places are compared from large to
    small: for each target cube, source cubes that lie farther than the farthest
    place of another one are left out, and only the cubes of the rest are looked
    at in the next round.  The last cubes are about ``spacing`` degrees wide, so a
    target meets the few sources around it, however far away they are and however
    the grids lie.  Of equally near sources the one with the smallest row and
    column is taken.  Places without coordinates are left out; without sources
    there are no rows.
    """
    levels = max(BITS, BITS * math.ceil(math.log2(2 / math.radians(spacing)) / BITS))

    def placed(df: DataFrame, p: str) -> DataFrame:
        known = df.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull())
        return known.select(f"{p}_row", f"{p}_col", *[c.alias(n) for n, c in _on_sphere(F.col("lon"), F.col("lat")).items()])

    t, s = durable(placed(targets, "t"), "targets"), durable(placed(sources, "s"), "sources")
    pairs = None
    for level in range(BITS, levels + 1, BITS):
        t_cubes, s_cubes = (df.select(*_parents(level, p)).distinct() for df, p in ((t, "t"), (s, "s")))
        if pairs is None:
            pairs = t_cubes.join(s_cubes, F.col("t_up") == F.col("s_up")).select("t", "s")
        else:
            up = pairs.select(F.col("t").alias("t_up"), F.col("s").alias("s_up"))
            pairs = up.join(t_cubes, "t_up").join(s_cubes, "s_up").select("t", "s")
        reach = F.min(_gap(level, True)).over(Window.partitionBy("t"))
        pairs = pairs.withColumn("reach", reach).filter(_gap(level, False) <= F.col("reach")).select("t", "s")
        pairs = durable(pairs, "cubes")
    place = [_parents(levels, "t")[0], _parents(levels, "s")[0]]
    near = t.select("t_row", "t_col", *[F.col(c).alias(f"t{c}") for c in "xyz"], place[0]).join(pairs, "t")
    near = near.join(s.select("s_row", "s_col", *[F.col(c).alias(f"s{c}") for c in "xyz"], place[1]), "s")
    apart = reduce(lambda a, b: a + b, [(F.col(f"t{c}") - F.col(f"s{c}")) * (F.col(f"t{c}") - F.col(f"s{c}")) for c in "xyz"])
    first = F.min(F.struct(apart.alias("d"), "s_row", "s_col")).alias("first")
    found = near.groupBy("t_row", "t_col").agg(first)
    km = 2 * EARTH_KM * F.asin(F.least(F.sqrt(F.col("first.d")) / 2, F.lit(1.0)))
    return found.select("t_row", "t_col", F.col("first.s_row").alias("s_row"), F.col("first.s_col").alias("s_col"), km.alias("km"))


def grid_places(spark, grid: Grid) -> DataFrame:
    """Row, column and centre of every cell of a grid."""
    cells = spark.range(grid.n_rows * grid.n_cols)
    row, col = F.floor(F.col("id") / grid.n_cols), F.col("id") % grid.n_cols
    return cells.select(row.alias("t_row"), col.alias("t_col")).select(
        "t_row", "t_col", (grid.west + (F.col("t_col") + 0.5) * grid.xres).alias("lon"), (grid.north - (F.col("t_row") + 0.5) * grid.yres).alias("lat")
    )


def warp(
    df: DataFrame, keys: Sequence[str], value: str, grid: Grid, spacing: float, places: DataFrame | None = None,
    max_km: float | None = None,
) -> DataFrame:
    """Nearest source value of every cell of ``grid``, for each of the ``keys``.

    ``df`` has ``row``, ``col``, ``lon``, ``lat`` and ``value`` of the source
    cells, in any projection; ``spacing`` is about the distance of its cells in
    degrees.  Which source cell a target cell takes is worked out once for the
    places, which may be given as (row, col, lon, lat), and not for each key.  No
    target cell stays empty, unless its nearest place is farther than ``max_km`` or
    the source has no row for it there.
    """
    places = df.select("row", "col", "lon", "lat").distinct() if places is None else places
    sources = places.select(F.col("row").alias("s_row"), F.col("col").alias("s_col"), "lon", "lat")
    near = nearest_places(grid_places(df.sparkSession, grid), sources, spacing)
    if max_km is not None:
        near = near.filter(F.col("km") <= max_km)
    values = df.select(*keys, F.col("row").alias("s_row"), F.col("col").alias("s_col"), value)
    return values.join(near, ["s_row", "s_col"]).select(*keys, F.col("t_row").alias("row"), F.col("t_col").alias("col"), value)


def z_order(row: Column, col: Column, bits: int = KEY_BITS) -> Column:
    """Bits of row and column in turn; a cell's parent is its key without the last two bits."""
    row, col = row.cast("bigint"), col.cast("bigint")

    def spread(n: Column, by: int) -> Column:
        return reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(F.shiftright(n, i).bitwiseAND(F.lit(1)), 2 * i + by) for i in range(bits)])

    return spread(row, 1).bitwiseOR(spread(col, 0))


def from_z_order(key: Column, bits: int = KEY_BITS) -> tuple[Column, Column]:
    """Row and column of a key."""

    def gather(by: int) -> Column:
        return reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(F.shiftright(key, 2 * i + by).bitwiseAND(F.lit(1)), i) for i in range(bits)])

    return gather(1), gather(0)


def pyramid(df: DataFrame, keys: Sequence[str], value: str, levels: int, policy: str = "MEAN", bits: int = 24) -> DataFrame:
    """Overviews of 2, 4, … 2**levels cells a side: ``keys``, ``level``, ``row``, ``col`` and the value.

    The cells are read once.  They are added up to the first level, and its
    states to all further ones with one aggregation over grouping sets of key
    prefixes.  ``MEAN`` is the mean of all cells with a value, ``MODE`` the most
    frequent value, the smallest of several, ``SAMPLE`` the first cell in Z order
    that has a value.  Cells without a value do not count; a block without any is
    not listed.  Rows and columns are below 2**bits.
    """
    if policy not in ("MEAN", "MODE", "SAMPLE"):
        raise ValueError(f"unknown policy {policy}")
    cells = df.filter(F.col(value).isNotNull()).withColumn("_z", z_order(F.col("row"), F.col("col"), bits))
    first = [*keys, F.shiftright("_z", 2).alias("_z1")]
    if policy == "MEAN":
        base = cells.groupBy(*first).agg(F.sum(value).alias("_a"), F.count(value).alias("_b"))
        combine = [F.sum("_a").alias("_a"), F.sum("_b").alias("_b")]
    elif policy == "MODE":
        base = cells.groupBy(*first, F.col(value).alias("_a")).agg(F.count(F.lit(1)).alias("_b"))
        combine = [F.sum("_b").alias("_b")]
    else:
        base = cells.groupBy(*first).agg(F.min_by(value, "_z").alias("_a"), F.min("_z").alias("_b"))
        combine = [F.min_by("_a", "_b").alias("_a")]
    names = [f"_z{i}" for i in range(1, levels + 1)]
    base = base.withColumns({f"_z{i}": F.shiftright("_z1", 2 * (i - 1)) for i in range(2, levels + 1)})
    also = [*keys, "_a"] if policy == "MODE" else list(keys)
    level = F.coalesce(*[F.when(F.col(n).isNotNull(), F.lit(i)) for i, n in enumerate(names, 1)])
    sets = base.groupingSets([[*also, n] for n in names], *also, *names).agg(*combine)
    states = sets.select(*also, level.alias("level"), F.coalesce(*names).alias("_z"), *[c for c in ("_a", "_b") if c in sets.columns and c not in also])
    if policy == "MEAN":
        states = states.withColumn("_a", F.col("_a") / F.col("_b"))
    elif policy == "MODE":
        best = F.max_by("_a", F.struct("_b", (-F.col("_a")).alias("less")))
        states = states.groupBy(*keys, "level", "_z").agg(best.alias("_a"))
    row, col = from_z_order(F.col("_z"), bits)
    return states.select(*keys, "level", row.alias("row"), col.alias("col"), F.col("_a").alias(value))
