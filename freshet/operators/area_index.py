"""Point-in-area joins over an index of tiles.

An area is any number of polygons with holes (``parts``), and a point is inside
if a ray from it to larger x crosses the edges an odd number of times, or if it
lies on an edge.  The index keeps for each tile that an area touches only what
that tile needs:

* the edges that pass through the tile, cut to its row, not the whole outline;
* for all edges further on in the row, whether they are crossed an odd number of
  times at the tile's lower border, and the heights at which this changes.  Along
  a closed outline such heights cancel in pairs, so only the ends of the tile's
  own edges are left;
* nothing more for a tile that lies inside: its points need no test.

So a point is tested against a handful of edges, however long the outline is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import parts_edges

#: Points in a tile above which the tile's index is copied, and the points are dealt over the copies.
POINTS_PER_COPY = 1_000_000

EDGE = "struct<x1: double, y1: double, x2: double, y2: double>"


def _in_rows(areas: DataFrame, key: str, parts: str, tile: float) -> DataFrame:
    """One row per edge and row of tiles that it passes, with the tiles that it passes there."""
    edges = areas.select(F.col(key).alias("area"), F.explode(parts_edges(F.col(parts))).alias("edge"))
    edges = edges.select("area", "edge", F.least("edge.y1", "edge.y2").alias("low"), F.greatest("edge.y1", "edge.y2").alias("high"))
    edges = edges.filter("low IS NOT NULL AND edge.x1 IS NOT NULL AND edge.x2 IS NOT NULL")
    rows = F.explode(F.sequence(F.floor(F.col("low") / tile), F.floor(F.col("high") / tile)))
    cut = edges.withColumn("ty", rows)
    below, above = F.col("ty") * tile, (F.col("ty") + 1) * tile
    rise = F.nullif(F.col("edge.y2") - F.col("edge.y1"), F.lit(0.0))

    def at(y: Column) -> Column:
        return F.col("edge.x1") + (y - F.col("edge.y1")) * ((F.col("edge.x2") - F.col("edge.x1")) / rise)

    ends = [at(F.greatest("low", below)), at(F.least("high", above))]
    west, east = F.least("edge.x1", "edge.x2"), F.greatest("edge.x1", "edge.x2")
    # a little wider than the cut, so that rounding never leaves a tile out; one edge more changes no result
    spare = F.lit(tile * 1e-6)
    first = F.greatest(west, F.coalesce(F.least(*ends), west) - spare)
    last = F.least(east, F.coalesce(F.greatest(*ends), east) + spare)
    return cut.select(
        "area", "ty", "edge", "low", "high", below.alias("below"), above.alias("above"),
        F.floor(first / tile).alias("tx_first"), F.floor(last / tile).alias("tx_last"),
    )


def _odd_runs(starts: Column) -> Column:
    """Tiles that have an odd number of the starts to their right: runs between each two of them."""
    down = F.sort_array(starts, asc=False)
    runs = F.transform(
        F.sequence(F.lit(0), F.floor(F.size(down) / 2).cast("int") - 1),
        lambda i: F.struct(F.get(down, 2 * i + 1).alias("a"), (F.get(down, 2 * i) - 1).alias("b")),
    )
    tiles = F.transform(F.filter(runs, lambda r: r["a"] <= r["b"]), lambda r: F.sequence(r["a"], r["b"]))
    return F.when(F.size(down) >= 2, F.flatten(tiles)).otherwise(F.array().cast("array<bigint>"))


def tile_index(areas: DataFrame, key: str, parts: str, tile: float) -> DataFrame:
    """One row per area and tile: ``area``, ``tx``, ``ty``, ``edges``, ``turns`` and ``inside``.

    ``edges`` are those that pass the tile, ``inside`` tells whether the edges
    further right are crossed an odd number of times at the lower border, and
    ``turns`` are the heights above it where that changes.  A tile without edges
    is inside as a whole; tiles outside are not listed.  Rows with the same key
    make up one area; null keys, areas without parts and edges without numbers
    are left out.
    """
    passed = _in_rows(areas.filter(F.col(key).isNotNull()), key, parts, tile)
    near = passed.select("area", "ty", F.explode(F.sequence("tx_first", "tx_last")).alias("tx"), "edge")
    ends = passed.filter("low < high").select(
        "area", "ty", "tx_first", F.explode(F.array("low", "high")).alias("y"), "below", "above"
    )
    turns = (
        ends.filter("below < y AND y < above").groupBy("area", "ty", "y").agg(F.collect_list("tx_first").alias("starts"))
        .select("area", "ty", F.explode(_odd_runs(F.col("starts"))).alias("tx"), "y")
    )
    level = (
        passed.filter("low <= below AND below < high").groupBy("area", "ty").agg(F.collect_list("tx_first").alias("starts"))
        .select("area", "ty", F.explode(_odd_runs(F.col("starts"))).alias("tx"))
    )
    none = {"edge": F.lit(None).cast(EDGE), "y": F.lit(None).cast("double"), "level": F.lit(None).cast("boolean")}

    def row(df: DataFrame, **own: Column) -> DataFrame:
        return df.select("area", "tx", "ty", *[c.alias(n) for n, c in {**none, **own}.items()])

    stacked = row(near, edge=F.col("edge")).unionByName(row(turns, y=F.col("y"))).unionByName(row(level, level=F.lit(True)))
    return stacked.groupBy("area", "tx", "ty").agg(
        F.collect_list("edge").alias("edges"), F.collect_list("y").alias("turns"),
        F.coalesce(F.bool_or("level"), F.lit(False)).alias("inside"),
    )


def _holds(x: Column, y: Column) -> Column:
    """Whether the area of an index row holds a point of its tile."""
    edges = F.col("edges")

    def crossed(e: Column) -> Column:
        at = e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0))
        return F.coalesce(((e["y1"] > y) != (e["y2"] > y)) & (x < at), F.lit(False))

    def touched(e: Column) -> Column:
        cross = (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
        between = x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        return (cross == 0) & between & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))

    times = F.size(F.filter(edges, crossed)) + F.size(F.filter("turns", lambda t: t <= y)) + F.col("inside").cast("int")
    return (F.size(edges) == 0) | (times % 2 == 1) | F.exists(edges, touched)


def points_in_areas(
    points: DataFrame, areas: DataFrame, key: str, x: str = "lon", y: str = "lat", parts: str = "parts",
    tile: float = 1.0, points_per_copy: int = POINTS_PER_COPY,
) -> DataFrame:
    """Each point with the key of each area that holds it; edges belong to the area.

    ``areas`` has ``key`` and ``parts``, a list of polygons of which the further
    rings are holes.  Points without both coordinates lie nowhere.  Points meet
    the tile that holds them by equality; a tile with many points is copied as
    often as the counted points need, and its points are dealt over the copies.
    A point lies in one tile, so no pair is found twice.
    """
    if key in points.columns:
        raise ValueError(f"points have a column {key}")
    index = tile_index(areas, key, parts, tile)
    placed = points.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.struct(*points.columns).alias("point"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")
    )
    placed = placed.withColumns({"tx": F.floor(F.col("x") / tile), "ty": F.floor(F.col("y") / tile)})
    hot = placed.groupBy("tx", "ty").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > points_per_copy)
    hot = hot.select("tx", "ty", F.ceil(F.col("n") / points_per_copy).cast("int").alias("copies"))
    copies = F.coalesce("copies", F.lit(1))
    dealt = placed.join(hot, ["tx", "ty"], "left").withColumn("copy", F.pmod(F.xxhash64("point"), copies).cast("int")).drop("copies")
    copied = index.join(hot, ["tx", "ty"], "left").withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1))).drop("copies")
    found = dealt.join(copied, ["tx", "ty", "copy"]).filter(_holds(F.col("x"), F.col("y")))
    return found.select(*[F.col("point")[c].alias(c) for c in points.columns], F.col("area").alias(key))
