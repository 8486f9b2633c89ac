"""Grid operators.

Embeddings are read as grids of 8 by 8 cells, one grid per vector, and events as
hourly grids whose cell follows from the user.  Values are whole numbers of
millionths, or of hundredths for events, so that sums are exact.
"""

from pyspark.sql import functions as F

from ..functions.units import fixed
from ..operators import grid
from ..operators.warp import Grid, pyramid, warp
from ..sources.grids import grid_to_cells, levels_to_cells
from .registry import day_text, query, table

CELLS_SQL = """
SELECT vec_id, label, CAST(i // 8 AS INTEGER) AS row, CAST(i % 8 AS INTEGER) AS col,
       CAST(round(CAST(embedding[i + 1] AS DOUBLE) * 1000000) AS BIGINT) AS v
FROM embeddings, range(64) t(i)
"""


def _grids(spark, sf_dir):
    """Grid arrays with bounds, row 0 in the north."""
    lines = F.transform(
        F.sequence(F.lit(0), F.lit(7)),
        lambda r: F.transform(F.slice("embedding", r * 8 + 1, F.lit(8)), lambda v: v.cast("double")),
    )
    bounds = F.struct(
        F.lit(0.0).alias("west"), F.lit(-60.0).alias("south"), F.lit(360.0).alias("east"), F.lit(60.0).alias("north")
    )
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", lines.alias("grid"), bounds.alias("bounds"))


def _cells(spark, sf_dir):
    cells = grid_to_cells(_grids(spark, sf_dir), "grid")
    return cells.withColumn("v", fixed("value", 6)).drop("value")


@query(f"""
SELECT vec_id, row, col, 52.5::DOUBLE - row * 15 AS lat, 22.5::DOUBLE + col * 45 AS lon,
       CASE WHEN col < 4 THEN 22.5::DOUBLE + col * 45 ELSE 22.5::DOUBLE + col * 45 - 360 END AS wrapped,
       CAST((col + 4) % 8 AS INTEGER) AS shifted, CAST(7 - row AS INTEGER) AS flipped, v FROM ({CELLS_SQL})
""")
def grid_cells(spark, sf_dir):
    return _cells(spark, sf_dir).select(
        "vec_id", "row", "col", "lat", "lon", grid.wrap_lon(F.col("lon")).alias("wrapped"),
        grid.shift_columns(F.col("col"), 8).alias("shifted"), grid.flip_rows(F.col("row"), 8).alias("flipped"), "v",
    )


EVENT_CELLS_SQL = """
SELECT CASE event_type WHEN 'click' THEN 'NO2' WHEN 'view' THEN 'O3' ELSE 'PM25_RH35_GCC' END AS var,
       CAST(ts + INTERVAL 12 HOUR AS DATE) AS day, CAST(user_id % 4 AS INTEGER) AS row, CAST(user_id % 3 AS INTEGER) AS col,
       CAST(round(value * 100) AS BIGINT) AS v, event_id, user_id FROM events
"""


def _event_cells(spark, sf_dir):
    var = F.when(F.col("event_type") == "click", "NO2").when(F.col("event_type") == "view", "O3")
    return table(spark, sf_dir, "events").select(
        var.otherwise("PM25_RH35_GCC").alias("var"),
        (F.col("ts") + F.expr("INTERVAL 12 HOURS")).cast("date").alias("day"),
        (F.col("user_id") % 4).cast("int").alias("row"), (F.col("user_id") % 3).cast("int").alias("col"),
        fixed("value").alias("v"), "event_id", "user_id",
    )


@query(f"""
SELECT var, strftime(day, '%Y-%m-%d') AS day, row, col,
       CASE var WHEN 'NO2' THEN sum(v)::DOUBLE / count(*) * 1000000000.0::DOUBLE WHEN 'O3' THEN max(v)::DOUBLE * 1000000000.0::DOUBLE
       ELSE sum(v)::DOUBLE / count(*) * 1.0::DOUBLE END AS v
FROM ({EVENT_CELLS_SQL}) GROUP BY var, day, row, col
""")
def grid_metrics(spark, sf_dir):
    out = grid.apply_metric(_event_cells(spark, sf_dir), ["day", "row", "col"], "var", "v")
    return out.withColumn("day", day_text("day"))


@query(f"""
SELECT 'mean' AS metric, row, col, CASE WHEN count(*) FILTER (label <> 3) = count(*) THEN sum(v)::DOUBLE / count(*) * 2.0::DOUBLE END AS v
FROM ({CELLS_SQL}) GROUP BY row, col
UNION ALL
SELECT 'max' AS metric, row, col, max(v)::DOUBLE * 2.0::DOUBLE AS v FROM ({CELLS_SQL}) WHERE label <> 3 GROUP BY row, col
UNION ALL
SELECT 'fixed' AS metric, row, col, sum(v)::DOUBLE / (SELECT count(*) FROM embeddings) * 1.0::DOUBLE AS v FROM ({CELLS_SQL}) GROUP BY row, col
""")
def grid_mean_max(spark, sf_dir):
    """A cell without a value in one file has no mean."""
    cells = _cells(spark, sf_dir)
    holed = cells.withColumn("v", F.when(F.col("label") != 3, F.col("v")))
    n_files = table(spark, sf_dir, "embeddings").select(F.count(F.lit(1))).scalar()
    parts = {
        "mean": grid.cell_mean(holed, ["row", "col"], "v", 2.0),
        "max": grid.cell_max(holed, ["row", "col"], "v", 2.0),
        "fixed": grid.cell_mean(cells, ["row", "col"], "v", 1.0, n_files),
    }
    frames = [df.select(F.lit(name).alias("metric"), "row", "col", "v") for name, df in parts.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(f"""
SELECT vec_id, col, avg(v) AS v FROM ({CELLS_SQL}) WHERE row < 5 GROUP BY vec_id, col
""")
def grid_level_mean(spark, sf_dir):
    """Rows stand for depth levels."""
    return grid.level_mean(_cells(spark, sf_dir), ["vec_id", "col"], "row", "v", 5)


@query(f"""
SELECT vec_id, row, col, CASE WHEN v > 0 THEN round(ln(v), 8) END AS logged,
       CASE WHEN (label = 1 AND v % 5 = 1) OR (label = 2 AND v % 5 = 2) THEN -32768 ELSE v % 5 END AS unified,
       CASE WHEN v >= 0 THEN v * 0.01::DOUBLE + 2.0::DOUBLE END AS unpacked,
       CASE WHEN v BETWEEN -40000 AND 40000 THEN v END AS valid
FROM ({CELLS_SQL})
""")
def grid_cell_values(spark, sf_dir):
    cells = _cells(spark, sf_dir).withColumns(
        {"logged": F.col("v"), "unpacked": F.col("v"), "valid": F.col("v"), "unified": F.expr("v % 5"),
         "product": F.col("label").cast("string")}
    )
    cells = grid.cell_log(cells, "logged")
    cells = grid.unify_nodata(cells, "product", "unified", {"1": 1, "2": 2}, -32768)
    cells = grid.valid_range(grid.unpack(cells, "unpacked", 0.01, 2.0), "valid", -40000, 40000)
    return cells.select(
        "vec_id", "row", "col", F.round("logged", 8).alias("logged"), F.col("unified").cast("bigint").alias("unified"),
        "unpacked", "valid",
    )


@query(f"""
SELECT label, row, col, v FROM (
  SELECT *, row_number() OVER (PARTITION BY label, row, col ORDER BY vec_id DESC) AS n FROM ({CELLS_SQL}) WHERE v % 3 <> 0)
WHERE n = 1 AND v > 0
""")
def grid_mosaic(spark, sf_dir):
    cells = _cells(spark, sf_dir).withColumn("v", F.when(F.col("v") % 3 != 0, F.col("v")))
    return grid.mask_positive(grid.mosaic(cells, ["label", "row", "col"], ["vec_id"], "v"), "v")


@query(f"""
SELECT strftime(day, '%Y-%m-%d') AS day, row, col, max(v) FILTER (var = 'NO2') AS NO2, max(v) FILTER (var = 'O3') AS O3
FROM (SELECT var, day, row, col, sum(v)::DOUBLE AS v FROM ({EVENT_CELLS_SQL}) GROUP BY 1, 2, 3, 4) GROUP BY day, row, col
""")
def grid_stack(spark, sf_dir):
    sums = _event_cells(spark, sf_dir).groupBy("var", "day", "row", "col").agg(
        F.sum("v").cast("double").alias("v")
    )
    stacked = grid.stack_bands(sums, ["day", "row", "col"], "var", "v", ["NO2", "O3"])
    return stacked.withColumn("day", day_text("day"))


@query(f"""
SELECT vec_id, CAST(row // 3 AS BIGINT) AS row, CAST(col // 3 AS BIGINT) AS col,
       first(v ORDER BY pow(22.5 + col * 45 - (col // 3 + 0.5) * 135, 2) + pow(52.5 - row * 15 - (60 - (row // 3 + 0.5) * 45), 2), -row, col) AS v
FROM ({CELLS_SQL}) GROUP BY vec_id, row // 3, col // 3
""")
def grid_regrid_coarser(spark, sf_dir):
    return grid.regrid(_cells(spark, sf_dir), ["vec_id"], (0.0, 60.0), (45.0, 15.0), (135.0, 45.0), "v")


@query(f"""
SELECT vec_id, CAST(r AS BIGINT) AS row, CAST(c AS BIGINT) AS col, v
FROM ({CELLS_SQL}), range(12) a(r), range(12) b(c)
WHERE CAST(floor((r + 0.5) * 10 / 15) AS BIGINT) = row AND CAST(floor((c + 0.5) * 30 / 45) AS BIGINT) = col
""")
def grid_regrid_finer(spark, sf_dir):
    """Two by two source cells give three by three target cells."""
    return grid.regrid(_cells(spark, sf_dir), ["vec_id"], (0.0, 60.0), (45.0, 15.0), (30.0, 10.0), "v")


@query(f"""
SELECT label, CAST(count(*) AS BIGINT) AS n, CAST(sum(v) AS BIGINT) AS total, CAST(max(row) AS INTEGER) AS max_row
FROM (SELECT label, row * 2 + a AS row, v FROM ({CELLS_SQL}), range(2) x(a), range(2) y(b)) GROUP BY label
""")
def grid_refined(spark, sf_dir):
    fine = grid.refine(_cells(spark, sf_dir), 2)
    return fine.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"), F.max("row").alias("max_row")
    )


@query(f"""
SELECT label, min(v) AS min, max(v) AS max, sum(v)::DOUBLE / count(*) AS mean, round(stddev_pop(v), 4) AS stddev
FROM ({CELLS_SQL}) WHERE 22.5 + col * 45 BETWEEN 60 AND 300 AND 52.5 - row * 15 BETWEEN -30 AND 60 GROUP BY label
""")
def grid_stats(spark, sf_dir):
    inside = grid.clip(_cells(spark, sf_dir), (60.0, -30.0, 300.0, 60.0))
    out = grid.grid_stats(inside, ["label"], "v")
    return out.withColumn("stddev", F.round("stddev", 4))


@query(f"""
WITH b AS (SELECT vec_id, CAST(row // 4 AS BIGINT) AS r, CAST(col // 4 AS BIGINT) AS c, row, col, v FROM ({CELLS_SQL})),
m AS (SELECT vec_id, r, c, v % 4 AS w, row_number() OVER (PARTITION BY vec_id, r, c ORDER BY count(*) DESC, v % 4) AS n
      FROM b GROUP BY vec_id, r, c, v % 4)
SELECT vec_id, r AS row, c AS col, sum(v)::DOUBLE / count(*) AS mean, any_value(w) AS mode, first(v ORDER BY row, col) AS sample
FROM b JOIN (SELECT * FROM m WHERE n = 1) USING (vec_id, r, c) GROUP BY vec_id, r, c
""")
def grid_overviews(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    mean = grid.overview(cells, ["vec_id"], 4, "v", "MEAN").withColumnRenamed("v", "mean")
    residues = cells.withColumn("v", F.col("v") % 4)
    mode = grid.overview(residues, ["vec_id"], 4, "v", "MODE").withColumnRenamed("v", "mode")
    sample = grid.overview(cells, ["vec_id"], 4, "v", "SAMPLE").withColumnRenamed("v", "sample")
    keys = ["vec_id", "row", "col"]
    return mean.join(mode, keys).join(sample, keys)


@query(f"""
SELECT vec_id, CAST(row // 4 AS INTEGER) AS step, CAST((row // 4) * 2 + (row // 2) % 2 AS INTEGER) AS band,
       CAST(sum(v) AS BIGINT) AS total
FROM ({CELLS_SQL}) WHERE row < 4 OR vec_id % 2 = 0 GROUP BY vec_id, row // 4, (row // 2) % 2
""")
def grid_bands(spark, sf_dir):
    """Grids as two steps of two levels; odd vectors lose their last step."""
    grids = _grids(spark, sf_dir)
    nested = F.transform(
        F.sequence(F.lit(0), F.lit(1)),
        lambda s: F.transform(F.sequence(F.lit(0), F.lit(1)), lambda z: F.slice("grid", s * 4 + z * 2 + 1, F.lit(2))),
    )
    cells = levels_to_cells(grids.withColumn("grid", nested), "grid")
    odd, even = cells.filter("vec_id % 2 = 1"), cells.filter("vec_id % 2 = 0")
    kept = grid.trim_tail(odd, ["vec_id"], "step").select(*even.columns).unionByName(even)
    band = grid.band_index(F.col("step"), 2, F.col("level"))
    return kept.groupBy("vec_id", "step", band.alias("band")).agg(F.sum(fixed("value", 6)).alias("total"))


@query(f"""
SELECT label, row, CAST(sum(v) AS BIGINT) AS total FROM ({CELLS_SQL}) WHERE label = 2 AND row = 3 GROUP BY 1, 2
""")
def grid_sliced(spark, sf_dir):
    return grid.grid_slice(_cells(spark, sf_dir), label=2, row=3).groupBy("label", "row").agg(
        F.sum("v").alias("total")
    )


POLAR_SQL = """
WITH p AS (SELECT event_id, (value - 100) * 20000 AS x, (user_id - 50.0::DOUBLE) * 30000 AS y FROM events),
k AS (SELECT 0.006693883::DOUBLE AS e2, sqrt(0.006693883::DOUBLE) AS e, radians(70.0::DOUBLE) AS phi),
c AS (SELECT e2, tan(pi() / 4 - phi / 2) / pow((1 - e * sin(phi)) / (1 + e * sin(phi)), e / 2) AS t,
             cos(phi) / sqrt(1 - e2 * pow(sin(phi), 2)) AS m FROM k),
h AS (SELECT event_id, x, y, e2, pi() / 2 - 2 * atan(sqrt(x * x + y * y) * t / (6378273.0::DOUBLE * m)) AS chi FROM p, c),
l AS (SELECT event_id, x, y, degrees(chi + (e2 / 2 + 5 * pow(e2, 2) / 24 + pow(e2, 3) / 12) * sin(2 * chi)
      + (7 * pow(e2, 2) / 48 + 29 * pow(e2, 3) / 240) * sin(4 * chi) + 7 * pow(e2, 3) / 120 * sin(6 * chi)) AS lat FROM h)
"""


@query(POLAR_SQL + """
SELECT event_id, round(lat, 6) AS north_lat, round(CASE WHEN degrees(atan2(x, -y)) - 45 < -180 THEN degrees(atan2(x, -y)) + 315
       ELSE degrees(atan2(x, -y)) - 45 END, 6) AS north_lon,
       round(-lat, 6) AS south_lat, round(degrees(atan2(x, y)), 6) AS south_lon
FROM l
""")
def polar_coordinates(spark, sf_dir):
    x, y = (F.col("value") - 100) * 20000, (F.col("user_id") - F.lit(50.0)) * 30000
    north_lon, north_lat = grid.polar_to_lonlat(x, y, "north")
    south_lon, south_lat = grid.polar_to_lonlat(x, y, "south")
    named = {"north_lat": north_lat, "north_lon": north_lon, "south_lat": south_lat, "south_lon": south_lon}
    return table(spark, sf_dir, "events").select("event_id", *[F.round(c, 6).alias(n) for n, c in named.items()])


_POLAR_CELLS_SQL = """
WITH p AS (SELECT i // 8 AS event_id, i, ((i % 8) - 3.5::DOUBLE) * 400000 + 13000 AS x, ((i // 8) - 3.5::DOUBLE) * 400000 - 27000 AS y FROM range(64) t(i)),
""" + POLAR_SQL.split("FROM events),", 1)[1].lstrip().replace("event_id, x, y", "i, x, y")


@query(_POLAR_CELLS_SQL + f""",
s AS (SELECT i, radians(degrees(atan2(x, -y)) - 45) AS a, radians(lat) AS b FROM l),
u AS (SELECT i, cos(b) * cos(a) AS x, cos(b) * sin(a) AS y, sin(b) AS z FROM s),
g AS (SELECT j // 16 AS row, j % 16 AS col, radians(-180 + (j % 16 + 0.5::DOUBLE) * 22.5) AS a, radians(89.37::DOUBLE - (j // 16 + 0.5::DOUBLE) * 6.1) AS b FROM range(80) t(j)),
n AS (SELECT g.row, g.col, u.i, row_number() OVER (PARTITION BY g.row, g.col
        ORDER BY pow(cos(b) * cos(a) - x, 2) + pow(cos(b) * sin(a) - y, 2) + pow(sin(b) - z, 2), u.i) AS k FROM g CROSS JOIN u)
SELECT vec_id, n.row, n.col, v FROM n JOIN ({CELLS_SQL}) c ON c.row = n.i // 8 AND c.col = n.i % 8 WHERE k = 1
""")
def polar_to_regular_grid(spark, sf_dir):
    """Polar cells of 400 km on degrees: every cell of the target takes the nearest one, also beyond the source."""
    x, y = (F.col("col") - 3.5) * 400000 + 13000, (F.col("row") - 3.5) * 400000 - 27000
    lon, lat = grid.polar_to_lonlat(x, y, "north")
    cells = _cells(spark, sf_dir).select("vec_id", "row", "col", lon.alias("lon"), lat.alias("lat"), "v")
    return warp(cells, ["vec_id"], "v", Grid(-180.0, 89.37, 22.5, 6.1, 5, 16), 4.0)


@query(f"""
WITH b AS (SELECT vec_id, level, row >> level AS r, col >> level AS c, v,
             ((row & 4) * 8 + (row & 2) * 4 + (row & 1) * 2) + ((col & 4) * 4 + (col & 2) * 2 + (col & 1)) AS z
           FROM ({CELLS_SQL}), (SELECT unnest([1, 2, 3])::INTEGER AS level)),
m AS (SELECT vec_id, level, r, c, v % 4 AS w, row_number() OVER (PARTITION BY vec_id, level, r, c ORDER BY count(*) DESC, v % 4) AS n
      FROM b GROUP BY vec_id, level, r, c, v % 4)
SELECT vec_id, level, CAST(r AS BIGINT) AS row, CAST(c AS BIGINT) AS col, sum(v)::DOUBLE / count(*) AS mean, any_value(w) AS mode, first(v ORDER BY z) AS sample
FROM b JOIN (SELECT * FROM m WHERE n = 1) USING (vec_id, level, r, c) GROUP BY vec_id, level, r, c
""")
def grid_pyramid(spark, sf_dir):
    """Three levels of overviews by each policy."""
    cells = _cells(spark, sf_dir)
    mean = pyramid(cells, ["vec_id"], "v", 3, "MEAN").withColumnRenamed("v", "mean")
    mode = pyramid(cells.withColumn("v", F.col("v") % 4), ["vec_id"], "v", 3, "MODE").withColumnRenamed("v", "mode")
    sample = pyramid(cells, ["vec_id"], "v", 3, "SAMPLE").withColumnRenamed("v", "sample")
    keys = ["vec_id", "level", "row", "col"]
    return mean.join(mode, keys).join(sample, keys)
