"""Areas of many parts, and large documents read by many tasks."""

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from ..functions.geometry import ANY, area_parts, parts_geojson, parts_perimeter
from ..operators.area_index import points_in_areas
from ..operators.spatial import count_in_areas
from ..runtime import shared_dir
from ..sources import documents, json_blocks
from .joining import _places
from .registry import query, table


def _box(x, y, width, height):
    corners = [(0, 0), (width, 0), (width, height), (0, height), (0, 0)]
    return F.array(*[F.array(x + float(a), y + float(b)) for a, b in corners])


def _two_parts(nation):
    """For each nation a box with a hole and a smaller box apart from it."""
    x = F.pmod(F.col("n_nationkey") * 37, F.lit(80)).cast("double")
    y = F.pmod(F.col("n_nationkey") * 53, F.lit(80)).cast("double")
    parts = F.array(F.array(_box(x, y, 8, 8), _box(x + 2, y + 2, 3, 3)), F.array(_box(x + 10, y, 3, 4)))
    return nation.select(F.col("n_name").alias("area"), parts.alias("parts"))


def _landed_areas(spark, sf_dir):
    """The areas written as features, one collection per line, and read again."""
    feature = F.to_json(F.struct(F.col("area").alias("name")))
    text = F.concat(
        F.lit('{"type":"FeatureCollection","features":[{"type":"Feature","properties":'), feature, F.lit(',"geometry":'),
        parts_geojson(F.col("parts")), F.lit("}]}"),
    )
    path = shared_dir(spark, "areas")
    _two_parts(table(spark, sf_dir, "nation")).select(text.alias("value")).write.text(path)
    read = documents.read_geojson(spark, path, "name string", ANY, multi_line=False)
    return read.select(F.col("name").alias("area"), area_parts(F.col("geometry")).alias("parts"))


@query("""
WITH p AS (SELECT event_id, event_type, (user_id * 7 + event_id) % 100 AS lon, (user_id * 11 + event_id * 3) % 100 AS lat FROM events),
a AS (SELECT n_name AS area, (n_nationkey * 37) % 80 AS x, (n_nationkey * 53) % 80 AS y FROM nation)
SELECT area, event_type, count(*) AS n FROM p JOIN a
  ON (lon BETWEEN x AND x + 8 AND lat BETWEEN y AND y + 8 AND NOT (lon > x + 2 AND lon < x + 5 AND lat > y + 2 AND lat < y + 5))
  OR (lon BETWEEN x + 10 AND x + 13 AND lat BETWEEN y AND y + 4)
GROUP BY 1, 2
""")
def events_in_multi_areas(spark, sf_dir):
    """Events per area of two parts, one of them with a hole."""
    pairs = points_in_areas(_places(table(spark, sf_dir, "events")), _landed_areas(spark, sf_dir), "area", tile=4.0)
    return count_in_areas(pairs, ["area", "event_type"])


@query("SELECT n_name AS area, 58.0::DOUBLE AS perimeter, 2 AS parts, 3 AS rings FROM nation")
def multi_perimeters(spark, sf_dir):
    areas = _landed_areas(spark, sf_dir)
    return areas.select("area", parts_perimeter(F.col("parts")).alias("perimeter"), F.size("parts").alias("parts"), F.size(F.flatten("parts")).alias("rings"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of each batch as one compressed text, with the first and last place."""
    for batch in batches:
        if batch.num_rows:
            at, text = batch.column("at"), " ".join(v or "" for v in batch.column("value").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [at.slice(0, 1), at.slice(batch.num_rows - 1, 1), pa.array([zlib.compress(text.encode(), 1)], pa.binary())],
                ["first", "last", "packed"],
            )


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packed in batch.column("packed"):
            yield pa.RecordBatch.from_arrays([pa.array([zlib.decompress(packed.as_py()).decode()], pa.string())], ["value"])


def _one_document(spark, records, order, head, tail, label):
    """Records as one file with one document on one line; the first element, null, is no record.

    One file has one writer, so the last step runs in one task.  Records are
    sorted and packed by many tasks before; the writer sorts packed blocks only.
    """
    lines = records.select(F.col(order).cast("bigint").alias("at"), F.concat(F.lit(","), "text").alias("value"))
    ends = spark.createDataFrame([(-1, head + "[null"), (2**62, "]" + tail)], "at bigint, value string")
    path = shared_dir(spark, label)
    blocks = lines.unionByName(ends).repartitionByRange("at").sortWithinPartitions("at").mapInArrow(
        _packed, "first bigint, last bigint, packed binary"
    )
    whole = blocks.repartition(1).sortWithinPartitions("first", "last").mapInArrow(_unpacked, "value string")
    whole.write.option("lineSep", " ").text(path)
    return path


@query("""
SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, CAST(sum(length(event_type) + 17) AS BIGINT) AS chars,
  CAST(sum(event_id % 4) AS BIGINT) AS parts FROM events GROUP BY 1
""")
def json_one_document(spark, sf_dir):
    """Records with braces, quotes and backslashes in their texts, beside other arrays of the same name."""
    note = F.concat(F.lit('}],"data":[{\\" }'), "event_type", F.lit("\\"))
    parts = F.transform(F.sequence(F.lit(0), (F.col("event_id") % 4).cast("int")), lambda i: F.struct(i.alias("i")))
    text = F.to_json(F.struct("event_id", note.alias("note"), F.struct(parts.alias("data")).alias("more"), "event_type"))
    head, tail = '{"page":{"data":[{"event_id":-1}]},"data":', ',"errors":[{"event_id":-2}]}'
    events = table(spark, sf_dir, "events").select("event_id", text.alias("text"))
    path = _one_document(spark, events, "event_id", head, tail, "document")
    rows = json_blocks.read_json_document(
        spark, path, "event_id bigint, note string, event_type string, more struct<data: array<struct<i: int>>>"
    )
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"), F.sum(F.length("note")).alias("chars"),
        F.sum(F.size("more.data") - 1).alias("parts"),
    )


@query("""
SELECT user_id, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, CAST(sum(event_id % 3 + 1) AS BIGINT) AS parts, max(place) AS last_position
FROM (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS place FROM events) GROUP BY 1
""")
def geojson_one_document(spark, sf_dir):
    """One collection with all events as areas of one to three parts."""
    lon = F.col("user_id").cast("double")
    parts = F.transform(F.sequence(F.lit(0), (F.col("event_id") % 3).cast("int")), lambda i: F.array(_box(lon + i * 2, F.lit(0.0), 1, 1)))
    text = F.concat(
        F.lit('{"type":"Feature","geometry":'), parts_geojson(parts), F.lit(',"properties":'), F.to_json(F.struct("event_id", "user_id")), F.lit("}")
    )
    events = table(spark, sf_dir, "events").select("event_id", text.alias("text"))
    path = _one_document(spark, events, "event_id", '{"type":"FeatureCollection","features":', "}", "collection")
    rows = json_blocks.read_geojson_document(spark, path, "event_id bigint, user_id bigint")
    return rows.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"), F.sum(F.size(area_parts(F.col("geometry")))).alias("parts"),
        F.max("position").alias("last_position"),
    )
