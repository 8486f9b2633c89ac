"""JSON, GeoJSON and XML documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import POINT
from .json_blocks import read_geojson_document, read_json_document


def read_json_records(
    spark: SparkSession, path: str, schema: T.StructType | str, records_path: str = "data",
    multi_line: bool = True,
) -> DataFrame:
    """One row per object in the array at ``records_path``.

    ``schema`` describes one record.  ``records_path`` may be dotted.  A document
    may span lines and is read by many tasks, see :mod:`json_blocks`.  With
    ``multi_line=False`` each line is a document.
    """
    if multi_line:
        return read_json_document(spark, path, schema, records_path)
    record = schema if isinstance(schema, str) else schema.simpleString()
    record = record if record.startswith("struct<") else f"struct<{record}>"
    parts = records_path.split(".")
    ddl = f"array<{record}>"
    for name in reversed(parts[1:]):
        ddl = f"struct<{name}: {ddl}>"
    df = spark.read.schema(f"{parts[0]} {ddl}").json(path)
    return df.select(F.explode(records_path).alias("record")).select("record.*")


def read_geojson(
    spark: SparkSession, path: str, prop_schema: str, geometry_schema: str = POINT,
    multi_line: bool = True,
) -> DataFrame:
    """Features of collections: properties, ``geometry``, file and position in the file.

    A collection may span lines and is read by many tasks.  With
    ``multi_line=False`` each line is a collection, and positions count within it.
    """
    if multi_line:
        return read_geojson_document(spark, path, prop_schema, geometry_schema)
    feature = f"struct<geometry: {geometry_schema}, properties: struct<{prop_schema}>>"
    df = (
        spark.read.schema(f"features array<{feature}>")
        .json(path)
        .select("features", F.col("_metadata.file_name").alias("file"))
    )
    return df.select("file", F.posexplode("features").alias("position", "feature")).select(
        "file", "position", "feature.properties.*", F.col("feature.geometry").alias("geometry")
    )


def read_xml_records(
    spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str
) -> DataFrame:
    """One row per ``row_tag`` element; elements of namespaces match by local name."""
    return (
        spark.read.format("xml")
        .schema(schema)
        .option("rowTag", row_tag)
        .option("ignoreNamespace", True)
        .load(path)
    )
