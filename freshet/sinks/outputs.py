"""Partitioned folders, versions and CSV exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import durable


def route(df: DataFrame, by: str, path: str, mode: str = "append") -> None:
    """One folder per parameter in a single pass.

    Rows are gathered by parameter; the adaptive planner splits a frequent
    parameter over many tasks and puts rare ones together.
    """
    df.hint("rebalance", F.col(by)).write.mode(mode).partitionBy(by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace only the partitions that ``df`` has rows for."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)


def upsert_partitions(spark: SparkSession, path: str, df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> None:
    """Upsert that rewrites only the partitions with new rows; keys do not change partition."""
    fresh = durable(df, "upsert")
    old = spark.read.schema(df.schema).parquet(path)
    touched = old.join(fresh.select(*by).distinct(), list(by), "left_semi")
    kept = touched.join(fresh.select(*keys), list(keys), "left_anti")
    merged = durable(kept.select(*df.columns).unionByName(fresh), "merged")
    overwrite_partitions(merged, path, by)


def clear_collection(rows: DataFrame, collection: str, value: str) -> DataFrame:
    """All rows but those of one collection."""
    return rows.filter(~F.col(collection).eqNullSafe(F.lit(value)))


def drop_partition(spark: SparkSession, table: str, **partition: str) -> None:
    """Drop a collection's partition of a catalogue table."""
    spec = ", ".join(f"{k} = '{v}'" for k, v in partition.items())
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def write_version(df: DataFrame, base: str, version: str) -> None:
    """A snapshot under ``v=<version>``; the version is a column when ``base`` is read."""
    df.write.mode("overwrite").parquet(f"{base.rstrip('/')}/v={version}")


def export_csv(df: DataFrame, path: str) -> None:
    """Compressed CSV with a header, one file per task."""
    df.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)
