"""Tables, configuration files and dated file listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import one_per_key


def scan_splits(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The same rows in ``n`` parts, where a source came in fewer or very uneven ones."""
    return df.repartition(n, *keys)


def target_fields(
    spark: SparkSession,
    table: str,
    cols: Sequence[str],
    where: Column | str | None = None,
    order: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Columns of a target table; filter and column choice reach its scan."""
    df = spark.table(table)
    if where is not None:
        df = df.filter(where)
    df = df.select(*cols)
    return df.orderBy(*order) if order else df


def list_dated_files(spark: SparkSession, path: str, pattern: str, fmt: str) -> DataFrame:
    """Files with the date in their path; contents are not read."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    date = F.try_to_timestamp(F.regexp_extract("path", pattern, 1), F.lit(fmt)).cast("date")
    return files.withColumn("date", date).filter("date is not null")


def newest_file(files: DataFrame) -> DataFrame:
    """The file of the newest date; the last path in order where a date has several."""
    return files.agg(F.max(F.struct("date", "path", "length")).alias("f")).select("f.*")


def read_dim(spark: SparkSession, path: str, schema: T.StructType | str, key: str) -> DataFrame:
    """Dimension or configuration file with one row per key, the smallest by the other columns.

    Spark broadcasts it in a join while it is below the session's size limit.
    """
    return one_per_key(spark.read.schema(schema).option("header", True).csv(path), [key])
