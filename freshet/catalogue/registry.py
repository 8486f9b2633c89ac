"""Named queries over the test tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def day_text(col: Column | str) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def time_text(col: Column | str) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
