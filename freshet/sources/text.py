"""Line-based sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    cols: Sequence[str] | None = None,
    sep: str = ",",
    multiline: bool = False,
) -> DataFrame:
    """Delimited text with a header; only ``cols`` are parsed."""
    reader = spark.read.schema(schema).option("header", True).option("sep", sep)
    if multiline:
        reader = reader.option("multiLine", True)
    df = reader.option("enforceSchema", False).csv(path)
    return df.select(*cols) if cols else df


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file and 0-based position in it.

    A file may be read in many splits at once.  The rows of one split keep
    their order, so a line's position is its place in its split plus the
    number of lines in the earlier splits of the same file.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_seq"),
    )
    splits = lines.groupBy("file", "_split").agg(
        F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_lines")
    )
    earlier = Window.partitionBy("file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(
        "file", "_split", "_first", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_before")
    )
    return lines.join(splits, ["file", "_split"]).select(
        "file", (F.col("_seq") - F.col("_first") + F.col("_before")).alias("line_no"), "value"
    )


def split_whitespace(
    lines: DataFrame,
    names: Sequence[str],
    col: str = "value",
    comment: str | None = None,
    header_prefix: str | None = None,
) -> DataFrame:
    """Rows of exactly ``len(names)`` blank-separated fields; other lines are left out."""
    for prefix in (comment, header_prefix):
        if prefix:
            lines = lines.filter(~F.col(col).startswith(prefix))
    fields = F.regexp_extract_all(col, F.lit(r"(\S+)"), F.lit(1))
    kept = [c for c in lines.columns if c != col]
    return (
        lines.withColumn("_fields", fields)
        .filter(F.size("_fields") == len(names))
        .select(*kept, *[F.col("_fields")[i].alias(n) for i, n in enumerate(names)])
    )


def read_whitespace(
    spark: SparkSession,
    path: str,
    names: Sequence[str],
    skip_lines: int = 0,
    comment: str | None = None,
    header_prefix: str | None = None,
) -> DataFrame:
    """Blank-separated text; ``skip_lines`` heading lines of each file are skipped."""
    if skip_lines:
        lines = numbered_lines(spark, path).filter(F.col("line_no") >= skip_lines).select("value")
    else:
        lines = spark.read.text(path)
    return split_whitespace(lines, names, comment=comment, header_prefix=header_prefix)


def read_tsv_with_file_id(
    spark: SparkSession, path: str, schema: T.StructType | str, id_pattern: str = r"^(.*?)\.[^.]*$"
) -> DataFrame:
    """Tab-separated files with a header, each row tagged with the id of its file."""
    df = spark.read.schema(schema).option("header", True).option("sep", "\t").csv(path)
    return df.select("*", F.regexp_extract("_metadata.file_name", id_pattern, 1).alias("file_id"))


def parse_json_lines(
    df: DataFrame, col: str, schema: T.StructType | str, strip_trailing_comma: bool = False
) -> DataFrame:
    """Add ``record`` parsed from a JSON text, and ``is_bad`` where it cannot be parsed."""
    text = F.trim(F.col(col))
    if strip_trailing_comma:
        text = F.regexp_replace(text, r",\s*$", "")
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    full = T.StructType([*schema.fields, T.StructField("_bad_text", T.StringType())])
    parsed = F.from_json(text, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad_text"})
    return (
        df.withColumn("_parsed", parsed)
        .withColumn("is_bad", F.col("_parsed").isNull() | F.col("_parsed._bad_text").isNotNull())
        .withColumn("record", F.when(~F.col("is_bad"), F.col("_parsed").dropFields("_bad_text")))
        .drop("_parsed")
    )


def read_ndjson(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    strip_trailing_comma: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Parsed rows, and the number of bad lines per file.

    Lines that only open or close an array are not counted as bad, so files
    with one array element per line are read as well.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    lines = lines.filter(~F.trim("value").isin("", "[", "]"))
    parsed = parse_json_lines(lines, "value", schema, strip_trailing_comma)
    rows = parsed.filter(~F.col("is_bad")).select("record.*")
    bad = parsed.filter("is_bad").groupBy("file").agg(F.count(F.lit(1)).alias("bad_lines"))
    return rows, bad
