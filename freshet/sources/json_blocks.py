"""Records of large JSON documents, one document read by many tasks.

A document is read in pieces that end at a closing brace, which Spark's text
reader finds from any split of the file, in blocks of so many pieces; such a
block is called a split below.  What a piece does to the reader's state (inside a text or not, how deep) is a small function of the state before
it: quotes flip the one, brackets outside of texts move the other.  Pieces of a
split are added up for both possible starts, the few sums per split are composed
along the file, and so each piece learns where it stands without anything being
read in order.  A record ends where a piece closes the depth of the records.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.geometry import ANY

_SPLIT = ["file", "split"]
_BLOCK = 1 << 15  # pieces that are sorted and added up together, however large the file and its splits
_TEXT = re.compile(r'"(?:[^"\\]|\\.)*"', re.S)
_OPEN_KEY = re.compile(r'"((?:[^"\\]|\\.)*)"\s*:\s*$', re.S)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Text before each closing brace, with its place in its split, and what it does from either start."""
    read = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("seq"), "value",
    )
    block = F.struct("start", F.expr(f"seq div {_BLOCK}").alias("block"))
    read = read.withColumn("split", block).drop("start")
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    read = read.withColumn("plain", plain).withColumn("quotes", F.length("plain") - F.length(F.replace("plain", F.lit('"'), F.lit(""))))
    inside = F.regexp_replace("plain", r'(?s)^[^"]*("|$)', "")
    bare = {s: F.regexp_replace(x, r'(?s)"[^"]*("|$)', "") for s, x in (("0", F.col("plain")), ("1", inside))}
    read = read.withColumns({f"bare{s}": x for s, x in bare.items()})

    def change(start: int) -> Column:
        text = F.col(f"bare{start}")
        ends_outside = (F.col("quotes") + start) % 2 == 0
        opened = F.length(F.regexp_replace(text, r"[^\[{]", "")) - F.length(F.regexp_replace(text, r"[^\]}]", ""))
        return opened - ends_outside.cast("int")

    return read.withColumns({"change0": change(0), "change1": change(1)}).drop("plain", "bare0", "bare1")


def _before(values: Column, order: str = "seq") -> Column:
    """Sum over the earlier pieces of the split."""
    window = Window.partitionBy(*_SPLIT).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(values).over(window), F.lit(0))


def _across(splits: DataFrame, values: Column) -> Column:
    """Sum over the earlier splits of the file."""
    window = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(values).over(window), F.lit(0))


def _with_state(pieces: DataFrame) -> DataFrame:
    """Pieces with ``inside`` (starts in a text), ``depth`` before and ``depth_after``."""
    odd = (_before(F.col("quotes")) % 2).cast("int")
    pieces = pieces.withColumn("odd", odd)
    for start in (0, 1):
        pieces = pieces.withColumn(f"step{start}", F.when(F.col("odd") == start, F.col("change0")).otherwise(F.col("change1")))
    splits = pieces.groupBy(*_SPLIT).agg(*[F.sum(c).alias(c) for c in ("quotes", "step0", "step1")])
    splits = splits.withColumn("starts", (_across(splits, F.col("quotes")) % 2).cast("int"))
    moved = F.when(F.col("starts") == 0, F.col("step0")).otherwise(F.col("step1"))
    splits = splits.withColumn("sunk", _across(splits, moved)).select(*_SPLIT, "starts", "sunk")
    joined = pieces.join(splits, _SPLIT)
    step = F.when(F.col("starts") == 0, F.col("step0")).otherwise(F.col("step1"))
    joined = joined.withColumn("step", step).withColumn("inside", (F.col("odd") + F.col("starts")) % 2 == 1)
    joined = joined.withColumn("depth", F.col("sunk") + _before(F.col("step")))
    ends_outside = (F.col("quotes") + F.col("inside").cast("int")) % 2 == 0
    return joined.select(
        *_SPLIT, "seq", "value", "inside", "depth", (F.col("depth") + F.col("step")).alias("depth_after"),
        ends_outside.alias("ends_outside"),
    )


def _opened(text: str, depth: int, inside: bool, levels: int) -> tuple[int, list[str | None]]:
    """Where the record of a piece begins (-1: none), and the container opened last at each level."""
    found: list[str | None] = [None] * levels
    blank = _TEXT.sub(lambda m: "_" * len(m[0]), text if not inside else re.sub(r'^(?:[^"\\]|\\.)*"', lambda m: "_" * len(m[0]), text, count=1, flags=re.S))
    start = -1
    for m in re.finditer(r'[\[\]{}"]', blank):
        if m[0] == '"':  # a text that goes on in the next piece
            break
        if m[0] in "]}":
            depth -= 1
            continue
        depth += 1
        if depth <= levels:
            key = _OPEN_KEY.search(text[: m.start()])
            found[depth - 1] = (key[1] if key else "") + m[0]
        elif depth == levels + 1 and m[0] == "{":
            start = m.start()
            break
    return start, found


def json_records(spark: SparkSession, path: str, records_path: str = "") -> DataFrame:
    """``file``, ``position`` and ``text`` of the objects in the array at a dotted path of names; "" is the document itself.

    Documents may hold anything else besides.  Elements that are no objects are
    left out and have no position; where the path occurs more than once in a
    document, positions go on.  A broken document gives the records up to the
    fault, and what follows is undefined.  An empty file gives no rows.
    """
    names = [n for n in records_path.split(".") if n]
    levels = len(names) + 1
    expected = [("{" if names else "[")] + [n + ("[" if i == len(names) - 1 else "{") for i, n in enumerate(names)]
    pieces = _with_state(_pieces(spark, path))
    simple = (F.col("depth") == levels) & ~F.col("inside") & F.col("value").rlike(r"^[\s,]*\{")
    upper = (F.col("depth") <= levels) & ~simple

    @F.pandas_udf(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("opened", T.ArrayType(T.StringType()))]))
    def context(text: pd.Series, depth: pd.Series, inside: pd.Series) -> pd.DataFrame:
        rows = [(-1, [None] * levels) if t is None else _opened(t, int(d), bool(i), levels) for t, d, i in zip(text, depth, inside, strict=True)]
        return pd.DataFrame(rows, columns=["start", "opened"])

    pieces = pieces.withColumn("upper", upper).withColumn("context", context(F.when(F.col("upper"), F.col("value")), "depth", "inside"))
    ends = (F.col("ends_outside") & (F.col("depth_after") <= levels)).cast("int")
    opened = [F.col("context.opened")[i] for i in range(levels)]
    so_far = Window.partitionBy(*_SPLIT).orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    pieces = pieces.withColumns({
        "ends": ends, **{f"at{i}": F.last(c, ignorenulls=True).over(so_far) for i, c in enumerate(opened)},
    }).withColumn("closed", _before(F.col("ends")))
    splits = pieces.groupBy(*_SPLIT).agg(F.sum("ends").alias("ends"), *[F.max_by(F.col(f"at{i}"), "seq").alias(f"last{i}") for i in range(levels)])
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(
        *_SPLIT, _across(splits, F.col("ends")).alias("closed_before"),
        *[F.last(f"last{i}", ignorenulls=True).over(earlier).alias(f"from{i}") for i in range(levels)],
    )
    placed = pieces.join(splits, _SPLIT).withColumn("record", F.col("closed") + F.col("closed_before"))
    here = F.lit(True)
    for i, name in enumerate(expected):
        here = here & F.coalesce(F.coalesce(f"at{i}", f"from{i}") == name, F.lit(False))
    starts = F.when(F.col("upper"), F.col("context.start")).otherwise(F.when(simple, F.instr("value", "{") - 1).otherwise(-1))
    placed = placed.filter(here).select("file", "record", "seq", "value", "ends", "depth", starts.alias("start"))
    whole = (F.col("start") >= 0) & (F.col("ends") == 1)
    one = placed.filter(whole).select("file", "record", F.concat(F.expr("substring(value, start + 1)"), F.lit("}")).alias("text"))
    parts = F.sort_array(F.collect_list(F.struct("seq", "value", "start", "ends")))
    some = placed.filter(~whole).groupBy("file", "record").agg(parts.alias("parts"))
    first = F.get("parts", F.lit(0))
    joined = F.array_join(F.transform("parts", lambda p: p["value"]), "}")
    some = some.filter((first["start"] >= 0) & (F.element_at("parts", -1)["ends"] == 1)).select(
        "file", "record", F.concat(F.substring(joined, first["start"] + 1, F.length(joined)), F.lit("}")).alias("text")
    )
    records = one.unionByName(some)
    firsts = placed.filter("start >= 0").groupBy("file").agg(F.min("record").alias("_first"))
    return records.join(firsts, "file").select("file", (F.col("record") - F.col("_first")).alias("position"), "text")


def read_json_document(spark: SparkSession, path: str, schema: T.StructType | str, records_path: str = "data") -> DataFrame:
    """Typed records of the array at ``records_path``, in one pass over blocks of the documents.

    A record that does not parse gives a row of nulls.
    """
    records = json_records(spark, path, records_path)
    return records.select(F.from_json("text", schema).alias("record")).select("record.*")


def read_geojson_document(
    spark: SparkSession, path: str, prop_schema: str, geometry_schema: str = ANY, file_name: bool = True
) -> DataFrame:
    """Features of collections of any size: properties, ``geometry``, file and position in the file."""
    feature = f"geometry {geometry_schema}, properties struct<{prop_schema}>"
    records = json_records(spark, path, "features").withColumn("feature", F.from_json("text", feature))
    file = F.regexp_extract("file", r"([^/]*)$", 1) if file_name else F.col("file")
    return records.select(file.alias("file"), "position", "feature.properties.*", F.col("feature.geometry").alias("geometry"))

