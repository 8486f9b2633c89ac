"""The same rules on Structured Streaming.

Checkpoints lie in the folder that the caller names or in the cluster's shared
checkpoint folder, so that a restarted stream goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import shared_dir
from ..sinks.targets import Target
from .incremental import drop_late


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", max_files: int | None = None, **options
) -> DataFrame:
    """Files at ``path`` (a folder or a pattern) that were not read before."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def run_available(stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()) -> None:
    """Append everything that is there to Parquet files, then stop."""
    writer = stream.writeStream.format("parquet").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.trigger(availableNow=True).start().awaitTermination()


def run_to_frame(stream: DataFrame, label: str) -> DataFrame:
    """Run a stream over all available input and read its result."""
    spark = stream.sparkSession
    base = shared_dir(spark, label)
    run_available(stream, f"{base}/rows", f"{base}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")


def ingest_files(
    spark: SparkSession, path: str, schema: T.StructType, out: str, checkpoint: str,
    fmt: str = "parquet", file_id: str | None = None, denied: Sequence[str] = (), **options,
) -> None:
    """Load files not seen before; ``denied`` file names are left out."""
    stream = file_stream(spark, path, schema, fmt, **options)
    name = F.col("_metadata.file_name")
    if denied:
        stream = stream.filter(~name.isin(*denied))
    if file_id:
        stream = stream.select("*", name.alias(file_id))
    run_available(stream, out, checkpoint)


def _event_time(stream: DataFrame, ts: str) -> DataFrame:
    """Watermarks need an instant; times without zone are read in the session's zone, UTC."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp"))


def unseen(stream: DataFrame, ts: str, key: str | Sequence[str], delay: str, target: DataFrame | None = None) -> DataFrame:
    """First row of each key within the watermark, without keys the target holds."""
    keys = [key] if isinstance(key, str) else list(key)
    if target is not None:
        stream = stream.join(target.select(*keys), keys, "left_anti")
    return _event_time(stream, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def not_late(stream: DataFrame, marks: DataFrame, by: str, ts: str) -> DataFrame:
    """Rows newer than the stored time of their parameter, by a join with the marks."""
    return drop_late(stream, marks, by, ts)


def window_agg(
    stream: DataFrame, ts: str, keys: Sequence[str], aggregates: Sequence[Column], delay: str,
    length: str = "1 day", slide: str | None = None, start: str = "12 hours",
) -> DataFrame:
    """Aggregates per event-time window; the default is the day from noon to noon.

    A window is given out once the watermark has passed its end.
    """
    window = F.window(ts, length, slide or length, start)
    out = _event_time(stream, ts).withWatermark(ts, delay).groupBy(window, *keys).agg(*aggregates)
    kept = [c for c in out.columns if c != "window"]
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *kept)


def upsert_stream(stream: DataFrame, target: Target, keys: Sequence[str], checkpoint: str, prepare: Callable[[DataFrame], DataFrame] | None = None, keep: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Upsert each batch into a target and trim it.

    ``prepare`` turns a batch into target rows, such as the recomputed summaries
    of the keys it touches.  An upsert that is run again gives the same rows.
    """

    def load(batch: DataFrame, _: int) -> None:
        target.upsert(prepare(batch) if prepare else batch, keys, keep)

    (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
