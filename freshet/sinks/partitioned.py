"""A partitioned table of rows, of which a change rewrites only the partitions that it touches.

Every change first counts, per partition, the rows that it takes away, in one
scan of the columns that it needs.  Partitions without such rows are left as
they are, those that lose all rows are removed, and only the others are written
anew.  The list of partitions is what reaches the driver.  Partitions are replaced one by one, so
a reader may see some of them changed before others; a change that is run again
after a failure gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.selection import By, first_condition
from ..runtime import durable
from .outputs import overwrite_partitions


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it."""
    folder = _path(spark, path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def child_folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names of the folders below ``path`` that start with ``prefix``, in order."""
    folder = _path(spark, path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(folder) if s.getPath().getName().startswith(prefix))


class PartitionedTarget:
    """Rows below ``path`` in one folder per value of ``by``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, by: str, id_col: str):
        self.spark, self.path, self.by, self.id_col = spark, path.rstrip("/"), by, id_col
        self.schema = T.StructType([*[f for f in schema if f.name != by], schema[by]])

    def read(self) -> DataFrame:
        """All rows; none if nothing was written yet."""
        if not child_folders(self.spark, self.path, f"{self.by}="):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def _conform(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema])

    def _of(self, rows: DataFrame, values: Sequence) -> DataFrame:
        """Rows of some partitions, read from their folders only."""
        known = [v for v in values if v is not None]
        hit = F.col(self.by).isin(known) if known else F.lit(False)
        return rows.filter(hit | F.col(self.by).isNull()) if len(known) < len(values) else rows.filter(hit)

    def append(self, df: DataFrame) -> None:
        self._conform(df).write.mode("append").partitionBy(self.by).parquet(self.path)

    def _replace(self, rows: DataFrame, marked: DataFrame, added: DataFrame | None = None) -> int:
        """Leave out the rows that ``marked`` (rows with ``_hit``) marks, add others; how many rows went."""
        counts = marked.groupBy(self.by).agg(
            F.count(F.lit(1)).alias("n"), F.count_if("_hit").alias("hits"), F.max("_file").alias("file")
        ).collect()
        new = [] if added is None else [r[0] for r in added.select(self.by).distinct().collect()]
        emptied = [r for r in counts if r["hits"] == r["n"] and r[self.by] not in new]
        kept = [r[self.by] for r in counts if 0 < r["hits"] < r["n"] or (r[self.by] in new and r["hits"] < r["n"])]
        rest = self._of(marked, kept).filter("NOT _hit").select(*self.schema.names)
        if added is not None:
            rest = rest.unionByName(added) if kept else added
        if kept or new:
            overwrite_partitions(durable(rest, "partitions"), self.path, [self.by])
        for r in emptied:
            folder = self.spark._jvm.java.net.URI(r["file"].rsplit("/", 1)[0])
            remove_folder(self.spark, self.spark._jvm.org.apache.hadoop.fs.Path(folder).toString())
        return sum(r["hits"] for r in counts)

    def _marked(self, rows: DataFrame, hit: Column) -> DataFrame:
        file = F.col("_metadata.file_path") if rows.inputFiles() else F.lit(None).cast("string")
        return rows.withColumn("_file", file).withColumn("_hit", F.coalesce(hit, F.lit(False)))

    def _marked_ids(self, rows: DataFrame, ids: DataFrame, keys: Sequence[str], present: bool = True) -> DataFrame:
        file = F.col("_metadata.file_path") if rows.inputFiles() else F.lit(None).cast("string")
        known = ids.select(*keys).distinct().withColumn("_known", F.lit(True))
        joined = rows.withColumn("_file", file).join(known, list(keys), "left")
        return joined.withColumn("_hit", F.col("_known").isNotNull() == F.lit(present)).select(*self.schema.names, "_file", "_hit")

    def delete_where(self, predicate: Column) -> int:
        """Delete matching rows; how many there were."""
        rows = self.read()
        return self._replace(rows, self._marked(rows, predicate))

    def delete_ids(self, ids: DataFrame) -> int:
        rows = self.read()
        return self._replace(rows, self._marked_ids(rows, durable(ids.select(self.id_col), "ids"), [self.id_col]))

    def delete_orphans(self, source_ids: DataFrame) -> int:
        """Delete rows whose id is no longer in the source."""
        rows = self.read()
        return self._replace(rows, self._marked_ids(rows, durable(source_ids.select(self.id_col), "ids"), [self.id_col], False))

    def upsert(self, df: DataFrame, keys: Sequence[str] | None = None, moves: bool = True) -> int:
        """Replace rows with the same key and add the others; how many were replaced.

        With ``moves=False`` a key stays in its partition for good, and only the
        partitions of the new rows are looked at.
        """
        keys = list(keys or [self.id_col])
        fresh = durable(self._conform(df), "upsert")
        rows = self.read()
        if not moves:
            rows = self._of(rows, [r[0] for r in fresh.select(self.by).distinct().collect()])
        return self._replace(rows, self._marked_ids(rows, fresh, keys), fresh)

    def patch_columns(self, df: DataFrame, cols: Sequence[str]) -> int:
        """Refresh ``cols`` of the rows with the same id where ``df``, one row per id, has a value; how many rows changed."""
        fresh = durable(df.select(self.id_col, *[F.col(c).alias(f"_{c}") for c in cols]), "patch")
        rows = self.read()
        stored = rows.join(fresh, self.id_col)
        changed = stored.select(*[F.coalesce(f"_{c}", c).alias(c) if c in cols else F.col(c) for c in self.schema.names])
        changed = durable(changed, "patched")
        return self._replace(rows, self._marked_ids(rows, changed, [self.id_col]), self._conform(changed))

    def keep_newest(self, ts: str, n: int, tie: str) -> int:
        """Row budget: delete all but the newest ``n`` rows; how many went.  Whole partitions go without being read."""
        rows = self.read()
        condition = first_condition(rows, [By(ts, True), By(tie, True)], n)
        return 0 if condition is None else self.delete_where(~condition)


def remove_versions(spark: SparkSession, base: str, n: int, exempt: Sequence[str] = ()) -> list[str]:
    """Delete the version folders below ``base`` but the newest ``n`` and the exempt ones; the names that went."""
    names = [name[2:] for name in child_folders(spark, base, "v=")]
    gone = [v for v in names[: max(0, len(names) - n)] if v not in exempt]
    for version in gone:
        remove_folder(spark, f"{base.rstrip('/')}/v={version}")
    return gone
