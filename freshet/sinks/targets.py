"""A table of rows that is appended to, replaced and trimmed.

Every change is written beside the live data and becomes visible when Spark's
``_SUCCESS`` marker of the finished write is there, so a job that dies leaves
the old rows in place.  A full rewrite starts a new generation; an append adds
a part to the current one and costs only its own rows.  Generations before the
last one are removed.  Tables too large to rewrite are partitioned, see
:mod:`freshet.sinks.partitioned`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.aggregates import pick_by
from ..operators.retention import keep_newest
from ..runtime import durable
from .partitioned import remove_folder


def _children(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the ``prefix=<n>`` folders below ``path``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(prefix + "="))


def _exists(spark: SparkSession, path: str) -> bool:
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark._jsc.hadoopConfiguration()).exists(file)


class Target:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, id_col: str, time_col: str | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.id_col = id_col
        self.time_col = time_col

    def _live(self) -> tuple[int, list[str]]:
        """Current generation and its finished parts."""
        for generation in reversed(_children(self.spark, self.path, "full")):
            base = f"{self.path}/full={generation}"
            parts = [
                f"{base}/part={n}"
                for n in _children(self.spark, base, "part")
                if _exists(self.spark, f"{base}/part={n}/_SUCCESS")
            ]
            if f"{base}/part=0" in parts:
                return generation, parts
        return 0, []

    def exists(self) -> bool:
        return bool(self._live()[1])

    def ensure(self) -> DataFrame:
        """Create an empty table if there is none; existing ids."""
        if not self.exists():
            self._rewrite(self.spark.createDataFrame([], self.schema))
        return self.ids()

    def read(self) -> DataFrame:
        parts = self._live()[1]
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*parts)

    def ids(self) -> DataFrame:
        return self.read().select(self.id_col).distinct()

    def _conform(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema])

    def _rewrite(self, df: DataFrame) -> None:
        generations = _children(self.spark, self.path, "full")
        number = generations[-1] + 1 if generations else 1
        self._conform(df).write.parquet(f"{self.path}/full={number}/part=0")
        for old in generations[:-1]:  # the last one may still be read
            remove_folder(self.spark, f"{self.path}/full={old}")

    def append(self, df: DataFrame) -> None:
        generation, parts = self._live()
        if not parts:
            self._rewrite(df)
            return
        base = f"{self.path}/full={generation}"
        number = _children(self.spark, base, "part")[-1] + 1
        self._conform(df).write.parquet(f"{base}/part={number}")

    def reload(self, df: DataFrame) -> None:
        """Replace all rows; the old ones stay visible until the new ones are written."""
        self._rewrite(df)

    def replace(self, df: DataFrame) -> None:
        """Replace all rows and the schema."""
        self.schema = df.schema
        self._rewrite(df)

    def truncate(self) -> None:
        self._rewrite(self.spark.createDataFrame([], self.schema))

    def delete_where(self, predicate: Column) -> int:
        """Delete matching rows; how many there were."""
        rows = self.read()
        hit = F.coalesce(predicate, F.lit(False))
        dropped = rows.filter(hit).count()
        if dropped:
            self._rewrite(rows.filter(~hit))
        return dropped

    def delete_ids(self, ids: DataFrame) -> None:
        self._rewrite(self.read().join(ids.select(self.id_col), self.id_col, "left_anti"))

    def delete_orphans(self, source_ids: DataFrame) -> None:
        """Delete rows whose id is no longer in the source."""
        self._rewrite(self.read().join(source_ids.select(self.id_col), self.id_col, "left_semi"))

    def insert_if_new(self, df: DataFrame, order: Sequence[str]) -> None:
        """Append rows with unseen ids, the first of each id in ``order``."""
        first = pick_by(df, [self.id_col], order, "first")
        self.append(first.join(self.ids(), self.id_col, "left_anti"))

    def upsert(self, df: DataFrame, keys: Sequence[str] | None = None, keep: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Replace rows with the same key and add the others; ``keep`` trims the result in the same rewrite."""
        keys = list(keys or [self.id_col])
        fresh = durable(self._conform(df), "upsert")
        kept = self.read().join(fresh.select(*keys), keys, "left_anti")
        merged = self._conform(kept).unionByName(fresh)
        self._rewrite(keep(merged) if keep else merged)

    def patch_columns(self, df: DataFrame, cols: Sequence[str], last_n: int | None = None, order: str | None = None) -> None:
        """:func:`patch_rows` on the rows of the target."""
        self._rewrite(patch_rows(self.read(), df, self.id_col, cols, last_n, order))

    def trim(self, keep) -> None:
        """Apply a retention operator, such as ``lambda df: keep_newest(df, ...)``."""
        self._rewrite(keep(self.read()))


def upsert_rows(target: DataFrame, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in ``df``, and the rows of ``df``."""
    kept = target.join(df.select(*keys), list(keys), "left_anti")
    return kept.unionByName(df, allowMissingColumns=True)


def patch_rows(
    target: DataFrame, df: DataFrame, key: str, cols: Sequence[str], last_n: int | None = None, order: str | None = None
) -> DataFrame:
    """Refresh ``cols`` from the rows of ``df`` with the same key, where they have a value.

    ``last_n`` uses only so many rows of ``df``, the last ones in ``order``.
    """
    if last_n is not None:
        df = keep_newest(df, order, last_n, key)
    fresh = df.select(key, *[F.col(c).alias(f"_{c}") for c in cols])
    patched = target.join(fresh, key, "left").withColumns({c: F.coalesce(f"_{c}", c) for c in cols})
    return patched.select(*target.columns)


def duplicates(df: DataFrame, id_col: str) -> DataFrame:
    """Ids that occur more than once, with their number of rows."""
    counts = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter(F.col("n_rows") > 1)


def assert_unique(df: DataFrame, id_col: str) -> None:
    if not duplicates(df, id_col).isEmpty():
        raise ValueError(f"{id_col} is not unique")


def ensure_table(spark: SparkSession, table: str, schema: T.StructType, id_col: str) -> DataFrame:
    """Create a catalogue table if there is none; existing ids."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet")
    return spark.table(table).select(id_col).distinct()


def append_table(df: DataFrame, table: str) -> None:
    df.select(*df.sparkSession.table(table).columns).write.mode("append").insertInto(table)


def replace_table(df: DataFrame, table: str) -> None:
    """Replace a catalogue table with its schema."""
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def truncate_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table}")


def tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)
