import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
DATA = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) tuples, with columns whose names an operator might use."""

    def make(*rows, extra=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            for name in ("size", "row", "cls", "key", "line", "spans", "score", "base", "_row", "hits", "n", "bucket"):
                df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make


@pytest.fixture(scope="session")
def small(spark):
    """The smallest documents table, with rows that are null, empty, long, alike or repeated."""
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    odd = [
        (None, "words without an id here", "en", "src1", 5), (900001, None, None, None, None), (900002, "", "en", None, 0),
        (900003, " \n\t ", "en", "src2", 4), (900004, "12 34 !!", "en", "src2", 8), (900005, "one", "xx", "src2", 3),
        (900006, "very long " * 40000, "en", "src0", 400000), (900007, "twice the same row", "en", "src0", 18),
        (900007, "twice the same row", "en", "src0", 18), (900007, "the same id with another text", "en", "src0", 18),
    ]
    return df.unionByName(spark.createDataFrame(odd, DOCS))


@pytest.fixture(scope="session")
def small_dir(spark, small, tmp_path_factory):
    """A folder with that table and the other tables that the queries read."""
    path = str(tmp_path_factory.mktemp("tables"))
    small.write.parquet(f"{path}/documents.parquet")
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{DATA}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.fixture(scope="session")
def small_rows(small):
    return [(r.doc_id, r.text, r.lang, r.source) for r in small.collect()]


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    """The same tables without rows."""
    path = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{DATA}/{name}.parquet").limit(0).write.parquet(f"{path}/{name}.parquet")
    return path
