"""Landed pages of a paginated source, in batches and as a stream."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..runtime import durable

PAGE_NUMBER = r"(\d+)\.json$"
PLACE = T.StructType([T.StructField("page", T.IntegerType()), T.StructField("position", T.IntegerType())])


class Pages(InputPartition):
    def __init__(self, pages: list[tuple[int, str]]):
        self.pages = pages


def _column(values: list, kind: pa.DataType) -> pa.Array:
    """Values as an Arrow column; one that does not fit the type is null, other things than text become their JSON in a text column."""
    if pa.types.is_string(kind):
        values = [v if v is None or isinstance(v, str) else json.dumps(v) for v in values]
    try:
        return pa.array(values, kind)
    except (pa.ArrowInvalid, pa.ArrowTypeError, pa.ArrowNotImplementedError, OverflowError):
        fitting = []
        for v in values:
            try:
                pa.array([v], kind)
                fitting.append(v)
            except (pa.ArrowInvalid, pa.ArrowTypeError, pa.ArrowNotImplementedError, OverflowError):
                fitting.append(None)
        return pa.array(fitting, kind)


class _PageFiles:
    """Page files of a folder, and their records as Arrow batches of the wanted columns."""

    def __init__(self, schema: T.StructType, options):
        from pyspark.sql.pandas.types import to_arrow_schema

        self.arrow = to_arrow_schema(schema)
        self.path = options["path"]
        self.records_path = options.get("records_path", "")
        self.pattern = options.get("page_pattern", PAGE_NUMBER)
        self.first = int(options.get("min_page", 0))
        self.last = int(options.get("max_page", 2**31 - 1))
        self.per_task = int(options.get("pages_per_task", 16))

    def listed(self, first: int, last: int) -> list[tuple[int, str]]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(self.path)
        pages = []
        for info in system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            match = re.search(self.pattern, info.path)
            if match and first <= int(match[1]) <= last:
                pages.append((int(match[1]), info.path))
        return sorted(pages)

    def tasks(self, pages: list[tuple[int, str]]) -> list[Pages]:
        return [Pages(pages[i : i + self.per_task]) for i in range(0, len(pages), self.per_task)]

    def batches(self, partition: Pages, mark_empty: bool) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, _ = fs.FileSystem.from_uri(self.path)
        for number, path in partition.pages:
            with system.open_input_stream(path) as stream:
                records = json.loads(stream.read())
            for name in filter(None, self.records_path.split(".")):
                records = records[int(name)] if name.isdigit() else records.get(name)
            places: list = list(range(len(records or [])))
            if not records:
                if not mark_empty:
                    continue
                records, places = [{}], [None]
            rows = [r if isinstance(r, dict) else {} for r in records]
            own = {"page": [number] * len(rows), "position": places}
            yield pa.RecordBatch.from_arrays(
                [_column(own.get(f.name) or [r.get(f.name) for r in rows], f.type) for f in self.arrow], schema=self.arrow
            )


class PagedJsonReader(DataSourceReader):
    """Some page files per task; an empty page gives one row without a position."""

    def __init__(self, schema: T.StructType, options):
        self.files = _PageFiles(schema, options)

    def partitions(self):
        return self.files.tasks(self.files.listed(self.files.first, self.files.last))

    def read(self, partition):
        return self.files.batches(partition, mark_empty=True)


class PagedJsonStream(DataSourceStreamReader):
    """Pages as they land; the offset is the number of the next page.

    A page is taken when all pages before it have landed, so nothing is left
    out when pages land out of order.  A restarted stream goes on with the page that its
    checkpoint names.  Empty pages give no rows.
    """

    def __init__(self, schema: T.StructType, options):
        self.files = _PageFiles(schema, options)

    def initialOffset(self):
        return {"page": self.files.first}

    def latestOffset(self):
        page = self.files.first
        for number, _ in self.files.listed(page, self.files.last):
            if number != page:
                break
            page += 1
        return {"page": page}

    def partitions(self, start, end):
        return self.files.tasks(self.files.listed(start["page"], end["page"] - 1))

    def read(self, partition):
        return self.files.batches(partition, mark_empty=False)

    def commit(self, end):
        pass


class PagedJson(DataSource):
    """``spark.read`` or ``spark.readStream`` with ``format("paged_json")``: records of numbered page files.

    The schema names the fields of a record that are wanted, after ``page`` and
    ``position``.
    """

    @classmethod
    def name(cls):
        return "paged_json"

    def schema(self):
        return T.StructType([*PLACE.fields, T.StructField("record", T.StringType())])

    def reader(self, schema):
        return PagedJsonReader(schema, self.options)

    def streamReader(self, schema):
        return PagedJsonStream(schema, self.options)


def _full_schema(schema: T.StructType | str) -> T.StructType:
    record = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return T.StructType([*PLACE.fields, *record.fields])


def until_empty_page(pages: DataFrame) -> DataFrame:
    """Rows of the pages before the first empty one."""
    first_empty = pages.filter("position is null").select(F.min("page"))
    return pages.filter(
        F.col("position").isNotNull()
        & (F.col("page") < F.coalesce(first_empty.scalar(), F.lit(2**31 - 1)))
    )


def read_pages(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    records_path: str = "",
    min_page: int = 0,
    max_page: int | None = None,
    stop_at_empty: bool = True,
    page_pattern: str = PAGE_NUMBER,
) -> DataFrame:
    """Typed records of the pages from ``min_page`` to ``max_page`` or the first empty page.

    A value that does not fit its type is null.
    """
    spark.dataSource.register(PagedJson)
    reader = spark.read.format("paged_json").schema(_full_schema(schema)).option("records_path", records_path)
    reader = reader.option("min_page", min_page).option("page_pattern", page_pattern)
    if max_page is not None:
        reader = reader.option("max_page", max_page)
    pages = reader.load(path)
    if stop_at_empty:
        # the first empty page is looked up in rows that are already read, so pages are parsed once
        return until_empty_page(durable(pages, "paged"))
    return pages.filter("position is not null")


def stream_pages(
    spark: SparkSession, path: str, schema: T.StructType | str, records_path: str = "", min_page: int = 0,
    page_pattern: str = PAGE_NUMBER,
) -> DataFrame:
    """Typed records of pages as they land, see :class:`PagedJsonStream`."""
    spark.dataSource.register(PagedJson)
    reader = spark.readStream.format("paged_json").schema(_full_schema(schema)).option("records_path", records_path)
    return reader.option("min_page", min_page).option("page_pattern", page_pattern).load(path)
