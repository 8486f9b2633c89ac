"""Archives: members of zip files as rows."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MEMBERS = "archive string, member string, content binary"


def expand_members(
    files: DataFrame,
    suffix: str | None = None,
    tags: Sequence[str] | None = None,
    nested: bool = True,
) -> DataFrame:
    """Members of the zip files in ``content`` whose name fits; zips inside zips are opened too."""

    def wanted(name: str) -> bool:
        return (suffix is None or name.endswith(suffix)) and (
            not tags or any(tag in name for tag in tags)
        )

    def members(raw: bytes, prefix: str = ""):
        with zipfile.ZipFile(io.BytesIO(raw)) as archive:
            for info in archive.infolist():
                if info.is_dir():
                    continue
                name = prefix + info.filename
                if nested and info.filename.lower().endswith(".zip"):
                    yield from members(archive.read(info), name + "/")
                elif wanted(name):
                    yield name, archive.read(info)

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, raw in zip(batch["path"], batch["content"]):
                for name, content in members(raw):
                    yield pd.DataFrame(
                        {"archive": [archive], "member": [name], "content": [content]}
                    )

    return files.select("path", "content").mapInPandas(expand, MEMBERS)


def expand_archives(spark: SparkSession, path: str, **choice) -> DataFrame:
    """:func:`expand_members` of the zip files at ``path``."""
    return expand_members(spark.read.format("binaryFile").load(path), **choice)


def pack_texts(df: DataFrame, path: str, text: str, nested: bool = False) -> DataFrame:
    """Each text as the member ``text.txt`` of an archive of its own."""

    def pack(name: str, content: bytes) -> bytes:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr(name, content)
        return buffer.getvalue()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            packed = [pack("text.txt", t.encode()) for t in batch[text]]
            if nested:
                packed = [pack("inner.zip", p) for p in packed]
            yield pd.DataFrame({"path": batch[path], "content": packed})

    return df.select(path, text).mapInPandas(run, "path string, content binary")


def member_lines(members: DataFrame) -> DataFrame:
    """Text lines of archive members with their position."""
    text = F.decode("content", "UTF-8")
    return members.select(
        "archive", "member", F.posexplode(F.split(text, r"\r?\n")).alias("line_no", "value")
    ).filter(F.col("value") != "")


def member_rows(members: DataFrame, schema: str, sep: str = "\t", header: bool = True) -> DataFrame:
    """Delimited rows of archive members, tagged with the member's file id."""
    lines = member_lines(members)
    if header:
        lines = lines.filter(F.col("line_no") > 0)
    parsed = F.from_csv("value", F.lit(schema), {"sep": sep})
    return lines.select(
        F.regexp_extract("member", r"([^/]*?)\.[^.]*$", 1).alias("file_id"), parsed.alias("row")
    ).select("file_id", "row.*")
