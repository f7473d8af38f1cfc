"""Scans: whole texts, chunk folders, JSON documents, archives, images and layout entries."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quire.functions import text as T

PAGE_RANGE = "start long, end long, confidence string"


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, doc, text): one row per file; ``doc`` is the file's stem."""
    found = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return found.withColumn("doc", F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)).select("path", "doc", "text")


def chunk_folder(spark: SparkSession, folder: str, *, digits_only: bool = False) -> DataFrame:
    """(doc, source, target): chunks/*.md with translated/*.tex on the stem; a missing side is null."""
    sides = [whole_texts(spark, f"{folder}/{p}").select("doc", F.col("text").alias(n)) for p, n in (("chunks/*.md", "source"), ("translated/*.tex", "target"))]
    both = sides[0].join(sides[1], "doc", "full")
    return both.filter(F.col("doc").rlike(r"^\d+$")) if digits_only else both


def json_documents(spark: SparkSession, path: str, schema: str | StructType, *, strict: bool = False) -> DataFrame:
    """Rows of JSON documents.  What is unreadable becomes nulls, or ends the query if ``strict``."""
    mode = "FAILFAST" if strict else "PERMISSIVE"
    return spark.read.schema(schema).option("multiLine", True).option("mode", mode).json(path)


def lenient_json(rows: DataFrame, column: str, schema: str) -> DataFrame:
    """``parsed``: the JSON object in a reply's text, null where there is none."""
    return rows.withColumn("parsed", F.from_json(T.json_object(F.col(column)), schema, {"mode": "PERMISSIVE"}))


def page_ranges(rows: DataFrame, *, page_count: int | None = None) -> DataFrame:
    """Ranges that hold ``1 <= start <= end <= page_count`` and a known confidence (default medium); others end the query."""
    good = (F.col("start") >= 1) & (F.col("start") <= F.col("end"))
    if page_count is not None:
        good &= F.col("end") <= page_count
    confidence = F.coalesce("confidence", F.lit("medium"))
    good &= confidence.isin("high", "medium", "low")
    return rows.withColumn("confidence", confidence).withColumn("start", F.when(F.coalesce(good, F.lit(False)), F.col("start")).otherwise(F.raise_error(F.lit("bad page range")).cast("long")))


def images(spark: SparkSession, path: str) -> DataFrame:
    """(path, kind, bytes) of image files; the kind comes from the first bytes."""
    found = spark.read.format("binaryFile").load(path)
    return found.select("path", T.image_kind(F.col("content")).alias("kind"), F.col("length").alias("bytes"))


def archive_members(spark: SparkSession, path: str) -> DataFrame:
    """(path, member, content) of the zip archives in a folder."""
    return unpacked(spark.read.format("binaryFile").load(path))


def unpacked(archives: DataFrame) -> DataFrame:
    """(path, member, content) of zip archives (path, content); one archive is one task's row."""

    def unpack(source: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in source:
            for r in batch.itertuples():
                with zipfile.ZipFile(io.BytesIO(r.content)) as archive:
                    for member in archive.infolist():
                        if not member.is_dir():
                            yield pd.DataFrame({"path": [r.path], "member": [member.filename], "content": [archive.read(member)]})

    return archives.select("path", "content").mapInPandas(unpack, "path string, member string, content binary")


def archive_texts(members: DataFrame) -> DataFrame:
    """(path, text): of each archive full.md, else the first Markdown file by name."""
    markdown = members.filter(F.col("member").endswith(".md")).withColumn("rank", F.struct(~F.col("member").endswith("full.md"), F.col("member")))
    return markdown.groupBy("path").agg(F.min_by("content", "rank").cast("string").alias("text"))


def shifted_entries(parts: DataFrame) -> DataFrame:
    """Layout entries with page numbers of the whole document: each part's are shifted by its first page."""
    return parts.withColumn("page_idx", F.col("page_idx") + F.col("first_page") - 1)
