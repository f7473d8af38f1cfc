"""Sinks: tables, gated publishing, kits and reports."""

from __future__ import annotations

import io
import zipfile
from html import escape
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.operators import checks


def overwrite(rows: DataFrame, path: str, kind: str = "parquet") -> None:
    """Replace a table.  The new one is written aside and takes the old one's place when it is whole.

    A failure while it is written leaves the old table; one between the two renames leaves both under
    their names aside, ``.old`` and ``.new``.
    """
    spark = rows.sparkSession
    there, new, old = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}{end}") for end in ("", ".new", ".old"))
    files = there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    rows.write.mode("overwrite").format(kind).save(new.toString())
    files.delete(old, True)
    if files.exists(there) and not files.rename(there, old):
        raise OSError(f"cannot move {path} aside")
    if not files.rename(new, there):
        raise OSError(f"cannot put the new table in {path}")
    files.delete(old, True)
    spark.catalog.refreshByPath(path)


def write_files(texts: DataFrame, path: str) -> None:
    """One file for each row (name, text), as it is; names must differ.

    Spark writes and commits the files; the driver then only names them, which suits the files of
    books but not those of a corpus.
    """
    spark = texts.sparkSession
    aside = f"{path}.parts"
    named = texts.select("name", F.col("text").alias("value"))
    if not named.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        raise ValueError("names of files repeat")
    named.repartition("name").write.mode("overwrite").partitionBy("name").text(aside)
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    files = hadoop.Path(aside).getFileSystem(conf)
    files.mkdirs(hadoop.Path(path))
    for found in files.globStatus(hadoop.Path(f"{aside}/name=*/part-*")):
        name = unquote(found.getPath().getParent().getName().removeprefix("name="))
        files.delete(hadoop.Path(f"{path}/{name}"), False)
        if not files.rename(found.getPath(), hadoop.Path(f"{path}/{name}")):
            raise OSError(f"cannot name {path}/{name}")
    files.delete(hadoop.Path(aside), True)


def write_kit(chunks: DataFrame, path: str) -> None:
    """Chunks (book, chunk, text) by book, the old ones gone."""
    chunks.write.mode("overwrite").partitionBy("book").parquet(path)


def archived(files: DataFrame) -> DataFrame:
    """(path, content): one zip archive for each path of files (path, member, content), members by name; a book's files are one group."""

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        whole = io.BytesIO()
        with zipfile.ZipFile(whole, "w", zipfile.ZIP_DEFLATED) as archive:
            for member, content in group.sort_values("member")[["member", "content"]].itertuples(index=False):
                archive.writestr(zipfile.ZipInfo(member), content)  # without the hour, so that equal files give equal archives
        return pd.DataFrame({"path": [key[0]], "content": [whole.getvalue()]})

    return files.select("path", "member", "content").groupBy("path").applyInPandas(pack, "path string, content binary")


def publishable(builds: DataFrame, outputs: DataFrame) -> DataFrame:
    """Outputs (book, path, made, source_changed) of books whose last build (book, seq, succeeded) went well, and that are no older than their source."""
    last = builds.groupBy("book").agg(F.max_by("succeeded", "seq").alias("good")).filter("good")
    return outputs.join(last, "book", "left_semi").filter("made >= source_changed")


def publish(builds: DataFrame, outputs: DataFrame, path: str) -> bool:
    """Write what may be published; false, and nothing written, if that is nothing."""
    rows = publishable(builds, outputs)
    if rows.isEmpty():
        return False
    overwrite(rows, path)
    return True


def package(references: DataFrame, files: DataFrame, kit: DataFrame, path: str) -> None:
    """Write a kit (path, member, content) as archives unless a referenced image is missing."""
    missing = checks.missing_files(references, files)
    if not missing.isEmpty():
        raise ValueError(f"missing images: {[r['path'] for r in missing.orderBy('path').limit(5).collect()]}")
    overwrite(archived(kit), path)


def review_rows(figures: DataFrame) -> DataFrame:
    """(nth, grp, html) of figures (position, name, keep, flags): table rows in three groups, dropped, flagged, others, each in reading order."""
    group = F.when(~F.col("keep"), 0).when(F.size("flags") > 0, 1).otherwise(2)
    kind = F.element_at(F.array(F.lit("dropped"), F.lit("flagged"), F.lit("kept")), F.col("grp") + 1)
    name = F.replace(F.replace(F.col("name"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    cells = F.concat(F.lit('<tr class="'), kind, F.lit('"><td>'), F.col("position").cast("string"), F.lit("</td><td>"), name, F.lit("</td><td>"), F.array_join("flags", " "), F.lit("</td></tr>"))
    nth = F.row_number().over(Window.orderBy("grp", "position")).cast("long")  # a book's figures
    return figures.withColumn("grp", group).select(nth.alias("nth"), "grp", cells.alias("html"))


def review_sheet(figures: DataFrame, title: str) -> DataFrame:
    """One row: the sheet as an HTML page."""
    rows = review_rows(figures).groupBy().agg(F.expr("listagg(html, '\n') within group (order by nth)").alias("rows"))
    head = f"<!doctype html><meta charset=utf-8><title>{escape(title)}</title><table>\n"
    return rows.select(F.concat(F.lit(head), F.coalesce("rows", F.lit("")), F.lit("\n</table>\n")).alias("html"))


def rendered(found: DataFrame) -> DataFrame:
    """(doc, report): the findings of each document as text, by line and check."""
    line = F.format_string("%s:%d [%s] %s: %s", F.col("doc").cast("string"), "line", "severity", "check", "message")
    return found.withColumn("t", line).groupBy("doc").agg(F.expr("listagg(t, '\n') within group (order by line, check, t)").alias("report"))


def gate(spark: SparkSession, found: DataFrame) -> int:
    """Exit code of a findings table: 1 if anything is left to review."""
    return int(checks.gate(found).first()["shut"])
