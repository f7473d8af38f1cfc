"""Whole lifecycles composed of the operators: prepare, lint and assemble."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import checks, generators, joins, markup, windows
from quire.operators import lint as surface


def prepare(books: DataFrame, levels: DataFrame, *, most: int = 30_000) -> tuple[DataFrame, DataFrame]:
    """Chunks (doc, chunk, lines, chars) and image tokens of books: headings merged and re-levelled, images numbered, lines packed."""
    lines = markup.relevelled(_texts(markup.merged_headings(books)), levels)
    text = _texts(lines)
    return windows.packed_chunks(text, most), windows.image_tokens(generators.image_references(text))


def _texts(lines: DataFrame) -> DataFrame:
    return lines.groupBy("doc").agg(F.expr("listagg(text, '\n') within group (order by line)").alias("text"))


def lint(source: DataFrame, target: DataFrame, waivers: DataFrame, known: surface.Dimensions = surface.Dimensions()) -> DataFrame:  # noqa: B008  immutable
    """Findings of chunk pairs and of the whole surface of the translations, after waivers."""
    pairs = joins.chunk_pairs(source, target)
    missing = checks.findings(pairs.filter("missing"), "missing-translation", "review", F.lit("no translation"))
    both = pairs.filter("not missing").select("doc", "source", "target")
    named = checks.pair_checks(both)
    pair = named.select(F.col("doc").cast("string").alias("doc"), "check", F.lit("review").alias("severity"), F.lit("").alias("message"), F.lit(0).cast("long").alias("line"), F.lit("").alias("context"))
    fidelity = markup.pair_fidelity(both).select(F.col("doc").cast("string").alias("doc"), "check", "severity", "message", F.lit(0).cast("long").alias("line"), F.lit("").alias("context"))
    texts = target.withColumn("text", T.strip_fence(F.col("text")))
    found = checks.capped(missing.unionByName(pair).unionByName(fidelity)).unionByName(surface.surface(texts, surface.LATEX, known).drop("rank"))
    return checks.waived(found, waivers)[0]


def assembled(chunks: DataFrame, by: str = "book") -> DataFrame:
    """One text per book, chunks (book, chunk, text) in order with a blank line between."""
    return chunks.groupBy(by).agg(F.expr("listagg(text, '\n\n') within group (order by chunk)").alias("text"))
