"""Row-wise rewrites of Markdown and LaTeX texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import generators

PAIR_BUDGET = 0.96


def prefixed_images(text: Column, prefix: str) -> Column:
    """Relative image paths below a prefix; URLs, data, absolute and drive paths stay."""
    away = r"(?![a-zA-Z][a-zA-Z0-9+.\-]*:|/|\\)"
    markdown = F.regexp_replace(text, rf"(!\[(?:[^\]]*)\]\(){away}([^\s)]+)", f"$1{prefix}/$2")
    return F.regexp_replace(markdown, rf'(?i)(<img\s(?:[^>]*\s)?src="){away}([^"]+)', f"$1{prefix}/$2")


def trimmed_inline(docs: DataFrame) -> DataFrame:
    """(doc, line, text): inline math without white space at its ends, outside display blocks."""
    inside = F.col("fence") | (F.col("block") % 2 == 1)
    trimmed = F.regexp_replace("text", r"(?<![\\$])\$(?!\$)[ \t]*([^$\n]+?)[ \t]*(?<!\\)\$(?!\$)", r"\$$1\$")
    return generators.fenced_lines(docs).select("doc", "line", F.when(inside, F.col("text")).otherwise(trimmed).alias("text"))


def figure_widths(calls: DataFrame, figures: DataFrame) -> DataFrame:
    """(doc, at, name, number, percent) of figure calls with their records; dropped ones go, pairs scale to fit side by side.

    ``calls`` has (doc, at, slot, name), two slots for a pair; ``figures`` has (doc, name, keep,
    number, width) with widths as shares of the line.
    """
    kept = calls.join(figures, ["doc", "name"], "left").filter(F.coalesce("keep", F.lit(True)))
    width = F.coalesce("width", F.lit(0.6))
    total = kept.groupBy("doc", "at").agg(F.sum(width).alias("total"), F.count(F.lit(1)).alias("n"))
    scale = F.when(F.col("n") > 1, F.least(F.lit(1.0), F.lit(PAIR_BUDGET) / F.col("total"))).otherwise(1.0)
    return kept.join(total, ["doc", "at"]).select("doc", "at", "name", "number", F.floor(width * scale * 100 + 0.5).cast("long").alias("percent"))


def without_preamble(docs: DataFrame) -> DataFrame:
    """(doc, text) without lines that belong to a preamble."""
    bad = r"^\s*\\(?:documentclass|usepackage|begin\{document\}|end\{document\})"
    return docs.select("doc", F.array_join(F.filter(F.split("text", "\n", -1), lambda x: ~x.rlike(bad)), "\n").alias("text"))


def first_chapter(preamble: Column) -> Column:
    """The number of the first chapter that a preamble's counter asks for."""
    return (F.coalesce(F.expr("try_cast(nullif(regexp_extract(preamble, '(?m)^[^%]*setcounter\\\\{chapter\\\\}\\\\{(\\\\d+)\\\\}', 1), '') as long)"), F.lit(0)) + 1).alias("first")


def filled(template: Column, values: dict[str, Column]) -> Column:
    """A template with ``%%NAME%%`` placeholders filled."""
    return reduce(lambda t, kv: F.replace(t, F.lit(f"%%{kv[0]}%%"), F.coalesce(kv[1].cast("string"), F.lit(""))), values.items(), template)


def overlay(labels: Column, height: Column) -> Column:
    """Picture commands for labels (en, x, y), y counted from the top."""
    return F.array_join(F.transform(labels, lambda l: F.concat(F.lit("\\put("), l["x"].cast("string"), F.lit(","), (height - l["y"]).cast("string"), F.lit("){"), T.escape_latex(l["en"]), F.lit("}"))), "\n")


def blanked_comments(text: Column) -> Column:
    """Comments as as many spaces, line by line, so that offsets stay."""
    def one(line: Column) -> Column:
        return F.rpad(F.regexp_extract(line, r"^((?:[^%\\]++|\\.|\\$)*+)", 1), F.length(line), " ")

    return F.array_join(F.transform(F.split(text, "\n", -1), one), "\n")


def coerced_levels(levels: Column) -> Column:
    """A map of heading levels as text: those that are no number from 1 to 6 go, they are not clamped."""
    return F.map_filter(F.transform_values(levels, lambda _, v: v.try_cast("int")), lambda _, v: v.between(1, 6))


def prompt(rows: DataFrame, by: str, order: str, line: Column) -> DataFrame:
    """One request text per key, its lines in order."""
    return rows.withColumn("t", line).groupBy(by).agg(F.expr(f"listagg(t, '\n') within group (order by {order})").alias("prompt"))


def doubled_starts(arguments: DataFrame) -> DataFrame:
    """Arguments of numbered commands that begin with the number they will be given; starred ones are told apart."""
    label = r"(?i)^(?:(?:fig(?:ure|\.)|tab(?:le|\.))\s*)?\d[\d.]*\s+\S"
    return arguments.filter(F.col("argument").rlike(label))


def array_overflows(docs: DataFrame) -> DataFrame:
    """(doc, columns, cells): array rows with more cells than the array has columns."""
    bodies = F.regexp_extract_all("text", F.lit(r"(?s)\\begin\{(?:array|tabular)\}\s*(\{[^}]*\}.*?)\\end\{(?:array|tabular)\}"), 1)
    found = docs.select("doc", F.explode(bodies).alias("body"))
    spec = F.regexp_extract("body", r"^\{([^}]*)\}", 1)
    columns = F.length(F.regexp_replace(spec, r"[^lcrpmbX]", ""))
    rows = F.split(F.regexp_replace("body", r"^\{[^}]*\}", ""), r"\\\\")
    flat = found.select("doc", columns.alias("columns"), F.explode(rows).alias("r"))
    cells = F.regexp_count(F.regexp_replace("r", r"\{[^{}]*\}|\\&", ""), F.lit("&")) + 1
    return flat.select("doc", "columns", cells.alias("cells")).filter("cells > columns")
