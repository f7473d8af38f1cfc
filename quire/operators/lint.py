"""The whole surface of checks in its fixed order, for Markdown sources and LaTeX targets.

Each check gives rows (doc, check, severity, message, line, context); ``rank`` is its place in the
order.  Dimensions that a check needs (vocabulary, packages, files, ...) are DataFrames; a check
without its dimension is left out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import checks, generators, markup, records, rewrites

HEADING_COMMANDS = ["chapter", "section", "subsection", "subsubsection"]
NUMBERED_COMMANDS = [*HEADING_COMMANDS, "caption"]


class Dimensions(NamedTuple):
    """What checks look things up in; None leaves out the checks that need it."""

    #: (word): command names that are known.
    vocabulary: DataFrame | None = None
    #: (command): commands that take an argument.
    arguments: DataFrame | None = None
    #: (command, provider): packages that commands need.
    packages: DataFrame | None = None
    #: (file): images at hand.
    files: DataFrame | None = None


Check = Callable[[DataFrame, Dimensions], DataFrame | None]


def paragraph_braces(docs: DataFrame) -> DataFrame:
    """(doc, line, depth, text) of paragraphs whose braces do not match."""
    return checks.unbalanced(checks.placed_paragraphs(docs)).select("doc", "line", F.col("depth").cast("long").alias("depth"), "text")


def starred_numbers(docs: DataFrame) -> DataFrame:
    """(doc, command, argument, line) of starred headings that begin with a number, which nothing will number again."""
    found = rewrites.doubled_starts(markup.braced_arguments(docs, HEADING_COMMANDS, placed=True)).filter("star")
    return found.select("doc", "command", "argument", "line")


def fragment_issues(docs: DataFrame) -> DataFrame:
    """(doc, issue) of body fragments; a fragment without a row is usable.

    What belongs to a preamble, environments that do not nest, braces, and dollar signs without a partner.
    """
    code = rewrites.blanked_comments(F.col("text"))
    leaks = docs.select("doc", F.explode(F.array_distinct(F.regexp_extract_all(code, F.lit(markup.PREAMBLE_PATTERN), 0))).alias("x")).select("doc", F.concat(F.lit("preamble: "), "x").alias("issue"))
    environments = markup.environment_issues(docs).select("doc", F.concat(F.col("kind"), F.lit(": "), "name").alias("issue"))
    depth = T.brace_imbalance(F.col("text"))
    rest = F.array_compact(F.array(
        F.when(depth > 0, F.concat(depth.cast("string"), F.lit(" unclosed braces"))), F.when(depth < 0, F.lit("a closing brace without its opening one")),
        F.when(T.inline_marks(F.col("text")) % 2 == 1, F.lit("odd number of dollar signs")), F.when(T.display_marks(F.col("text")) % 2 == 1, F.lit("odd number of display delimiters")),
    ))
    return leaks.unionByName(environments).unionByName(docs.select("doc", F.explode(rest).alias("issue")))


def diagnostics(docs: DataFrame) -> DataFrame:
    """(doc, diagnostic, value): runs of dollar signs by length, displays, padded spans, headings by level."""

    def counted(rows: DataFrame, name: Column) -> DataFrame:
        return rows.groupBy("doc", name.alias("diagnostic")).agg(F.count(F.lit(1)).alias("value"))

    runs = checks.dollar_runs(docs).select("doc", F.concat(F.lit("dollar-run-"), F.col("run").cast("string")).alias("diagnostic"), F.col("times").alias("value"))
    displays = docs.select("doc", F.lit("display-delimiters").alias("diagnostic"), T.display_marks(F.col("text")).alias("value"))
    padded = counted(checks.padded_spans(generators.math_spans(docs)), F.lit("padded-spans"))
    levels = counted(generators.headings(docs), F.concat(F.lit("heading-level-"), F.col("level").cast("string")))
    return reduce(DataFrame.unionByName, (displays, padded, levels), runs)


# Checks in the form of findings.


def _each(rows: DataFrame, check: str, message: Column, line: Column | None = None, context: Column | None = None, severity: str = "review") -> DataFrame:
    return checks.findings(rows, check, severity, message, line=line, context=None if context is None else T.excerpt(context))


def _environments(docs: DataFrame, _: Dimensions) -> DataFrame:
    rows = markup.environment_issues(docs).withColumnRenamed("line", "at")
    named = _each(rows, "environment-balance", F.concat_ws(" ", "kind", "name"), F.col("at"), F.col("name"))
    return named.withColumn("check", F.when(F.col("message").startswith("undefined"), "undefined-environment").otherwise(F.col("check")))


def _preamble(docs: DataFrame, _: Dimensions) -> DataFrame:
    return _each(markup.preamble_leaks(docs), "preamble-leakage", F.lit("belongs to the preamble"), F.col("line"))


def _characters(docs: DataFrame, _: Dimensions) -> DataFrame:
    signs = docs.select("doc", F.explode(F.regexp_extract_all("text", F.lit(r"([^\x{00}-\x{FF}])"), 1)).alias("sign")).groupBy("doc", "sign").agg(F.count(F.lit(1)).alias("n"))
    code = F.format_string("U+%04X %d times", F.expr("ascii(sign)"), "n")
    thin = F.col("context").rlike(r"[\x{200B}-\x{200F}\x{2060}\x{FEFF}]")
    return _each(signs, "unicode-character", code, context=F.col("sign")).withColumn("check", F.when(thin, "zero-width-character").otherwise(F.col("check")))


def _delimiters(docs: DataFrame, _: Dimensions) -> DataFrame:
    return _each(markup.bare_delimiters(docs), "display-delimiter", F.concat(F.col("delimiters").cast("string"), F.when(F.col("repairable"), " that alternate").otherwise(" that do not alternate")))


def _misplaced(docs: DataFrame, _: Dimensions) -> DataFrame:
    return _each(markup.misplaced_tags(docs), "misplaced-tag", F.lit("a tag outside an environment that numbers"), context=F.col("body"))


def _braces(docs: DataFrame, _: Dimensions) -> DataFrame:
    return _each(paragraph_braces(docs), "brace-balance", F.col("depth"), F.col("line"), F.col("text"))


def _inline(docs: DataFrame, _: Dimensions) -> DataFrame:
    return _each(checks.inline_parity(docs), "inline-parity", F.col("n"), F.col("line"))


def _doubled_numbers(docs: DataFrame, _: Dimensions) -> DataFrame:
    found = rewrites.doubled_starts(markup.braced_arguments(docs, NUMBERED_COMMANDS, placed=True)).filter("not star")
    return _each(found, "duplicated-number", F.col("command"), F.col("line"), F.col("argument"))


def _starred(docs: DataFrame, _: Dimensions) -> DataFrame:
    return _each(starred_numbers(docs), "numbered-starred-heading", F.col("command"), F.col("line"), F.col("argument"))


def _markdown_headings(docs: DataFrame, _: Dimensions) -> DataFrame:
    lines = generators.lines(docs.withColumn("text", rewrites.blanked_comments(F.col("text"))))
    return _each(lines.filter(F.col("text").rlike(r"^[ \t]{0,3}#{1,6}[ \t]+\S")), "markdown-heading", F.lit("a Markdown heading"), F.col("line"), F.col("text"))


def _dangling(docs: DataFrame, known: Dimensions) -> DataFrame | None:
    return known.arguments and _each(checks.dangling(generators.latex_spans(docs.filter(F.col("text").rlike(r"(?U)\\[A-Za-z]+\s*(?:\$|\\|\z)|\\\$\$"))), known.arguments), "dangling-command", F.col("command"), context=F.col("body"))


def _doubled_commands(docs: DataFrame, _: Dimensions) -> DataFrame:
    return _each(checks.doubled_commands(docs), "doubled-command", F.col("command"))


def _unknown(docs: DataFrame, known: Dimensions) -> DataFrame | None:
    if known.vocabulary is None:
        return None
    code = generators.lines(docs.withColumn("text", rewrites.blanked_comments(F.col("text"))))
    used = code.select("doc", F.col("line").alias("seq"), F.explode(F.regexp_extract_all("text", F.lit(r"\\(\p{Alpha}+)"), 1)).alias("word"))
    return _each(checks.unknown_words(used, known.vocabulary, by=["doc"]), "unknown-command", F.concat(F.col("word"), F.lit(" "), F.col("n").cast("string"), F.lit(" times")), F.col("first"))


def _text_in_math(docs: DataFrame, _: Dimensions) -> DataFrame:
    return _each(markup.text_in_math(docs), "text-command-in-math", F.col("command"), F.col("line"), F.col("body"))


def _packages(docs: DataFrame, known: Dimensions) -> DataFrame | None:
    return known.packages and _each(markup.required_packages(docs, known.packages), "missing-package", F.col("command"), F.col("line"))


def _chapters(docs: DataFrame, _: Dimensions) -> DataFrame:
    drift = records.chapter_drift(markup.chapter_tags(docs))
    return _each(drift, "chapter-numbering", F.format_string("chapter %d is tagged %d", "number", "tagged"))


def _images(docs: DataFrame, known: Dimensions) -> DataFrame | None:
    if known.files is None:
        return None
    called = markup.braced_arguments(docs, ["includegraphics"]).select("doc", F.col("argument").alias("path"))
    return _each(checks.missing_files(called, known.files), "image-path", F.col("path"))


def _source_images(docs: DataFrame, known: Dimensions) -> DataFrame | None:
    return known.files and _each(checks.missing_files(generators.image_references(docs), known.files), "image-path", F.col("path"))


def _runs(docs: DataFrame, _: Dimensions) -> DataFrame:
    welded = docs.filter(F.contains("text", F.lit("$$$")))  # runs are counted where one is long enough
    return _each(checks.dollar_runs(welded).filter("welded"), "dollar-runs", F.format_string("%d signs, %d times", "run", "times"))


def _displays(docs: DataFrame, _: Dimensions) -> DataFrame:
    n = T.display_marks(F.col("text"))
    return _each(docs.filter(n % 2 == 1), "display-parity", n)


def _padding(docs: DataFrame, _: Dimensions) -> DataFrame:
    return _each(checks.padded_spans(generators.math_spans(docs)), "delimiter-whitespace", F.lit("padded"), F.col("line"), F.col("body"), "info")


def _escaped(docs: DataFrame, _: Dimensions) -> DataFrame:
    n = T.count_of(F.col("text"), r"\\\$")
    return _each(docs.filter(n > 0), "escaped-dollar", n, severity="info")


def _span_braces(docs: DataFrame, _: Dimensions) -> DataFrame:
    spans = generators.math_spans(docs).withColumn("text", F.col("body"))
    return _each(checks.unbalanced(spans), "math-brace-balance", F.col("depth"), F.col("line"), F.col("body"))


def _tags(docs: DataFrame, _: Dimensions) -> DataFrame:
    tagged = docs.filter(F.col("text").rlike(r"(?s)\\tag.*\\tag|\\t?a?\$\$"))  # a span is a part of its text, but for displays taken out of it
    return _each(checks.many_tags(generators.math_spans(tagged)), "multiple-tags", F.col("tags"), F.col("line"), F.col("body"))


def _arrays(docs: DataFrame, _: Dimensions) -> DataFrame:
    return _each(rewrites.array_overflows(docs), "array-columns", F.format_string("%d cells in %d columns", "cells", "columns"))


def _source_dangling(docs: DataFrame, known: Dimensions) -> DataFrame | None:
    # a span ends before a dollar sign or with its text; a display taken out may join its last command
    ending = docs.filter(F.col("text").rlike(r"(?U)\\[A-Za-z]+\s*(?:\$|\z)|\\\$\$"))
    return known.arguments and _each(checks.dangling(generators.math_spans(ending), known.arguments), "dangling-command", F.col("command"), F.col("line"), F.col("body"))


def _levels(docs: DataFrame, _: Dimensions) -> DataFrame:
    return _each(checks.heading_levels(generators.headings(docs)).filter("flat"), "heading-levels", F.format_string("%d of %d headings share a level", "largest", "headings"))


def _tables(docs: DataFrame, _: Dimensions) -> DataFrame:
    return _each(markup.html_tables(docs).filter("defect <> ''"), "table", F.col("defect"), severity="info")


#: Checks of LaTeX targets, in order.
LATEX: tuple[Check, ...] = (
    _environments, _preamble, _characters, _delimiters, _misplaced, _braces, _inline, _doubled_numbers, _starred, _markdown_headings,
    _dangling, _doubled_commands, _unknown, _text_in_math, _packages, _chapters, _images,
)
#: Checks of Markdown sources, in order.
MARKDOWN: tuple[Check, ...] = (
    _runs, _displays, _inline, _padding, _escaped, _span_braces, _tags, _arrays, _source_dangling, _unknown, _levels, _source_images, _tables,
)


def surface(docs: DataFrame, order: tuple[Check, ...], known: Dimensions = Dimensions()) -> DataFrame:  # noqa: B008  immutable
    """Findings of all checks of ``order`` over documents (doc, text), with ``rank``; at most a dozen of a check for each document."""
    found = [rows.withColumn("rank", F.lit(k)) for k, check in enumerate(order) if (rows := check(docs, known)) is not None]
    return checks.capped(reduce(DataFrame.unionByName, found))
