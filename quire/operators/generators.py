"""Row generators: documents to lines, paragraphs, headings, spans and references.

Each takes a DataFrame with a key column ``doc`` and ``text`` and explodes within the row, so none of
them shuffles; filters above them reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as T

HEADING = r"^(#{1,6})(?:[\t ]+)(\S.*?)[\t ]*$"
MD_IMAGE = r"!\[(?:[^\]]*)\]\(([^\s)]+)"
HTML_IMAGE = r'(?i)<img\s(?:[^>]*\s)?src="([^"]+)"'


def lines(docs: DataFrame) -> DataFrame:
    """(doc, line, text): lines from 1, the empty ones too."""
    return docs.select("doc", F.posexplode(F.split("text", "\n", -1)).alias("p", "text")).select("doc", (F.col("p") + 1).cast("long").alias("line"), "text")


def paragraphs(docs: DataFrame, *, keep_blank: bool) -> DataFrame:
    """(doc, nth, text) between blank lines: stripped of line feeds and without blank ones, or all as they are."""
    return docs.select("doc", F.posexplode(paragraph_pieces(F.col("text"), keep_blank=keep_blank)).alias("p", "text")).select("doc", F.col("p").cast("long").alias("nth"), "text")


def paragraph_pieces(text: Column, *, keep_blank: bool) -> Column:
    """What ``paragraphs`` explodes."""
    pieces = F.split(text, r"(?U)\n\s*\n" if keep_blank else r"\n[ \t]*\n", -1)
    if keep_blank:
        return pieces
    return F.filter(F.transform(pieces, lambda p: F.regexp_replace(p, r"^\n+|\n+$", "")), lambda p: T.strip(p) != "")


def headings(docs: DataFrame) -> DataFrame:
    """(doc, line, offset, level, title) of ATX headings; offset counts code points."""
    start = Window.partitionBy("doc").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    numbered = lines(docs).withColumn("offset", F.coalesce(F.sum(F.length("text") + 1).over(start), F.lit(0)))
    return numbered.filter(F.col("text").rlike(HEADING)).select(
        "doc", "line", F.col("offset").cast("long").alias("offset"),
        F.length(F.regexp_extract("text", HEADING, 1)).cast("long").alias("level"), F.regexp_extract("text", HEADING, 2).alias("title"),
    )


def ordered_distinct(rows: DataFrame, by: list[str], order: str) -> DataFrame:
    """One row per key with the first place it has."""
    return rows.groupBy(*by).agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))


def fenced_lines(docs: DataFrame) -> DataFrame:
    """Lines with ``block``, the display block a line is inside of (odd) or after (even), and ``fence``."""
    before = Window.partitionBy("doc").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    fence = T.strip(F.col("text")) == "$$"
    return lines(docs).withColumn("fence", fence).withColumn("block", F.sum(fence.cast("long")).over(before))


INLINE = r"(?<![\\$])\$(?!\$)([^$\n]+?)(?<!\\)\$(?!\$)"


def math_spans(docs: DataFrame) -> DataFrame:
    """(doc, line, kind, body) in document order.

    A line that is ``$$`` alone toggles a display block, an unterminated one is kept; elsewhere
    one-line ``$$..$$`` are displays, and ``$..$`` outside them inline spans.
    """
    return docs.select("doc", F.explode(_spans(F.col("text"))).alias("s")).select("doc", "s.*")


def _spans(text: Column) -> Column:
    """The spans of a text in order, (line, nth, kind, body): its lines are cut at the fences, all within the row."""

    def of_line(x: Column, line: Column) -> Column:
        display = F.regexp_extract_all(x, F.lit(r"\${2}(.+?)\${2}"), 1)
        inline = F.regexp_extract_all(F.regexp_replace(x, r"\$\$.+?\$\$", ""), F.lit(INLINE), 1)
        return F.transform(F.concat(_kinded(display, "display"), _kinded(inline, "inline")), lambda s, n: _span(line, n, s["kind"], s["body"]))

    def of_piece(lines: Column, bounds: Column, k: Column) -> Column:
        first = F.get(bounds, k)
        piece = F.slice(lines, first + 1, F.get(bounds, k + 1) - first - 1)
        block = F.array(_span(first, F.lit(0), F.lit("display"), F.array_join(piece, "\n")))
        return F.when(k % 2 == 1, block).otherwise(F.flatten(F.transform(piece, lambda x, i: of_line(x, first + 1 + i))))

    def of_lines(lines: Column) -> Column:
        fences = F.filter(F.transform(lines, lambda x, i: F.when(T.strip(x) == "$$", i + 1)), lambda i: i.isNotNull())
        bounds = F.concat(F.array(F.lit(0)), fences, F.array(F.size(lines) + 1))
        return T.bound(bounds, lambda b: F.flatten(F.transform(F.sequence(F.lit(0), F.size(b) - 2), lambda k: of_piece(lines, b, k))))

    return F.when(text.isNotNull(), T.bound(F.split(text, "\n", -1), of_lines))


def _span(line: Column, nth: Column, kind: Column, body: Column) -> Column:
    return F.struct(line.cast("long").alias("line"), nth.cast("long").alias("nth"), kind.alias("kind"), body.alias("body"))


def _kinded(bodies: Column, kind: str) -> Column:
    return F.transform(bodies, lambda b: F.struct(F.lit(kind).alias("kind"), b.alias("body")))


def latex_spans(docs: DataFrame) -> DataFrame:
    """(doc, source, nth, body): Markdown spans, then ``\\[..\\]``, then math environments.

    The three sources follow each other, so the rows are not in document order, and a dollar inside
    an environment shows up twice.
    """
    markdown = docs.select("doc", F.lit(0).alias("source"), F.posexplode(_spans(F.col("text"))).alias("nth", "s")).select("doc", "source", F.col("nth").cast("long").alias("nth"), "s.body")
    brackets = F.regexp_extract_all("text", F.lit(r"(?s)\\\[(.*?)\\\]"), 1)
    environments = F.regexp_extract_all("text", F.lit(r"(?s)\\begin\{(align|displaymath|eqnarray|equation|gather|multline)[*]?\}(.*?)\\end\{\1[*]?\}"), 2)
    rest = [docs.select("doc", F.lit(k).alias("source"), F.posexplode(x).alias("nth", "body")).withColumn("nth", F.col("nth").cast("long")) for k, x in ((1, brackets), (2, environments))]
    return markdown.unionByName(rest[0]).unionByName(rest[1])


def image_references(docs: DataFrame) -> DataFrame:
    """(doc, syntax, nth, path): Markdown references first, then HTML ones."""
    kinds = [docs.select("doc", F.lit(k).alias("syntax"), F.posexplode(F.regexp_extract_all("text", F.lit(p), 1)).alias("nth", "path")) for k, p in enumerate((MD_IMAGE, HTML_IMAGE))]
    return kinds[0].unionByName(kinds[1]).withColumn("nth", F.col("nth").cast("long"))


def page_ranges(specs: DataFrame) -> DataFrame:
    """(key, page) of page specifications such as ``1-40,350-380``; ``-40`` are the last forty.

    ``specs`` has key, spec and page_count; reversed ranges are turned round, pages clipped and distinct.
    """
    part = specs.select("key", "page_count", F.explode(F.split("spec", ",")).alias("part")).withColumn("part", F.trim("part")).filter("part <> ''")
    tail = F.col("part").startswith("-")
    a = F.when(tail, F.col("page_count") - F.substring("part", 2, 20).cast("long") + 1).otherwise(F.split("part", "-")[0].cast("long"))
    b = F.when(tail, F.col("page_count")).otherwise(F.element_at(F.split("part", "-"), -1).cast("long"))
    ends = part.select("key", F.greatest(F.least(a, b), F.lit(1)).alias("low"), F.least(F.greatest(a, b), F.col("page_count")).alias("high"))
    return ends.filter("low <= high").select("key", F.explode(F.sequence("low", "high")).alias("page")).distinct()


def log_errors(logs: DataFrame, *, ahead: int = 12) -> DataFrame:
    """(doc, line, message, tex_line): error lines of a compiler's log, each with the first place within ``ahead`` lines."""
    window = Window.partitionBy("doc").orderBy("line").rowsBetween(0, ahead)
    place = F.when(F.col("text").rlike(r"^l\.\d+"), F.regexp_extract("text", r"^l\.(\d+)", 1).cast("long"))
    found = lines(logs).withColumn("place", place).withColumn("tex_line", F.first("place", ignorenulls=True).over(window))
    errors = found.filter(F.col("text").startswith("! ")).select("doc", "line", F.substring("text", 3, 10_000).alias("message"), "tex_line")
    return errors.groupBy("doc", "message", "tex_line").agg(F.min("line").alias("line"))
