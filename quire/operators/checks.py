"""Checks over documents, lines and pairs, and the findings they come together in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import generators
from quire.operators.windows import top

MAX_EXAMPLES = 12
RESIDUE = 0.04
TRUNCATED = 0.4
FINDING = ["doc", "check", "severity", "message", "line", "context"]


def findings(rows: DataFrame, check: str, severity: str, message: Column, *, line: Column | None = None, context: Column | None = None) -> DataFrame:
    """Rows of a check as findings; line 0 means none."""
    return rows.select(
        F.col("doc").cast("string").alias("doc"), F.lit(check).alias("check"), F.lit(severity).alias("severity"), message.cast("string").alias("message"),
        (F.lit(0) if line is None else line).cast("long").alias("line"), (F.lit("") if context is None else context).alias("context"),
    )


def capped(found: DataFrame, most: int = MAX_EXAMPLES) -> DataFrame:
    """The first findings of each document and check, in document order."""
    place = Window.partitionBy("doc", "check").orderBy("line", "message")
    return found.withColumn("nth_of_check", F.row_number().over(place)).filter(F.col("nth_of_check") <= most).drop("nth_of_check")


def dollar_runs(docs: DataFrame) -> DataFrame:
    """(doc, run, times, welded): runs of dollar signs by length; longer than two are welded delimiters."""
    runs = docs.select("doc", F.explode(T.dollar_runs(F.col("text"))).alias("run"))
    return runs.groupBy("doc", "run").agg(F.count(F.lit(1)).alias("times")).withColumn("welded", F.col("run") > 2)


def placed_paragraphs(docs: DataFrame) -> DataFrame:
    """Paragraphs with ``line``: it counts the line feeds of the paragraphs before and two for each separator."""

    def feeds(p: Column) -> Column:
        return (F.length(p) - F.length(F.replace(p, F.lit("\n"), F.lit("")))).cast("long")

    def placed(pieces: Column) -> Column:
        start = F.struct(F.array().cast("array<bigint>").alias("lines"), F.lit(1).cast("long").alias("next"))
        lines = F.aggregate(pieces, start, lambda s, p: F.struct(F.array_append(s["lines"], s["next"]).alias("lines"), (s["next"] + feeds(p) + 2).alias("next")), lambda s: s["lines"])
        return F.zip_with(pieces, lines, lambda p, line: F.struct(p.alias("text"), line.alias("line")))

    found = docs.filter("text is not null").select("doc", F.posexplode(T.bound(generators.paragraph_pieces(F.col("text"), keep_blank=True), placed)).alias("p", "s"))
    return found.select("doc", F.col("p").cast("long").alias("nth"), "s.*")


def inline_parity(docs: DataFrame) -> DataFrame:
    """(doc, line, n): paragraphs of even pairs but an odd number of single dollar signs."""
    n = T.inline_marks(F.col("text"))
    return placed_paragraphs(docs).filter((T.display_marks(F.col("text")) % 2 == 0) & (n % 2 == 1)).select("doc", "line", n.alias("n"))


def unusual_characters(docs: DataFrame, *, ceiling: str = "\\x{FF}") -> DataFrame:
    """(sign, times, first_doc, code) of the characters beyond a code point."""
    signs = docs.select("doc", F.explode(F.regexp_extract_all("text", F.lit(f"([^\\x{{00}}-{ceiling}])"), 1)).alias("sign"))
    return signs.groupBy("sign").agg(F.count(F.lit(1)).alias("times"), F.min("doc").alias("first_doc")).withColumn("code", F.expr("ascii(sign)").cast("long"))


def padded_spans(spans: DataFrame) -> DataFrame:
    """Inline spans that white space pads."""
    return spans.filter((F.col("kind") == "inline") & (F.col("body") != T.strip(F.col("body"))))


def unbalanced(rows: DataFrame) -> DataFrame:
    """Rows whose braces do not match, with the depth."""
    return rows.withColumn("depth", T.brace_imbalance(F.col("text"))).filter("depth <> 0")


def many_tags(spans: DataFrame) -> DataFrame:
    """Spans of more than one equation tag."""
    return spans.withColumn("tags", T.count_of(F.col("body"), r"\\tag[\s*]*\{[^{}]*\}")).filter("tags > 1")


def dangling(spans: DataFrame, commands: DataFrame) -> DataFrame:
    """Spans that end in a command that takes an argument; ``commands`` has the names."""
    last = spans.withColumn("command", F.regexp_extract(T.strip(F.col("body")), r"\\([A-Za-z]+)$", 1))
    # most spans end in no command, and the others in a few; the names are a short list
    return last.filter("command <> ''").join(F.broadcast(commands.select("command").distinct()), "command", "left_semi")


def unknown_words(words: DataFrame, vocabulary: DataFrame, *, by: list[str], most: int = MAX_EXAMPLES) -> DataFrame:
    """The rarest words that the vocabulary lacks, ties in order of first appearance, of each group."""
    # counted first, so that the join sees each word of a group once and not as often as it stands there
    counted = words.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"))
    unknown = counted.join(vocabulary, "word", "left_anti")
    return top(unknown, by, [F.asc("n"), F.asc("first"), F.asc("word")], most)


def doubled_commands(rows: DataFrame) -> DataFrame:
    """(doc, command): names that are written twice over one backslash."""
    return rows.select("doc", F.explode(F.regexp_extract_all("text", F.lit(r"\\(\p{Alpha}+?)\1(?!\p{Alpha})"), 1)).alias("command"))


def heading_levels(headings: DataFrame) -> DataFrame:
    """(doc, headings, largest, flat): a document's headings, its largest level, and whether nine in ten of 20 or more share it."""
    levels = headings.groupBy("doc", "level").agg(F.count(F.lit(1)).alias("n"))
    shape = levels.groupBy("doc").agg(F.sum("n").alias("headings"), F.max("n").alias("largest"))
    return shape.withColumn("flat", (F.col("headings") >= 20) & (F.col("largest") * 10 >= F.col("headings") * 9))


def missing_files(references: DataFrame, files: DataFrame) -> DataFrame:
    """Distinct references, no URLs, that neither stand in ``files`` as they are nor under images/."""
    local = references.filter(~F.col("path").rlike("^[a-z]+://")).select("doc", "path").distinct()
    named = F.concat(F.lit("images/"), F.regexp_extract("path", r"([^/]+)$", 1))
    seen = local.withColumn("named", named)
    return seen.join(files.select(F.col("file").alias("path")), "path", "left_anti").join(files.select(F.col("file").alias("named")), "named", "left_anti").select("doc", "path")


def pair_checks(pairs: DataFrame, *, alphabet: str = T.CJK_MAIN, residue: float = RESIDUE, truncated: float = TRUNCATED) -> DataFrame:
    """(doc, check) for pairs (doc, source, target): left-over source script, truncation, image tokens lost or invented."""
    found, solid = T.residue_counts(F.col("target"), alphabet)
    tokens = {side: F.array_distinct(F.regexp_extract_all(side, F.lit(r"IMG_\d{4}"), 0)) for side in ("source", "target")}
    checks = {
        "untranslated": (solid > 0) & (found > solid * residue),
        "truncated": (F.length("source") > 0) & (F.length("target") < F.length("source") * truncated),
        "tokens-lost": F.size(F.array_except(tokens["source"], tokens["target"])) > 0,
        "tokens-invented": F.size(F.array_except(tokens["target"], tokens["source"])) > 0,
    }
    named = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in checks.items()]))
    return pairs.select("doc", F.explode(named).alias("check"))


def diagnosis(source: Column, reply: Column, *, least: float = 0.30, floor: int = 200, sentinel: str | None = None) -> Column:
    """The first rule that a reply fails: empty, too short for a source of some length, without the sentinel; else null."""
    short = (F.length(source) > floor) & (F.length(reply) < F.length(source) * least)
    rule = F.when(T.strip(reply) == "", "empty").when(short, "short")
    return rule if sentinel is None else rule.when(T.last_line(reply) != sentinel, "no-sentinel")


def length_outliers(pairs: DataFrame, by: str, *, least: int = 4, share: float = 0.5) -> DataFrame:
    """Pairs of a group of ``least`` or more whose length ratio is under a share of the group's median."""
    ratio = pairs.filter(F.length("source") > 0).withColumn("ratio", F.length("target") / F.length("source"))
    medians = ratio.groupBy(by).agg(F.median("ratio").alias("median"), F.count(F.lit(1)).alias("pairs")).filter(F.col("pairs") >= least)
    return ratio.join(medians, by).filter(F.col("ratio") < F.col("median") * share)


def waived(found: DataFrame, waivers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Findings left after waivers, and the waivers that none used.

    A waiver (pos, check, excerpt, reason) fits findings of its check, or of any for ``*``, whose
    context holds its excerpt; info findings are never waived and a waiver without a reason does
    nothing.  The first that fits a finding is the one it uses.

    Findings meet waivers of their check by key.  One for any check is written out for the checks
    that there are, so there is no second kind of join, and none of all pairs.
    """
    valid = waivers.filter(T.strip(F.coalesce("reason", F.lit(""))) != "")
    f = found.withColumn("id", F.xxhash64(*FINDING)).alias("f")
    names = found.filter("severity <> 'info'").agg(F.collect_set("check").alias("every"))  # the names of checks, a few dozen
    named = F.when(F.col("check") == "*", F.col("every")).otherwise(F.array("check"))
    w = valid.join(names).select("pos", "excerpt", F.explode(named).alias("check")).alias("w")
    fits = F.contains("f.context", "w.excerpt") & (F.col("f.severity") != "info")
    met = f.join(w, (F.col("f.check") == F.col("w.check")) & fits).select("f.id", "w.pos")
    used = met.groupBy("id").agg(F.min("pos").alias("pos"))
    left = f.join(used, "id", "left_anti").select(*[f"f.{c}" for c in FINDING])
    return left, waivers.join(used.select("pos").distinct(), "pos", "left_anti")


def gate(found: DataFrame) -> DataFrame:
    """One row: how many findings, how many to review, and whether the gate is shut."""
    review = F.col("severity") == "review"
    return found.agg(F.count(F.lit(1)).alias("findings"), F.count_if(review).alias("review"), F.coalesce(F.bool_or(review), F.lit(False)).alias("shut"))


def summary(found: DataFrame) -> DataFrame:
    """Findings by severity and check."""
    return found.groupBy("severity", "check").agg(F.count(F.lit(1)).alias("n"))


def fix_counts(docs: DataFrame, fixes: list[tuple[str, str, str]]) -> DataFrame:
    """Documents after a chain of regular replacements (name, pattern, replacement), with the times of each."""
    text, counts = F.col("text"), []
    for name, pattern, new in fixes:
        counts.append(T.count_of(text, pattern).alias(name))
        text = F.regexp_replace(text, pattern, new)
    return docs.select("doc", text.alias("text"), *counts)
