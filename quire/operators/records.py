"""Decisions on figures and divisions: verdicts, gaps, coverage, validation, location, follow-ups."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as T

LABELS = ("figure", "decoration", "logo", "other")
DROP_CONFIDENCE = 0.9
METHODS = {"overlay": True, "redraw": True, "keep": False}
ENUMS = {"kind": ("formula", "number", "term", "omission", "addition", "style", "figure", "other"), "severity": ("major", "minor"), "action": ("fix", "keep", "report")}
LOCATE_LEAST, LOCATE_NEAR = 0.6, 0.1


def verdicts(replies: DataFrame) -> DataFrame:
    """(id, label, confidence, chinese_text, flag) of classifier replies (id, reply).

    The label must be a known one and the confidence a number, no boolean; it is clamped to 0 and 1.
    Whatever else is a malformed reply, without a label.
    """
    body = T.json_object(F.col("reply"))
    raw = F.get_json_object(body, "$.confidence")
    number = F.when(~F.coalesce(body.rlike(r'"confidence"\s*:\s*"'), F.lit(False)), F.expr("try_cast(get_json_object(body, '$.confidence') as double)"))
    found = replies.withColumn("body", body).withColumns({"l": F.get_json_object("body", "$.label"), "c": number, "t": F.get_json_object("body", "$.chinese_text"), "raw": raw})
    good = F.coalesce(F.col("l").isin(*LABELS) & F.col("c").isNotNull(), F.lit(False))
    return found.select(
        "id", F.when(good, F.col("l")).alias("label"), F.when(good, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("c")))).alias("confidence"),
        F.when(good & F.col("t").isin("true", "false"), F.col("t") == "true").alias("chinese_text"), F.when(~good, "malformed").alias("flag"),
    )


def decided(records: DataFrame, *, mode: str = "on", threshold: float = DROP_CONFIDENCE) -> DataFrame:
    """``keep`` and ``new_flag`` of uncaptioned records (label, confidence, in_gap, flag).

    Only a decoration of enough confidence outside a numbering gap is dropped; in a dry run it is
    flagged instead.  Everything uncertain is kept and flagged.
    """
    label, sure = F.col("label"), F.coalesce(F.col("confidence") >= threshold, F.lit(False))
    unread = F.lit(mode == "off") | label.isNull()
    drop = ~unread & (label == "decoration") & sure & ~F.col("in_gap")
    flag = (
        F.when(unread & F.col("flag").isNull(), "unclassified").when(unread, F.col("flag")).when(label == "figure", None)
        .when((label == "decoration") & sure & F.col("in_gap"), "gap").when(drop & F.lit(mode == "dry-run"), "would-drop").when(drop, None).otherwise("uncertain")
    )
    return records.withColumn("keep", ~(drop & F.lit(mode != "dry-run"))).withColumn("new_flag", flag)


def split_number(number: Column) -> tuple[Column, Column]:
    """The sequence a figure number belongs to and its position in it; null if it has no such form."""
    form = r"^(.+)[-.](\d+)'?$"
    return F.nullif(F.regexp_extract(number, form, 1), F.lit("")), F.nullif(F.regexp_extract(number, form, 2), F.lit("")).cast("long")


def figure_gaps(sites: DataFrame) -> DataFrame:
    """Uncaptioned sites (doc, pos, number) where a caption number is missing.

    The next numbered site must be two or more after the last one of its sequence, or beyond the
    first where its sequence begins; without a next one there is no gap.
    """
    seq, at = split_number(F.col("number"))
    parsed = sites.withColumn("n", F.when(seq.isNotNull(), F.struct(seq.alias("seq"), at.alias("at"))))
    w = Window.partitionBy("doc").orderBy("pos")
    last = F.last("n", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    following = F.first("n", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    known = parsed.withColumns({"p": last, "f": following}).filter(F.col("number").isNull() & F.col("f").isNotNull())
    floor = F.when(F.col("p.seq") == F.col("f.seq"), F.col("p.at") + 1).otherwise(1)
    return known.filter(F.col("f.at") > floor).drop("n", "p", "f")


def figure_numbers(figures: DataFrame) -> DataFrame:
    """(doc, seq, at, problem) of figure numbers (doc, number) that are missing from or twice in their sequence."""
    seq, at = split_number(F.col("number"))
    parsed = figures.select("doc", seq.alias("seq"), at.alias("at")).filter("seq is not null")
    twice = parsed.groupBy("doc", "seq", "at").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc", "seq", "at", F.lit("duplicate").alias("problem"))
    whole = parsed.groupBy("doc", "seq").agg(F.max("at").alias("most"), F.collect_set("at").alias("have"))
    missing = whole.select("doc", "seq", F.explode(F.array_except(F.sequence(F.lit(1).cast("long"), F.col("most")), "have")).alias("at"), F.lit("missing").alias("problem"))
    return twice.unionByName(missing)


def figure_coverage(used: DataFrame, tokens: DataFrame, records: DataFrame) -> DataFrame:
    """(doc, token, problem): used tokens without a record or whose image was dropped; mapped tokens that nothing uses."""
    joined = used.select("doc", "token").distinct().join(tokens, ["doc", "token"])
    named = joined.withColumn("name", F.regexp_extract("path", r"([^/]+)$", 1)).join(records, ["doc", "name"], "left")
    problem = F.when(F.col("keep").isNull(), "no-record").when(~F.col("keep"), "dropped")
    unused = tokens.join(used.select("doc", "token").distinct(), ["doc", "token"], "left_anti").select("doc", "token", F.lit("unused").alias("problem"))
    return named.select("doc", "token", problem.alias("problem")).filter("problem is not null").unionByName(unused)


def finding_problems(findings: DataFrame) -> DataFrame:
    """(doc, id, problems) of verification findings: unknown values, a fix without text, an excerpt that its text lacks, repeated ids.

    Misses are flags: no finding goes for them.
    """
    rules = [F.when(~F.coalesce(F.col(c).isin(*values), F.lit(False)), F.lit(f"unknown {c}")) for c, values in ENUMS.items()]
    rules.append(F.when((F.col("action") == "fix") & (F.coalesce("fixed_text", F.lit("")) == ""), F.lit("fix without text")))
    rules.append(F.when(~F.contains(T.compact(F.col("text")), T.compact(F.col("excerpt"))), F.lit("excerpt not found")))
    rules.append(F.when(F.count(F.lit(1)).over(Window.partitionBy("doc", "id")) > 1, F.lit("repeated id")))
    return findings.select("doc", "id", F.array_compact(F.array(*rules)).alias("problems"))


def spec_problems(specs: DataFrame) -> DataFrame:
    """(image, problems) of figure specs: method, labels where it needs them, boxes inside the picture, translated labels."""
    box = "exists(labels, l -> l.box is not null and (size(l.box) <> 4 or l.box[0] < 0 or l.box[1] < 0 or l.box[2] > 1 or l.box[3] > 1 or l.box[0] >= l.box[2] or l.box[1] >= l.box[3]))"
    rules = [
        F.when(~F.coalesce(F.col("method").isin(*METHODS), F.lit(False)), F.lit("unknown method")),
        F.when(F.col("method").isin(*[m for m, needs in METHODS.items() if needs]) & (F.coalesce(F.size("labels"), F.lit(0)) <= 0), F.lit("no labels")),
        F.when(F.coalesce(F.expr(box), F.lit(False)), F.lit("bad box")),
        F.when(F.coalesce(F.expr("exists(labels, l -> l.en rlike '[\\\\x{3000}-\\\\x{303F}\\\\x{3400}-\\\\x{9FFF}\\\\x{FF00}-\\\\x{FFEF}]')"), F.lit(False)), F.lit("untranslated label")),
    ]
    return specs.select("image", F.array_compact(F.array(*rules)).alias("problems"))


def substituted(images: DataFrame, finished: DataFrame, folder: str = "figure_text") -> DataFrame:
    """The image map (token, path) with the figures that ``finished`` (name) has pointing at their new files, and whether they do."""
    named = images.withColumn("name", F.regexp_extract("path", r"([^/]+)$", 1))
    met = named.join(finished.select("name", F.lit(True).alias("new")).distinct(), "name", "left")
    stem = F.regexp_replace("name", r"\.[^.]*$", "")
    path = F.when(F.col("new"), F.concat(F.lit(f"{folder}/"), stem, F.lit(".pdf"))).otherwise(F.col("path"))
    return met.select("token", path.alias("path"), F.coalesce("new", F.lit(False)).alias("swapped"))


def spec_status(specs: DataFrame) -> DataFrame:
    """(image, status): done while the rendered hash is the spec's, stale when it is another, else failed or todo."""
    own = F.sha2(F.concat_ws("\x1f", "method", F.to_json("labels")), 256)
    status = F.when(F.col("error").isNotNull(), "failed").when(F.col("rendered").isNull(), "todo").when(F.col("accepted") == F.lit(False), "rejected").when(F.col("rendered") == own, "done").otherwise("stale")
    return specs.select("image", status.alias("status"))


def first_heading(headings: DataFrame, front: str = r"(?i)^(preface|contents|copyright|前言|目录)") -> DataFrame:
    """(doc, warning): documents that begin with neither a chapter nor a part and a chapter."""
    kind = F.when(F.col("title").rlike(front), "front matter").when(F.col("title").rlike(r"(?i)^(part\b|第.+[篇部])"), "part").when(F.col("title").rlike(r"(?i)^(chapter\b|第.+章|\d+\s)"), "chapter").otherwise("other")
    w = Window.partitionBy("doc").orderBy("line")
    top = headings.filter("level = 1").withColumns({"kind": kind, "nth": F.row_number().over(w), "next": F.lead(kind).over(w)}).filter("nth = 1")
    good = (F.col("kind") == "chapter") | ((F.col("kind") == "part") & F.coalesce(F.col("next") == "chapter", F.lit(False)))
    return top.filter(~good).select("doc", F.when(F.col("kind") == "front matter", "front matter").otherwise("no chapter").alias("warning"))


def chapter_drift(chapters: DataFrame) -> DataFrame:
    """Chapters (doc, pos, starred, tags) whose printed number leaves their tags' prefix in a new way.

    Tags are the prefixes of the chapter's equations; the most common one, the least of equals,
    counts.  Starred chapters take no number.  A drift is reported unless it is zero or the last one.
    """
    w = Window.partitionBy("doc").orderBy("pos")
    plain = chapters.filter("not starred").withColumn("number", F.row_number().over(w).cast("long"))
    each = plain.select("doc", "pos", "number", F.explode("tags").alias("tag")).groupBy("doc", "pos", "number", "tag").agg(F.count(F.lit(1)).alias("n"))
    mode = each.groupBy("doc", "pos", "number").agg(F.min_by("tag", F.struct(-F.col("n"), "tag")).alias("tagged"))
    moved = mode.withColumn("drift", F.col("number") - F.col("tagged"))
    return moved.withColumn("before", F.coalesce(F.lag("drift").over(w), F.lit(0))).filter("drift <> 0 and drift <> before").drop("before")


def score(target: str, text: str) -> float:
    """How well a passage is found in a text: one if it stands there, else its longest run or, from ``LOCATE_LEAST`` on, likeness.

    A text may be any number of times as long as the passage: only the likeness depends on that.
    """
    if "" in (target, text) or target in text:
        return float(bool(target) and target in text)
    likeness = SequenceMatcher(None, target, text, autojunk=False)
    run = likeness.find_longest_match().size / len(target)
    return max(run, likeness.ratio()) if likeness.real_quick_ratio() >= LOCATE_LEAST else run


def located(excerpts: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc, id, pages, how) of excerpts (doc, id, first, last, excerpt) among page texts (doc, page, text).

    Pages of the excerpt's own span, and one beyond either end, come first; the whole document is
    searched only for excerpts that have no match there.  A neighbour that scores within a tenth
    counts as the other half of a passage across a page break.  Texts meet by merging: what a plan
    expects of their size, before they are made, would send all of them through the driver.
    """

    def scores(source: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in source:
            yield batch.assign(score=[score(e, t) for e, t in zip(batch["excerpt"], batch["text"], strict=True)])[["doc", "id", "page", "score"]]

    wanted = excerpts.withColumn("excerpt", T.compact(F.col("excerpt")))
    # a page scores only with a run of so much of the excerpt, which holds one of its blocks, or if it is short enough to be like it
    n = F.length("excerpt")
    size = F.greatest(F.floor((F.ceil(n * LOCATE_LEAST) + 1) / 2), F.lit(1)).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), F.floor(n / size).cast("int") - 1), lambda j: F.col("excerpt").substr(j * size + 1, size))
    alike = (n > 0) & ((F.length("text") <= n * (2 / LOCATE_LEAST - 1) + 1) | F.exists(blocks, lambda b: F.contains(F.col("text"), b)))
    texts = pages.select("doc", "page", T.compact(F.col("text")).alias("text"))
    kinds = f"doc {excerpts.schema['doc'].dataType.simpleString()}, id long, page long, score double"

    def tried(some: DataFrame, near: bool) -> DataFrame:
        met = some.join(texts.hint("merge"), "doc")
        met = met.filter(F.col("page").between(F.col("first") - 1, F.col("last") + 1)) if near else met
        met = met.filter(F.coalesce(alike, F.lit(False)))
        return met.select("doc", "id", "page", "excerpt", "text").mapInPandas(scores, kinds).filter(F.col("score") >= LOCATE_LEAST)

    inside = tried(wanted, True)
    outside = tried(wanted.join(inside.select("doc", "id").distinct().hint("merge"), ["doc", "id"], "left_anti"), False)
    best = inside.unionByName(outside).groupBy("doc", "id", "page").agg(F.max("score").alias("score"))
    w = Window.partitionBy("doc", "id")
    ranked = best.withColumn("rank", F.row_number().over(w.orderBy(F.desc("score"), "page"))).withColumns({"top": F.max("score").over(w)})
    first = F.max(F.when(F.col("rank") == 1, F.col("page"))).over(w)
    shown = ranked.withColumn("main", first).filter("rank = 1 or (rank = 2 and abs(page - main) = 1 and score >= top - 0.1)")
    return shown.groupBy("doc", "id").agg(F.array_sort(F.collect_list("page")).alias("pages"), F.when(F.max("top") >= 1, "exact").otherwise("fuzzy").alias("how"))


def span_of_pages(hits: DataFrame) -> DataFrame:
    """(doc, low, high): tenth and ninetieth percentile by nearest rank of the pages (doc, page) of unique hits."""
    from quire.operators.windows import nearest_ranks

    return nearest_ranks(hits.select("doc", F.col("page").alias("v")), ["doc"])


def context_of(tokens: DataFrame, files: DataFrame, *, around: int = 700) -> DataFrame:
    """(token, file, context): the first file, by name, that holds a token, and what surrounds it.

    Files offer their tokens, so the two meet by key.
    """
    held = files.select("file", "text", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"(IMG_\d{4})"), 1))).alias("token"))
    first = held.join(tokens, "token", "left_semi").groupBy("token").agg(F.min(F.struct("file", "text")).alias("f"))
    at = F.instr(F.col("f.text"), F.col("token"))
    start = F.greatest(at - around, F.lit(1))
    return first.select("token", "f.file", F.col("f.text").substr(start, at - start + F.length("token") + around).alias("context"))


def accepted_titles(answers: DataFrame, headings: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Answers (doc, title, kind, clean) on headings that exist, of a known kind, with a clean title that is part of the title."""
    known = answers.join(headings.select("doc", "title").distinct(), ["doc", "title"], "left_semi")
    return known.filter(F.col("kind").isin(*kinds)).withColumn("clean", F.when(F.contains("title", "clean"), F.col("clean")).otherwise(F.col("title")))
