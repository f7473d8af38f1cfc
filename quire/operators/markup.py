"""Operators on Markdown and LaTeX: structure, tables, figures, fragments and fidelity of pairs.

What balanced braces, environments or alignment need runs as Arrow-fed Python, document by document;
everything regular is a column expression.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from difflib import SequenceMatcher
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import mathtext as M
from quire.functions import text as T
from quire.operators import generators

DEFINED = frozenset(
    "document figure table tabular equation align gather multline eqnarray displaymath itemize enumerate description center quote quotation verbatim "
    "array aligned alignedat split gathered cases matrix pmatrix bmatrix vmatrix Vmatrix longtable minipage abstract theorem proof example flalign titlepage".split()
)
SUMMARY = ("summary", "本章小结", "小结")
UNNUMBERED = ("frontmatter", "backmatter")
#: Text commands that typeset another sign in mathematics, and groups in which they may stand.
TEXT_ONLY = frozenset(f"text{x}" for x in ("circled", "degree", "mu", "subscript", "superscript"))
TEXT_GROUPS = "hbox|mbox|text|textbf|textit|textrm"
PREAMBLE_ONLY = tuple(f"\\{x}" for x in ("usepackage", "documentclass", "end{document}", "begin{document}"))
PREAMBLE_PATTERN = "|".join(re.escape(x) for x in PREAMBLE_ONLY)
SIMILAR, PAIRED, PER_PAIR = 0.85, 0.5, 8


def mapped(docs: DataFrame, columns: list[str], schema: str, rows: Callable[..., Iterable[tuple]]) -> DataFrame:
    """Rows that ``rows`` yields from the given columns of each document, after its ``doc``."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(source: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in source:
            out = [(key, *r) for key, *values in batch.itertuples(index=False) for r in rows(*values)]
            yield pd.DataFrame(out, columns=["doc", *names])

    return docs.select("doc", *columns).mapInPandas(run, f"doc {docs.schema['doc'].dataType.simpleString()}, {schema}")


def scanned_spans(docs: DataFrame, *, latex: bool) -> DataFrame:
    """(doc, first, last, display, body, tag_after) of math spans, escapes and comments minded."""
    return mapped(docs, ["text"], "first long, last long, display boolean, body string, tag_after string", lambda t: [(s.start, s.end, s.display, s.body, s.tag_after) for s in M.spans(t or "", latex=latex)])


def span_tokens(spans: DataFrame) -> DataFrame:
    """(doc, nth, tokens, numbers) of bodies (doc, nth, body)."""
    return mapped(spans, ["nth", "body"], "nth long, tokens string, numbers string", lambda n, b: [(n, " ".join(t := M.tokens(b)), " ".join(M.numbers(t)))])


def equation_tags(docs: DataFrame, *, latex: bool) -> DataFrame:
    """(doc, tag, times)."""
    return mapped(docs, ["text"], "tag string, times long", lambda t: sorted(M.all_tags(t or "", latex=latex).items()))


def prose_numbers(docs: DataFrame, *, latex: bool, loose: bool = False) -> DataFrame:
    """(doc, number, times) outside math."""
    return mapped(docs, ["text"], "number string, times long", lambda t: sorted(M.prose_numbers(t or "", latex=latex, loose=loose).items()))


def environment_issues(docs: DataFrame, defined: frozenset[str] = DEFINED) -> DataFrame:
    """(doc, kind, name, line) of environments that do not nest or are unknown."""
    return mapped(docs, ["text"], "kind string, name string, line long", lambda t: M.environment_issues(t or "", defined))


def text_in_math(docs: DataFrame, commands: frozenset[str] = TEXT_ONLY) -> DataFrame:
    """(doc, command, line, body): text commands in spans outside the groups that switch back to text."""

    def rows(text: str | None) -> Iterator[tuple]:
        for s in M.spans(text or "", latex=True):
            kept, done = [], 0
            for start, end, _ in M.calls(s.body, TEXT_GROUPS):
                kept, done = [*kept, s.body[done:start]], end
            for name in re.findall(r"(?<=\\)[A-Za-z]+", " ".join([*kept, s.body[done:]])):
                if name in commands:
                    yield name, text.count("\n", 0, s.start) + 1, s.body

    return mapped(docs, ["text"], "command string, line long, body string", rows)


def chapter_tags(docs: DataFrame) -> DataFrame:
    """(doc, pos, starred, tags): chapters in order, starred or not, with the chapter numbers that the tags in them begin with."""

    def rows(text: str | None) -> Iterator[tuple]:
        found = list(M.calls(text or "", "chapter"))
        ends = [start for start, _, _ in found[1:]] + [None]
        for k, ((start, after, _), end) in enumerate(zip(found, ends, strict=False), 1):
            heads = [M.plain_tag(tag).replace("-", ".").split(".")[0] for _, _, tag in M.calls(text[after:end], "tag")]
            yield k, text.startswith("\\chapter*", start), [int(h) for h in heads if h.isdecimal()]

    return mapped(docs, ["text"], "pos long, starred boolean, tags array<long>", rows)


def braced_arguments(docs: DataFrame, commands: list[str], *, placed: bool = False) -> DataFrame:
    """(doc, command, star, at, argument) of the commands' first braced arguments, options skipped; ``placed`` adds their line."""
    names = "|".join(commands)
    pattern = re.compile(rf"\\({names})(\*?)(?![A-Za-z])(?:\[[^]]*])?")

    def rows(text: str | None) -> Iterator[tuple]:
        for m in pattern.finditer(text or ""):
            if (found := M.argument(text, m.end())) is not None:
                yield (m[1], bool(m[2]), m.start(), found[0], *([text.count("\n", 0, m.start()) + 1] if placed else []))

    return mapped(docs, ["text"], "command string, star boolean, at long, argument string" + (", line long" if placed else ""), rows)


#: A group of cells: text, columns and rows spanned.
Cell = tuple[str, int, int]
_HTML_PART = re.compile(r"<(?P<end>/?)(?P<tag>tr|t[dh]|br)\b(?P<more>[^>]*)>|<[^>]*>|[^<]+", re.IGNORECASE)


def _spanned(attributes: str, name: str) -> int:
    found = re.search(rf"(?i)\b{name}\s*=\s*[\"']?\s*([0-9]+)\s*(?:[\"']|\s|/|$)", attributes)
    return max(int(found[1]), 1) if found else 1


def cells_of(html: str) -> list[list[Cell]]:
    """Cells by row; white space collapsed, a bad span is one, rows without cells left out."""
    table: list[list[Cell]] = [[]]
    said: list[str] | None = None  # of the cell that is open
    spans = (1, 1)
    for part in [*_HTML_PART.finditer(html), None]:
        tag = part and (part["tag"] or "").lower()
        if said is not None and (part is None or tag in ("tr", "td", "th")):
            table[-1].append((" ".join(unescape("".join(said)).split()), *spans))
            said = None
        if not tag:
            if part is not None and said is not None and not part[0].startswith("<"):
                said.append(part[0])
        elif tag == "br":
            said = said and [*said, " "]
        elif not part["end"] and tag == "tr":
            table.append([])
        elif not part["end"]:
            said, spans = [], (_spanned(part["more"], "colspan"), _spanned(part["more"], "rowspan"))
    return [row for row in table if row]


def table_defect(rows: list[list[Cell]]) -> str:
    """Why a table cannot be a pipe table: empty, merged, ragged, or cells that collapsed into one; else empty."""
    if not rows:
        return "no rows"
    if any(c > 1 or r > 1 for row in rows for _, c, r in row):
        return "merged cells"
    if len({len(row) for row in rows}) > 1:
        return "ragged rows"
    groups = [[len(cell[0].split()) for cell in row] for row in rows]
    if len(rows[0]) == 1:
        return "single crowded column" if max(g[0] for g in groups) >= 4 else ""
    for column in zip(*groups, strict=True):
        for k, n in enumerate(column):
            rest = max((x for j, x in enumerate(column) if j != k), default=0)
            if n >= 4 and rest and n >= 3 * rest and all(x[0].isdigit() for x in rows[k][0][0].split()[:1]):
                return "collapsed cells"
    return ""


_TABLE = re.compile(r"(?is)<table\b.*?</table\s*>")


def pipe_tables(docs: DataFrame) -> DataFrame:
    """(doc, text, converted, kept): HTML tables as pipe tables where that is faithful; others stay byte by byte."""

    def rows(text: str | None) -> list[tuple]:
        count = Counter()

        def pipe(m: re.Match[str]) -> str:
            cells = cells_of(m[0])
            if table_defect(cells):
                count["kept"] += 1
                return m[0]
            count["converted"] += 1
            lines = ["| " + " | ".join(c[0].replace("|", "\\|") for c in row) + " |" for row in cells]
            lines.insert(1, "|" + " --- |" * len(cells[0]))
            return "\n\n" + "\n".join(lines) + "\n\n"

        out = _TABLE.sub(pipe, text or "")
        return [(re.sub(r"\n\n\n+", 2 * "\n", out) if count["converted"] else out, count["converted"], count["kept"])]

    return mapped(docs, ["text"], "text string, converted long, kept long", rows)


def html_cells(docs: DataFrame) -> DataFrame:
    """(doc, nth, row, column, text, colspan, rowspan) of the cells of the tables of HTML texts; a cell's column is its place in its row."""

    def rows(text: str | None) -> Iterator[tuple]:
        for nth, table in enumerate(_TABLE.findall(text or "")):
            for r, row in enumerate(cells_of(table)):
                yield from ((nth, r, c, *cell) for c, cell in enumerate(row))

    return mapped(docs, ["text"], "nth long, row long, column long, text string, colspan long, rowspan long", rows)


def html_tables(docs: DataFrame) -> DataFrame:
    """(doc, nth, rows, defect) of the tables of HTML texts."""
    return mapped(docs, ["text"], "nth long, rows long, defect string", lambda t: [(k, len(c := cells_of(m)), table_defect(c)) for k, m in enumerate(_TABLE.findall(t or ""))])


def wide_tables(docs: DataFrame) -> DataFrame:
    """(doc, text, fitted): outermost tabulars wrapped to the line's width, those in a box left."""

    def rows(text: str | None) -> list[tuple]:
        out, depth, fitted, done = [], 0, 0, 0
        for m in re.finditer(r"\\(begin|end)\{tabular\*?\}", text or ""):
            if m[1] == "begin":
                if depth == 0 and not re.search(r"\\(?:resizebox|adjustbox|fittable)[^\n]*\{\s*$", text[: m.start()]):
                    out += [text[done : m.start()], r"\fittable{"]
                    done, fitted = m.start(), fitted + 1
                    wrapped = True
                elif depth == 0:
                    wrapped = False
                depth += 1
            elif depth:
                depth -= 1
                if depth == 0 and wrapped:
                    out += [text[done : m.end()], "}"]
                    done = m.end()
        return [("".join([*out, (text or "")[done:]]), fitted)]

    return mapped(docs, ["text"], "text string, fitted long", rows)


def relevelled(docs: DataFrame, levels: DataFrame) -> DataFrame:
    """(doc, line, text, change) of all lines, headings at the level that ``levels`` (title, level) says.

    Level 0 makes a paragraph of a heading; a title that is not listed stays.
    """
    found = generators.lines(docs).withColumn("title", F.when(F.col("text").rlike(generators.HEADING), F.regexp_extract("text", generators.HEADING, 2)))
    joined = found.join(levels.withColumnRenamed("level", "new"), "title", "left")
    listed = F.col("title").isNotNull() & F.col("new").isNotNull()
    text = F.when(listed & (F.col("new") == 0), F.col("title")).when(listed, F.concat(F.expr("repeat('#', new)"), F.lit(" "), F.col("title"))).otherwise(F.col("text"))
    change = F.when(listed & (F.col("new") == 0), "demoted").when(listed & (text != F.col("text")), "relevelled").when(F.col("title").isNotNull(), "unchanged")
    return joined.select("doc", "line", text.alias("text"), change.alias("change"))


def merged_headings(docs: DataFrame, number: str = r"^第[0-9一二三四五六七八九十百]+章$|^Chapter \d+$") -> DataFrame:
    """(doc, line, text): a heading that is a chapter number alone joins the heading after it, at the lesser level."""
    w = Window.partitionBy("doc").orderBy("line")
    solid = generators.lines(docs).filter(T.strip(F.col("text")) != "")
    level = F.length(F.regexp_extract("text", r"^(#{1,6})[ \t]", 1))
    solid = solid.withColumns({"level": level, "title": F.trim(F.regexp_replace("text", r"^#{1,6}[ \t]+", ""))})
    bare = (F.col("level") > 0) & F.col("title").rlike(number)
    joins_next = bare & (F.lead("level").over(w) > 0) & ~F.lead("title").over(w).rlike(number)
    marked = solid.withColumn("joins", F.coalesce(joins_next, F.lit(False)))
    marked = marked.withColumns({"next_level": F.lead("level").over(w), "next_title": F.lead("title").over(w), "taken": F.coalesce(F.lag("joins").over(w), F.lit(False))})
    text = F.when(F.col("joins"), F.concat(F.expr("repeat('#', least(level, next_level))"), F.lit(" "), F.col("title"), F.lit(" "), F.col("next_title"))).otherwise(F.col("text"))
    return marked.filter("not taken").select("doc", "line", text.alias("text"))


def structured(docs: DataFrame, divisions: DataFrame) -> DataFrame:
    """(doc, line, text): level-1 headings as divisions (doc, line, kind, title) say.

    Numbered sections of unnumbered chapters get a star, numbered items under a summary heading
    become paragraphs; both states are carried forward from the last heading above.
    """
    w = Window.partitionBy("doc").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    found = generators.lines(docs).join(divisions, ["doc", "line"], "left")
    level = F.length(F.regexp_extract("text", r"^(#{1,6})[ \t]", 1))
    title = F.trim(F.regexp_replace("text", r"^#{1,6}[ \t]+", ""))
    found = found.withColumns({"level": level, "own": title})
    item = F.col("own").rlike(r"^\d+\.(?!\d)")
    found = found.withColumn("carried", F.last("kind", ignorenulls=True).over(w)).withColumn("numbered_item", item)
    summary = F.last(F.when((F.col("level") > 0) & ~F.col("numbered_item"), F.lower("own").isin(*SUMMARY)), ignorenulls=True).over(w)
    text = (
        F.when(F.col("kind") == "part", F.concat(F.lit("# "), F.col("title")))
        .when(F.col("kind") == "chapter", F.concat(F.lit("# "), F.col("title")))
        .when(F.col("kind").isin(*UNNUMBERED), F.concat(F.lit("#* "), F.col("title")))
        .when((F.col("level") > 0) & F.col("numbered_item") & F.coalesce(F.col("in_summary"), F.lit(False)), F.col("own"))
        .when((F.col("level") > 1) & F.col("carried").isin(*UNNUMBERED), F.concat(F.expr("repeat('#', level)"), F.lit("* "), F.col("own")))
        .otherwise(F.col("text"))
    )
    return found.withColumn("in_summary", summary).select("doc", "line", text.alias("text"))


def division_evidence(docs: DataFrame) -> DataFrame:
    """(doc, division, prefix, times): chapter numbers that sub-headings, captions and tags of a division begin with."""
    top = F.col("text").rlike(r"^#[ \t]")
    w = Window.partitionBy("doc").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    found = generators.lines(docs).withColumn("division", F.max(F.when(top, F.col("line"))).over(w)).filter("division is not null")
    patterns = (r"^#{2,6}[ \t]+(\d+)\.\d+", r"^(?:图|Fig\.|Figure)\s*(\d+)[.\-]\d+", r"\\tag\s*\{\s*([0-9]+)[.]\d")
    prefixes = F.flatten(F.array(*[F.regexp_extract_all("text", F.lit(p), 1) for p in patterns]))
    return found.select("doc", "division", F.explode(prefixes).alias("prefix")).groupBy("doc", "division", "prefix").agg(F.count(F.lit(1)).alias("times"))


def restored_images(docs: DataFrame, images: DataFrame) -> DataFrame:
    """(doc, text, unknown): image tokens that fill an argument back as paths; unknown ones stay and are counted."""
    paths = images.groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("token", "path"))).alias("paths"))
    joined = docs.join(paths, "doc", "left")
    held = F.array_distinct(F.regexp_extract_all("text", F.lit(r"[{(\"](IMG_\d{4})[})\"]"), 1))
    known = F.coalesce("paths", F.expr("cast(map() as map<string,string>)"))
    text = F.aggregate(
        F.filter(held, lambda t: F.map_contains_key(known, t)), F.col("text"),
        lambda text, t: F.regexp_replace(text, F.concat(F.lit(r"([{(\"])"), t, F.lit(r"([})\"])")), F.concat(F.lit("$1"), F.try_element_at(known, t), F.lit("$2"))),
    )
    return joined.select("doc", text.alias("text"), F.size(F.filter(held, lambda t: ~F.map_contains_key(known, t))).cast("long").alias("unknown"))


def without_images(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """(doc, line, text): lines without references to dropped images (doc, path); a line that held nothing else goes."""
    bad = dropped.groupBy("doc").agg(F.collect_set("path").alias("bad"))
    found = generators.lines(docs).join(bad, "doc", "left")
    held = F.regexp_extract_all("text", F.lit(r"!\[(?:[^\]]*)\]\([^\s)]+\)"), 0)
    gone = F.filter(held, lambda r: F.array_contains(F.coalesce("bad", F.array().cast("array<string>")), F.regexp_extract(r, r"\(([^)\s]+)\)", 1)))
    text = F.aggregate(gone, F.col("text"), lambda t, r: F.replace(t, r, F.lit("")))
    return found.withColumn("n", F.size(gone)).withColumn("new", text).filter("n = 0 or trim(new) <> ''").select("doc", "line", F.col("new").alias("text"))


def image_sites(docs: DataFrame, *, ahead: int = 7) -> DataFrame:
    """(doc, path, line, number): distinct images in reading order with the caption number within the next lines; a heading ends the search."""
    w = Window.partitionBy("doc").orderBy("line")
    number = F.nullif(F.regexp_extract("text", r"^\s*(?:图|Fig\.|Figure)\s*(\d+(?:[.\-]\d+)*)", 1), F.lit(""))
    stop = F.col("text").rlike(r"^#{1,6}[ \t]")
    found = generators.lines(docs).withColumn("caption", number).withColumn("stop", stop)
    following = F.collect_list(F.struct(F.coalesce("caption", F.lit("")).alias("caption"), "stop")).over(w.rowsBetween(1, ahead))
    start = F.struct(F.lit("").alias("number"), F.lit(False).alias("over"))
    pick = F.aggregate(
        following, start,
        lambda s, x: F.struct(F.when(~s["over"] & ~x["stop"], x["caption"]).otherwise(s["number"]).alias("number"), (s["over"] | x["stop"] | (x["caption"] != "")).alias("over")),
        lambda s: F.nullif(s["number"], F.lit("")),
    )
    sites = found.withColumn("number", pick).select("doc", "line", "number", F.explode(F.regexp_extract_all("text", F.lit(generators.MD_IMAGE), 1)).alias("path"))
    return sites.groupBy("doc", "path").agg(F.min("line").alias("line"), F.min_by("number", "line").alias("number"))


def caption_number(caption: Column) -> Column:
    """The number that a caption of at most 100 characters, without a full stop, begins with; else null.

    Its separators become dots.
    """
    flat = T.strip(caption)
    number = F.regexp_extract(flat, r"^(?:图|表|Fig\.|Figure|Table)?\s*([A-Z]?\d+(?:[.\-．·]\d+)*)", 1)
    fits = (F.length(flat) <= 100) & ~F.contains(flat, F.lit("。"))
    return F.when(fits, F.nullif(F.translate(number, "-．·", "..."), F.lit("")))


def layout_images(entries: DataFrame) -> DataFrame:
    """The first layout entry of each image file, its caption number and relative width in hundredths.

    ``entries`` has (doc, pos, type, text, text_level, bbox, img_path, captions); the reference width
    is the median of body texts of 60 characters or more.
    """
    sound = (F.size("bbox") == 4) & (F.col("bbox")[2] > F.col("bbox")[0]) & (F.col("bbox")[3] > F.col("bbox")[1])
    width = F.when(sound, F.col("bbox")[2] - F.col("bbox")[0])
    body = entries.filter((F.col("type") == "text") & F.col("text_level").isNull() & (F.length("text") >= 60) & sound)
    reference = body.groupBy("doc").agg(F.median(width).alias("reference"))
    name = F.regexp_extract("img_path", r"([^/]+)$", 1)
    first = Window.partitionBy("doc", "name").orderBy("pos")
    images = entries.filter("img_path is not null").withColumn("name", name).withColumn("nth", F.row_number().over(first)).filter("nth = 1")
    share = F.greatest(F.lit(0.2), F.least(F.lit(0.9), width / F.col("reference")))
    number = F.try_element_at(F.filter(F.transform("captions", caption_number), lambda x: x.isNotNull()), F.lit(1))
    return images.join(reference, "doc", "left").select("doc", "name", number.alias("number"), F.floor(share * 100 + 0.5).cast("long").alias("percent"))


def pair_fidelity(pairs: DataFrame, *, most: int = PER_PAIR) -> DataFrame:
    """(doc, check, severity, message) for pairs (doc, source, target): tags, displays, numbers, aligned blocks, prose numbers."""

    def rows(source: str | None, target: str | None) -> list[tuple]:
        a, b = source or "", target or ""
        out: list[tuple[str, str, str]] = []
        b = M.blanked(b)  # each side is scanned once, and each span read once
        left, right = (list(M.spans(t, latex=False)) for t in (a, b))
        before, after = (M.all_tags(t, latex=False, known=known) for t, known in ((a, left), (b, right)))
        for side, gone in (("lost", before - after), ("added", after - before)) if before or after else ():
            out += [("equation-tags", "review", f"{side} {t}") for t in sorted(gone)]
        read = [[(s.display, M.tokens(M.bare(s)[0])) for s in side] for side in (left, right)]
        blocks = [[t for display, t in side if display] for side in read]
        if len(blocks[0]) != len(blocks[1]):
            inline = [t for display, t in read[1] if not display]
            moved = sum(any(ratio(x, y) >= SIMILAR for y in inline) for x in blocks[0])
            lost = len(blocks[0]) - len(blocks[1]) - moved
            out.append(("display-count", "review" if lost > 0 or len(blocks[1]) > len(blocks[0]) else "info", f"{len(blocks[0])} became {len(blocks[1])}"))
        said = [[n for _, t in side for n in M.numbers(t)] for side in read]
        counts = [Counter(x) for x in said] if said[0] != said[1] else ()
        for side, x, y in (("lost", *counts), ("added", *counts[::-1])) if counts else ():
            out += [("numbers", "info" if n in y else "review", f"{side} {n}") for n in sorted(x - y)]
        for x, y in matched(*blocks):
            if x == y:
                continue
            operators = [sorted(t for t in z if t in M.OPERATORS) for z in (x, y)]
            if operators[0] != operators[1] or ratio(x, y) < SIMILAR:
                out.append(("changed-block", "review", " ".join(x)[:100]))
        missing = M.prose_numbers(a, latex=False, known=left).keys()
        for loose in (True, False):
            missing = missing and missing - M.prose_numbers(b, latex=False, loose=loose, known=right).keys()
        out += [("prose-numbers", "info", n) for n in sorted(missing, key=lambda n: (len(n), n))]
        return [x for kind in dict.fromkeys(o[0] for o in out) for x in [o for o in out if o[0] == kind][:most]]

    return mapped(pairs, ["source", "target"], "check string, severity string, message string", rows)


def ratio(one: list[str], other: list[str]) -> float:
    """Likeness of token lists; it depends on the order of the two."""
    return 1.0 if not (one or other) else SequenceMatcher(None, one, other, autojunk=False).ratio()


def matched(source: list[list[str]], target: list[list[str]]) -> list[tuple[list[str], list[str]]]:
    """Blocks paired in order: equal ones anchor, runs of equal length pair by place, others by the best likeness."""
    if source == target or len(source) == len(target) == 1:
        return list(zip(source, target, strict=True))
    a, b = ([" ".join(x) for x in side] for side in (source, target))
    out = []
    for kind, i, j, k, n in SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        if kind == "equal" or (kind == "replace" and j - i == n - k):
            out += list(zip(source[i:j], target[k:n], strict=True))
        elif kind == "replace":
            at = k
            for x in source[i:j]:
                score, place = max(((ratio(x, y), -p) for p, y in enumerate(target[at:n], at)), default=(0.0, 0))
                if score > PAIRED:
                    out.append((x, target[-place]))
                    at = 1 - place
    return out


def preamble_leaks(docs: DataFrame) -> DataFrame:
    """(doc, line) of lines that hold a command of the preamble."""
    return generators.lines(docs).filter(F.regexp_replace("text", r"(?<!\\)%.*", "").rlike(PREAMBLE_PATTERN)).select("doc", "line")


def misplaced_tags(docs: DataFrame) -> DataFrame:
    """(doc, body): displays between dollar or square delimiters that hold exactly one tag."""
    bodies = F.concat(F.regexp_extract_all("text", F.lit(r"(?s)\$\$(.*?)\$\$"), 1), F.regexp_extract_all("text", F.lit(r"(?s)\\\[(.*?)\\\]"), 1))
    return docs.select("doc", F.explode(bodies).alias("body")).filter(F.regexp_count("body", F.lit(r"\\tag[\s*]*\{")) == 1)


def bare_delimiters(docs: DataFrame) -> DataFrame:
    """(doc, delimiters, repairable): lines that are a bracket alone; repairable if they strictly alternate."""
    w = Window.partitionBy("doc").orderBy("line")
    bare = generators.lines(docs).withColumn("sign", T.strip(F.col("text"))).filter(F.col("sign").isin("[", "]"))
    wanted = F.when(F.row_number().over(w) % 2 == 1, "[").otherwise("]")
    good = bare.withColumn("good", F.col("sign") == wanted)
    return good.groupBy("doc").agg(F.count(F.lit(1)).alias("delimiters"), (F.bool_and("good") & (F.count(F.lit(1)) % 2 == 0)).alias("repairable"))


def required_packages(docs: DataFrame, packages: DataFrame) -> DataFrame:
    """(doc, command, n, line): commands (command, provider) whose provider no \\usepackage loads and no text defines."""
    code = generators.lines(docs).withColumn("text", F.regexp_replace("text", r"(?<!\\)%.*", ""))
    used = code.select("doc", "line", F.explode(F.regexp_extract_all("text", F.lit(r"\\(\p{Alpha}+)"), 1)).alias("command"))
    loaded = code.select("doc", F.explode(F.flatten(F.transform(F.regexp_extract_all("text", F.lit(r"\\usepackage(?:\[[^\]]*\]|\s)*\{([^}{]*)\}"), 1), lambda p: F.split(p, r"\s*,\s*")))).alias("provider")).distinct()
    defined = code.select("doc", F.explode(F.regexp_extract_all("text", F.lit(r"\\(?:re)?newcommand[\s*]*\{?\\(\p{Alpha}+)"), 1)).alias("command")).distinct()
    provided = packages.join(loaded, "provider").select("doc", "command").distinct()
    missing = used.join(packages.select("command").distinct(), "command", "left_semi").join(provided, ["doc", "command"], "left_anti").join(defined, ["doc", "command"], "left_anti")
    return missing.groupBy("doc", "command").agg(F.count(F.lit(1)).alias("n"), F.min("line").alias("line"))
