"""Queries of markup operators over inline fixtures that both engines read."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import checks, generators, markup, windows
from quire.plans.catalog import Fixture, query, table
from quire.plans.text_queries import _HEADINGS, BOOKS

TEX = Fixture("doc string, text string", [
    ("001", "\\chapter{1 Motion}\n\\section{1.1 Speed} % \\begin{x}\n\\begin{equation}v=\\frac{s}{t}\\tag{1.1}\\end{equation}\nIt is $v$ and \\textbf{bold.\n\\usepackage{multirow}\n\\multirow{2}{*}{x} \\cancel{x} \\cancel{y}"),
    ("002", "\\begin{itemize}\n\\begin{center}\n\\end{itemize}\n\\end{center}\n$$a=b\\tag{2.1}$$ \\[c=d\\tag{2.2}\\tag{2.3}\\]\n[\nx=1\n]\n# left heading"),
    ("003", "\\documentclass{book}\nplain \\includegraphics[width=1cm]{IMG_0001} {IMG_0002}\n\\begin{tabular}{lr}u & v\\end{tabular}\n]\n["),
    ("004", ""),
])
_TEX = TEX.sql()
_TEX_LINES = f"(SELECT doc, unnest(range(1, len(l) + 1)) AS line, unnest(l) AS t FROM (SELECT doc, string_split(text, chr(10)) AS l FROM {_TEX}))"
_CODE = f"(SELECT doc, line, regexp_replace(t, '%.*', '') AS t FROM {_TEX_LINES})"



@query("c06_unbalanced_braces", f"SELECT doc, len(regexp_extract_all(t, '\\{{')) - len(regexp_extract_all(t, '\\}}')) AS depth FROM (SELECT doc, regexp_replace(text, '\\\\.', '', 'g') AS t FROM {_TEX}) WHERE len(regexp_extract_all(t, '\\{{')) <> len(regexp_extract_all(t, '\\}}'))")
def c06(spark, sf_dir):
    return checks.unbalanced(TEX.frame(spark)).select("doc", "depth")


@query("c12_heading_levels", "SELECT doc, CAST(sum(n) AS BIGINT) AS headings, max(n) AS largest, sum(n) >= 20 AND max(n) * 10 >= sum(n) * 9 AS flat FROM (SELECT page_id AS doc, level, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, '<h([1-6])', 1)) AS level FROM pages) GROUP BY ALL) GROUP BY doc")
def c12(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc"), F.explode(F.regexp_extract_all("html", F.lit(r"<h([1-6])"), 1)).alias("level"))
    return checks.heading_levels(pages)


@query("c15_preamble_leaks", f"SELECT doc, line FROM {_CODE} WHERE regexp_matches(t, '\\\\documentclass|\\\\usepackage|\\\\begin\\{{document\\}}|\\\\end\\{{document\\}}')")
def c15(spark, sf_dir):
    return markup.preamble_leaks(TEX.frame(spark))


@query("c18_misplaced_tags", f"SELECT doc, body FROM (SELECT doc, unnest(list_concat(regexp_extract_all(text, '(?s)\\$\\$(.*?)\\$\\$', 1), regexp_extract_all(text, '(?s)\\\\\\[(.*?)\\\\\\]', 1))) AS body FROM {_TEX}) WHERE len(regexp_extract_all(body, '\\\\tag\\s*\\*?\\s*\\{{')) = 1")
def c18(spark, sf_dir):
    return markup.misplaced_tags(TEX.frame(spark))


@query("c19_bare_delimiters", f"SELECT doc, count(*) AS delimiters, bool_and(s = CASE WHEN k % 2 = 1 THEN '[' ELSE ']' END) AND count(*) % 2 = 0 AS repairable FROM (SELECT doc, trim(t) AS s, row_number() OVER (PARTITION BY doc ORDER BY line) AS k FROM {_TEX_LINES} WHERE trim(t) IN ('[', ']')) GROUP BY doc")
def c19(spark, sf_dir):
    return markup.bare_delimiters(TEX.frame(spark))


HTML = Fixture("doc string, text string", [("a", "x<table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2|3</td></tr></table>y<table><tr><td colspan=2>m</td></tr></table>"), ("b", "<table><tr><td>1</td></tr><tr><td>1</td><td>2</td></tr></table><table></table>")])


@query("c25_required_packages", f"WITH u AS (SELECT doc, line, unnest(regexp_extract_all(t, '\\\\([A-Za-z]+)', 1)) AS command FROM {_CODE}) SELECT doc, command, count(*) AS n, min(line) AS line FROM u WHERE command = 'cancel' GROUP BY doc, command")
def c25(spark, sf_dir):
    packages = spark.createDataFrame([("multirow", "multirow"), ("cancel", "cancel"), ("color", "color"), ("color", "xcolor")], "command string, provider string")
    return markup.required_packages(TEX.frame(spark), packages)


@query("w06_sections", f"SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY off) AS nth, title, off AS first, CAST(coalesce(lead(off) OVER (PARTITION BY doc ORDER BY off), length(text)) - 1 AS BIGINT) AS last FROM {_HEADINGS} JOIN {BOOKS.sql()} USING (doc)")
def w06(spark, sf_dir):
    docs = BOOKS.frame(spark)
    return windows.sections(generators.headings(docs), docs.select("doc", F.length("text").cast("long").alias("total")))


@query("p10_sentinels", "SELECT doc_id AS doc, coalesce(trim(regexp_replace(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')[-1], '^\\s+|\\s+$', '', 'g')), '') AS last FROM documents")
def p10(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), T.last_line(F.col("text")).alias("last"))


@query("p13_fixes", "SELECT doc_id AS doc, sha256(regexp_replace(regexp_replace(text, '!!+', '!', 'g'), '  +', ' ', 'g')) AS digest, CAST(len(regexp_extract_all(text, '!!+')) AS BIGINT) AS doubled FROM documents")
def p13(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), "text")
    fixed = checks.fix_counts(docs, [("doubled", "!!+", "!"), ("spaces", "  +", " ")])
    return fixed.select("doc", F.sha2("text", 256).alias("digest"), "doubled")
