"""Queries over texts made from the driver's tables.

A template turns the key of an order into a text by an expression that both engines read, so the
expected rows follow from the key, in SQL, without looking at the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import checks, generators, joins, lint, markup, records, rewrites, windows
from quire.plans.catalog import Fixture, query, table
from quire.streaming import state

#: Line feed and backslash, which the two engines write differently in literals.
N, B = "chr(10)", "chr(92)"
_K = "(SELECT o_orderkey AS k, o_custkey AS c FROM orders)"


def keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"))


def made(spark: SparkSession, sf_dir: str, template: str) -> DataFrame:
    """(doc, text) of the template."""
    return keys(spark, sf_dir).selectExpr("k AS doc", f"{template} AS text")


def _lines(*parts: str) -> str:
    return f"concat_ws({N}, {', '.join(parts)})"


TEX = _lines(
    f"concat({B}, 'chapter{{', k % 10, ' Motion}}')",
    f"concat({B}, CASE WHEN k % 3 = 0 THEN concat('section*{{', k % 9, '. Part}}') ELSE 'section{{Part}}' END)",
    f"concat({B}, 'begin{{', CASE WHEN k % 2 = 0 THEN 'itemize' ELSE 'oddity' END, '}}')",
    "concat('so $a_{', k % 100, '} = -', k % 7, '$ holds')",
    f"concat('$$b^{{', k % 11, '}} + c', {B}, 'tag{{', k % 10, '.', k % 13, '}}$$')",
    f"concat({B}, 'end{{', CASE WHEN k % 4 = 1 THEN 'center' WHEN k % 2 = 0 THEN 'itemize' ELSE 'oddity' END, '}}')",
    "''",
    "CASE WHEN k % 5 = 0 THEN '{open' ELSE 'plain' END",
    f"CASE WHEN k % 6 = 0 THEN concat({B}, 'usepackage{{x}}') ELSE 'text 3.5' END",
)
_INLINE = "concat('a_{', k % 100, '} = -', k % 7)"
_DISPLAY = f"concat('b^{{', k % 11, '}} + c', {B}, 'tag{{', k % 10, '.', k % 13, '}}')"
_TEX = f"(SELECT k, {TEX} AS t FROM {_K})"

MATH = _lines(
    "concat('see $', CASE WHEN k % 3 = 0 THEN ' ' ELSE '' END, 'y_', k % 7, '$ there')",
    f"concat('$$q', CASE WHEN k % 4 = 0 THEN concat({B}, 'tag{{1.1}}', {B}, 'tag{{1.2}}') ELSE '' END, '$$')",
    f"concat('at $z', CASE WHEN k % 5 = 0 THEN concat({B}, 'frac') ELSE '' END, '$ end')",
    f"concat({B}, CASE WHEN k % 6 = 0 THEN 'texttext' ELSE 'alpha' END, '{{a}}')",
    "CASE WHEN k % 7 = 0 THEN '## head' ELSE 'no head' END",
    f"concat('$w', CASE WHEN k % 8 = 0 THEN concat('^{{', {B}, 'textcircled{{1}}}}') ELSE '' END, '$')",
    f"concat({B}, 'begin{{array}}{{', CASE WHEN k % 9 = 0 THEN 'l' ELSE 'll' END, '}}a&b', {B}, 'end{{array}}')",
)
HTML = "concat('x<table><tr><td>', k % 10, '</td><td', CASE WHEN k % 3 = 0 THEN ' colspan=2' ELSE '' END, '>b</td></tr>', CASE WHEN k % 4 = 0 THEN '<tr><td>1</td></tr>' ELSE '' END, '</table>y')"


def big(value: object) -> str:
    return f"CAST({value} AS BIGINT)"


@query("g06_latex_spans", f"SELECT k AS doc, 0 AS source, {big(0)} AS nth, {_INLINE} AS body FROM {_K} UNION ALL SELECT k, 0, 1, {_DISPLAY} FROM {_K}")
def g06(spark, sf_dir):
    return generators.latex_spans(made(spark, sf_dir, TEX))


@query("g07_scanned_spans", f"""SELECT k AS doc, {big("strpos(t, '$a_') - 1")} AS first, {big("strpos(t, '$ holds')")} AS last, false AS display, {_INLINE} AS body, '' AS tag_after FROM {_TEX}
UNION ALL SELECT k, strpos(t, '$$b') - 1, strpos(t, '}}$$') + 2, true, {_DISPLAY}, '' FROM {_TEX}""")
def g07(spark, sf_dir):
    return markup.scanned_spans(made(spark, sf_dir, TEX), latex=True)


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = f"concat('a_{{', k % 100, '}} = -', k % 7, ' ', {B}, 'mathrm{{sin}} x ', {B}, 'le 2')"
    return markup.span_tokens(keys(spark, sf_dir).selectExpr("k AS doc", "0L AS nth", f"{body} AS body"))


@query("g08_canonical_tokens", f"SELECT k AS doc, {big(0)} AS nth, concat('a _ ', k % 100, ' = - ', k % 7, ' ', {B}, 'sin x ', {B}, 'leq 2') AS tokens, concat('_', k % 100, ' -', k % 7, ' 2') AS numbers FROM {_K}")
def g08(spark, sf_dir):
    return _tokens(spark, sf_dir)


@query("g09_math_numbers", f"SELECT k AS doc, i AS at_number, n AS number FROM (SELECT k, unnest([0, 1, 2]) AS i, unnest([concat('_', k % 100), concat('-', k % 7), '2']) AS n FROM {_K})")
def g09(spark, sf_dir):
    return _tokens(spark, sf_dir).select("doc", F.posexplode(F.split("numbers", " ")).alias("at_number", "number"))


@query("g10_prose_numbers", f"SELECT k AS doc, '3.5' AS number, {big(1)} AS times FROM {_K} WHERE k % 6 <> 0")
def g10(spark, sf_dir):
    return markup.prose_numbers(made(spark, sf_dir, TEX), latex=False)


@query("g11_equation_tags", f"SELECT k AS doc, concat(k % 10, '.', k % 13) AS tag, {big(1)} AS times FROM {_K}")
def g11(spark, sf_dir):
    return markup.equation_tags(made(spark, sf_dir, TEX), latex=True)


@query("g14_table_cells", f"""SELECT k AS doc, {big(0)} AS nth, {big("r")} AS "row", {big("c")} AS "column", t AS text, {big("w")} AS colspan, {big(1)} AS rowspan FROM (
SELECT k, 0 AS r, 0 AS c, CAST(k % 10 AS VARCHAR) AS t, 1 AS w FROM {_K} UNION ALL SELECT k, 0, 1, 'b', CASE WHEN k % 3 = 0 THEN 2 ELSE 1 END FROM {_K} UNION ALL SELECT k, 1, 0, '1', 1 FROM {_K} WHERE k % 4 = 0)""")
def g14(spark, sf_dir):
    return markup.html_cells(made(spark, sf_dir, HTML))


@query("g17_braced_arguments", f"""SELECT k AS doc, 'chapter' AS command, false AS star, {big(0)} AS "at", concat(k % 10, ' Motion') AS argument FROM {_K}
UNION ALL SELECT k, 'section', k % 3 = 0, 19, CASE WHEN k % 3 = 0 THEN concat(k % 9, '. Part') ELSE 'Part' END FROM {_K}""")
def g17(spark, sf_dir):
    return markup.braced_arguments(made(spark, sf_dir, TEX), ["chapter", "section", "caption"])


_ISSUES = f"SELECT k AS doc, 'undefined' AS kind, 'oddity' AS name, {big(3)} AS line FROM {_K} WHERE k % 2 = 1 UNION ALL SELECT k, 'crossed', 'center', 6 FROM {_K} WHERE k % 4 = 1"


@query("g18_environment_issues", _ISSUES)
def g18(spark, sf_dir):
    return markup.environment_issues(made(spark, sf_dir, TEX))


@query("c14_environment_balance", f"SELECT k AS doc, line FROM (SELECT doc AS k, kind, line FROM ({_ISSUES})) WHERE kind <> 'undefined'")
def c14(spark, sf_dir):
    return markup.environment_issues(made(spark, sf_dir, TEX)).filter("kind <> 'undefined'").select("doc", "line")


@query("c14_undefined_environments", f"SELECT k AS doc, 'oddity' AS name FROM {_K} WHERE k % 2 = 1")
def c14_undefined(spark, sf_dir):
    return markup.environment_issues(made(spark, sf_dir, TEX)).filter("kind = 'undefined'").select("doc", "name")


@query("c16_paragraph_braces", f"SELECT k AS doc, {big(8)} AS line, {big(1)} AS depth FROM {_K} WHERE k % 5 = 0")
def c16(spark, sf_dir):
    return lint.paragraph_braces(made(spark, sf_dir, TEX)).select("doc", "line", "depth")


@query("c21_doubled_numbers", f"SELECT k AS doc, 'chapter' AS command, concat(k % 10, ' Motion') AS argument FROM {_K}")
def c21(spark, sf_dir):
    found = rewrites.doubled_starts(markup.braced_arguments(made(spark, sf_dir, TEX), lint.NUMBERED_COMMANDS))
    return found.filter("not star").select("doc", "command", "argument")


@query("c22_numbered_starred_headings", f"SELECT k AS doc, 'section' AS command, concat(k % 9, '. Part') AS argument, {big(2)} AS line FROM {_K} WHERE k % 3 = 0")
def c22(spark, sf_dir):
    return lint.starred_numbers(made(spark, sf_dir, TEX))


@query("c27_fragment_issues", f"""SELECT k AS doc, concat('preamble: ', {B}, 'usepackage') AS issue FROM {_K} WHERE k % 6 = 0 UNION ALL SELECT doc, concat(kind, ': ', name) FROM ({_ISSUES})
UNION ALL SELECT k, '1 unclosed braces' FROM {_K} WHERE k % 5 = 0""")
def c27(spark, sf_dir):
    return lint.fragment_issues(made(spark, sf_dir, TEX))


@query("c39_latex_surface", f"""SELECT k AS doc, n AS check_name, r AS rank FROM (
SELECT k, 'environment-balance' AS n, 0 AS r FROM {_K} WHERE k % 4 = 1 UNION ALL SELECT k, 'undefined-environment', 0 FROM {_K} WHERE k % 2 = 1 UNION ALL SELECT k, 'preamble-leakage', 1 FROM {_K} WHERE k % 6 = 0
UNION ALL SELECT k, 'misplaced-tag', 4 FROM {_K} UNION ALL SELECT k, 'brace-balance', 5 FROM {_K} WHERE k % 5 = 0 UNION ALL SELECT k, 'duplicated-number', 7 FROM {_K}
UNION ALL SELECT k, 'numbered-starred-heading', 8 FROM {_K} WHERE k % 3 = 0 UNION ALL SELECT k, 'chapter-numbering', 15 FROM {_K} WHERE k % 10 <> 1)""")
def c39_latex(spark, sf_dir):
    return lint.surface(made(spark, sf_dir, TEX), lint.LATEX).select(F.col("doc").cast("long").alias("doc"), F.col("check").alias("check_name"), "rank")


@query("c39_markdown_surface", f"""SELECT k AS doc, n AS check_name, r AS rank FROM (
SELECT k, 'delimiter-whitespace' AS n, 3 AS r FROM {_K} WHERE k % 3 = 0 UNION ALL SELECT k, 'multiple-tags', 6 FROM {_K} WHERE k % 4 = 0
UNION ALL SELECT k, 'array-columns', 7 FROM {_K} WHERE k % 9 = 0 UNION ALL SELECT k, 'dangling-command', 8 FROM {_K} WHERE k % 5 = 0)""")
def c39_markdown(spark, sf_dir):
    known = lint.Dimensions(arguments=spark.createDataFrame([("frac",), ("sqrt",)], "command string"))
    return lint.surface(made(spark, sf_dir, MATH), lint.MARKDOWN, known).select(F.col("doc").cast("long").alias("doc"), F.col("check").alias("check_name"), "rank")


@query("c41_diagnostics", f"""SELECT k AS doc, n AS diagnostic, {big("v")} AS value FROM (
SELECT k, 'dollar-run-1' AS n, 6 AS v FROM {_K} UNION ALL SELECT k, 'dollar-run-2', 2 FROM {_K} UNION ALL SELECT k, 'display-delimiters', 2 FROM {_K}
UNION ALL SELECT k, 'padded-spans', 1 FROM {_K} WHERE k % 3 = 0 UNION ALL SELECT k, 'heading-level-2', 1 FROM {_K} WHERE k % 7 = 0)""")
def c41(spark, sf_dir):
    return lint.diagnostics(made(spark, sf_dir, MATH))


@query("c04_padded_spans", f"SELECT k AS doc, {big(1)} AS line, concat(' y_', k % 7) AS body FROM {_K} WHERE k % 3 = 0")
def c04(spark, sf_dir):
    return checks.padded_spans(generators.math_spans(made(spark, sf_dir, MATH))).select("doc", "line", "body")


@query("c07_many_tags", f"SELECT k AS doc, concat('q', {B}, 'tag{{1.1}}', {B}, 'tag{{1.2}}') AS body, {big(2)} AS tags FROM {_K} WHERE k % 4 = 0")
def c07(spark, sf_dir):
    return checks.many_tags(generators.latex_spans(made(spark, sf_dir, MATH))).select("doc", "body", "tags")


@query("c08_array_overflows", f"SELECT k AS doc, 1 AS columns, 2 AS cells FROM {_K} WHERE k % 9 = 0")
def c08(spark, sf_dir):
    return rewrites.array_overflows(made(spark, sf_dir, MATH))


@query("c09_dangling_commands", f"SELECT k AS doc, 'frac' AS command FROM {_K} WHERE k % 5 = 0")
def c09(spark, sf_dir):
    return checks.dangling(generators.math_spans(made(spark, sf_dir, MATH)), spark.createDataFrame([("frac",), ("sqrt",)], "command string")).select("doc", "command")


@query("c11_doubled_commands", f"SELECT k AS doc, 'text' AS command FROM {_K} WHERE k % 6 = 0")
def c11(spark, sf_dir):
    return checks.doubled_commands(made(spark, sf_dir, MATH))


@query("c23_markdown_headings", f"SELECT k AS doc, {big(5)} AS line FROM {_K} WHERE k % 7 = 0")
def c23(spark, sf_dir):
    lines = generators.lines(made(spark, sf_dir, MATH)).withColumn("text", F.regexp_replace("text", r"(?<!\\)%.*", ""))
    return lines.filter(F.col("text").rlike(r"^[ \t]{0,3}#{1,6}[ \t]+\S")).select("doc", "line")


@query("c24_text_commands_in_math", f"SELECT k AS doc, 'textcircled' AS command, {big(6)} AS line, concat('w^{{', {B}, 'textcircled{{1}}}}') AS body FROM {_K} WHERE k % 8 = 0")
def c24(spark, sf_dir):
    return markup.text_in_math(made(spark, sf_dir, MATH))


@query("p08_trimmed_inline", f"SELECT doc, line, t AS text FROM (SELECT k AS doc, unnest(range(1, 8)) AS line, unnest(string_split(replace({MATH}, '$ y_', '$y_'), chr(10))) AS t FROM {_K})")
def p08(spark, sf_dir):
    return rewrites.trimmed_inline(made(spark, sf_dir, MATH)).select("doc", "line", "text")


@query("c20_table_defects", f"SELECT k AS doc, {big(0)} AS nth, {big('1 + CAST(k % 4 = 0 AS INTEGER)')} AS rows, CASE WHEN k % 3 = 0 THEN 'merged cells' WHEN k % 4 = 0 THEN 'ragged rows' ELSE '' END AS defect FROM {_K}")
def c20(spark, sf_dir):
    return markup.html_tables(made(spark, sf_dir, HTML))


@query("p04_pipe_tables", f"""SELECT k AS doc, {big("CAST(good AS INTEGER)")} AS converted, {big("CAST(NOT good AS INTEGER)")} AS kept,
CASE WHEN good THEN concat('x', {N}, {N}, '| ', k % 10, ' | b |', {N}, '| --- | --- |', {N}, {N}, 'y') ELSE {HTML} END AS text FROM (SELECT k, k % 3 <> 0 AND k % 4 <> 0 AS good FROM {_K})""")
def p04(spark, sf_dir):
    return markup.pipe_tables(made(spark, sf_dir, HTML)).select("doc", "converted", "kept", "text")


@query("p09_fences", f"SELECT k, CASE k % 3 WHEN 0 THEN concat(k, {N}) WHEN 1 THEN concat(k) ELSE concat(k) END AS text FROM {_K}")
def p09(spark, sf_dir):
    fenced = f"CASE k % 3 WHEN 0 THEN concat('```tex', {N}, k, {N}, '```', {N}) WHEN 1 THEN concat(k) ELSE concat('```', {N}, k) END"
    return keys(spark, sf_dir).selectExpr("k", f"{fenced} AS raw").select("k", T.strip_fence(F.col("raw")).alias("text"))


@query("p24_chinese_numbers", f"SELECT k, CASE WHEN k % 10000 > 0 THEN {big('k % 10000')} END AS n FROM {_K}")
def p24(spark, sf_dir):
    digits = [f"CASE WHEN k % {10 * unit} >= {unit} THEN concat(substr('一二三四五六七八九', CAST(floor(k % {10 * unit} / {unit}) AS INT), 1), '{sign}') ELSE '' END" for unit, sign in ((1000, "千"), (100, "百"), (10, "十"), (1, ""))]
    return keys(spark, sf_dir).selectExpr("k", f"concat({', '.join(digits)}) AS s").select("k", T.chinese_number(F.col("s")).alias("n"))


@query("p25_caption_numbers", f"SELECT k, CASE k % 5 WHEN 0 THEN concat(k % 7, '.', k % 9) WHEN 1 THEN concat(k % 7, '.', k % 9) WHEN 3 THEN concat('A', k % 9) END AS number FROM {_K}")
def p25(spark, sf_dir):
    caption = "CASE k % 5 WHEN 0 THEN concat('Fig. ', k % 7, '.', k % 9, ' Heat') WHEN 1 THEN concat('图', k % 7, '-', k % 9, ' 热') WHEN 2 THEN 'no number' WHEN 3 THEN concat('Table A', k % 9) ELSE '图1 一句话。' END"
    return keys(spark, sf_dir).selectExpr("k", f"{caption} AS caption").select("k", markup.caption_number(F.col("caption")).alias("number"))


@query("s08_image_kinds", f"SELECT k, CASE k % 6 WHEN 0 THEN 'image/jpeg' WHEN 1 THEN 'image/png' WHEN 2 THEN 'image/gif' WHEN 3 THEN 'image/gif' WHEN 4 THEN 'image/webp' END AS kind FROM {_K}")
def s08(spark, sf_dir):
    head = "CASE k % 6 WHEN 0 THEN 'FFD8FF' WHEN 1 THEN '89504E470D0A1A0A' WHEN 2 THEN '474946383761' WHEN 3 THEN '474946383961' WHEN 4 THEN '524946460000000057454250' ELSE 'FFD7FF' END"
    return keys(spark, sf_dir).selectExpr("k", f"unhex(concat({head}, lpad(CAST(k % 100 AS STRING), 2, '0'))) AS content").select("k", T.image_kind(F.col("content")).alias("kind"))


@query("p05_prefixed_images", f"""SELECT k, CASE k % 4 WHEN 0 THEN concat('![f](../images/', k, '.png)') WHEN 1 THEN concat('![h](http://x.org/', k, '.png)') WHEN 2 THEN concat('![r](/', k, '.png)') ELSE concat('<img src="../', k, '.png">') END AS text FROM {_K}""")
def p05(spark, sf_dir):
    text = """CASE k % 4 WHEN 0 THEN concat('![f](images/', k, '.png)') WHEN 1 THEN concat('![h](http://x.org/', k, '.png)') WHEN 2 THEN concat('![r](/', k, '.png)') ELSE concat('<img src="', k, '.png">') END"""
    return keys(spark, sf_dir).selectExpr("k", f"{text} AS text").select("k", rewrites.prefixed_images(F.col("text"), "..").alias("text"))


@query("p01_merged_headings", f"SELECT k AS doc, {big(1)} AS line, concat('# Chapter ', k % 9, ' Title ', k % 5) AS text FROM {_K} UNION ALL SELECT k, 5, 'text' FROM {_K}")
def p01(spark, sf_dir):
    return markup.merged_headings(made(spark, sf_dir, _lines("concat('## Chapter ', k % 9)", "''", "concat('# Title ', k % 5)", "''", "'text'")))


LEVELS = Fixture("title string, level int", [("Title 0", 2), ("Title 1", 0), ("Title 9", 3)])


@query("p02_relevelled", f"""SELECT k AS doc, {big(1)} AS line, CASE WHEN level IS NULL THEN concat('# Title ', k % 4) WHEN level = 0 THEN title ELSE concat(repeat('#', level), ' ', title) END AS text,
CASE WHEN level = 0 THEN 'demoted' WHEN level > 1 THEN 'relevelled' ELSE 'unchanged' END AS change FROM {_K} LEFT JOIN {LEVELS.sql()} ON title = concat('Title ', k % 4) UNION ALL SELECT k, 2, 'body', NULL FROM {_K}""")
def p02(spark, sf_dir):
    return markup.relevelled(made(spark, sf_dir, _lines("concat('# Title ', k % 4)", "'body'")), LEVELS.frame(spark))


@query("p03_structured", f"SELECT k AS doc, {big('i')} AS line, t AS text FROM (SELECT k, unnest(range(1, 7)) AS i, unnest(['#* Preface', '##* Thanks', concat('# One ', k), '## Summary', concat(k % 7, '. item'), 'end']) AS t FROM {_K})")
def p03(spark, sf_dir):
    docs = made(spark, sf_dir, _lines("'# preface'", "'## Thanks'", "concat('# ', k % 9, ' one')", "'## Summary'", "concat('### ', k % 7, '. item')", "'end'"))
    divisions = keys(spark, sf_dir).selectExpr("k AS doc", "1L AS line", "'frontmatter' AS kind", "'Preface' AS title").unionByName(keys(spark, sf_dir).selectExpr("k AS doc", "3L AS line", "'chapter' AS kind", "concat('One ', k) AS title"))
    return markup.structured(docs, divisions)


@query("a07_division_evidence", f"SELECT k AS doc, {big(1)} AS division, prefix, count(*) AS times FROM (SELECT k, unnest([CAST(k % 9 AS VARCHAR), CAST(k % 9 AS VARCHAR), CAST(k % 5 AS VARCHAR)]) AS prefix FROM {_K}) GROUP BY k, prefix")
def a07(spark, sf_dir):
    return markup.division_evidence(made(spark, sf_dir, _lines("'# Heat'", "concat('## ', k % 9, '.1 A')", "concat('Fig. ', k % 9, '.3 x')", f"concat('$$a', {B}, 'tag{{', k % 5, '.1}}$$')")))


@query("p07_restored_images", f"SELECT k AS doc, concat({B}, 'x{{images/', k, '.png}} {{IMG_0009}} IMG_0001') AS text, {big(1)} AS unknown FROM {_K}")
def p07(spark, sf_dir):
    docs = made(spark, sf_dir, f"concat({B}, 'x{{IMG_000', k % 4, '}} {{IMG_0009}} IMG_0001')")
    return markup.restored_images(docs, keys(spark, sf_dir).selectExpr("k AS doc", "concat('IMG_000', k % 4) AS token", "concat('images/', k, '.png') AS path"))


@query("p16_without_images", f"SELECT k AS doc, {big(1)} AS line, CASE WHEN k % 3 = 1 THEN 'a  b' ELSE concat('a ![x](x', k % 3, '.png) b') END AS text FROM {_K} UNION ALL SELECT k, 3, '![y](y.png)' FROM {_K}")
def p16(spark, sf_dir):
    docs = made(spark, sf_dir, _lines("concat('a ![x](x', k % 3, '.png) b')", "'![x](x1.png)'", "'![y](y.png)'"))
    return markup.without_images(docs, keys(spark, sf_dir).selectExpr("k AS doc", "'x1.png' AS path"))


@query("p15_wide_tables", f"""SELECT k AS doc, CASE WHEN k % 2 = 0 THEN concat({B}, 'resizebox{{w}}{{!}}{{', {B}, 'begin{{tabular}}{{lr}}', k, {B}, 'end{{tabular}}}}') ELSE concat('a ', {B}, 'fittable{{', {B}, 'begin{{tabular}}{{lr}}', k, {B}, 'end{{tabular}}}}') END AS text, {big('k % 2')} AS fitted FROM {_K}""")
def p15(spark, sf_dir):
    tabular = f"concat({B}, 'begin{{tabular}}{{lr}}', k, {B}, 'end{{tabular}}')"
    return markup.wide_tables(made(spark, sf_dir, f"CASE WHEN k % 2 = 0 THEN concat({B}, 'resizebox{{w}}{{!}}{{', {tabular}, '}}') ELSE concat('a ', {tabular}) END"))


@query("g12_image_sites", f"SELECT k AS doc, concat('i/', k % 3, '.png') AS path, {big(1)} AS line, CASE WHEN k % 2 = 0 THEN '2.1' END AS number FROM {_K}")
def g12(spark, sf_dir):
    return markup.image_sites(made(spark, sf_dir, _lines("concat('![a](i/', k % 3, '.png)')", "CASE WHEN k % 2 = 0 THEN 'Fig. 2.1 x' ELSE '## stop' END", "concat('Fig. 3.', k % 5)")))


@query("g19_layout_images", f"SELECT k AS doc, concat(k, '.png') AS name, CASE WHEN k % 2 = 0 THEN concat(k % 7, '.1') END AS number, {big('floor(greatest(0.2, least(0.9, (100 + k % 8 * 100) / 800)) * 100 + 0.5)')} AS percent FROM {_K}")
def g19(spark, sf_dir):
    kinds = "CAST(NULL AS INT) AS text_level"
    body = keys(spark, sf_dir).selectExpr("k AS doc", "0 AS pos", "'text' AS type", "repeat('x', 60) AS text", kinds, "array(0D, 0D, 800D, 10D) AS bbox", "CAST(NULL AS STRING) AS img_path", "CAST(array() AS ARRAY<STRING>) AS captions")
    image = keys(spark, sf_dir).selectExpr("k AS doc", "1 AS pos", "'image' AS type", "'' AS text", kinds, "array(0D, 0D, 100D + k % 8 * 100, 10D) AS bbox", "concat('images/', k, '.png') AS img_path", "array('panel', CASE WHEN k % 2 = 0 THEN concat('Fig. ', k % 7, '.1 Heat') ELSE 'none' END) AS captions")
    return markup.layout_images(body.unionByName(image).unionByName(image.withColumn("pos", F.lit(2)).withColumn("bbox", F.expr("array(0D, 0D, 1D, 1D)"))))


@query("p21_repair_variants", f"SELECT k, {big('1 + k % 2')} AS n FROM {_K}")
def p21(spark, sf_dir):
    return keys(spark, sf_dir).selectExpr("k", "CASE WHEN k % 2 = 1 THEN concat('a', chr(12), 'rac') ELSE 'plain' END AS s").select("k", F.size(T.repair_variants(F.col("s"))).cast("long").alias("n"))


@query("p29_verdicts", f"""SELECT k AS id, CASE k % 5 WHEN 0 THEN 'figure' WHEN 1 THEN 'decoration' END AS label, CASE k % 5 WHEN 0 THEN least(k % 3, 1.0)::DOUBLE WHEN 1 THEN 0.5::DOUBLE END AS confidence,
CASE WHEN k % 5 = 0 THEN true END AS chinese_text, CASE WHEN k % 5 > 1 THEN 'malformed' END AS flag FROM {_K}""")
def p29(spark, sf_dir):
    reply = """CASE k % 5 WHEN 0 THEN concat('Sure: {"label": "figure", "confidence": ', k % 3, ', "chinese_text": true}') WHEN 1 THEN '{"label": "decoration", "confidence": 0.5, "chinese_text": "yes"}'
    WHEN 2 THEN 'no json' WHEN 3 THEN '{"label": "figure", "confidence": true}' ELSE '{"label": "cat", "confidence": 1}' END"""
    return records.verdicts(keys(spark, sf_dir).selectExpr("k AS id", f"{reply} AS reply"))


_RECORD = "CASE k % 4 WHEN 0 THEN 'figure' WHEN 1 THEN 'decoration' WHEN 2 THEN 'decoration' END AS label, k % 11 / 10.0 AS confidence, k % 3 = 0 AS in_gap, CASE WHEN k % 7 = 0 THEN 'malformed' END AS flag"


@query("t10_decisions", f"""SELECT k AS id, coalesce(label = 'figure' OR confidence < 0.9 OR in_gap, true) AS keep,
CASE WHEN label IS NULL THEN coalesce(flag, 'unclassified') WHEN label = 'figure' OR (confidence >= 0.9 AND NOT in_gap) THEN NULL WHEN confidence >= 0.9 THEN 'gap' ELSE 'uncertain' END AS flag FROM (SELECT k, {_RECORD} FROM {_K})""")
def t10(spark, sf_dir):
    return records.decided(keys(spark, sf_dir).selectExpr("k AS id", *[x for x in _RECORD.split(", ")])).select("id", "keep", F.col("new_flag").alias("flag"))


_SITES = f"(SELECT c AS doc, k AS pos, CASE WHEN k % 3 = 0 THEN NULL ELSE k % 11 + 1 END AS n FROM {_K})"


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys(spark, sf_dir).selectExpr("c AS doc", "k AS pos", "CASE WHEN k % 3 = 0 THEN NULL ELSE concat('3.', k % 11 + 1) END AS number")


@query("j15_figure_gaps", f"""SELECT doc, pos FROM (SELECT doc, pos, n, last_value(n IGNORE NULLS) OVER (PARTITION BY doc ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p,
first_value(n IGNORE NULLS) OVER (PARTITION BY doc ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS f FROM {_SITES}) WHERE n IS NULL AND f > coalesce(p + 1, 1)""")
def j15(spark, sf_dir):
    return records.figure_gaps(sites(spark, sf_dir)).select("doc", "pos")


@query("c31_figure_numbers", f"""SELECT doc, '3' AS seq, n AS at_number, 'duplicate' AS problem FROM {_SITES} WHERE n IS NOT NULL GROUP BY doc, n HAVING count(*) > 1
UNION ALL SELECT doc, '3', n, 'missing' FROM (SELECT doc, unnest(range(1, max(n) + 1)) AS n FROM {_SITES} GROUP BY doc) m WHERE NOT EXISTS (SELECT 1 FROM {_SITES} s WHERE s.doc = m.doc AND s.n = m.n)""")
def c31(spark, sf_dir):
    return records.figure_numbers(sites(spark, sf_dir)).withColumnRenamed("at", "at_number")


@query("c32_figure_coverage", f"""WITH used AS (SELECT DISTINCT c AS doc, k % 5 AS t FROM {_K}), tokens AS (SELECT DISTINCT c AS doc, k % 5 + k % 2 AS t FROM {_K}), kept AS (SELECT DISTINCT c AS doc, k % 4 AS t FROM {_K})
SELECT doc, concat('IMG_000', t) AS token, CASE WHEN k.doc IS NULL THEN 'no-record' ELSE 'dropped' END AS problem FROM used JOIN tokens USING (doc, t) LEFT JOIN kept k USING (doc, t) WHERE k.doc IS NULL OR t = 1
UNION ALL SELECT doc, concat('IMG_000', t), 'unused' FROM tokens ANTI JOIN used USING (doc, t)""")
def c32(spark, sf_dir):
    used = keys(spark, sf_dir).selectExpr("c AS doc", "concat('IMG_000', k % 5) AS token")
    tokens = keys(spark, sf_dir).selectExpr("c AS doc", "concat('IMG_000', k % 5 + k % 2) AS token", "concat('images/', k % 5 + k % 2, '.png') AS path").distinct()
    kept = keys(spark, sf_dir).selectExpr("c AS doc", "concat(k % 4, '.png') AS name", "k % 4 <> 1 AS keep").distinct()
    return records.figure_coverage(used, tokens, kept)


@query("c34_finding_problems", f"""SELECT k AS id, array_to_string(list_filter([CASE WHEN k % 5 = 0 THEN 'unknown kind' END, CASE WHEN k % 7 = 0 THEN 'fix without text' END, CASE WHEN k % 3 = 0 THEN 'excerpt not found' END], lambda x: x IS NOT NULL), ',') AS problems FROM {_K}""")
def c34(spark, sf_dir):
    made_rows = keys(spark, sf_dir).selectExpr(
        "c AS doc", "k AS id", "CASE WHEN k % 5 = 0 THEN 'odd' ELSE 'formula' END AS kind", "'major' AS severity", "CASE WHEN k % 7 = 0 THEN 'fix' ELSE 'keep' END AS action",
        "CASE WHEN k % 3 = 0 THEN 'zz' ELSE concat('a $', k, '$') END AS excerpt", "'' AS fixed_text", "concat('x a ', k, ' y') AS text",
    )
    return records.finding_problems(made_rows).select("id", F.array_join("problems", ",").alias("problems"))


@query("c35_spec_problems", f"SELECT k AS image, CASE k % 4 WHEN 0 THEN '' WHEN 1 THEN 'unknown method' WHEN 2 THEN 'no labels' ELSE 'bad box,untranslated label' END AS problems FROM {_K}")
def c35(spark, sf_dir):
    label = "named_struct('zh', '力', 'en', CASE WHEN k % 4 = 3 THEN '力' ELSE 'force' END, 'box', array(CASE WHEN k % 4 = 3 THEN 0.5D ELSE 0.1D END, 0.1D, 0.2D, 0.2D))"
    specs = keys(spark, sf_dir).selectExpr("k AS image", "CASE k % 4 WHEN 1 THEN 'paint' WHEN 2 THEN 'redraw' ELSE 'overlay' END AS method", f"CASE WHEN k % 4 IN (0, 3) THEN array({label}) ELSE filter(array({label}), l -> false) END AS labels")
    return records.spec_problems(specs).select("image", F.array_join("problems", ",").alias("problems"))


@query("c36_first_heading", f"SELECT k AS doc, CASE k % 4 WHEN 1 THEN 'no chapter' ELSE 'front matter' END AS warning FROM {_K} WHERE k % 4 IN (1, 2)")
def c36(spark, sf_dir):
    text = "CASE k % 4 WHEN 0 THEN concat('# Part One', chr(10), '# Chapter ', k) WHEN 1 THEN concat('# Notes', chr(10), '# Chapter ', k) WHEN 2 THEN '# Preface' ELSE '# 第一章 力' END"
    return records.first_heading(generators.headings(made(spark, sf_dir, text)))


@query("c26_chapter_drift", f"""SELECT c AS doc, k AS pos, number, tagged, number - tagged AS drift FROM (SELECT *, coalesce(lag(number - tagged) OVER (PARTITION BY c ORDER BY k), 0) AS before FROM (
SELECT c, k, row_number() OVER (PARTITION BY c ORDER BY k) AS number, {big('k % 4')} AS tagged FROM {_K} WHERE k % 5 <> 0)) WHERE number <> tagged AND number - tagged <> before""")
def c26(spark, sf_dir):
    return records.chapter_drift(keys(spark, sf_dir).selectExpr("c AS doc", "k AS pos", "k % 5 = 0 AS starred", "array(k % 4, 9L, k % 4) AS tags"))


@query("j16_contexts", f"SELECT DISTINCT concat('IMG_', lpad(CAST(t AS VARCHAR), 4, '0')) AS token, min(concat(k, '.md')) AS file FROM (SELECT k, k % 50 AS t FROM {_K}) GROUP BY t")
def j16(spark, sf_dir):
    files = keys(spark, sf_dir).selectExpr("concat(k, '.md') AS file", "concat('see IMG_', lpad(CAST(k % 50 AS STRING), 4, '0'), ' there') AS text")
    tokens = keys(spark, sf_dir).selectExpr("concat('IMG_', lpad(CAST(k % 60 AS STRING), 4, '0')) AS token").distinct()
    return records.context_of(tokens, files).select("token", "file")


@query("j11_overlap", f"SELECT k AS doc, {big('CASE WHEN k % 2 = 0 THEN 45 ELSE 0 END')} AS k FROM {_K}")
def j11(spark, sf_dir):
    shared = "repeat(lpad(CAST(k AS STRING), 9, '0'), 5)"
    rows = keys(spark, sf_dir).selectExpr("k AS doc", f"concat('head ', {shared}) AS a", f"CASE WHEN k % 2 = 0 THEN concat({shared}, ' tail') ELSE 'another text' END AS b")
    return rows.select("doc", joins.overlap_length(F.col("a"), F.col("b")).alias("k"))


@query("j18_error_hints", f"""SELECT k, CASE k % 4 WHEN 0 THEN concat(k, ': check the credentials') ELSE concat(k) END AS message, CASE WHEN k % 4 IN (1, 3) THEN 'transient' ELSE 'permanent' END AS class FROM {_K}""")
def j18(spark, sf_dir):
    rows = keys(spark, sf_dir).selectExpr("k", "CASE k % 4 WHEN 0 THEN 401 WHEN 1 THEN 429 WHEN 2 THEN 418 ELSE 500 END AS status", "CAST(k AS STRING) AS text")
    return rows.select("k", state.hint(F.col("status"), F.col("text")).alias("message"), state.error_class(F.col("status")).alias("class"))


@query("j07_similar_lists", f"""WITH t AS (SELECT k, k % 40 AS g, t, count(*) AS n FROM (SELECT k, unnest(['a' || k % 5, 'b' || k % 7, 'c' || k % 11, 'd' || k % 3, 'a' || k % 2]) AS t FROM {_K}) GROUP BY ALL)
SELECT a.g, a.k AS id, b.k AS other, 2 * sum(least(a.n, b.n)) / 10 AS bag FROM t a JOIN t b ON a.g = b.g AND a.t = b.t WHERE a.k % 3 = 0 AND b.k % 3 <> 0 GROUP BY a.g, a.k, b.k HAVING 2 * sum(least(a.n, b.n)) / 10 >= 0.8""")
def j07(spark, sf_dir):
    lists = keys(spark, sf_dir).selectExpr("k % 40 AS g", "k AS id", "array('a' || k % 5, 'b' || k % 7, 'c' || k % 11, 'd' || k % 3, 'a' || k % 2) AS tokens")
    return joins.similar(lists.filter("id % 3 = 0"), lists.filter("id % 3 <> 0"), ["g"], least=0.8)


@query("j17_substituted_figures", f"SELECT k, CASE WHEN k % 100 < 30 THEN concat('figure_text/', k % 100, '.pdf') ELSE concat('images/', k % 100, '.png') END AS path, k % 100 < 30 AS swapped FROM {_K}")
def j17(spark, sf_dir):
    images = keys(spark, sf_dir).selectExpr("CAST(k AS STRING) AS token", "concat('images/', k % 100, '.png') AS path")
    done = keys(spark, sf_dir).filter("k % 100 < 30").selectExpr("concat(k % 100, '.png') AS name")
    return records.substituted(images, done).select(F.col("token").cast("long").alias("k"), "path", "swapped")


_POLLS = "(SELECT user_id AS batch, event_id % 3 AS part, event_id AS seq, CASE event_type WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'failed' ELSE 'running' END AS state FROM events)"
_POLLED = f"(SELECT batch, count(*) FILTER (s = 'done') AS done, count(*) FILTER (s = 'failed') AS failed, count(*) FILTER (s = 'running') AS waiting, CASE WHEN count(*) FILTER (s = 'running') = 0 THEN max(since) END AS ended FROM (SELECT batch, part, arg_max(state, seq) AS s, min(seq) FILTER (state <> 'running') AS since FROM {_POLLS} GROUP BY batch, part) GROUP BY batch)"


def polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = "CASE event_type WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'failed' ELSE 'running' END"
    return table(spark, sf_dir, "events").selectExpr("user_id AS batch", "event_id % 3 AS part", "event_id AS seq", f"{kind} AS state")


@query("t01_polled_batches", f"SELECT * FROM {_POLLED}")
def t01(spark, sf_dir):
    return state.polled(polls(spark, sf_dir))


@query("t02_resumed_sources", f"""SELECT c_custkey AS source, CASE WHEN c_custkey % 3 > 0 AND c_custkey % 5 > 0 THEN c_custkey END AS batch,
CASE WHEN c_custkey % 3 = 0 OR c_custkey % 5 = 0 THEN 'submit' WHEN ended IS NOT NULL THEN 'collect' ELSE 'poll' END AS step FROM customer LEFT JOIN {_POLLED} ON batch = c_custkey""")
def t02(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    sources = customer.selectExpr("c_custkey AS source", "c_name AS digest")
    recorded = customer.filter("c_custkey % 3 > 0").selectExpr("c_custkey AS source", "CASE WHEN c_custkey % 5 > 0 THEN c_name ELSE 'old' END AS digest", "c_custkey AS batch")
    return state.resumed(sources, recorded, polls(spark, sf_dir))


@query("t09_follow_ups", f"""WITH b AS (SELECT DISTINCT k % 20 AS key FROM {_K}), a AS (SELECT DISTINCT c AS variant, k % 23 AS key FROM {_K}), q AS (SELECT DISTINCT c AS variant, k % 19 AS key FROM {_K})
SELECT CAST(variant AS VARCHAR) AS variant, CAST(key AS VARCHAR) AS key FROM q WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.variant = q.variant AND a.key = q.key) AND variant NOT IN (SELECT variant FROM a WHERE key NOT IN (SELECT key FROM b))""")
def t09(spark, sf_dir):
    rows = keys(spark, sf_dir)
    before = rows.selectExpr("CAST(k % 20 AS STRING) AS key").distinct()
    after, answers = (rows.selectExpr("CAST(c AS STRING) AS variant", f"CAST(k % {n} AS STRING) AS key").distinct() for n in (23, 19))
    return state.accepted_follow_ups(before, after, answers)


@query("c40_accepted_titles", f"SELECT k AS doc, concat('Title ', k % 7) AS title, CASE WHEN k % 5 = 0 THEN concat('Title ', k % 7) ELSE concat(k % 7) END AS clean FROM {_K} WHERE k % 3 <> 0 AND k % 2 = 0")
def c40(spark, sf_dir):
    headings = generators.headings(made(spark, sf_dir, "concat('# Title ', k % 7)"))
    answers = keys(spark, sf_dir).selectExpr("k AS doc", "CASE WHEN k % 2 = 0 THEN concat('Title ', k % 7) ELSE 'Invented' END AS title", "CASE WHEN k % 3 = 0 THEN 'odd' ELSE 'chapter' END AS kind", "CASE WHEN k % 5 = 0 THEN 'Other' ELSE CAST(k % 7 AS STRING) END AS clean")
    return records.accepted_titles(answers, headings, ("part", "chapter")).select("doc", "title", "clean")


@query("p31_coerced_levels", f"SELECT k, {big('CAST(k % 9 BETWEEN 1 AND 6 AS INTEGER) + 1')} AS kept FROM {_K}")
def p31(spark, sf_dir):
    rows = keys(spark, sf_dir).selectExpr("k", "map('a', CAST(k % 9 AS STRING), 'b', '2', 'c', 'x') AS levels")
    return rows.select("k", F.size(rewrites.coerced_levels(F.col("levels"))).cast("long").alias("kept"))


@query("p17_without_preamble", f"SELECT k AS doc, CASE WHEN k % 6 = 0 THEN replace(t, concat({N}, {B}, 'usepackage{{x}}'), '') ELSE t END AS text FROM {_TEX}")
def p17(spark, sf_dir):
    return rewrites.without_preamble(made(spark, sf_dir, TEX))


@query("p17_first_chapter", f"SELECT k, {big('CASE WHEN k % 3 = 0 THEN 1 ELSE k % 20 + 1 END')} AS first FROM {_K}")
def p17_first(spark, sf_dir):
    rows = keys(spark, sf_dir).selectExpr("k", f"concat(CASE WHEN k % 3 = 0 THEN '% ' ELSE '' END, {B}, 'setcounter{{chapter}}{{', k % 20, '}}') AS preamble")
    return rows.select("k", rewrites.first_chapter(F.col("preamble")))


@query("p14_figure_widths", f"""SELECT doc, name, {big('floor(w * CASE WHEN count(*) OVER (PARTITION BY doc) > 1 THEN least(1.0, 0.96 / sum(w) OVER (PARTITION BY doc)) ELSE 1.0 END * 100 + 0.5)')} AS percent FROM (
SELECT k AS doc, concat(i, '.png') AS name, CASE WHEN i = 0 THEN 0.5 ELSE 0.75 END::DOUBLE AS w FROM {_K}, (VALUES (0), (1)) v(i) WHERE i = 0 OR k % 3 > 0)""")
def p14(spark, sf_dir):
    calls = keys(spark, sf_dir).selectExpr("k AS doc", "1 AS at", "explode(array(0, 1)) AS slot").selectExpr("*", "concat(slot, '.png') AS name")
    figures = keys(spark, sf_dir).selectExpr("k AS doc", "k", "explode(array(0, 1)) AS i").selectExpr("doc", "concat(i, '.png') AS name", "i = 0 OR k % 3 > 0 AS keep", "CAST(NULL AS STRING) AS number", "CASE WHEN i = 0 THEN 0.5D ELSE 0.75D END AS width")
    return rewrites.figure_widths(calls, figures).select("doc", "name", "percent")


@query("c13_missing_images", f"SELECT DISTINCT k AS doc, concat('i/', k % 3, '.png') AS path FROM {_K} WHERE k % 3 <> 1")
def c13(spark, sf_dir):
    files = spark.createDataFrame([("images/1.png",), ("i/9.png",)], "file string")
    return checks.missing_files(generators.image_references(made(spark, sf_dir, "concat('![a](i/', k % 3, '.png) ![b](http://x.org/', k, '.png)')")), files)


@query("j12_located_pages", f"SELECT k AS doc, {big(1)} AS id, concat(k % 9 + 1) AS pages, 'exact' AS how FROM {_K}")
def j12(spark, sf_dir):
    pages = keys(spark, sf_dir).selectExpr("k", "explode(sequence(1L, 9L)) AS page").selectExpr("k AS doc", "page", "concat('of order ', k, ' the page ', repeat(CAST(page AS STRING), 12)) AS text")
    excerpts = keys(spark, sf_dir).selectExpr("k AS doc", "1L AS id", "1L AS first", "5L AS last", "repeat(CAST(k % 9 + 1 AS STRING), 12) AS excerpt")
    return records.located(excerpts, pages).select("doc", "id", F.array_join(F.transform("pages", lambda p: p.cast("string")), ",").alias("pages"), "how")


@query("j06_alignment", f"SELECT k AS doc, {big('i')} AS source_nth, {big('i')} AS target_nth, {big('CASE WHEN i = 1 THEN 666666 ELSE 1000000 END')} AS similarity FROM {_K}, (VALUES (0), (1), (2)) v(i)")
def j06(spark, sf_dir):
    rows = keys(spark, sf_dir).selectExpr("CAST(k AS STRING) AS doc", "array(concat('x = ', k), 'y = 2', 'z = 3') AS source", "array(concat('x = ', k), 'y = 3', 'z = 3') AS target")
    return joins.aligned(rows).withColumn("doc", F.col("doc").cast("long"))


_PAIR = {  # what the source says, what the target says, and the findings
    0: ("concat('$$x^{', k, '}+y$$')", "concat('$$x^{', k + 1, '}+y$$')", (("numbers", "concat('lost ^', k)"), ("numbers", "concat('added ^', k + 1)"), ("changed-block", "concat('x ^ ', k, ' + y')"))),
    1: ("concat('$$a-', k, '=c$$')", "concat('$$a+', k, '=c$$')", (("numbers", "concat('lost -', k)"), ("numbers", "concat('added +', k)"), ("changed-block", "concat('a - ', k, ' = c')"))),
    2: (f"concat('$$a=', k, '$$', {N}, {N}, '$$b=q$$')", "concat('$$a=', k, '$$')", (("display-count", "'2 became 1'"),)),
    3: (f"concat('$$a=b$$ (', k, '.3)', {N})", f"concat('$$a=b$$', {N})", (("equation-tags", "concat('lost ', k, '.3')"), ("prose-numbers", "concat(k, '.3')"))),
    4: (f"concat('$', {B}, 'dfrac{{', k, '}}{{2}}', {B}, 'le x$')", f"concat('$', {B}, 'frac{{', k, '}}2 ', {B}, 'leq x$')", ()),
}


@query("c33_pair_fidelity", " UNION ALL ".join(f"SELECT k AS doc, '{check}' AS check_name, '{'info' if check == 'prose-numbers' else 'review'}' AS severity, {message} AS message FROM {_K} WHERE k % 5 = {r}" for r, (_, _, found) in _PAIR.items() for check, message in found))
def c33(spark, sf_dir):
    sides = [f"CASE k % 5 {' '.join(f'WHEN {r} THEN {pair[side]}' for r, pair in _PAIR.items())} END" for side in (0, 1)]
    pairs = keys(spark, sf_dir).selectExpr("k AS doc", f"{sides[0]} AS source", f"{sides[1]} AS target")
    return markup.pair_fidelity(pairs).withColumnRenamed("check", "check_name")


def _snapped(first: str) -> str:
    """The last page of a tile of 100 pages of 1 to ``total``, moved to before one of two marks."""
    last = f"least({first} + 99, total)"
    near = " ".join(f"WHEN {last} < total AND abs({m - 1} - {last}) <= 10 AND {m} - {first} BETWEEN 20 AND 100 THEN {m - 1}" for m in (96, 150))
    return f"CASE {near} ELSE {last} END"


@query("w09_snapped_tiles", f"""WITH RECURSIVE r AS (SELECT k, total, {big(1)} AS first, {_snapped("1")} AS last FROM (SELECT k, k % 300 + 1 AS total FROM {_K})
UNION ALL SELECT k, total, f, {_snapped("f")} FROM (SELECT k, total, greatest(last - 1, first + 1) AS f FROM r WHERE last < total)) SELECT k AS doc, first, last FROM r""")
def w09_snapped(spark, sf_dir):
    docs = keys(spark, sf_dir).selectExpr("k AS doc", "k % 300 + 1 AS total", "array(96L, 150L) AS marks")
    return windows.snapped(docs, most=100, overlap=2)
