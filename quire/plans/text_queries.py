"""Queries of text primitives, lines, packing and aggregates over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import aggregates, checks, generators, windows
from quire.plans.catalog import Fixture, query, table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as ``doc`` and ``text``."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), "text")


@query("g01_lines", "SELECT doc_id AS doc, k AS line, CAST(length(t) AS BIGINT) AS n_chars, t = '' AS blank FROM (SELECT doc_id, unnest(range(1, len(l) + 1)) AS k, unnest(l) AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))")
def g01(spark, sf_dir):
    return generators.lines(documents(spark, sf_dir)).select("doc", "line", F.length("text").cast("long").alias("n_chars"), (F.col("text") == "").alias("blank"))


BOOKS = Fixture("doc string, text string", [
    ("a", "# Part One\n\n# Chapter 1 Motion\n\nText $x$ and $ y $.\n\n\nMore $$a+b$$ text\n$$\nE=mc^2 \\tag{1.1}\n$$\nEnd"),
    ("b", "## 2.1 Heat\n\n![f](images/a.png)\nFig. 2.1 Heat\n<img src=\"images/b.png\">\n\n### Sub \n \t\nline\n$$\nopen"),
    ("c", ""),
    ("d", "no heading\n#not one\n# Same\n# Same\n\n  \nlast ![g](images/a.png) ![h](http://x.org/c.png)"),
])
_BOOKS = BOOKS.sql()
_LINES = f"(SELECT doc, unnest(range(1, len(l) + 1)) AS line, unnest(l) AS t FROM (SELECT doc, string_split(text, chr(10)) AS l FROM {_BOOKS}))"


@query("g02_paragraphs", f"SELECT doc, CAST(k - 1 AS BIGINT) AS nth, p AS text FROM (SELECT doc, unnest(range(1, len(l) + 1)) AS k, unnest(l) AS p FROM (SELECT doc, list_filter(list_transform(regexp_split_to_array(text, '\\n[ \\t]*\\n'), lambda x: regexp_replace(x, '^\\n+|\\n+$', '', 'g')), lambda x: trim(x, ' ' || chr(9) || chr(10)) <> '') AS l FROM {_BOOKS}))")
def g02(spark, sf_dir):
    return generators.paragraphs(BOOKS.frame(spark), keep_blank=False)


@query("g02_paragraphs_all", f"SELECT doc, CAST(k - 1 AS BIGINT) AS nth, p AS text FROM (SELECT doc, unnest(range(1, len(l) + 1)) AS k, unnest(l) AS p FROM (SELECT doc, regexp_split_to_array(text, '\\n\\s*\\n') AS l FROM {_BOOKS}))")
def g02_all(spark, sf_dir):
    return generators.paragraphs(BOOKS.frame(spark), keep_blank=True)


_HEADINGS = f"(SELECT doc, line, off, CAST(length(regexp_extract(t, '^(#+)', 1)) AS BIGINT) AS level, trim(regexp_extract(t, '^#+[ \\t]+(.*)$', 1), ' ' || chr(9)) AS title FROM (SELECT *, CAST(coalesce(sum(length(t) + 1) OVER (PARTITION BY doc ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off FROM {_LINES}) WHERE regexp_matches(t, '^#{{1,6}}[ \\t]+\\S'))"


@query("g03_headings", f"SELECT doc, line, level, title FROM {_HEADINGS}")
def g03(spark, sf_dir):
    return generators.headings(BOOKS.frame(spark)).select("doc", "line", "level", "title")


@query("g04_heading_offsets", f"SELECT doc, off AS \"offset\", level FROM {_HEADINGS}")
def g04(spark, sf_dir):
    return generators.headings(BOOKS.frame(spark)).select("doc", "offset", "level")


@query("a03_ordered_distinct", f"SELECT doc, title, min(line) AS first, count(*) AS n FROM {_HEADINGS} GROUP BY doc, title")
def a03(spark, sf_dir):
    return generators.ordered_distinct(generators.headings(BOOKS.frame(spark)), ["doc", "title"], "line")


_STATE = f"(SELECT *, trim(t) = '$$' AS fence, sum(CAST(trim(t) = '$$' AS BIGINT)) OVER (PARTITION BY doc ORDER BY line) AS block FROM {_LINES})"
_SPANS = f"""(SELECT doc, o.line, 0 AS nth, 'display' AS kind, coalesce(body, '') AS body FROM (SELECT doc, block, line FROM {_STATE} WHERE fence AND block % 2 = 1) o
LEFT JOIN (SELECT doc, block, string_agg(t, chr(10) ORDER BY line) AS body FROM {_STATE} WHERE NOT fence AND block % 2 = 1 GROUP BY doc, block) USING (doc, block)
UNION ALL SELECT doc, line, unnest(range(len(s))) AS nth, CASE WHEN unnest(range(len(s))) < n THEN 'display' ELSE 'inline' END, unnest(s) FROM (
  SELECT doc, line, len(regexp_extract_all(t, '\\$\\$(.+?)\\$\\$', 1)) AS n, list_concat(regexp_extract_all(t, '\\$\\$(.+?)\\$\\$', 1), regexp_extract_all(regexp_replace(t, '\\$\\$.+?\\$\\$', '', 'g'), '\\$([^$\\n]+?)\\$', 1)) AS s
  FROM {_STATE} WHERE NOT fence AND block % 2 = 0))"""


@query("g05_math_spans", f"SELECT doc, line, CAST(nth AS BIGINT) AS nth, kind, body FROM {_SPANS}")
def g05(spark, sf_dir):
    return generators.math_spans(BOOKS.frame(spark))


@query("w01_fence_parity", f"SELECT doc, line, fence, CAST(block % 2 AS BIGINT) AS inside FROM {_STATE}")
def w01(spark, sf_dir):
    return generators.fenced_lines(BOOKS.frame(spark)).select("doc", "line", "fence", (F.col("block") % 2).alias("inside"))


_IMAGES = f"(SELECT doc, 0 AS syntax, unnest(range(len(l))) AS nth, unnest(l) AS path FROM (SELECT doc, regexp_extract_all(text, '!\\[[^\\]]*\\]\\(([^)\\s]+)', 1) AS l FROM {_BOOKS}) UNION ALL SELECT doc, 1, unnest(range(len(l))), unnest(l) FROM (SELECT doc, regexp_extract_all(text, '(?i)<img\\b[^>]*\\bsrc=\"([^\"]+)\"', 1) AS l FROM {_BOOKS}))"


@query("g13_image_references", f"SELECT * FROM {_IMAGES}")
def g13(spark, sf_dir):
    return generators.image_references(BOOKS.frame(spark))


@query("p06_image_tokens", f"SELECT doc, path, printf('IMG_%04d', row_number() OVER (PARTITION BY doc ORDER BY syntax, nth)) AS token FROM (SELECT doc, path, min(syntax) AS syntax, arg_min(nth, syntax * 1000000 + nth) AS nth FROM {_IMAGES} GROUP BY doc, path)")
def p06(spark, sf_dir):
    return windows.image_tokens(generators.image_references(BOOKS.frame(spark)))


SPECS = Fixture("key string, spec string, page_count long", [("a", "1-4,3, 9-7", 20), ("b", "-3", 10), ("c", "8-40", 10), ("d", "12-15", 10), ("e", "", 5)])


@query("g15_page_ranges", f"WITH p AS (SELECT key, page_count, trim(unnest(string_split(spec, ','))) AS s FROM {SPECS.sql()}), e AS (SELECT key, page_count, CASE WHEN s LIKE '-%' THEN page_count - CAST(s[2:] AS BIGINT) + 1 ELSE CAST(string_split(s, '-')[1] AS BIGINT) END AS a, CASE WHEN s LIKE '-%' THEN page_count ELSE CAST(string_split(s, '-')[-1] AS BIGINT) END AS b FROM p WHERE s <> '') SELECT DISTINCT key, unnest(range(greatest(least(a, b), 1), least(greatest(a, b), page_count) + 1)) AS page FROM e")
def g15(spark, sf_dir):
    return generators.page_ranges(SPECS.frame(spark))


LOGS = Fixture("doc string, text string", [("x", "This is TeX\n! Undefined control sequence.\nsome\nl.12 \\foo\n! Missing $ inserted.\nl.40 a_b\n! Undefined control sequence.\nl.12 \\foo"), ("y", "! Emergency stop."), ("z", "fine")])
_LOGS = f"(SELECT doc, unnest(range(1, len(l) + 1)) AS line, unnest(l) AS t FROM (SELECT doc, string_split(text, chr(10)) AS l FROM {LOGS.sql()}))"


@query("g16_log_errors", f"WITH l AS {_LOGS}, e AS (SELECT doc, line, t[3:] AS message FROM l WHERE t LIKE '! %'), p AS (SELECT doc, line, CAST(regexp_extract(t, '^l\\.(\\d+)', 1) AS BIGINT) AS n FROM l WHERE regexp_matches(t, '^l\\.\\d+')) SELECT doc, message, tex_line, min(line) AS line FROM (SELECT e.doc, e.line, message, arg_min(n, p.line) AS tex_line FROM e LEFT JOIN p ON p.doc = e.doc AND p.line BETWEEN e.line AND e.line + 12 GROUP BY ALL) GROUP BY doc, message, tex_line")
def g16(spark, sf_dir):
    return generators.log_errors(LOGS.frame(spark)).select("doc", "message", "tex_line", "line")


_RUNS = "(SELECT doc_id, length(unnest(regexp_extract_all(text, '\\$+'))) AS n FROM documents)"


@query("c01_dollar_runs", f"SELECT doc_id AS doc, n AS run, count(*) AS times, n > 2 AS welded FROM {_RUNS} GROUP BY doc_id, n")
def c01(spark, sf_dir):
    return checks.dollar_runs(documents(spark, sf_dir))


@query("a01_histogram", f"SELECT n AS run, count(*) AS times FROM {_RUNS} GROUP BY n")
def a01(spark, sf_dir):
    return checks.dollar_runs(documents(spark, sf_dir)).groupBy("run").agg(F.sum("times").alias("times"))


@query("c02_display_parity", "SELECT doc_id AS doc, CAST(len(regexp_extract_all(text, '\\$\\$')) AS BIGINT) AS n FROM documents WHERE len(regexp_extract_all(text, '\\$\\$')) % 2 = 1")
def c02(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc", T.display_marks(F.col("text")).alias("n"))
    return docs.filter("n % 2 = 1")


@query("c03_inline_parity", "SELECT doc, line, n FROM (SELECT doc, p, d, length(replace(p, '$$', '')) - length(replace(replace(p, '$$', ''), '$', '')) AS n, CAST(coalesce(sum(length(p) - length(replace(p, chr(10), '')) + 2) OVER (PARTITION BY doc ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS BIGINT) AS line FROM (SELECT doc_id AS doc, unnest(range(1, len(l) + 1)) AS k, unnest(l) AS p, len(regexp_extract_all(unnest(l), '\\$\\$')) AS d FROM (SELECT doc_id, regexp_split_to_array(text, '\\n\\s*\\n') AS l FROM documents))) WHERE d % 2 = 0 AND n % 2 = 1")
def c03(spark, sf_dir):
    return checks.inline_parity(documents(spark, sf_dir))


@query("c05_escaped_dollars", "SELECT doc_id AS doc, line FROM (SELECT doc_id, unnest(range(1, len(l) + 1)) AS line, unnest(l) AS t FROM (SELECT doc_id, string_split(replace(text, '&', '\\$'), chr(10)) AS l FROM documents)) WHERE contains(t, '\\$')")
def c05(spark, sf_dir):
    marked = documents(spark, sf_dir).withColumn("text", F.replace("text", F.lit("&"), F.lit("\\$")))
    return generators.lines(marked).filter(F.contains("text", F.lit("\\$"))).select("doc", "line")


@query("c17_unusual_characters", "WITH c AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS line, unnest(l) AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)), s AS (SELECT doc_id, line, unnest(regexp_extract_all(t, '[^\\x{00}-\\x{7F}]')) AS sign FROM c) SELECT sign, count(*) AS times, min(doc_id) AS first_doc, CAST(unicode(sign) AS BIGINT) AS code FROM s GROUP BY sign")
def c17(spark, sf_dir):
    return checks.unusual_characters(documents(spark, sf_dir), ceiling="\\x{7F}")


@query("c29_script_residue", "SELECT doc_id AS doc, CAST(length(regexp_replace(s, '[^\\x{C0}-\\x{24F}]+', '', 'g')) AS BIGINT) AS foreign_chars, CAST(length(s) AS BIGINT) AS solid FROM (SELECT doc_id, regexp_replace(regexp_replace(text, '\\$\\$(.|\\n)*?\\$\\$|\\$[^$\\n]+\\$', '', 'g'), '\\s+', '', 'g') AS s FROM documents)")
def c29(spark, sf_dir):
    found, solid = T.residue_counts(F.col("text"), "\\x{C0}-\\x{24F}")
    return documents(spark, sf_dir).select("doc", found.alias("foreign_chars"), solid.alias("solid"))


@query("p20_compaction", "SELECT doc_id AS doc, CAST(length(regexp_replace(text, '[\\s$]+', '', 'g')) AS BIGINT) AS compact_chars, left(trim(regexp_replace(text, '\\s+', ' ', 'g')), 40) AS head FROM documents")
def p20(spark, sf_dir):
    return documents(spark, sf_dir).select("doc", F.length(T.compact(F.col("text"))).cast("long").alias("compact_chars"), F.substring(T.collapse(F.col("text")), 1, 40).alias("head"))


@query("p27_token_estimate", "SELECT doc_id AS doc, CAST(ceil(length(text) / 1.5) AS BIGINT) AS tokens FROM documents")
def p27(spark, sf_dir):
    return documents(spark, sf_dir).select("doc", T.token_estimate(F.col("text")).alias("tokens"))


@query("p11_prose_only", "SELECT doc_id AS doc, CAST(length(regexp_replace(text, '\\$\\$(.|\\n)*?\\$\\$|\\$[^$\\n]+\\$', '', 'g')) AS BIGINT) AS prose FROM documents")
def p11(spark, sf_dir):
    return documents(spark, sf_dir).select("doc", F.length(T.without_math(F.col("text"))).cast("long").alias("prose"))


def _escaped_sql() -> str:
    """The special signs replaced one after the other; three of them by way of control characters, so that no escape is escaped."""
    text = "text"
    for k, sign in enumerate("\\~^", 1):
        text = f"replace({text}, '{sign}', chr({k}))"
    for sign in "#$%&_{}":
        text = f"replace({text}, '{sign}', '\\{sign}')"
    for k, name in enumerate(("backslash", "asciitilde", "asciicircum"), 1):
        text = f"replace({text}, chr({k}), '\\text{name}{{}}')"
    return f"SELECT doc_id AS doc, {text} AS tex, coalesce(regexp_matches(text, '^[\\x{{00}}-\\x{{FF}}]*$'), false) AS latin1 FROM documents"


_ESCAPED = _escaped_sql()


@query("p12_escape_latex", _ESCAPED)
def p12(spark, sf_dir):
    return documents(spark, sf_dir).select("doc", T.escape_latex(F.col("text")).alias("tex"), T.latin1_only(F.col("text")).alias("latin1"))


@query("p23_filename", "SELECT doc_id AS doc, left(regexp_replace(regexp_replace(regexp_replace(t, '[\\\\/:*?\"<>|]', '', 'g'), '\\s+', '_', 'g'), '^[_.]+|[_.]+$', '', 'g'), 80) AS name FROM (SELECT doc_id, string_split(text, chr(10))[1] AS t FROM documents)")
def p23(spark, sf_dir):
    return documents(spark, sf_dir).select("doc", T.filename(F.split("text", "\n")[0]).alias("name"))


@query("p33_chunk_id", "SELECT doc_id AS doc, lpad(CAST(doc_id % 1000 AS VARCHAR), 3, '0') AS id FROM documents")
def p33(spark, sf_dir):
    return documents(spark, sf_dir).select("doc", T.chunk_id(F.concat((F.col("doc") % 1000).cast("string"), F.lit(".md"))).alias("id"))


@query("w08_line_packing", "WITH RECURSIVE l AS (SELECT doc_id AS doc, unnest(range(1, len(x) + 1)) AS k, length(unnest(x)) AS n FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents)), r AS (SELECT doc, k, n, CAST(1 AS BIGINT) AS chunk, n + 2 AS size FROM l WHERE k = 1 UNION ALL SELECT l.doc, l.k, l.n, CASE WHEN r.size > 0 AND r.size + l.n > 600 THEN r.chunk + 1 ELSE r.chunk END, CASE WHEN r.size > 0 AND r.size + l.n > 600 THEN l.n + 2 ELSE r.size + l.n + 2 END FROM r JOIN l ON l.doc = r.doc AND l.k = r.k + 1) SELECT doc, chunk, count(*) AS lines, CAST(sum(n) AS BIGINT) AS chars FROM r GROUP BY doc, chunk")
def w08(spark, sf_dir):
    return windows.packed_chunks(documents(spark, sf_dir), 600)


@query("w09_page_tiling", "WITH RECURSIVE t AS (SELECT doc_id AS doc, n_chars AS total, CAST(1 AS BIGINT) AS first, least(190, n_chars) AS last FROM documents WHERE n_chars > 0 UNION ALL SELECT doc, total, last - 1, least(last - 1 + 189, total) FROM t WHERE last < total) SELECT doc, first, last FROM t")
def w09(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), F.col("n_chars").alias("total"))
    return windows.tiles(docs, most=190, overlap=2)


@query("w10_halving", "WITH RECURSIVE h AS (SELECT doc_id AS doc, CAST(1 AS BIGINT) AS a, n_chars AS b FROM documents WHERE n_chars > 0 UNION ALL SELECT doc, CASE p WHEN 0 THEN a ELSE (a + b) // 2 + 1 END, CASE p WHEN 0 THEN (a + b) // 2 ELSE b END FROM h, (VALUES (0), (1)) v(p) WHERE b - a + 1 > 1000) SELECT doc, a AS first, b AS last FROM h WHERE b - a + 1 <= 1000")
def w10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), F.col("n_chars").alias("total"))
    return windows.halved(docs, most=1000)


@query("w12_line_offsets", "SELECT doc_id AS doc, line, CAST(coalesce(sum(length(t) + 1) OVER (PARTITION BY doc_id ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS \"offset\" FROM (SELECT doc_id, unnest(range(1, len(l) + 1)) AS line, unnest(l) AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))")
def w12(spark, sf_dir):
    before = Window.partitionBy("doc").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    return generators.lines(documents(spark, sf_dir)).select("doc", "line", F.coalesce(F.sum(F.length("text") + 1).over(before), F.lit(0)).cast("long").alias("offset"))


@query("w13_capped_top", "SELECT lang, word, n FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS r FROM (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(regexp_extract_all(text, '[A-Za-z]{2,}')) AS word FROM documents) GROUP BY lang, word)) WHERE r <= 12")
def w13(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select("lang", F.explode(F.regexp_extract_all("text", F.lit("([A-Za-z]{2,})"), 1)).alias("word"))
    return windows.top(words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), ["lang"], [F.desc("n"), F.asc("word")], 12).select("lang", "word", "n")


@query("a02_count_first_seen", "SELECT lang, count(*) AS n, min(doc_id) AS first_doc, arg_min(n_chars, doc_id) AS first_chars FROM documents GROUP BY lang")
def a02(spark, sf_dir):
    return aggregates.counted(table(spark, sf_dir, "documents"), ["lang"], "doc_id", "n_chars").withColumnsRenamed({"first_doc_id": "first_doc", "first_n_chars": "first_chars"})


@query("a04_exact_median", "SELECT lang, CAST(floor(median(n_chars) * 2) AS BIGINT) AS twice FROM documents GROUP BY lang")
def a04(spark, sf_dir):
    return aggregates.exact_median(table(spark, sf_dir, "documents"), ["lang"], "n_chars").select("lang", F.floor(F.col("median") * 2).cast("long").alias("twice"))


@query("a05_nearest_rank", "SELECT lang, l[len(l) // 10 + 1] AS low, l[least(len(l) - 1, len(l) * 9 // 10) + 1] AS high FROM (SELECT lang, list_sort(list(n_chars)) AS l FROM documents GROUP BY lang)")
def a05(spark, sf_dir):
    return windows.nearest_ranks(table(spark, sf_dir, "documents").select("lang", F.col("n_chars").alias("v")), ["lang"])


@query("a06_dominant_value", "SELECT source, lang, n, total FROM (SELECT source, lang, n, CAST(sum(n) OVER (PARTITION BY source) AS BIGINT) AS total, row_number() OVER (PARTITION BY source ORDER BY n DESC, first_seen) AS r FROM (SELECT source, lang, count(*) AS n, min(doc_id) AS first_seen FROM documents GROUP BY source, lang)) WHERE r = 1 AND n * 10 >= total * 3")
def a06(spark, sf_dir):
    return windows.dominant(table(spark, sf_dir, "documents").select("source", "lang", "doc_id"), "source", "lang", "doc_id", share=0.3)


@query("a08_largest_share", "SELECT source, max(n) AS largest, CAST(sum(n) AS BIGINT) AS total FROM (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL) GROUP BY source")
def a08(spark, sf_dir):
    return aggregates.largest_share(table(spark, sf_dir, "documents"), ["source"], "lang")


@query("a09_any_all", "SELECT source, bool_or(n_chars > 10000) AS any_long, bool_and(n_chars > 10) AS all_some FROM documents GROUP BY source")
def a09(spark, sf_dir):
    return aggregates.tested(table(spark, sf_dir, "documents"), ["source"], {"any_long": F.col("n_chars") > 10000}, {"all_some": F.col("n_chars") > 10})


@query("a10_ordered_concat", "SELECT conv_id, sha256(string_agg(role || ': ' || text, chr(10) ORDER BY turn)) AS digest, count(*) AS turns FROM conversations GROUP BY conv_id")
def a10(spark, sf_dir):
    turns = aggregates.concatenated(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", F.concat("role", F.lit(": "), "text"))
    return turns.select("conv_id", F.sha2("text", 256).alias("digest"), F.col("n").alias("turns"))


@query("a11_best_per_group", "SELECT source, max_by(doc_id, n_chars * 1000000 - doc_id) AS longest FROM documents GROUP BY source")
def a11(spark, sf_dir):
    return aggregates.best(table(spark, sf_dir, "documents"), ["source"], "doc_id", F.col("n_chars"), -F.col("doc_id")).withColumnRenamed("doc_id", "longest")


@query("a12_conditional_counts", "SELECT user_id, count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_type NOT IN ('view', 'error')) AS rest FROM events GROUP BY user_id")
def a12(spark, sf_dir):
    kind = F.col("event_type")
    return aggregates.counted_if(table(spark, sf_dir, "events"), ["user_id"], {"views": kind == "view", "errors": kind == "error", "rest": ~kind.isin("view", "error")})


@query("p18_document_sample", "SELECT doc_id AS doc, CAST(CASE WHEN length(text) <= 21000 THEN length(text) ELSE 6000 END AS BIGINT) AS head, sha256(CASE WHEN length(text) <= 21000 THEN text ELSE left(text, 6000) END) AS digest FROM documents")
def p18(spark, sf_dir):
    return windows.sample_heads(documents(spark, sf_dir))


@query("t03_request_ids", "SELECT conv_id, turn, left(sha256(concat_ws(chr(31), role, text)), 16) AS id FROM conversations")
def t03_ids(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.request_id(F.col("role"), F.col("text")).alias("id"))


@query("p19_json_object", "SELECT event_id, CASE WHEN contains(s, '{') AND contains(s, '}') THEN substr(s, strpos(s, '{'), length(s) - strpos(reverse(s), '}') + 2 - strpos(s, '{')) END AS doc FROM (SELECT event_id, 'Here: ' || coalesce(props, '') || ' done' AS s FROM events)")
def p19(spark, sf_dir):
    wrapped = F.concat(F.lit("Here: "), F.coalesce("props", F.lit("")), F.lit(" done"))
    return table(spark, sf_dir, "events").select("event_id", T.json_object(wrapped).alias("doc"))
