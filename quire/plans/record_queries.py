"""Queries of decisions, validation, location and rewrites."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import aggregates, records, rewrites
from quire.plans.catalog import Fixture, query, table
from quire.streaming import events, state


SITES = Fixture("doc string, pos long, number string", [("a", 1, "18.3"), ("a", 2, None), ("a", 3, "18.5"), ("a", 4, None), ("a", 5, "19.1"), ("a", 6, None), ("b", 1, None), ("b", 2, "2-2"), ("b", 3, "2-2"), ("b", 4, "2-5")])


@query("t04_barrier", "SELECT count(*) AS waiting, count(*) = 0 AS open FROM documents ANTI JOIN labels USING (doc_id)")
def t04(spark, sf_dir):
    return state.barrier(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")), table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id")))


@query("t07_reused_answers", "SELECT d.doc_id AS id, l.quality AS answer FROM documents d JOIN labels l USING (doc_id)")
def t07(spark, sf_dir):
    answers = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("answer"), F.lit(0).alias("seq"))
    return state.answered(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")), answers)


@query("x02_sessions", "WITH e AS (SELECT user_id, ts, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS gap FROM events), s AS (SELECT user_id, ts, sum(CASE WHEN gap < INTERVAL 30 MINUTE THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e) SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k")
def x02(spark, sf_dir):
    return events.sessions(table(spark, sf_dir, "events"), "30 minutes").select("user_id", "start", "n")


@query("x03_sliding_windows", "SELECT s AS start, event_type, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL 1 HOUR, ts), time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 HOUR]) AS s FROM events) GROUP BY ALL")
def x03(spark, sf_dir):
    return events.window_counts(table(spark, sf_dir, "events"), "2 hours", slide="1 hour")


@query("p22_filled_template", "SELECT c_custkey, 'Title: ' || c_name || '; no ' || c_custkey AS cover FROM customer")
def p22(spark, sf_dir):
    template = F.lit("Title: %%NAME%%; no %%NO%%")
    return table(spark, sf_dir, "customer").select("c_custkey", rewrites.filled(template, {"NAME": F.col("c_name"), "NO": F.col("c_custkey")}).alias("cover"))


@query("p30_blanked_comments", "SELECT doc_id AS doc, CAST(length(text) AS BIGINT) AS n, sha256(array_to_string(list_transform(string_split(text, chr(10)), lambda x: rpad(regexp_extract(x, '^(?:[^%\\\\]|\\\\.|\\\\$)*'), CAST(length(x) AS INTEGER), ' ')), chr(10))) AS digest FROM documents")
def p30(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    blank = rewrites.blanked_comments(F.col("text"))
    return docs.select(F.col("doc_id").alias("doc"), F.length(blank).cast("long").alias("n"), F.sha2(blank, 256).alias("digest"))


@query("p32_prompts", "SELECT conv_id, sha256(string_agg(turn || '. ' || role, chr(10) ORDER BY turn)) AS digest FROM conversations GROUP BY conv_id")
def p32(spark, sf_dir):
    line = F.concat(F.col("turn").cast("string"), F.lit(". "), F.col("role"))
    return rewrites.prompt(table(spark, sf_dir, "conversations"), "conv_id", "turn", line).select("conv_id", F.sha2("prompt", 256).alias("digest"))


@query("a05_page_spans", "SELECT source AS doc, l[len(l) // 10 + 1] AS low, l[least(len(l) - 1, len(l) * 9 // 10) + 1] AS high FROM (SELECT source, list_sort(list(doc_id)) AS l FROM documents GROUP BY source)")
def a05_spans(spark, sf_dir):
    return records.span_of_pages(table(spark, sf_dir, "documents").select(F.col("source").alias("doc"), F.col("doc_id").alias("page")))


@query("a13_flagged_view", "SELECT doc_id, n_chars FROM documents WHERE n_chars < 200 AND doc_id % 3 <> 0")
def a13(spark, sf_dir):
    by = F.when(F.col("doc_id") % 3 == 0, "manual").otherwise("auto")
    return aggregates.flagged(table(spark, sf_dir, "documents"), F.col("n_chars") < 200, by, "doc_id").select("doc_id", "n_chars")


@query("p19_lenient_json", "SELECT event_id, props IS NOT NULL AND json_valid(props) AS good FROM events")
def p19_lenient(spark, sf_dir):
    from quire.sources import readers

    parsed = readers.lenient_json(table(spark, sf_dir, "events"), "props", "map<string,string>")
    return parsed.select("event_id", F.col("parsed").isNotNull().alias("good"))
