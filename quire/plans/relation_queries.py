"""Queries of pairs, sequences, joins, findings and state over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.operators import aggregates, checks, joins, windows
from quire.plans.catalog import Fixture, query, table
from quire.plans.text_queries import documents
from quire.streaming import events


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the next assistant turn of their conversation."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    turns = table(spark, sf_dir, "conversations").withColumn("next_role", F.lead("role").over(w)).withColumn("target", F.lead("text").over(w))
    pairs = turns.filter("role = 'user' and next_role = 'assistant'")
    return pairs.select(F.concat_ws(":", "conv_id", "turn").alias("doc"), F.col("text").alias("source"), "target", (F.col("conv_id") % 7).alias("book"))


_PAIRS = "(SELECT concat_ws(':', conv_id, turn) AS doc, text AS source, target, conv_id % 7 AS book FROM (SELECT *, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS target FROM conversations) WHERE role = 'user' AND next_role = 'assistant')"


@query("j01_chunk_pairs", "SELECT d.doc_id AS doc, l.doc_id IS NULL AS missing FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def j01(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("doc"), F.col("quality").cast("string").alias("text"))
    return joins.chunk_pairs(documents(spark, sf_dir), labels).select("doc", "missing")


@query("j02_lookup", "SELECT c_custkey, coalesce(n_name, '?') AS n_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 5 <> 0) ON n_nationkey = c_nationkey")
def j02(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").filter("n_nationkey % 5 <> 0").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return joins.looked_up(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), nations, "c_nationkey", "n_name", F.lit("?")).select("c_custkey", "n_name")


@query("j03_untranslated", "SELECT doc_id AS doc FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def j03(spark, sf_dir):
    return aggregates.missing(documents(spark, sf_dir).select("doc"), table(spark, sf_dir, "labels").select(F.col("doc_id").alias("doc")), "doc")


@query("j05_multiset_difference", f"WITH p AS {_PAIRS}, a AS (SELECT doc, word, count(*) AS a FROM (SELECT doc, unnest(regexp_extract_all(source, '[a-z]+')) AS word FROM p) GROUP BY ALL), b AS (SELECT doc, word, count(*) AS b FROM (SELECT doc, unnest(regexp_extract_all(target, '[a-z]+')) AS word FROM p) GROUP BY ALL) SELECT doc, word, greatest(coalesce(a, 0) - coalesce(b, 0), 0) AS lost, greatest(coalesce(b, 0) - coalesce(a, 0), 0) AS gained FROM a FULL JOIN b USING (doc, word) WHERE coalesce(a, 0) <> coalesce(b, 0)")
def j05(spark, sf_dir):
    pairs = turn_pairs(spark, sf_dir)
    left, right = (pairs.select("doc", F.explode(F.regexp_extract_all(side, F.lit("([a-z]+)"), 1)).alias("word")) for side in ("source", "target"))
    return joins.multiset_difference(left, right, ["doc"], "word")


@query("j08_locate_passage", "WITH d AS (SELECT doc_id AS doc, regexp_replace(text, '[\\s$]+', '', 'g') AS h FROM documents), b AS (SELECT item_id AS item, regexp_replace(text, '[\\s$]+', '', 'g') AS n FROM benchmark) SELECT doc, item, strpos(h, n) AS at FROM d JOIN b ON n <> '' AND contains(h, n)")
def j08(spark, sf_dir):
    return joins.passages(documents(spark, sf_dir), table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("item"), "text"))


@query("j09_as_of", "SELECT e.event_id, max(s.event_id) AS last_signup FROM events e LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') s ON s.user_id = e.user_id AND s.event_id <= e.event_id WHERE e.event_type = 'purchase' GROUP BY e.event_id")
def j09(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    marks = events.filter("event_type = 'signup'").select("user_id", "event_id", F.col("event_id").alias("last_signup"))
    return joins.as_of(events.filter("event_type = 'purchase'").drop("event_type"), marks, ["user_id"], "event_id", "last_signup").select("event_id", "last_signup")


@query("j10_first_in_range", "SELECT t.source, t.at, min(p.doc_id) AS found FROM (SELECT DISTINCT source, doc_id // 97 * 97 AS at FROM documents) t LEFT JOIN documents p ON p.source = t.source AND p.n_chars > 3000 AND p.doc_id >= t.at AND p.doc_id < t.at + 50 GROUP BY t.source, t.at")
def j10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    targets = docs.select("source", (F.floor(F.col("doc_id") / 97) * 97).alias("at")).distinct()
    points = docs.filter("n_chars > 3000").select("source", F.col("doc_id").alias("point"))
    return joins.first_in_range(targets, points, "source", 50)


@query("j13_nearest_hash", "WITH v AS (SELECT vec_id, embedding FROM embeddings), p AS (SELECT a.vec_id AS old_id, b.vec_id AS new_id, CAST(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: CAST((z[1] > 0) <> (z[2] > 0) AS INTEGER))) AS BIGINT) AS distance FROM v a JOIN v b ON b.vec_id BETWEEN a.vec_id - 20 AND a.vec_id + 20 AND b.vec_id <> a.vec_id WHERE a.vec_id % 2 = 0 AND b.vec_id % 2 = 1), r AS (SELECT *, row_number() OVER (PARTITION BY old_id ORDER BY distance, new_id) AS k FROM p WHERE distance <= 24) SELECT old_id, new_id, distance FROM r WHERE k = 1")
def j13(spark, sf_dir):
    hashed = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("vec_id").alias("pos"), joins.sign_bits(F.col("embedding")).alias("hash"))
    return joins.nearest_in_band(hashed.filter("id % 2 = 0"), hashed.filter("id % 2 = 1"), window=20, most=24)


@query("j14_protected_merge", "WITH o AS (SELECT doc_id AS doc, lang AS v, CASE doc_id % 3 WHEN 0 THEN 'manual' WHEN 1 THEN 'agent' ELSE 'auto' END AS by FROM documents), n AS (SELECT doc_id AS doc, 'q' || quality AS v, 'auto' AS by FROM labels) SELECT doc, CASE WHEN o.by IN ('manual', 'agent') OR n.by IS NULL THEN o.v ELSE n.v END AS v, CASE WHEN o.by IN ('manual', 'agent') OR n.by IS NULL THEN o.by ELSE n.by END AS by FROM o FULL JOIN n USING (doc)")
def j14(spark, sf_dir):
    by = F.when(F.col("doc_id") % 3 == 0, "manual").when(F.col("doc_id") % 3 == 1, "agent").otherwise("auto")
    old = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), F.col("lang").alias("v"), by.alias("by"))
    new = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("doc"), F.concat(F.lit("q"), "quality").alias("v"), F.lit("auto").alias("by"))
    return joins.protected_merge(old, new, "doc", "v")


_NUMBERED = "(SELECT l_orderkey, l_linenumber AS \"at\", CASE WHEN l_partkey % 3 > 0 THEN CAST(l_linenumber AS BIGINT) END AS number FROM (SELECT DISTINCT ON (l_orderkey, l_linenumber) * FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey))"


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order and line number; every third part leaves its number out."""
    first = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min(F.struct("l_partkey", "l_suppkey")).alias("m"))
    return first.select("l_orderkey", F.col("l_linenumber").alias("at"), F.when(F.col("m.l_partkey") % 3 > 0, F.col("l_linenumber").cast("long")).alias("number"))


@query("j15_number_gaps", f"SELECT l_orderkey, \"at\" FROM (SELECT *, last_value(number IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY \"at\" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b, first_value(number IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY \"at\" ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS a FROM {_NUMBERED}) WHERE number IS NULL AND a > coalesce(b, 0) + 1")
def j15(spark, sf_dir):
    return joins.number_gaps(numbered(spark, sf_dir), ["l_orderkey"], "at", "number").select("l_orderkey", "at")


@query("w02_forward_fill", f"SELECT l_orderkey, \"at\", last_value(number IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY \"at\") AS filled FROM {_NUMBERED}")
def w02(spark, sf_dir):
    return windows.forward_filled(numbered(spark, sf_dir), ["l_orderkey"], ["at"], "number", "filled").select("l_orderkey", "at", "filled")


@query("w03_sequence_breaks", f"WITH n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY \"at\") AS place FROM {_NUMBERED}), p AS (SELECT *, last_value(number IGNORE NULLS) OVER w AS ln, last_value(CASE WHEN number IS NOT NULL THEN place END IGNORE NULLS) OVER w AS lp FROM n WINDOW w AS (PARTITION BY l_orderkey ORDER BY \"at\" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) SELECT l_orderkey, number, CAST(ln + place - lp AS BIGINT) AS expected FROM p WHERE number IS NOT NULL AND ln IS NOT NULL AND number <> ln + place - lp")
def w03(spark, sf_dir):
    return windows.sequence_breaks(numbered(spark, sf_dir), ["l_orderkey"], ["at"], "number").select("l_orderkey", "number", F.col("expected").cast("long").alias("expected"))


@query("w04_number_gaps", "WITH m AS (SELECT l_orderkey, max(l_linenumber) AS n FROM lineitem GROUP BY l_orderkey), s AS (SELECT l_orderkey, unnest(range(1, CAST(n AS BIGINT) + 1)) AS missing FROM m) SELECT s.* FROM s ANTI JOIN lineitem l ON l.l_orderkey = s.l_orderkey AND l.l_linenumber = s.missing")
def w04(spark, sf_dir):
    return windows.sequence_gaps(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber")


@query("w04_duplicates", "SELECT l_orderkey, l_linenumber, count(*) AS times FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def w04_dups(spark, sf_dir):
    return windows.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("w05_lookahead", "WITH e AS (SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events), n AS (SELECT a.event_id, b.k, b.event_type FROM e a JOIN e b ON b.user_id = a.user_id AND b.k BETWEEN a.k + 1 AND a.k + 7 WHERE b.event_type IN ('purchase', 'error')), f AS (SELECT event_id, arg_min(event_type, k) AS t FROM n GROUP BY event_id) SELECT e.event_id, CASE WHEN t = 'purchase' THEN t END AS found FROM e LEFT JOIN f USING (event_id)")
def w05(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    bought = F.when(F.col("event_type") == "purchase", F.col("event_type"))
    return windows.lookahead(events, ["user_id"], ["event_id"], bought, F.col("event_type") == "error", 7).select("event_id", "found")


@query("w07_islands", "SELECT user_id, island, count(*) AS n FROM (SELECT user_id, CAST(sum(CAST(event_type = 'signup' AS BIGINT)) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS island FROM events) GROUP BY user_id, island")
def w07(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return windows.islands(events, ["user_id"], ["event_id"], F.col("event_type") == "signup").groupBy("user_id", "island").agg(F.count(F.lit(1)).alias("n"))


@query("w11_drift", f"WITH n AS (SELECT l_orderkey, \"at\", row_number() OVER (PARTITION BY l_orderkey ORDER BY \"at\") - number AS drift FROM {_NUMBERED}), d AS (SELECT *, coalesce(lag(drift) OVER (PARTITION BY l_orderkey ORDER BY \"at\"), 0) AS b FROM n WHERE drift IS NOT NULL) SELECT l_orderkey, \"at\", CAST(drift AS BIGINT) AS drift FROM d WHERE drift <> 0 AND drift <> b")
def w11(spark, sf_dir):
    counted = numbered(spark, sf_dir).withColumn("counter", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("at")))
    return windows.drift(counted, ["l_orderkey"], ["at"], "counter", "number").select("l_orderkey", "at", F.col("drift").cast("long").alias("drift"))


@query("c28_pair_checks", f"WITH p AS (SELECT doc, source, target, length(regexp_replace(target, '[^\\x{{C0}}-\\x{{24F}}]+', '', 'g')) AS f, length(regexp_replace(target, '\\s+', '', 'g')) AS s FROM (SELECT doc, source, regexp_replace(target, '\\$\\$(.|\\n)*?\\$\\$|\\$[^$\\n]+\\$', '', 'g') AS target, target AS whole FROM {_PAIRS})) SELECT doc, 'untranslated' AS check FROM p WHERE s > 0 AND f > s * 0.04 UNION ALL SELECT doc, 'truncated' FROM {_PAIRS} WHERE length(source) > 0 AND length(target) < length(source) * 0.4")
def c28(spark, sf_dir):
    return checks.pair_checks(turn_pairs(spark, sf_dir), alphabet="\\x{C0}-\\x{24F}")


@query("c30_diagnosis", f"SELECT doc, CASE WHEN trim(target) = '' THEN 'empty' WHEN length(source) > 200 AND length(target) < length(source) * 0.3 THEN 'short' END AS reason FROM {_PAIRS}")
def c30(spark, sf_dir):
    return turn_pairs(spark, sf_dir).select("doc", checks.diagnosis(F.col("source"), F.col("target")).alias("reason"))


@query("a04_length_outliers", f"WITH p AS (SELECT doc, book, length(target) / length(source) AS ratio FROM {_PAIRS} WHERE length(source) > 0), m AS (SELECT book, median(ratio) AS med FROM p GROUP BY book HAVING count(*) >= 4) SELECT doc FROM p JOIN m USING (book) WHERE ratio < med * 0.5")
def a04_outliers(spark, sf_dir):
    return checks.length_outliers(turn_pairs(spark, sf_dir), "book").select("doc")


@query("c10_unknown_words", "WITH w AS (SELECT lang, doc_id, unnest(regexp_extract_all(text, '[a-z]{3,}')) AS word FROM documents), v AS (SELECT word FROM w GROUP BY word HAVING count(*) >= 20), u AS (SELECT lang, word, count(*) AS n, min(doc_id) AS first FROM w WHERE word NOT IN (SELECT word FROM v) GROUP BY lang, word) SELECT lang, word, n, first FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n, first, word) AS r FROM u) WHERE r <= 12")
def c10(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select("lang", F.col("doc_id").alias("seq"), F.explode(F.regexp_extract_all("text", F.lit("([a-z]{3,})"), 1)).alias("word"))
    vocabulary = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter("n >= 20").select("word")
    return checks.unknown_words(words, vocabulary, by=["lang"]).select("lang", "word", "n", "first")


@query("c37_split_confidence", "SELECT source, count(*) >= 2 AND max(n_chars) * 10 <= sum(n_chars) * 6 AS confident FROM documents GROUP BY source")
def c37(spark, sf_dir):
    return aggregates.confident(table(spark, sf_dir, "documents"), "source", "n_chars")


WAIVERS = Fixture("pos int, check string, excerpt string, reason string", [(1, "short", "The", "known"), (2, "*", "***", "junk is expected"), (3, "short", "Nowhere at all", "stale"), (4, "long", "", ""), (5, "long", "Th", "accepted")])


def length_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    n, head = F.length("text"), F.substring("text", 1, 60)
    found = [
        checks.findings(docs.filter(n < 300), "short", "review", n, context=head),
        checks.findings(docs.filter(n > 5000), "long", "review", n, context=head),
        checks.findings(docs.filter(F.contains("text", F.lit("***"))), "junk", "info", n, context=head),
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


_FOUND = "(SELECT CAST(doc_id AS VARCHAR) AS doc, c AS \"check\", s AS severity, CAST(length(text) AS VARCHAR) AS message, 0 AS line, left(text, 60) AS context FROM documents JOIN (VALUES ('short', 'review'), ('long', 'review'), ('junk', 'info')) v(c, s) ON CASE c WHEN 'short' THEN length(text) < 300 WHEN 'long' THEN length(text) > 5000 ELSE contains(text, '***') END)"
_LEFT = f"(SELECT * FROM {_FOUND} f WHERE NOT EXISTS (SELECT 1 FROM {WAIVERS.sql()} w WHERE trim(coalesce(w.reason, '')) <> '' AND f.severity <> 'info' AND w.\"check\" IN (f.\"check\", '*') AND contains(f.context, w.excerpt)))"


@query("j04_waivers", f"SELECT doc, \"check\", severity, message, CAST(line AS BIGINT) AS line, context FROM {_LEFT}")
def j04(spark, sf_dir):
    return checks.waived(length_findings(spark, sf_dir), WAIVERS.frame(spark))[0]


@query("j04_unused_waivers", f"SELECT w.pos FROM {WAIVERS.sql()} w WHERE pos NOT IN (SELECT min(w.pos) FROM {_FOUND} f JOIN {WAIVERS.sql()} w ON trim(coalesce(w.reason, '')) <> '' AND f.severity <> 'info' AND w.\"check\" IN (f.\"check\", '*') AND contains(f.context, w.excerpt) GROUP BY f.doc, f.\"check\")")
def j04_unused(spark, sf_dir):
    return checks.waived(length_findings(spark, sf_dir), WAIVERS.frame(spark))[1].select("pos")


@query("c38_gate", f"SELECT count(*) AS findings, count(*) FILTER (severity = 'review') AS review, coalesce(bool_or(severity = 'review'), false) AS shut FROM {_LEFT}")
def c38(spark, sf_dir):
    return checks.gate(checks.waived(length_findings(spark, sf_dir), WAIVERS.frame(spark))[0])


@query("s14_summary", f"SELECT severity, \"check\", count(*) AS n FROM {_FOUND} GROUP BY severity, \"check\"")
def s14(spark, sf_dir):
    return checks.summary(length_findings(spark, sf_dir))


@query("p26_relative_width", "WITH m AS (SELECT median(p_size) AS med FROM part) SELECT p_partkey, CAST(floor(greatest(0.2, least(0.9, p_size / med)) * 100 + 0.000001) AS BIGINT) AS percent FROM part, m")
def p26(spark, sf_dir):
    return aggregates.relative_width(table(spark, sf_dir, "part"), "p_size").select("p_partkey", "percent")


_STATE = "(SELECT user_id, event_id, CASE event_type WHEN 'signup' THEN 'pending' WHEN 'purchase' THEN 'translated' WHEN 'error' THEN 'failed' ELSE 'gap' END AS status FROM events)"


@query("t05_run_state", f"SELECT user_id AS chunk, arg_max(status, event_id) AS status, count(*) FILTER (status IN ('translated', 'failed')) AS attempts, CASE WHEN arg_max(status, event_id) = 'failed' THEN 'e' || max(event_id) END AS last_error FROM {_STATE} GROUP BY user_id")
def t05(spark, sf_dir):
    from quire.streaming import state

    return state.folded(state.chunk_events(table(spark, sf_dir, "events")))


@query("t03_pending_requests", "SELECT doc_id AS id FROM documents ANTI JOIN labels USING (doc_id)")
def t03(spark, sf_dir):
    from quire.streaming import state

    requests = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    return state.pending(requests, table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id")))


@query("t06_stale_outputs", "SELECT o_orderkey FROM orders JOIN (SELECT l_orderkey, max(l_shipdate) AS made FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey WHERE made < o_orderdate")
def t06(spark, sf_dir):
    from quire.streaming import state

    source = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderdate").alias("changed"))
    made = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.max("l_shipdate").alias("made"))
    return state.stale(source.join(made.select("key"), "key", "left_semi"), made).select(F.col("key").alias("o_orderkey"))


@query("t08_last_attempt", "SELECT user_id, arg_max(event_type, event_id) AS outcome, least(count(*), 3) AS attempts FROM events GROUP BY user_id")
def t08(spark, sf_dir):
    from quire.streaming import state

    tries = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), F.col("event_id").alias("seq"), F.col("event_type").alias("outcome"))
    return state.last_attempts(tries, most=3).select(F.col("id").alias("user_id"), "outcome", "attempts")


@query("x01_tumbling_windows", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS hour, event_type, count(*) AS n FROM events GROUP BY ALL")
def x01(spark, sf_dir):
    return events.window_counts(table(spark, sf_dir, "events"), "1 hour").withColumnRenamed("start", "hour")


@query("set_difference", "SELECT doc_id FROM documents WHERE n_chars > 500 EXCEPT SELECT doc_id FROM labels")
def set_difference(spark, sf_dir):
    return aggregates.difference(table(spark, sf_dir, "documents").filter("n_chars > 500").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id"))


@query("set_multiset_difference", "SELECT l_partkey FROM lineitem EXCEPT ALL SELECT p_partkey FROM part")
def set_multiset(spark, sf_dir):
    return aggregates.multiset_difference(table(spark, sf_dir, "lineitem").select("l_partkey"), table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey")))


@query("set_union_ranked", "SELECT doc_id AS id, 0 AS rank FROM documents UNION ALL SELECT item_id, 1 FROM benchmark")
def set_union(spark, sf_dir):
    return aggregates.ranked_union(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")), table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id")))


@query("set_intersection", "SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels")
def set_intersection(spark, sf_dir):
    return aggregates.intersection(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id"))
