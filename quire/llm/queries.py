"""The queries of this subpackage's operators and, where SQL can say it, their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import decontaminate, licenses, packing, quality, secrets, simhash, substrings, tokencount, toxicity, urls
from quire.llm.common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_items = F.size("items").cast("long")
    return found.select(
        "doc_id", "n_words", "n_hit", n_items.alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_items >= decontaminate.CONTAMINATED_ITEMS).alias("contaminated"),
        F.size("near").cast("long").alias("n_near"),
    )


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_paths(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE_KINDS))

    def number(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def listed(spans: F.Column) -> F.Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id", *[number(k).alias(f"n_{k}") for k in secrets.BASE_KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), urls.rule_table(spark))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_token_counts, op3_decontaminate, op4_secret_scan, op5_toxicity,
        op6_url_filter, op7_license_scan, op8_substring_dedup, op9_best_fit_packing, op10_simhash,
    )
}



def _license_sql() -> str:
    """The license rules as nested SQL expressions, one for each rule in order."""
    known = ", ".join("('{}', '{}')".format(key, licenses.normalised(sentence)) for key, sentence in licenses.SENTENCES)
    steps, left = [], "seq"
    for k, (name, keys) in enumerate(licenses.RULES):
        pattern = "".join(f"<{x}>" for x in keys)
        steps.append(f"s{k} AS (SELECT *, replace({left}, '{pattern}', '|') AS left{k}, CASE WHEN contains({left}, '{pattern}') THEN '{name}' END AS f{k} FROM {'q' if not k else f's{k - 1}'})")
        left = f"left{k}"
    found = ", ".join(f"f{k}" for k in range(len(licenses.RULES)))
    return f"""
WITH known(id, sentence) AS (VALUES {known}),
d AS (SELECT row_number() OVER () AS r, doc_id, string_split(regexp_replace({_LOWER}, '[.!?]+([ \t\r]+|$)|\n', '\n', 'g'), chr(10)) AS units FROM documents),
u AS (SELECT r, unnest(range(1, len(units) + 1)) AS k, trim(regexp_replace(unnest(units), '[^a-z0-9]+', ' ', 'g')) AS sentence FROM d),
m AS (SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY k) AS ids, string_agg('<' || id || '>', '' ORDER BY k) AS seq FROM u JOIN known USING (sentence) GROUP BY r),
q AS (SELECT doc_id, coalesce(n, 0) AS n_known, coalesce(ids, '') AS sentences, coalesce(seq, '') AS seq FROM d LEFT JOIN m USING (r)),
{', '.join(steps)},
l AS (SELECT *, list_filter([{found}], lambda x: x IS NOT NULL) AS found FROM s{len(licenses.RULES) - 1})
SELECT doc_id, n_known, sentences,
  array_to_string(list_transform(list_filter(range(1, len(found) + 1), lambda i: list_position(found, found[i]) = i), lambda i: found[i]), ',') AS licenses,
  CAST(length({left}) - length(replace({left}, '<', '')) AS BIGINT) AS n_unused
FROM l
"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+"

ORACLE_SQL: dict[str, str] = {
    "op6_url_filter": r"""
WITH p AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(verdict, h, p) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
n AS (SELECT *, row_number() OVER () AS k FROM q),
f AS (SELECT k, max_by(struct_pack(v := verdict, rule := h || p), length(h || p)) AS best FROM n JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY k)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.v, 'allow') AS verdict FROM n LEFT JOIN f USING (k)
""",
    "op8_substring_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, doc_id, k, hash(array_to_string(w[k:k + 49], ' ')) AS h FROM (SELECT *, unnest(range(1, len(w) - 48)) AS k FROM d WHERE len(w) >= 50)),
m AS (SELECT r, k, doc_id > min(doc_id) OVER (PARTITION BY h) AS again FROM s),
p AS (SELECT r, list(DISTINCT p) AS gone FROM (SELECT r, unnest(range(k, k + 50)) AS p FROM m WHERE again) GROUP BY r),
x AS (SELECT r, p, w[p] AS word FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS p FROM d WHERE len(w) > 0)),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS t FROM x WHERE NOT EXISTS (SELECT 1 FROM (SELECT r, unnest(gone) AS p FROM p) g WHERE g.r = x.r AND g.p = x.p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN p USING (r) LEFT JOIN kept USING (r)
""",
    "op3_decontaminate": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(len(w), 8) AS n, array_to_string(w[k:k + least(len(w), 8) - 1], ' ') AS phrase
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 7, 1) + 1)) AS k FROM b WHERE len(w) > 0)),
dw AS (
  SELECT r, n, k, array_to_string(w[k:k + n - 1], ' ') AS phrase
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
m AS (SELECT r, item, k, dw.n AS n FROM dw JOIN bw USING (n, phrase)),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM m) GROUP BY r),
i AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM m GROUP BY r),
-- proximity: a stretch of n + 4 words that holds every word of the window
bt AS (SELECT DISTINCT item, n, phrase, unnest(list_distinct(string_split(phrase, ' '))) AS t FROM bw),
nt AS (SELECT item, n, phrase, count(*) AS terms FROM bt GROUP BY ALL),
dt AS (SELECT r, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS p FROM d WHERE len(w) > 0),
df AS (SELECT t, count(*) AS f FROM dt GROUP BY t),
rare AS (SELECT item, n, phrase, arg_min(t, coalesce(f, 0)) AS t FROM bt LEFT JOIN df USING (t) GROUP BY ALL),
c AS (SELECT DISTINCT r, item, rare.n, phrase, unnest(range(p - n - 3, p + 1)) AS s FROM rare JOIN dt USING (t)),
g AS (
  SELECT r, item, n, phrase, s FROM c JOIN bt USING (item, n, phrase) JOIN dt USING (r, t)
  WHERE p BETWEEN s AND s + n + 3 GROUP BY r, item, n, phrase, s HAVING count(DISTINCT t) = (
    SELECT terms FROM nt WHERE nt.item = c.item AND nt.n = c.n AND nt.phrase = c.phrase)),
e AS (SELECT r, count(DISTINCT item) AS n_near FROM g GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated, coalesce(n_near, 0) AS n_near
FROM d LEFT JOIN h USING (r) LEFT JOIN i USING (r) LEFT JOIN e USING (r)
""",
}
ORACLE_SQL["op7_license_scan"] = _license_sql()
