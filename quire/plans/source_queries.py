"""Queries of sources and sinks: what they write to a folder of their own they read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.plans.catalog import folder, query, table
from quire.sources import readers, writers


@query("s01_whole_texts", "SELECT n_nationkey AS doc, n_name AS text FROM nation")
def s01(spark, sf_dir):
    path = folder(spark, "texts")
    table(spark, sf_dir, "nation").select("n_nationkey", "n_name").repartition("n_nationkey").write.mode("overwrite").partitionBy("n_nationkey").text(path)
    key = F.regexp_extract("path", r"n_nationkey=(\d+)/", 1).cast("int")
    return readers.whole_texts(spark, f"{path}/*/*.txt").select(key.alias("doc"), "text")


@query("s02_chunk_folder", "SELECT r_regionkey AS doc, r_name AS source, CASE WHEN r_regionkey < 3 THEN lower(r_name) END AS target FROM region")
def s02(spark, sf_dir):
    path, region = folder(spark, "kit"), table(spark, sf_dir, "region")
    writers.write_files(region.select(F.concat(F.col("r_regionkey").cast("string"), F.lit(".md")).alias("name"), F.col("r_name").alias("text")), f"{path}/chunks")
    translated = region.filter("r_regionkey < 3")
    writers.write_files(translated.select(F.concat(F.col("r_regionkey").cast("string"), F.lit(".tex")).alias("name"), F.lower("r_name").alias("text")), f"{path}/translated")
    return readers.chunk_folder(spark, path, digits_only=True).withColumn("doc", F.col("doc").cast("int"))


@query("s03_json_documents", "SELECT CASE WHEN n_nationkey % 5 > 0 THEN n_nationkey END AS key, CASE WHEN n_nationkey % 5 > 0 THEN n_name END AS name FROM nation")
def s03(spark, sf_dir):
    path, nation = folder(spark, "json"), table(spark, sf_dir, "nation")
    body = F.when(F.col("n_nationkey") % 5 > 0, F.to_json(F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name")))).otherwise("{\"key\": ")
    writers.write_files(nation.select(F.concat(F.col("n_nationkey").cast("string"), F.lit(".json")).alias("name"), body.alias("text")), path)
    return readers.json_documents(spark, path, "key int, name string")


@query("s04_strict_json_documents", "SELECT n_nationkey AS key, n_name AS name FROM nation")
def s04(spark, sf_dir):
    path, nation = folder(spark, "json"), table(spark, sf_dir, "nation")
    body = F.to_json(F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name")))
    writers.write_files(nation.select(F.concat(F.col("n_nationkey").cast("string"), F.lit(".json")).alias("name"), body.alias("text")), path)
    return readers.json_documents(spark, path, "key int, name string", strict=True)


@query("s09_text_files", "SELECT n_nationkey AS doc, concat(n_name, ' of ', n_regionkey) AS text FROM nation")
def s09(spark, sf_dir):
    path, nation = folder(spark, "files"), table(spark, sf_dir, "nation")
    writers.write_files(nation.select(F.concat(F.col("n_nationkey").cast("string"), F.lit(".txt")).alias("name"), F.concat("n_name", F.lit(" of "), F.col("n_regionkey").cast("string")).alias("text")), path)
    return readers.whole_texts(spark, path).select(F.col("doc").cast("int").alias("doc"), "text")


@query("s10_replaced_table", "SELECT n_nationkey, n_name FROM nation WHERE n_regionkey > 1")
def s10(spark, sf_dir):
    path, nation = f"{folder(spark, 'state')}/table", table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    writers.overwrite(nation, path)
    # the second table is made from the first one, which is there until the new one is whole
    writers.overwrite(spark.read.parquet(path).filter("n_regionkey > 1").drop("n_regionkey"), path)
    return spark.read.parquet(path)


@query("s12_published", "SELECT o_custkey AS book, count(*) AS n FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING arg_max(o_totalprice, o_orderkey) > 100000) AND o_orderkey % 3 > 0 GROUP BY o_custkey")
def s12(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    builds = orders.select(F.col("o_custkey").alias("book"), F.col("o_orderkey").alias("seq"), (F.col("o_totalprice") > 100000).alias("succeeded"))
    outputs = orders.select(F.col("o_custkey").alias("book"), F.col("o_orderkey").alias("path"), (F.col("o_orderkey") % 3).alias("made"), F.lit(1).alias("source_changed"))
    path = f"{folder(spark, 'published')}/table"
    writers.publish(builds, outputs, path)
    return spark.read.parquet(path).groupBy("book").agg(F.count(F.lit(1)).alias("n"))


@query("s13_review_sheet", """SELECT row_number() OVER (ORDER BY grp, n_nationkey) AS nth, grp, concat('<tr class="', CASE grp WHEN 0 THEN 'dropped' WHEN 1 THEN 'flagged' ELSE 'kept' END, '"><td>', n_nationkey, '</td><td>', replace(n_name, '&', '&amp;'), '</td><td>', CASE WHEN n_nationkey % 3 = 0 THEN 'gap' ELSE '' END, '</td></tr>') AS html
FROM (SELECT *, CASE WHEN n_nationkey % 4 = 0 THEN 0 WHEN n_nationkey % 3 = 0 THEN 1 ELSE 2 END AS grp FROM nation)""")
def s13(spark, sf_dir):
    flags = F.when(F.col("n_nationkey") % 3 == 0, F.array(F.lit("gap"))).otherwise(F.array().cast("array<string>"))
    figures = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("position"), F.col("n_name").alias("name"), (F.col("n_nationkey") % 4 != 0).alias("keep"), flags.alias("flags"))
    return writers.review_rows(figures).select("nth", "grp", "html")


@query("s14_rendered_reports", "SELECT n_regionkey AS doc, string_agg(concat(n_regionkey, ':', n_nationkey, ' [review] name: ', n_name), chr(10) ORDER BY n_nationkey) AS report FROM nation GROUP BY n_regionkey")
def s14_rendered(spark, sf_dir):
    found = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("doc"), F.lit("name").alias("check"), F.lit("review").alias("severity"), F.col("n_name").alias("message"), F.col("n_nationkey").cast("long").alias("line"), F.lit("").alias("context"))
    return writers.rendered(found)


@query("p28_page_offsets", "SELECT n_nationkey AS entry, n_regionkey * 10 + n_nationkey % 10 AS page_idx FROM nation")
def p28(spark, sf_dir):
    parts = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("entry"), (F.col("n_nationkey") % 10).alias("page_idx"), (F.col("n_regionkey") * 10 + 1).alias("first_page"))
    return readers.shifted_entries(parts).select("entry", "page_idx")


def _archives(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    files = nation.select(F.concat(F.lit("r"), F.col("n_regionkey")).alias("path"), F.concat(F.lower("n_name"), F.lit(".txt")).alias("member"), F.col("n_name").cast("binary").alias("content"))
    full = nation.filter("n_nationkey % 2 = 0").groupBy("n_regionkey").agg(F.min("n_name").alias("first")).select(F.concat(F.lit("r"), F.col("n_regionkey")).alias("path"), F.lit("a/full.md").alias("member"), F.col("first").cast("binary").alias("content"))
    other = nation.groupBy("n_regionkey").agg(F.max("n_name").alias("last")).select(F.concat(F.lit("r"), F.col("n_regionkey")).alias("path"), F.lit("a/an.md").alias("member"), F.col("last").cast("binary").alias("content"))
    return writers.archived(files.unionByName(full).unionByName(other))


@query("s07_archive_texts", "SELECT concat('r', n_regionkey) AS path, coalesce(min(n_name) FILTER (n_nationkey % 2 = 0), max(n_name)) AS text FROM nation GROUP BY n_regionkey")
def s07(spark, sf_dir):
    return readers.archive_texts(readers.unpacked(_archives(spark, sf_dir)))


@query("s11_archive_members", """SELECT concat('r', n_regionkey) AS path, concat(lower(n_name), '.txt') AS member, n_name AS text FROM nation
UNION ALL SELECT concat('r', n_regionkey), 'a/full.md', min(n_name) FROM nation WHERE n_nationkey % 2 = 0 GROUP BY n_regionkey UNION ALL SELECT concat('r', n_regionkey), 'a/an.md', max(n_name) FROM nation GROUP BY n_regionkey""")
def s11(spark, sf_dir):
    return readers.unpacked(_archives(spark, sf_dir)).select("path", "member", F.col("content").cast("string").alias("text"))
