from __future__ import annotations

import corpus_pipeline
from quire.llm import decontaminate, packing, secrets, simhash
from quire.llm.common import table


def test_stages_and_run(spark, sf_dir):
    """Each stage keeps the columns and takes effect on what came before; run() gives the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    start, counts = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == start.columns, name
        docs = spark.createDataFrame(out.collect(), start.schema)
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] == counts[4] > 0
    assert docs.select("doc_id").distinct().count() == docs.count()
    assert decontaminate.benchmark_matches(docs, table(spark, sf_dir, "benchmark")).filter("n_hit > 0").count() == 0
    assert secrets.scan_paths(docs).filter("size(spans) > 0").count() == 0
    assert docs.filter("length(text) <> n_chars").count() == 0
    expected = {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in packing.pack(docs).collect()}
    assert {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, sf_dir).collect()} == expected


def test_near_dedup_similarity(spark):
    """Two texts of similarity 0.86 on five words are one class for the stage; the op10 contract's two bits do not link them."""
    words = [f"w{k}" for k in range(200)]
    texts = [" ".join(words), " ".join(words[:60] + ["x", "y"] + words[60:140] + ["z"] + words[140:])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()] == [0]
    assert simhash.keep_representatives(docs).count() == 2
