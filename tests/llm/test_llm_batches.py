"""Memory of the pipeline's Python workers."""

from __future__ import annotations

import corpus_pipeline
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from quire.llm import common


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_bounded_batches(spark, sf_dir, stage):
    """After each stage was asked for, no batch for Python holds more than its bytes and a row, whatever the rows' length."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(name)

    def measure(source):
        for batch in source:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], ["held"])

    corpus_pipeline.STAGES[stage][1](spark, common.table(spark, sf_dir, "documents").limit(3), sf_dir)
    rows = spark.range(0, 9_000, 1, 1).select(F.repeat(F.lit("x"), 4_000).alias("text"))
    held = [r["held"] for r in rows.mapInArrow(measure, "held long").collect()]
    spark.conf.unset(name)
    assert sum(held) >= 36_000_000 and max(held) <= common.BATCH_BYTES + 100_000
