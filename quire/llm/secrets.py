"""Secret scans over an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its text.  A ledger row says that a blob
was scanned under a rule version, and what was found.  A run computes the addresses of all versions,
leaves out those that the ledger has, scans each remaining blob once, whatever number of paths it
has, appends what it found to the ledger, and joins findings back to all paths.

A ledger is a folder of Parquet tables, one for each run.  The session names it in ``LEDGER``; a run
without that setting starts an empty one in the shared folder, so it scans every blob.

Blobs are made distinct within each task before their shuffle, so one that a third of all paths
share costs one row for each task, and paths travel without their text.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import dealt_join, durable, hot_keys, scratch, utf8

#: Raise it with any change of the rules: blobs are then scanned anew.
RULE_VERSION = 1
#: Setting of the session that names the folder of a ledger to go on with.
LEDGER = "spark.quire.secrets.ledger"

_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
#: Kind and pattern, in the order of kinds; the first three are the base rules, on UTF-8 bytes.
RULES: tuple[tuple[str, re.Pattern[bytes]], ...] = (
    ("assign", _ASSIGN),
    ("access", re.compile(rb"AKIA[A-Z0-9]{16,}")),
    ("hex", re.compile(rb"[0-9a-f]{24,}")),
    ("pem", re.compile(rb"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]{0,32}PRIVATE KEY-----)?")),
    ("jwt", re.compile(rb"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    ("github", re.compile(rb"(?<![A-Za-z0-9_])gh[pousr]_[A-Za-z0-9]{36,}")),
    ("slack", re.compile(rb"(?<![A-Za-z0-9_-])xox[abprs]-[A-Za-z0-9-]{10,}")),
)
BASE_KINDS = ("assign", "access", "hex")
_KINDS = [kind for kind, _ in RULES]
#: Characters that the value of an assignment needs.
ASSIGN_LEAST = 6

SPANS = "array<struct<kind:string,start:int,end:int>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def spans_of(text: bytes) -> list[dict]:
    """Findings of a text: kind, start and end in code points, ordered by start, then kind."""
    found = []
    for rank, (kind, pattern) in enumerate(RULES):
        for m in pattern.finditer(text):
            if kind != "assign" or len(m[2]) >= ASSIGN_LEAST:
                found.append((m.start(), rank, m.end(), kind))
    if text.isascii():
        return [{"kind": kind, "start": a, "end": b} for a, _, b, kind in sorted(found)]
    out, points, done = [], 0, 0
    for a, _, b, kind in sorted(found):  # code points up to a are counted once
        points, done = points + len(text[done:a].decode(errors="replace")), a
        out.append({"kind": kind, "start": points, "end": points + len(text[a:b].decode(errors="replace"))})
    return out


def _local_blobs(docs: DataFrame) -> DataFrame:
    """(blob, text), each blob once for each task."""

    def distinct(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in source:
            texts, marks = [], []
            for text in batch.column(0).to_pylist():
                mark = sha256(text).digest()
                if mark not in seen:
                    seen.add(mark)
                    marks.append(mark)
                    texts.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(marks, pa.binary()), pa.array(texts, pa.binary())], ["blob", "text"])

    return docs.select(F.coalesce(utf8("text"), F.lit(b"")).alias("text")).mapInArrow(distinct, "blob binary, text binary")


def scan(docs: DataFrame, ledger: DataFrame | None = None, *, version: int = RULE_VERSION) -> DataFrame:
    """New ledger rows (blob, version, spans) for the texts that ``ledger`` has not under ``version``.

    A null text is the empty one.  Blobs without findings get a row, too.
    """
    unseen = _local_blobs(docs).repartition("blob")
    if ledger is not None:
        unseen = unseen.join(ledger.filter(F.col("version") == version).select("blob"), "blob", "left_anti").repartition("blob")

    def find(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # equal blobs of several tasks are in one partition now
        for batch in source:
            marks, spans = [], []
            for mark, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if mark not in seen:
                    seen.add(mark)
                    marks.append(mark)
                    spans.append(spans_of(text))
            columns = [pa.array(marks, pa.binary()), pa.array([version] * len(marks), pa.int32()), pa.array(spans, _SPAN_TYPE)]
            yield pa.RecordBatch.from_arrays(columns, ["blob", "version", "spans"])

    return unseen.mapInArrow(find, f"blob binary, version int, spans {SPANS}")


def blob_of(column: str = "text") -> F.Column:
    """The address of a text: the bytes of its SHA-256."""
    return F.unhex(F.sha2(F.coalesce(utf8(column), F.lit(b"")), 256))


def ledger_path(spark: SparkSession) -> str:
    """The folder that the session names, or a new one."""
    return spark.conf.get(LEDGER, None) or scratch(spark, "ledger")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """(blob, version, spans) of all runs so far; none of a folder without any."""
    schema = f"blob binary, version int, spans {SPANS}"
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(there):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def update_ledger(docs: DataFrame, path: str, *, version: int = RULE_VERSION) -> DataFrame:
    """Scan what the ledger in ``path`` has not, append it as a table of its own, and return the ledger.

    A run that fails leaves no row: a table counts with its last file's commit.
    """
    spark = docs.sparkSession
    scan(docs, read_ledger(spark, path), version=version).write.parquet(f"{path}/run-{uuid.uuid4().hex}")
    return read_ledger(spark, path)


def scan_paths(docs: DataFrame, path: str | None = None, *, version: int = RULE_VERSION) -> DataFrame:
    """Findings of every path, (doc_id, blob, spans), over the ledger in ``path`` or the session's.

    Repeated paths come out as often as they came in, each with its own version's findings; an empty
    table gives no rows.
    """
    ledger = update_ledger(docs, path or ledger_path(docs.sparkSession), version=version)
    paths = durable(docs.select(F.col("doc_id").cast("long").alias("doc_id"), blob_of().alias("blob")))
    sizes = paths.groupBy("blob").agg(F.count(F.lit(1)).alias("n"))
    # runs that overlap in time may both have scanned a blob
    known = ledger.filter(F.col("version") == version).groupBy("blob").agg(F.first("spans").alias("spans"))
    return dealt_join(paths, known, "blob", hot_keys(sizes, "blob", paths.count()))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every finding replaced by ``[REDACTED]``, overlapping ones by a single one, and
    n_chars, where there is one, of the new text.  Other rows and columns stay as they are, null and
    empty texts, too; an empty table stays empty."""
    columns = docs.columns
    ledger = update_ledger(docs, ledger_path(docs.sparkSession)).filter((F.col("version") == RULE_VERSION) & (F.size("spans") > 0))
    found = durable(ledger.groupBy("blob").agg(F.first("spans").alias("spans")).select(F.col("blob").alias("__blob"), F.col("spans").alias("__spans")))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__row"), blob_of().alias("__blob"))
    cut = F.expr(
        "aggregate(__spans, named_struct('out', '', 'last', 0), (a, s) -> named_struct("
        "'out', if(s.start >= a.last, concat(a.out, substring(__row.text, a.last + 1, s.start - a.last), '[REDACTED]'), a.out), "
        "'last', greatest(a.last, s.end)), a -> concat(a.out, substring(__row.text, a.last + 1)))"
    )
    done = row.join(found, "__blob", "left").withColumn("__text", F.when(F.col("__spans").isNotNull(), cut))
    new = {"text": F.coalesce("__text", "__row.text")}
    if "n_chars" in columns:
        chars = F.length("__text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("__text").isNotNull(), chars).otherwise(F.col("__row.n_chars"))
    return done.select(*[new.get(c, F.col(f"__row.`{c}`")).alias(c) for c in columns])
