"""What the corpus operators share: table access, durable cuts of lineage and the word rules.

Text columns travel to Python as UTF-8 bytes.  ``bytes.split()`` splits on exactly
``[\\x20\\x09-\\x0D]`` and ``bytes.lower()`` lower-cases exactly ``A-Z``, so both word rules of
this subpackage run at C speed and never touch a non-ASCII letter.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the decontamination contract, on lower-cased UTF-8 bytes.
ALNUM_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, by a path that only Spark opens."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: bytes | None) -> list[bytes]:
    """Maximal runs outside ``[\\x20\\x09-\\x0D]``; a null text has none."""
    return text.split() if text else []


def alnum_words(text: bytes | None) -> list[bytes]:
    """Runs of ``0-9``, letters and everything beyond ASCII, ``A-Z`` lower-cased."""
    return ALNUM_WORD.findall(text.lower()) if text else []


def utf8(column: str) -> Column:
    """A text column as bytes, whatever type it came with."""
    return F.col(column).cast("string").cast("binary")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the session; a temporary one only in a single-machine session."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if found is None:
        if not re.match(r"local($|\[)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="quire-checkpoint-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(found)
    return found


def scratch(spark: SparkSession, kind: str) -> str:
    """A new folder in the shared one; it is removed when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark)}/quire-{kind}-{uuid.uuid4().hex}"
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(jvm_path)
    files.deleteOnExit(jvm_path)
    return path


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder now and go on from there.

    A written table rather than a checkpoint: its size is known, so later joins plan with it, while the
    estimates of a checkpoint of joins multiply from round to round.
    """
    path = scratch(df.sparkSession, "table")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bytes of a batch of rows on its way to Python; a task holds such a batch a few times over.
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """From now on the session's batches for Python have ``BATCH_BYTES`` at most, or a row; a lower setting stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    found = spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()
    if not 0 < found <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def batches(
    make: Callable[[pa.RecordBatch], pa.RecordBatch | None],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``mapInArrow`` function that applies ``make`` to each batch on its own."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            if batch.num_rows and (out := make(batch)) is not None and out.num_rows:
                yield out
            pa.default_memory_pool().release_unused()

    return run


#: Keys with more than one in so many rows are dealt to so many tasks each.  There are fewer than 16 of
#: the first kind and fewer than 256 in all.
SHARES = ((16, 64), (256, 8))


def hot_keys(sizes: DataFrame, key: str, total: int) -> list[tuple[list[int], int]]:
    """Hashes of the hot keys of ``sizes`` (key, n) of ``total`` rows, fewer than 256, with the number of tasks to deal them to."""
    least = SHARES[-1][0]
    found = [tuple(r) for r in sizes.filter(F.col("n") * least > total).select(F.xxhash64(key), "n").collect()]
    kinds, above = [], set()
    for share, parts in SHARES:
        own = [h for h, n in found if n * share > total and h not in above]
        above.update(own)
        kinds.append((own, parts))
    return [k for k in kinds if k[0]]


def dealt_join(rows: DataFrame, unique: DataFrame, key: str, hot: list[tuple[list[int], int]]) -> DataFrame:
    """``rows`` joined with ``unique``, one row for each ``key``; rows of a hot key are dealt to many tasks.

    Of ``unique`` only the rows of hot keys are repeated, fewer than 3,000 in all.  A key counts as hot
    by its hash, on both sides alike, so one that shares a hot key's hash is only dealt, too.
    """
    if not hot:
        return rows.join(unique, key)
    parts = F.lit(1)
    for hashes, many in reversed(hot):
        parts = F.when(F.xxhash64(key).isin(hashes), many).otherwise(parts)
    deal = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), parts)
    left = rows.withColumn("__part", deal.cast("int"))
    right = unique.withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return left.join(right, [key, "__part"]).drop("__part")


#: Bits of a sieve, 4 MB, and of one of its rows.
SIEVE, SIEVE_ROW = 1 << 25, 1 << 15


def sifted(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rows`` without most of those whose values of the columns of ``wanted`` are not in it, and without a shuffle.

    The sieve has a bit for each hash of ``wanted``; the more rows that has, the more others pass, so a join has to follow.
    """
    hashed = F.pmod(F.xxhash64(*wanted.columns), F.lit(SIEVE))
    at, bit = F.floor(hashed / SIEVE_ROW).alias("__at"), F.pmod(hashed, F.lit(SIEVE_ROW))
    sieve = wanted.select(at, bit.alias("bit")).groupBy("__at").agg(F.bitmap_construct_agg("bit").alias("__sieve"))
    met = rows.withColumn("__at", at).withColumn("__bit", bit.cast("int")).join(F.broadcast(sieve), "__at")
    there = F.expr("shiftright(cast(conv(hex(substring(__sieve, __bit div 8 + 1, 1)), 16, 10) as int), cast(__bit % 8 as int)) % 2 = 1")
    return met.filter(there).select(*[F.col(f"`{c}`") for c in rows.columns])


def row_key(docs: DataFrame) -> Column:
    """Key of a row: doc_id, null ids last, then the hash of the whole row."""
    mark = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    return F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), mark.alias("mark"))


def rows_of(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row of ``docs`` for each key of ``kept``, with all columns."""
    packed = docs.select(row_key(docs).alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    # equal rows become one within tasks first; the join then finds them where they are, since fields, other than
    # structs, have one type whether they may be null or not
    parts = ["none", "id", "mark"]
    return packed.select("key.*", "row").dropDuplicates(parts).join(kept.select("key.*"), parts, "left_semi").select("row.*")
