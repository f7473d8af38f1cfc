"""SimHash near-duplicates by pigeonhole blocks.

Distinct fingerprints are split into four 16-bit blocks.  Two that differ in at most two bits agree
on at least two blocks, so they meet on one of the six block pairs.  Meeting places of up to
``GROUP`` fingerprints verify their Hamming distances directly.  A fuller one, such as a large group
of near copies makes, never lists its pairs: each of its fingerprints is sent to the 65 points
within one bit of it, and two fingerprints share a point exactly when they differ in at most two
bits.  A point has 65 possible visitors at most, so that way is linear and exact at any size.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import similar
from quire.llm.common import batches, dealt_join, durable, hot_keys, row_key, rows_of, utf8, words
from quire.llm.components import connected_components

SEED = 42
SHINGLE = 3
#: Fingerprints at one meeting place that are compared pair by pair.
GROUP = 16
_CHUNK = 1 << 18


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text; zero without words."""
    found = words(text.lower() if text else None)
    if not found:
        return 0
    if len(found) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(found), SEED)
    grams = map(b" ".join, zip(*(found[k:] for k in range(shingle)), strict=False))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), dtype="<u8", count=len(found) - shingle + 1)
    ones = sum(
        np.unpackbits(hashes[k : k + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        for k in range(0, len(hashes), _CHUNK)
    )
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and the signed 64-bit ``fp`` of every row; null texts have none of the words."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.asarray([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), utf8("text")).mapInArrow(batches(make), "doc_id long, fp long")


def close_pairs(distinct: DataFrame) -> DataFrame:
    """Links (a, b) that connect all of ``distinct``'s fp at most two bits apart.

    Sparse meeting places give every close pair; full ones give, for each point, the links to its
    least visitor.  Both have the same connected components as all close pairs.
    """
    block = [F.shiftrightunsigned("fp", 16 * k).bitwiseAND(0xFFFF) for k in range(4)]
    places = [F.lit(k).cast("long") * (1 << 32) + F.shiftleft(block[i], 16) + block[j] for k, (i, j) in enumerate(combinations(range(4), 2))]
    met = distinct.select("fp", F.explode(F.array(*places)).alias("place"))
    sizes = durable(met.groupBy("place").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    shared = dealt_join(met, sizes, "place", hot_keys(sizes, "place", len(places) * distinct.count()))
    met = durable(shared.select("place", "fp", (F.col("n") > GROUP).alias("full")))
    group = F.array_sort(F.collect_list("fp"))
    pairs = (
        met.filter("not full").groupBy("place").agg(group.alias("fps"))
        .select("fps", F.posexplode("fps").alias("k", "a"))
        .select("a", F.explode(F.expr("filter(slice(fps, k + 2, size(fps)), b -> bit_count(a ^ b) <= 2)")).alias("b"))
    )
    near = F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")
    points = met.filter("full").select("fp").distinct().select("fp", F.explode(near).alias("point"))
    stars = (
        points.groupBy("point").agg(F.collect_list("fp").alias("fps"))  # 65 at most
        .filter("size(fps) > 1")
        .select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
        .filter("a <> b and bit_count(a ^ b) <= 2")
    )
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, *, shingle: int = SHINGLE) -> DataFrame:
    """Class of every row: doc_id, fp and component_id, the least doc_id that its links reach.

    Rows of equal fingerprint are linked, so all rows without words form one class.  A null doc_id
    never names a class that has another; repeated rows come out as often as they came in; an empty
    table gives no rows.
    """
    return classes(durable(fingerprints(docs, shingle=shingle))).drop("class_fp")


def classes(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, fp and any others) with component_id and class_fp, the class's least fp."""
    distinct = durable(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")))
    total = distinct.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    linked = connected_components(close_pairs(distinct.select("fp")))
    named = distinct.join(linked.withColumnRenamed("node", "fp"), "fp").select("fp", "least", "component")
    least = named.groupBy("component").agg(F.min("least").alias("found"))
    moved = named.join(least, "component").select("fp", "found", F.col("component").alias("moved"))
    names = distinct.join(moved, "fp", "left").select(
        "fp",
        F.when(F.col("moved").isNull(), F.col("least")).otherwise(F.col("found")).alias("component_id"),
        F.coalesce("moved", "fp").alias("class_fp"),
    )
    return dealt_join(rows, names, "fp", hot_keys(distinct, "fp", total))


def keep_representatives(docs: DataFrame, *, similarity: bool = False) -> DataFrame:
    """One row of every class of near-duplicates, with all columns of ``docs``: the one of the least
    doc_id, null ids last, then of the least hash of the whole row.  Rows without words form a class
    and keep one row, too; an empty table keeps none.

    Classes are those of ``near_duplicates``, or with ``similarity`` those of five-word shingles with
    a similarity of 0.8 or more, for which ``quire.llm.similar`` cuts more fingerprints into blocks.
    """
    if similarity:
        return similar.keep_representatives(docs)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.asarray([fingerprint(t) for t in batch.column(3).to_pylist()], dtype=np.uint64)
        return pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found.view(np.int64))], ["none", "id", "mark", "fp"])

    marked = docs.select(row_key(docs).alias("key"), utf8("text").alias("text")).select("key.*", "text")
    marked = durable(marked.mapInArrow(batches(make), "none boolean, id long, mark long, fp long"))
    rows = marked.select("fp", F.struct("none", "id", "mark").alias("key"), F.when(~F.col("none"), F.col("id")).alias("doc_id"))
    return rows_of(docs, classes(rows).groupBy("class_fp").agg(F.min("key").alias("key")).select("key").distinct())
