"""Near-duplicates of a similarity that 64-bit fingerprints cannot tell: see ``quire.llm.simhash``.

Fingerprints of texts with a similarity of 0.8 differ in ten bits on average, and blocks that such
pairs are sure to share have five bits or fewer, which everything shares.  Candidates are therefore
distinct texts that meet where one of ``BANDS`` bands of ``ROWS`` minima of their shingles' hashes
agrees; a pair of similarity 0.8 misses all of them with chance (1 - 0.8^4)^24 = 3e-6, more similar
ones with less.  Candidates are verified on the whole sets of shingles.

Places of up to ``GROUP`` texts verify all pairs.  A fuller one verifies each text against its most
central one, which is at more and fuller places than others, drops those near it, and so on while
that takes away a tenth of what is left.  The rest, texts of which few are near each other, is dealt
to blocks, and a task holds two of them, compares signatures, then sets, and reports only links that
connect what is not connected yet: no list of all pairs is ever made.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import batches, dealt_join, durable, hot_keys, row_key, rows_of, sifted, utf8, words
from quire.llm.components import connected_components

SEED = 42

SHINGLE = 5
#: Least similarity of near-duplicates, as a fraction.
SIMILARITY = (4, 5)
BANDS, ROWS = 24, 4
#: Texts at one meeting place that are compared pair by pair.
GROUP = 16
#: Texts, and shingles of them, of a block that is compared with another one.
BLOCK, BLOCK_SHINGLES = 512, 500_000
#: Equal minima that make a pair a candidate there; of 96, a pair of similarity 0.8 has fewer with chance 4e-7.
AGREEING = 58
_CHUNK = 1 << 12
_RNG = np.random.default_rng(SEED)
_FACTORS = _RNG.integers(0, 1 << 63, (BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(0, 1 << 63, (BANDS * ROWS, 1), dtype=np.uint64)
_KEY = "none boolean, id long, mark long"


def shingles(text: bytes | None) -> np.ndarray:
    """Distinct hashes of a text's shingles, in order; a text of fewer words is one, one without words has none."""
    found = words(text.lower() if text else None)
    grams = [b" ".join(found)] if 0 < len(found) < SHINGLE else map(b" ".join, zip(*(found[k:] for k in range(SHINGLE)), strict=False))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), dtype="<u8"))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The minima of a set of shingles under ``BANDS * ROWS`` orders."""
    return np.min([(hashes[k : k + _CHUNK] * _FACTORS + _SHIFTS).min(axis=1) for k in range(0, len(hashes), _CHUNK)], axis=0)


def bands(least: np.ndarray) -> np.ndarray:
    """The places where a signature meets others, as signed numbers."""
    found = [xxhash.xxh64_intdigest(row.tobytes(), k) for k, row in enumerate(least.reshape(BANDS, ROWS))]
    return np.asarray(found, dtype=np.uint64).view(np.int64)


def _marked(docs: DataFrame, key: Column) -> DataFrame:
    """Key, hash of the words, meeting places and signature (a byte of each minimum) of every row."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        same, places, signs = [], [], []
        for text in batch.column(3).to_pylist():
            same.append(xxhash.xxh3_128_digest(b" ".join(words(text.lower() if text else None))))
            hashes = shingles(text)
            least = signature(hashes) if len(hashes) else None
            places.append([] if least is None else bands(least))
            signs.append(b"" if least is None else (least >> np.uint64(56)).astype(np.uint8).tobytes())
        columns = [pa.array(same, pa.binary()), pa.array(places, pa.list_(pa.int64())), pa.array(signs, pa.binary())]
        return pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], ["none", "id", "mark", "same", "places", "signature"])

    rows = docs.select(key.alias("key"), utf8("text").alias("text")).select("key.*", "text")
    return rows.mapInArrow(batches(make), f"{_KEY}, same binary, places array<long>, signature binary")


def _sets(docs: DataFrame, key: Column, nodes: DataFrame) -> DataFrame:
    """``nodes`` (node and any others), each once, with the shingles of their texts."""
    others = [c for c in nodes.columns if c != "node"]

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = pa.array([shingles(t).view(np.int64) for t in batch.column(3).to_pylist()], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([*batch.columns[:3], *batch.columns[4:], found], ["none", "id", "mark", *others, "shingles"])

    parts = ["none", "id", "mark"]
    wanted = nodes.select("node.*", *others)
    rows = docs.select(key.alias("key"), utf8("text").alias("text")).select("key.*", "text")
    # equal rows become one within tasks first; the join then finds them where they are
    rows = sifted(rows, wanted.select(parts)).dropDuplicates(parts).join(wanted, parts).select(*parts, "text", *others)
    schema = T.StructType([*rows.schema.fields[:3], *rows.schema.fields[4:], T.StructField("shingles", T.ArrayType(T.LongType()))])
    return rows.mapInArrow(batches(make), schema).select(F.struct(*parts).alias("node"), *others, "shingles")


def _near(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose similarity is high enough, written."""
    up, down = SIMILARITY
    pairs = durable(pairs.distinct())
    sizes = durable(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    a, b = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}")) for c in "ab")
    n, m = F.size("sa"), F.size("sb")
    sized = F.least(n, m) * down >= F.greatest(n, m) * up
    shared = F.size(F.array_intersect("sa", "sb")) * (up + down) >= (n + m) * up
    met = dealt_join(pairs.join(b, "b"), a, "a", hot_keys(sizes, "a", total))
    return durable(met.filter(F.when(sized, shared).otherwise(False)).select("a", "b"))


def _sparse_pairs(met: DataFrame) -> DataFrame:
    """All pairs (a < b) of nodes that share a place of ``GROUP`` at most."""
    listed = met.groupBy("place").agg(F.array_sort(F.collect_set("node")).alias("nodes")).select("nodes", F.posexplode("nodes").alias("k", "a"))
    return listed.select("a", F.explode(F.expr("slice(nodes, k + 2, size(nodes))")).alias("b"))


def _alike(one: np.ndarray, two: np.ndarray) -> bool:
    """Is the similarity of two sets of distinct shingles high enough?"""
    up, down = SIMILARITY
    n, m = len(one), len(two)
    return min(n, m) * down >= max(n, m) * up and len(np.intersect1d(one, two, assume_unique=True)) * (up + down) >= (n + m) * up


def _block_links(rest: DataFrame, signatures: DataFrame, sets: DataFrame) -> DataFrame:
    """Verified links among the nodes that share a place of ``rest`` (place, node), as many as it takes to connect them."""
    sized = durable(rest.join(signatures, "node").join(sets, "node"))
    sizes = durable(sized.groupBy("place").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("shingles")).alias("held")))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows = dealt_join(sized, sizes, "place", hot_keys(sizes, "place", total))
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("held") / BLOCK_SHINGLES)).cast("int")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.select("place", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "own", "node.*", "signature", "shingles")

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        signs = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)
        held = table.column("shingles").combine_chunks()
        values, edges = held.values.to_numpy(), held.offsets.to_numpy()
        own, (_, one, two) = table.column("own").to_numpy(), (k.as_py() for k in key)
        first, second = np.flatnonzero(own == one), np.flatnonzero(own == two)
        group = np.arange(len(own))  # of each text the least it is connected with
        a, b = [], []
        for k, i in enumerate(first):
            against = second[k + 1 :] if one == two else second
            for j in against[np.count_nonzero(signs[against] == signs[i], axis=1) >= AGREEING]:
                if group[i] != group[j] and _alike(values[edges[i] : edges[i + 1]], values[edges[j] : edges[j + 1]]):
                    group[group == max(group[i], group[j])] = min(group[i], group[j])
                    a.append(int(i))
                    b.append(int(j))
        nodes = table.select(["none", "id", "mark"])
        sides = [c for side in (a, b) for c in nodes.take(pa.array(side, pa.int64())).columns]
        return pa.Table.from_arrays(sides, [f"{x}_{c}" for x in "ab" for c in ("none", "id", "mark")])

    found = rows.groupBy("place", "one", "two").applyInArrow(compare, ", ".join(f"{x}_none boolean, {x}_id long, {x}_mark long" for x in "ab"))
    return durable(found.select(*[F.struct(*[F.col(f"{x}_{c}").alias(c) for c in ("none", "id", "mark")]).alias(x) for x in "ab"]))


def links(met: DataFrame, sets: DataFrame, signatures: DataFrame) -> DataFrame:
    """Verified pairs of ``met`` (place, node, n)."""
    found = _near(_sparse_pairs(met.filter(F.col("n") <= GROUP)), sets)
    full = met.filter(F.col("n") > GROUP)
    central = full.groupBy("node").agg((-F.sum("n")).alias("order"))
    rest = durable(full.select("place", "node").join(central, "node"))
    left = rest.count()
    while left:
        leaders = durable(rest.groupBy("place").agg(F.min(F.struct("order", "node")).alias("l"), F.count(F.lit(1)).alias("n")))
        stars = dealt_join(rest, leaders.select("place", F.col("l.node").alias("a")), "place", hot_keys(leaders, "place", left))
        stars = durable(stars.filter("node <> a").withColumnRenamed("node", "b"))
        near = _near(stars.select("a", "b"), sets)
        found = found.unionByName(near)
        rest = durable(stars.join(near, ["a", "b"], "left_anti").select("place", F.col("b").alias("node"), "order"))
        before, left = left, rest.count()
        if 10 * left > 9 * before:
            return found.unionByName(_block_links(rest.select("place", "node"), signatures, sets))
    return found


def keep_representatives(docs: DataFrame) -> DataFrame:
    """One row of every class of near-duplicates, with all columns of ``docs``: the one of the least
    doc_id, null ids last, then of the least hash of the whole row.

    Rows of equal words (A-Z lower-cased) are linked, so those without words keep one row, and so are
    rows whose five-word shingles have similarity 0.8 or more.  At a full place texts near the central
    one are not compared with each other, so a class may end up as several; every row that goes is
    linked to one that stays.
    """
    key = row_key(docs)
    # the mark of a row is of all its columns, so rows of one key have one text
    marked = _marked(docs, key)
    first = F.min(F.struct(F.struct("none", "id", "mark").alias("node"), "places", "signature")).alias("m")
    nodes = durable(marked.groupBy("same").agg(first).select("m.*"))
    met = nodes.select("node", F.explode("places").alias("place"))
    sizes = durable(met.groupBy("place").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    total = nodes.agg(F.coalesce(F.sum(F.size("places")), F.lit(0))).first()[0]
    met = durable(dealt_join(met, sizes, "place", hot_keys(sizes, "place", total)))
    sets = durable(_sets(docs, key, met.select("node").distinct()))
    linked = connected_components(links(met, sets, nodes.select("node", "signature")))
    gone = linked.filter("node <> component").select("node")
    return rows_of(docs, nodes.select("node").join(gone, "node", "left_anti").select(F.col("node").alias("key")))
