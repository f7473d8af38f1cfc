"""Near-duplicates of a given similarity by SimHash and blocks of fingerprints.

One 64-bit fingerprint cannot tell a similarity of 0.8: such texts differ in ten of its bits on average,
and no block that they are sure to share is long enough to select anything.  A text therefore has
``FINGERPRINTS`` SimHash fingerprints of its distinct five-word shingles, of as many independent hashes,
each cut into the four 16-bit blocks of ``quire.llm.simhash``.  Two texts whose fingerprints differ in
fewer bits than there are blocks share a block by the pigeonhole principle; a pair of similarity 0.8,
whose bits differ with chance 0.1515, misses all 160 with chance (1 - 0.8485^16)^160 = 6e-6, more similar
ones with less.  Texts of four or five shingles, whose bits vary more, miss them with chance 0.3 %.

What meets in a block is compared by its first two fingerprints; pairs within ``CLOSE`` bits of these 128
are listed, and those within ``CLOSE_ALL`` bits of all fingerprints stay.  At a place where more than ``GROUP``
texts hang together by close pairs, a crowd, no list of pairs is made.  Texts that listed pairs and crowds
connect are sent to one place, each once, and where they are ``BLOCK`` at most they are compared there, on the
whole sets of shingles, inside a task, which reports only links that connect what is not connected yet.  Where
they are more, the listed pairs are verified one by one, and crowds with a text in common become one.  One of up
to ``BLOCK`` texts is compared inside a task; in a larger one each is verified against the most central one, those
linked to it are compared in blocks inside tasks with those that are not, and so on with the latter.  So no link
between texts not connected yet is left out.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm import minhash
from quire.llm.common import batches, dealt_join, durable, hot_keys, row_key, rows_of, sifted, utf8, words
from quire.llm.components import connected_components

FINGERPRINTS = 40
#: Bits of the first two fingerprints in which a pair that is verified may differ; a pair of similarity 0.8 differs in
#: 19.4 of the 128 on average and in more than 42 with chance 1e-7, unrelated texts in 64.
CLOSE = 42
#: The same for all fingerprints: 388 of 2,560 on average, and 480 for texts of four and five shingles, the most of any pair
#: of that similarity; that is six standard deviations below 600, so a pair is lost here with chance 1e-9.
CLOSE_ALL = 600
#: Texts at one meeting place that are compared pair by pair.
GROUP = 16
#: Texts, and shingles of them, of a block that is compared with another one.
BLOCK, BLOCK_SHINGLES = 512, 500_000
#: Rows of meeting places in a task's group.
BUCKET = 1 << 17
#: Longer runs of texts at one place are searched text by text, not shift by shift.
LONG = 1_024
_STEPS = (np.arange(1, FINGERPRINTS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :]
#: The bits of each byte, one in each byte of a number: sums of up to 255 of them are counts.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8").ravel()
_NODE = ("none", "id", "mark")


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    """The SimHash fingerprints of a set of shingles' hashes."""
    ones = np.zeros(64 * FINGERPRINTS, dtype=np.int64)
    for k in range(0, len(hashes), 255):
        mixed = hashes[k : k + 255, None] + _STEPS  # SplitMix64
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(31)
        ones += np.take(_SPREAD, mixed.view(np.uint8)).sum(axis=0, dtype=np.uint64).view(np.uint8)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")


def _marked(docs: DataFrame, key: Column) -> DataFrame:
    """Key, hash of the words and fingerprints of every row; a row without words has none of the latter."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        same, prints = [], []
        for text in batch.column(3).to_pylist():
            same.append(xxhash.xxh3_128_digest(b" ".join(words(text.lower() if text else None))))
            hashes = minhash.shingles(text)
            prints.append(fingerprints(hashes).view(np.int64) if len(hashes) else [])
        columns = [pa.array(same, pa.binary()), pa.array(prints, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], [*_NODE, "same", "prints"])

    rows = docs.select(key.alias("key"), utf8("text").alias("text")).select("key.*", "text")
    return rows.mapInArrow(batches(make), "none boolean, id long, mark long, same binary, prints array<long>")


def _runs(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of a sorted array begins, and for every element where its run ends."""
    starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    ends = np.r_[starts[1:], len(place)]
    return starts, np.repeat(ends, ends - starts)


def _close(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return np.bitwise_count(one ^ two).sum(axis=-1, dtype=np.int64) <= CLOSE


def close_pairs(place: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Close pairs of rows of one place, ``place`` being sorted; of a run longer than ``LONG`` as many as connect the same rows."""
    starts, ends = _runs(place)
    a, b = [], []
    begin = np.repeat(starts, np.diff(np.r_[starts, len(place)]))
    active = np.flatnonzero(ends - begin <= LONG)
    for d in count(1):
        active = active[active + d < ends[active]]
        if not len(active):
            break
        met = active[_close(prints[active], prints[active + d])]
        a.append(met)
        b.append(met + d)
    for start in starts[ends[starts] - starts > LONG]:
        left, queue = np.arange(start, ends[start]), []
        while len(left):
            i = queue.pop() if queue else left[0]
            left = left[left != i]
            near = _close(prints[left], prints[i])
            a.append(np.full(np.count_nonzero(near), i))
            b.append(left[near])
            queue.extend(left[near].tolist())
            left = left[~near]
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, int), np.zeros(0, int))


def least_reached(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` rows the least that links (a, b) connect it with."""
    least = np.arange(n)
    while True:
        low = np.minimum(least[a], least[b])
        after = least.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        np.minimum.at(after, least[a], low)
        np.minimum.at(after, least[b], low)
        after = after[after]
        if np.array_equal(after, least):
            return least
        least = after


def _met(table: pa.Table, group: int) -> pa.Table:
    """Pairs (a, b) to verify, and the rows (crowd, a, n) of crowds, among the rows (place, number, first, second) of whole places."""
    place, number = table.column("place").to_numpy(), table.column("number").to_numpy()
    order = np.lexsort((number, place))
    place, number = place[order], number[order]
    prints = np.stack([table.column(c).to_numpy()[order].view(np.uint64) for c in ("first", "second")], axis=1)
    a, b = close_pairs(place, prints)
    least = least_reached(len(place), a, b)
    size = np.bincount(least, minlength=len(place))[least]
    few = size[a] <= group
    a, b = a[few], b[few]
    # a pair that agrees in an earlier block of these two fingerprints is listed or in a crowd there
    agree = (prints[a] ^ prints[b]).view("<u2") == 0
    new = ~(agree & (np.arange(8) < (place[a] >> 16)[:, None])).any(axis=1)
    a, b = a[new], b[new]
    many = np.flatnonzero(size > group)
    begin, _ = _runs(place)
    offset = least[many] - begin[np.searchsorted(begin, least[many], side="right") - 1]
    crowd = place[many].astype(np.int64) << 32 | offset
    columns = [
        pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(crowd, pa.int64())]),
        pa.array(np.r_[number[a], number[many]], pa.int64()),
        pa.concat_arrays([pa.array(number[b], pa.int64()), pa.nulls(len(many), pa.int64())]),
        pa.array(np.r_[np.zeros(len(a), np.int64), size[many]], pa.int64()),
    ]
    return pa.Table.from_arrays(columns, ["place", "a", "b", "n"])


def candidates(nodes: DataFrame) -> DataFrame:
    """Of ``nodes`` (number, prints), written: pairs (a, b) to verify, and rows (place, a, n) of crowds of n."""
    blocks = [
        F.struct((F.shiftleft(F.col("k") * 4 + j, 16) + F.shiftrightunsigned("p", 16 * j).bitwiseAND(0xFFFF).cast("int")).alias("place"))
        for j in range(4)
    ]
    listed = nodes.select("number", F.col("prints")[0].alias("first"), F.col("prints")[1].alias("second"), F.posexplode("prints").alias("k", "p"))
    rows = listed.select(F.explode(F.array(*blocks)).alias("m"), "number", "first", "second").select("m.place", "number", "first", "second")
    group = GROUP
    buckets = nodes.count() * 4 * FINGERPRINTS // BUCKET + 1
    dealt = rows.groupBy(F.pmod(F.xxhash64("place"), F.lit(buckets)).cast("int").alias("bucket"))
    return durable(dealt.applyInArrow(lambda table: _met(table, group), "place long, a long, b long, n long"))


def _named(numbered: DataFrame, known: DataFrame, column: str) -> DataFrame:
    return numbered.join(known.select(F.col("number").alias(column), *[F.col(c).alias(f"{column}_{c}") for c in ("node", "prints")]), column)


def _links_in_blocks(sized: DataFrame) -> DataFrame:
    """Verified links between the nodes of ``sized`` (place, node, side, prints, shingles), written, as many as it takes to connect them.

    At a place with both sides, those on side 0 are connected already and are compared with side 1 only; at a place
    of side 1 alone all are compared with each other.
    """
    n = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum(F.size("shingles")) / BLOCK_SHINGLES)).cast("int")
    parts = sized.groupBy("place", "side").agg(n.alias("blocks"), F.count(F.lit(1)).alias("n"))
    known = [F.max(F.when(F.col("side") == s, F.col("blocks"))).alias(f"blocks{s}") for s in (0, 1)]
    sizes = durable(parts.groupBy("place").agg(*known, F.sum("n").alias("n")))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows = dealt_join(sized, sizes.filter("blocks1 is not null"), "place", hot_keys(sizes, "place", total))
    own, cross = F.pmod(F.xxhash64("node"), F.when(F.col("side") == 0, F.col("blocks0")).otherwise(F.col("blocks1"))).cast("int"), F.col("blocks0").isNotNull()
    other = F.when(cross & (F.col("side") == 1), F.col("blocks0")).otherwise(F.col("blocks1"))
    rows = rows.withColumn("own", own).withColumn("cross", cross).withColumn("other", F.explode(F.sequence(F.lit(0), other - 1)))
    one = F.when(~F.col("cross"), F.least("own", "other")).when(F.col("side") == 0, F.col("own")).otherwise(F.col("other"))
    two = F.when(~F.col("cross"), F.greatest("own", "other")).when(F.col("side") == 0, F.col("other")).otherwise(F.col("own"))
    second = F.when(F.col("cross"), F.col("side") == 1).otherwise(F.col("own") != one)
    rows = rows.select("place", one.alias("one"), two.alias("two"), "cross", second.alias("second"), "node.*", "prints", "shingles")

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        prints = table.column("prints").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, FINGERPRINTS)
        held = table.column("shingles").combine_chunks()
        values, edges = held.values.to_numpy(), held.offsets.to_numpy()
        later = table.column("second").to_numpy(zero_copy_only=False)
        _, one, two, cross = (k.as_py() for k in key)
        within = not cross and one == two
        first, second = np.flatnonzero(~later), np.flatnonzero(~later if within else later)
        group = np.arange(len(later))  # of each text the least it is connected with
        if cross and len(first):
            group[first] = first[0]
        a, b = [], []
        for k, i in enumerate(first):
            against = second[k + 1 :] if within else second
            against = against[group[against] != group[i]]
            for j in against[np.bitwise_count(prints[against] ^ prints[i]).sum(axis=1, dtype=np.int64) <= CLOSE_ALL]:
                if group[i] != group[j] and minhash._alike(values[edges[i] : edges[i + 1]], values[edges[j] : edges[j + 1]]):
                    group[group == max(group[i], group[j])] = min(group[i], group[j])
                    a.append(int(i))
                    b.append(int(j))
        nodes = table.select(list(_NODE))
        sides = [c for side in (a, b) for c in nodes.take(pa.array(side, pa.int64())).columns]
        return pa.Table.from_arrays(sides, [f"{x}_{c}" for x in "ab" for c in _NODE])

    found = rows.groupBy("place", "one", "two", "cross").applyInArrow(compare, ", ".join(f"{x}_none boolean, {x}_id long, {x}_mark long" for x in "ab"))
    return durable(found.select(*[F.struct(*[F.col(f"{x}_{c}").alias(c) for c in _NODE]).alias(x) for x in "ab"]))


def crowd_links(crowds: DataFrame, sets: DataFrame) -> list[DataFrame]:
    """Verified links within each of ``crowds`` (place, node, order), each node being in one, as many as connect what all of them would.

    ``sets`` has prints and shingles of each node.
    """

    def sized(sides: DataFrame) -> DataFrame:
        return durable(sides.join(sets.select("node", "prints", "shingles"), "node"))

    sizes = durable(crowds.groupBy("place").agg(F.count(F.lit(1)).alias("n")))
    small = crowds.join(sizes.filter(F.col("n") <= BLOCK), "place", "left_semi")
    found = [_links_in_blocks(sized(small.select("place", "node", F.lit(1).alias("side"))))]
    rest = durable(dealt_join(crowds, sizes.filter(F.col("n") > BLOCK).select("place"), "place", hot_keys(sizes, "place", crowds.count())))
    left = rest.count()
    while left:
        leaders = durable(rest.groupBy("place").agg(F.min(F.struct("order", "node")).alias("l"), F.count(F.lit(1)).alias("n")))
        stars = dealt_join(rest, leaders.select("place", F.col("l.node").alias("a")), "place", hot_keys(leaders, "place", left))
        stars = durable(stars.filter("node <> a").withColumnRenamed("node", "b"))
        near = minhash._near(stars.select("a", "b"), sets)
        found.append(near)
        rest = durable(stars.join(near, ["a", "b"], "left_anti").select("place", F.col("b").alias("node"), "order"))
        before, left = left, rest.count()
        if not left:
            break
        apart = rest.select("place", "node", F.lit(1).alias("side"))
        linked = stars.join(near, ["a", "b"], "left_semi").select("place", F.col("b").alias("node"), F.lit(0).alias("side"))
        found.append(_links_in_blocks(sized(apart.unionByName(linked))))
        if 10 * left > 9 * before:
            # at places with a side 0 only that was compared
            found.append(_links_in_blocks(sized(apart)))
            break
    return found


def links(docs: DataFrame, key: Column, nodes: DataFrame) -> DataFrame:
    """Verified links (a, b) of ``nodes`` (node, number, prints), the rows of ``docs`` with those keys, enough to connect what all would."""
    met = candidates(nodes.filter("size(prints) > 0").select("number", "prints"))
    listed, crowds = met.filter("place is null").select("a", "b").distinct(), met.filter("place is not null").select("place", "a", "n")
    known = durable(sifted(nodes, met.select(F.explode(F.array("a", "b")).alias("number")).filter("number is not null")))
    differ = F.zip_with("a_prints", "b_prints", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    pairs = _named(_named(listed, known, "a"), known, "b").filter(F.aggregate(differ, F.lit(0), lambda n, x: n + x) <= CLOSE_ALL)
    pairs = durable(pairs.select("a", "b", "a_node", "b_node"))
    stars = durable(crowds.select("place", "a").join(crowds.groupBy("place").agg(F.min("a").alias("b")), "place").select("a", "b").distinct())
    hung = durable(connected_components(pairs.select("a", "b").unionByName(stars)).select(F.col("node").alias("number"), F.col("component").alias("place")))
    sizes = durable(hung.groupBy("place").agg(F.count(F.lit(1)).alias("n")))
    hung = dealt_join(hung, sizes, "place", hot_keys(sizes, "place", hung.count()))
    sets = durable(minhash._sets(docs, key, durable(known.join(hung, "number"))))
    out = _links_in_blocks(sets.filter(F.col("n") <= BLOCK).select("place", "node", F.lit(1).alias("side"), "prints", "shingles"))
    if sizes.filter(F.col("n") > BLOCK).isEmpty():
        return out
    sets = durable(sets.filter(F.col("n") > BLOCK))
    names = sets.select(F.col("number").alias("a"), "node")
    out = out.unionByName(minhash._near(pairs.join(names, "a", "left_semi").select(F.col("a_node").alias("a"), F.col("b_node").alias("b")), sets))
    # crowds with a text in common are one, so each text is in one of them
    whole = connected_components(stars.join(names, "a", "left_semi")).select(F.col("node").alias("a"), F.col("component").alias("place"))
    central = crowds.groupBy("a").agg((-F.sum("n")).alias("order"))
    for part in crowd_links(durable(central.join(whole, "a").join(names, "a").select("place", "node", "order")), sets):
        out = out.unionByName(part)
    return out


def keep_representatives(docs: DataFrame) -> DataFrame:
    """One row of every class of near-duplicates, with all columns of ``docs``: the one of the least
    doc_id, null ids last, then of the least hash of the whole row.

    Rows of equal words (A-Z lower-cased) are linked, so those without words keep one row, and so are
    rows whose five-word shingles have similarity 0.8 or more; an empty table keeps none.
    """
    key = row_key(docs)
    # the mark of a row is of all its columns, so rows of one key have one text
    first = F.min(F.struct(F.struct(*_NODE).alias("node"), "prints")).alias("m")
    nodes = durable(_marked(docs, key).groupBy("same").agg(first).select("m.*", F.monotonically_increasing_id().alias("number")))
    linked = connected_components(links(docs, key, nodes))
    gone = linked.filter("node <> component").select("node")
    return rows_of(docs, nodes.select("node").join(gone, "node", "left_anti").select(F.col("node").alias("key")))
