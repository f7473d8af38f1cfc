"""Substring dedup with fixed-block anchors.

A window of ``2 * BLOCK`` words holds a whole block of its document, if documents are cut into
blocks of ``BLOCK`` words.  So the non-overlapping blocks of all documents are the index, and every
rolling window of ``BLOCK`` words probes it: a key that is a block of one document and stands in
another one is an anchor, and any repeated window holds one.  Anchors are extended by their
neighbourhood, all windows around one, until those stop to repeat; what windows of a smaller doc_id
cover is a union of maximal exact repeats.

Keys never meet pairwise: a key or window is reduced to its least doc_id, first within a group of
documents, then over all groups, so that a passage of a third of all documents costs one entry for
each group.  Entries travel packed, a binary row for each group of documents and bucket of keys.
Texts are shuffled once, by group; the three steps that need them share that exchange.  There are as
many groups, buckets and tasks as it takes for a group to hold ``GROUP_BYTES`` of text, so that what a
task reads and holds does not grow with the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import batches, shuffle_partitions, utf8, words

WINDOW = 50
BLOCK = WINDOW // 2
#: Text of a group of documents.
GROUP_BYTES = 8_000_000
#: Bits of a block's key: of 10^13 windows about one in 10^4 is an anchor by chance, and extension drops it.
KEY_BITS = 52
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd, so they have inverses


class _Powers:
    """Powers of the two bases and of their inverses, as far as the longest text so far."""

    def __init__(self) -> None:
        self.n = 0

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = 1 << n.bit_length()
            lanes = [np.full((2, self.n), 1, np.uint64), np.full((2, self.n), 1, np.uint64)]
            for lane, base in enumerate(_BASES):
                lanes[0][lane, 1:] = base
                lanes[1][lane, 1:] = pow(base, -1, 1 << 64)
            self.up, self.down = (np.cumprod(x, axis=1, dtype=np.uint64) for x in lanes)
        return self.up[:, :n], self.down[:, :n]


_powers = _Powers()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Rolled:
    """The words of a text and the prefix sums from which windows of any length are hashed."""

    def __init__(self, text: bytes | None) -> None:
        self.words = words(text)
        n = len(self.words)
        digests = b"".join(map(xxhash.xxh3_128_digest, self.words))
        values = np.frombuffer(digests, "<u8").reshape(n, 2).T
        up, self._down = _powers.get(n + 1)
        self._sums = np.zeros((2, n + 1), np.uint64)
        np.cumsum(values * up[:, :n], axis=1, out=self._sums[:, 1:])

    def hashes(self, length: int) -> np.ndarray:
        """Two 64-bit hashes of each window of ``length`` words; no window, no column."""
        n = len(self.words) - length + 1
        if n < 1:
            return np.empty((2, 0), np.uint64)
        return _mix((self._sums[:, length:] - self._sums[:, :-length]) * self._down[:, :n])


def _keys(rolled: Rolled, block: int) -> np.ndarray:
    """The key of each rolling block window."""
    return rolled.hashes(block)[0] >> np.uint64(64 - KEY_BITS)


def _bucket(hashes: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """The bucket of each hash of so many bits; buckets are ranges of hashes."""
    return (((hashes >> np.uint64(bits - 32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys as the steps between them, byte by byte of all: the high bytes are mostly zero and cost nothing."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return steps.view(np.uint8).reshape(-1, 8).T[: -(-KEY_BITS // 8)].tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(-(-KEY_BITS // 8), -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, : len(planes)] = planes.T
    return np.cumsum(steps.view(np.uint64)[:, 0], dtype=np.uint64)


def _runs(changed: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal entries, given where an entry differs from the one before."""
    return np.flatnonzero(np.concatenate([[True], changed]))


def _by_bucket(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """Each bucket's slice of entries sorted by bucket."""
    edges = np.searchsorted(bucket, np.arange(buckets + 1))
    for k in np.flatnonzero(np.diff(edges)):
        yield int(k), slice(int(edges[k]), int(edges[k + 1]))


def _texts(table: pa.Table) -> Iterator[tuple[int | None, bytes | None]]:
    for batch in table.to_batches(max_chunksize=64):
        yield from zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)


def _uncut(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The rows that no window can cut."""
    kept = [words(t) for t in batch.column(1).to_pylist()]
    rows = [(doc_id, len(w), 0, [], b" ".join(w)) for doc_id, w in zip(batch.column(0).to_pylist(), kept, strict=True)]
    return _table(rows, CUT, CUT_TYPES).combine_chunks().to_batches()[0]


def repeated_passages(docs: DataFrame, *, window: int = WINDOW, groups: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, spans (word ranges) and kept_text.

    A word is removed if a window of ``window`` words covers it whose words, in order, also stand in
    a document of a smaller doc_id; windows are judged on the input.  Windows that repeat within
    one document only stay, as do those of equal doc_ids.  A document of null doc_id is neither a
    reference nor cut.  Null texts have no words; an empty table gives no rows.
    """
    block = window // 2
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))
    if groups is None:
        size = every.agg(F.sum(F.length("text"))).first()[0] or 0
        groups = max(shuffle_partitions(docs.sparkSession), -(-size // GROUP_BYTES))
    buckets = groups
    known = every.filter("doc_id is not null")
    grouped = known.withColumn("grp", F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(groups)).cast("int")).repartition(groups, "grp")

    def probe(table: pa.Table) -> pa.Table:
        """Distinct keys of a group: are they a block here (1), do several documents have them (2)?"""
        grp = table.column("grp")[0].as_py()
        keys, owners, blocks = [], [], []
        for nth, (doc_id, text) in enumerate(_texts(table)):
            if len(k := _keys(Rolled(text), block)):
                keys.append(k)
                owners.append(np.full(len(k), nth, np.int32))
                blocks.append(np.arange(len(k)) % block == 0)
        rows: list[tuple] = []
        if keys:
            key, owner, is_block = np.concatenate(keys), np.concatenate(owners), np.concatenate(blocks)
            keys = owners = blocks = None
            order = np.argsort(key, kind="stable")
            key, owner, is_block = key[order], owner[order], is_block[order]
            at = _runs(key[1:] != key[:-1])
            several = np.minimum.reduceat(owner, at) != np.maximum.reduceat(owner, at)
            flags = np.logical_or.reduceat(is_block, at).astype(np.uint8) + 2 * several.astype(np.uint8)
            key = key[at]
            for k, s in _by_bucket(_bucket(key, KEY_BITS, buckets), buckets):
                rows.append((k, grp, _packed(key[s]), np.packbits(np.unpackbits(flags[s, None], axis=1)[:, 6:]).tobytes()))
        return _table(rows, ("bucket", "grp", "keys", "flags"), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))

    def anchors(table: pa.Table) -> pa.Table:
        """Which of each group's keys are a block somewhere and stand in several documents."""
        grps = table.column("grp").to_pylist()
        keys = [_unpacked(x) for x in table.column("keys").to_pylist()]
        flags = [np.unpackbits(np.frombuffer(x, np.uint8), count=2 * len(k)).reshape(-1, 2) for k, x in zip(keys, table.column("flags").to_pylist(), strict=True)]
        key, flag = np.concatenate(keys), np.concatenate(flags)
        row = np.repeat(np.arange(len(keys), dtype=np.int32), [len(k) for k in keys])
        order = np.argsort(key, kind="stable")
        key, flag, row = key[order], flag[order], row[order]
        at = _runs(key[1:] != key[:-1])
        times = np.diff(np.append(at, len(key)))
        several, is_block = np.bitwise_or.reduceat(flag[:, 0], at) > 0, np.bitwise_or.reduceat(flag[:, 1], at) > 0
        good = np.repeat(((times > 1) | several) & is_block, times)
        key, row = key[good], row[good]
        order = np.argsort(row, kind="stable")
        key, row = key[order], row[order]
        rows = [(grps[k], _packed(key[s])) for k, s in _by_bucket(row, len(keys))]
        return _table(rows, ("grp", "keys"), (pa.int32(), pa.binary()))

    def extend(table: pa.Table, found: pa.Table) -> pa.Table:
        """Distinct windows around a group's anchors, with the least doc_id of each in the group."""
        if not table.num_rows or not found.num_rows:
            return _table([], WINDOWS, WINDOW_TYPES)
        grp = table.column("grp")[0].as_py()
        anchor = np.sort(np.concatenate([_unpacked(x) for x in found.column("keys").to_pylist()]))
        lanes, owners = [], []
        for doc_id, text in _texts(table):
            rolled = Rolled(text)
            n = len(rolled.words) - window + 1
            if n < 1:
                continue
            key = _keys(rolled, block)
            hit = anchor[np.minimum(np.searchsorted(anchor, key), len(anchor) - 1)] == key
            before = np.concatenate([[0], np.cumsum(hit)])
            near = before[window - block + 1 :][:n] > before[:n]
            lanes.append(rolled.hashes(window)[:, near])
            owners.append(np.full(lanes[-1].shape[1], doc_id, np.int64))
        rows: list[tuple] = []
        if lanes and sum(map(len, owners)):
            (h, g), owner = np.concatenate(lanes, axis=1), np.concatenate(owners)
            order = np.lexsort((g, h))
            h, g, owner = h[order], g[order], owner[order]
            at = _runs((h[1:] != h[:-1]) | (g[1:] != g[:-1]))
            least = np.minimum.reduceat(owner, at)
            several = least != np.maximum.reduceat(owner, at)
            h, g = h[at], g[at]
            for k, s in _by_bucket(_bucket(h, 64, buckets), buckets):
                rows.append((k, grp, h[s].tobytes(), g[s].tobytes(), least[s].tobytes(), several[s].tobytes()))
        return _table(rows, WINDOWS, WINDOW_TYPES)

    def least(table: pa.Table) -> pa.Table:
        """For each group, its windows of which it has a document beyond the least of all groups."""
        grps = table.column("grp").to_pylist()
        h, g, owner, several = (np.concatenate([np.frombuffer(x, t) for x in table.column(c).to_pylist()]) for c, t in (("h", np.uint64), ("g", np.uint64), ("owner", np.int64), ("several", np.bool_)))
        row = np.repeat(np.arange(len(grps), dtype=np.int32), [len(x) // 8 for x in table.column("h").to_pylist()])
        order = np.lexsort((g, h))
        h, g, owner, several, row = h[order], g[order], owner[order], several[order], row[order]
        at = _runs((h[1:] != h[:-1]) | (g[1:] != g[:-1]))
        first = np.repeat(np.minimum.reduceat(owner, at), np.diff(np.append(at, len(h))))
        good = (first < owner) | several
        h, g, first, row = h[good], g[good], first[good], row[good]
        order = np.argsort(row, kind="stable")
        h, g, first, row = h[order], g[order], first[order], row[order]
        rows = [(grps[k], h[s].tobytes(), g[s].tobytes(), first[s].tobytes()) for k, s in _by_bucket(row, len(grps))]
        return _table(rows, ("grp", "h", "g", "owner"), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))

    def cut(table: pa.Table, found: pa.Table) -> pa.Table:
        h, g, owner = (np.concatenate([np.frombuffer(x, t) for x in found.column(c).to_pylist()]) if found.num_rows else np.empty(0, t) for c, t in (("h", np.uint64), ("g", np.uint64), ("owner", np.int64)))
        order = np.lexsort((g, h))
        h, g, owner = h[order], g[order], owner[order]
        rows: list[tuple] = []
        for doc_id, text in _texts(table):
            rolled = Rolled(text)
            n = len(rolled.words)
            covered = np.zeros(n + 1, np.int32)
            if len(h) and n >= window:
                mine = rolled.hashes(window)
                place = np.minimum(np.searchsorted(h, mine[0]), len(h) - 1)
                starts = np.flatnonzero((h[place] == mine[0]) & (g[place] == mine[1]) & (owner[place] < doc_id))
                np.add.at(covered, starts, 1)
                np.add.at(covered, starts + window, -1)
            gone = np.cumsum(covered)[:n] > 0
            edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
            spans = [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]
            kept = b" ".join(rolled.words) if not spans else b" ".join(w for w, x in zip(rolled.words, gone, strict=True) if not x)
            rows.append((doc_id, n, int(gone.sum()), spans, kept))
        return _table(rows, CUT, CUT_TYPES)

    probes = grouped.groupBy("grp").applyInArrow(probe, "bucket int, grp int, keys binary, flags binary")
    shared = probes.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(anchors, "grp int, keys binary")
    near = grouped.groupBy("grp").cogroup(shared.groupBy("grp")).applyInArrow(extend, "bucket int, grp int, h binary, g binary, owner binary, several binary")
    repeats = near.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(least, "grp int, h binary, g binary, owner binary")
    out = grouped.groupBy("grp").cogroup(repeats.groupBy("grp")).applyInArrow(cut, CUT_SCHEMA)
    rest = every.filter("doc_id is null").mapInArrow(batches(_uncut), CUT_SCHEMA)
    return out.unionByName(rest).select("doc_id", "n_words", "n_removed", "spans", F.col("kept").cast("string").alias("kept_text"))


CUT = ("doc_id", "n_words", "n_removed", "spans", "kept")
CUT_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.binary())
CUT_SCHEMA = "doc_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept binary"
WINDOWS = ("bucket", "grp", "h", "g", "owner", "several")
WINDOW_TYPES = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())


def _table(rows: list[tuple], names: tuple[str, ...], kinds: tuple[pa.DataType, ...]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else ([] for _ in names)
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], list(names))
