"""Benchmark decontamination by a distributed positional inverted index.

Documents are indexed in segments of some million words: each holds, for every term, the sorted
positions of the term in the segment.  Segments are written once; any number of searches read them
where they lie, so neither texts nor postings are shuffled.  Within a segment a benchmark window
starts from the postings of its rarest term (by frequency over the whole corpus) and intersects the
others' offset-adjusted lists in order of rarity: what is left are the exact phrase matches.  A
proximity match asks that all words of a window occur, in any order, within its length plus ``slop``
words.

The benchmark is the query side.  It is taken in blocks of ``BLOCK_BYTES`` of text, each of which
is sent to the executors, so that neither their memory nor the driver's depends on its size; all
blocks search the same index, and another benchmark can be searched in it later.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from quire.llm.common import alnum_words, durable, utf8

WINDOW = 8
SLOP = 4
#: Items that a document must hold windows of to count as contaminated.
CONTAMINATED_ITEMS = 2
SEGMENT_WORDS = 1_000_000
BLOCK_BYTES = 4_000_000
#: Empty positions between the documents of a segment, more than any match spans.
GAP = 64

SEGMENT = "task int, part int, doc_ids array<long>, starts array<long>, lengths array<int>, terms array<binary>, freqs array<long>, postings binary"
MATCHES = "task int, part int, nth int, doc_id long, n_words long, items array<string>, near array<string>, spans array<struct<start:int,end:int>>"


class _Ids(dict):
    """A number for each term, in order of first use; known terms are looked up without a call of Python code."""

    def __missing__(self, term: bytes) -> int:
        self[term] = number = len(self)
        return number


def positional_index(docs: DataFrame, *, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """Segments of (doc_id, text) with the postings of all terms.

    (task, part) tells segments apart once they are written: write the index before it is searched.
    """

    def build(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, part = TaskContext.get().partitionId(), 0
        own = _Ids()
        doc_ids, starts, lengths, terms, at, size = [], [], [], [], [], 0

        def segment() -> pa.RecordBatch:
            names = list(own)
            term = np.concatenate(terms) if terms else np.empty(0, np.int32)
            order = np.argsort(term, kind="stable")
            freqs = np.bincount(term, minlength=len(names))
            positions = (np.concatenate(at) if at else np.empty(0, np.int32))[order]
            row = (task, part, doc_ids, starts, lengths, names, freqs.tolist(), positions.tobytes())
            kinds = (pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary())
            columns = [pa.array([x], k) for x, k in zip(row, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in SEGMENT.split(", ")])

        for batch in source:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = alnum_words(text)
                terms.append(np.fromiter(map(own.__getitem__, found), np.int32, len(found)))
                at.append(np.arange(size, size + len(found), dtype=np.int32))
                doc_ids.append(doc_id)
                starts.append(size)
                lengths.append(len(found))
                size += len(found) + GAP
                if size > segment_words:
                    yield segment()
                    part, size = part + 1, 0
                    doc_ids, starts, lengths, terms, at, own = [], [], [], [], [], _Ids()
        if doc_ids:
            yield segment()

    return docs.select(F.col("doc_id").cast("long"), utf8("text")).mapInArrow(build, SEGMENT)


class Window(NamedTuple):
    """A phrase to look for: its words with the offsets, rarest first, and the items that hold it."""

    terms: tuple[bytes, ...]
    offsets: tuple[int, ...]
    items: tuple[int, ...]


def windows_of(items: list[tuple[str, bytes | None]], frequency: dict[bytes, int], window: int = WINDOW) -> list[Window]:
    """All distinct windows of the items; a shorter item is one window, one without words has none."""
    held: dict[tuple[bytes, ...], set[int]] = {}
    for k, (_, text) in enumerate(items):
        found = alnum_words(text)
        for a in range(max(1, len(found) - window + 1) if found else 0):
            held.setdefault(tuple(found[a : a + window]), set()).add(k)
    out = []
    for phrase, owners in held.items():
        order = sorted(range(len(phrase)), key=lambda k: (frequency.get(phrase[k], 0), k))  # noqa: B023
        out.append(Window(tuple(phrase[k] for k in order), tuple(order), tuple(sorted(owners))))
    return out


def _exact(lists: list[np.ndarray], window: Window) -> np.ndarray:
    """Starts of the window's exact occurrences."""
    starts = lists[0] - window.offsets[0]
    for positions, offset in zip(lists[1:], window.offsets[1:], strict=True):
        if not len(starts):
            break
        place = np.minimum(np.searchsorted(positions, starts + offset), len(positions) - 1)
        starts = starts[positions[place] == starts + offset]
    return starts


def _near(lists: list[np.ndarray], span: int) -> np.ndarray:
    """Starts of stretches of ``span`` words that hold a word of every list."""
    starts = np.unique(lists[0][:, None] - np.arange(span))
    for positions in lists[1:]:
        if not len(starts):
            break
        place = np.searchsorted(positions, starts)
        inside = place < len(positions)
        inside[inside] = positions[place[inside]] < starts[inside] + span
        starts = starts[inside]
    return starts


def search(index: DataFrame, items: list[tuple[str, bytes | None]], *, window: int = WINDOW, slop: int | None = SLOP) -> DataFrame:
    """Matches of the items' windows, one row for each indexed document.

    ``spans`` are the word ranges that exact occurrences cover, ``items`` the items with an exact
    occurrence, ``near`` those with a proximity match (none where ``slop`` is None).  (task, part,
    nth) tells rows apart where doc_id does not.
    """
    if slop is not None and window + slop >= GAP:
        raise ValueError(f"window and slop together must stay below {GAP}")
    vocabulary = {w for _, text in items for w in alnum_words(text)}
    wanted = index.sparkSession.createDataFrame([(w,) for w in sorted(vocabulary)], "term binary")
    counts = index.select(F.explode(F.arrays_zip("terms", "freqs")).alias("t")).select(F.col("t.terms").alias("term"), F.col("t.freqs").alias("n"))
    counts = counts.join(F.broadcast(wanted), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("n"))
    frequency = {bytes(r["term"]): r["n"] for r in counts.collect()}  # a block's terms at most
    by_rarest: dict[bytes, list[Window]] = {}
    for w in windows_of(items, frequency, window):
        by_rarest.setdefault(w.terms[0], []).append(w)
    names = [name for name, _ in items]
    terms = pa.array(sorted(vocabulary), pa.binary())

    def find(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for k in range(batch.num_rows):
                yield _matches({c: batch.column(c)[k] for c in batch.schema.names}, by_rarest, terms, names, slop)

    return index.mapInArrow(find, MATCHES)


def _matches(row: dict[str, pa.Scalar], by_rarest: dict[bytes, list[Window]], wanted: pa.Array, names: list[str], slop: int | None) -> pa.RecordBatch:
    freqs, terms = row["freqs"].values.to_numpy(), row["terms"].values
    edges = np.concatenate([[0], np.cumsum(freqs)])
    positions = np.frombuffer(row["postings"].as_buffer(), np.int32)
    held = np.flatnonzero(pc.is_in(terms, value_set=wanted).to_numpy(zero_copy_only=False))  # only these become objects of Python
    lists = {t: positions[edges[k] : edges[k + 1]].astype(np.int64) for t, k in zip(terms.take(pa.array(held)).to_pylist(), held, strict=True)}
    starts, lengths = row["starts"].values.to_numpy(), row["lengths"].values.to_numpy()
    n = len(starts)
    covered = np.zeros(int(starts[-1] + lengths[-1]) + 1, np.int32)
    exact: list[set[int]] = [set() for _ in range(n)]
    near: list[set[int]] = [set() for _ in range(n)]
    for term in by_rarest.keys() & lists.keys():
        for window in by_rarest[term]:
            found = [lists.get(t) for t in window.terms]
            if any(f is None for f in found):
                continue
            hits = _exact(found, window)
            np.add.at(covered, hits, 1)
            np.add.at(covered, hits + len(window.terms), -1)
            docs = np.unique(np.searchsorted(starts, hits, side="right") - 1)
            for doc in docs:
                exact[doc].update(window.items)
            if slop is not None:
                single = [lists[t] for t in dict.fromkeys(window.terms)]
                at = _near(single, len(window.terms) + slop)
                for doc in np.unique(np.searchsorted(starts, at + len(window.terms) + slop - 1, side="right") - 1):
                    near[doc].update(window.items)
    inside = np.concatenate([[0], (np.cumsum(covered) > 0).astype(np.int8), [0]])
    begin, end = np.flatnonzero(np.diff(inside) == 1), np.flatnonzero(np.diff(inside) == -1)
    spans: list[list[dict]] = [[] for _ in range(n)]
    for doc, a, b in zip(np.searchsorted(starts, begin, side="right") - 1, begin, end, strict=True):
        spans[doc].append({"start": int(a - starts[doc]), "end": int(b - starts[doc])})
    columns = [
        pa.array([row["task"].as_py()] * n, pa.int32()),
        pa.array([row["part"].as_py()] * n, pa.int32()),
        pa.array(range(n), pa.int32()),
        row["doc_ids"].values,
        pa.array(lengths, pa.int64()),
        pa.array([sorted({names[k] for k in x}) for x in exact], pa.list_(pa.string())),
        pa.array([sorted({names[k] for k in x}) for x in near], pa.list_(pa.string())),
        pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ]
    return pa.RecordBatch.from_arrays(columns, ["task", "part", "nth", "doc_id", "n_words", "items", "near", "spans"])


def _blocks(items: DataFrame, size: int) -> Iterator[list[tuple[str, bytes | None]]]:
    """The items in blocks of at most ``size`` bytes of text, or one item where that is longer."""
    block: list[tuple[str, bytes | None]] = []
    held = 0
    rows: Iterator[Row] = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), utf8("text").alias("text")).toLocalIterator()
    for row in rows:
        text = None if row["text"] is None else bytes(row["text"])
        if block and held + len(text or b"") > size:
            yield block
            block, held = [], 0
        block.append((row["name"], text))
        held += len(text or b"")
    if block:
        yield block


def benchmark_matches(
    docs: DataFrame, items: DataFrame, *, index: DataFrame | None = None, window: int = WINDOW, slop: int | None = SLOP, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per document: doc_id, n_words, items, near and n_hit, the words inside exact matches.

    ``index`` is the written index of ``docs``; without one it is made here, from texts read once.
    Null texts have no words, on either side; items of equal or null id count as one (null: named by
    the empty string).  Texts of any length are indexed whole.  Repeated documents come out as often
    as they came in.  Without items every document is clean; without documents there are no rows.
    """
    if index is None:
        index = durable(positional_index(docs))
    parts = [search(index, block, window=window, slop=slop) for block in _blocks(items, block_bytes)] or [search(index, [], window=window, slop=slop)]
    out = parts[0]
    if len(parts) > 1:
        lists = [F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("items", "near")]  # an entry for each block
        met = reduce(DataFrame.unionByName, map(durable, parts))
        out = met.groupBy("task", "part", "nth").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), *lists, F.flatten(F.collect_list("spans")).alias("spans"))
    n_hit = F.expr(
        "aggregate(array_sort(spans), struct(0L as n, 0 as last), "
        "(a, s) -> struct(a.n + greatest(s.end - greatest(s.start, a.last), 0) as n, greatest(a.last, s.end) as last), a -> a.n)"
    )
    return out.select("doc_id", "n_words", "items", "near", n_hit.alias("n_hit"))


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any window of the benchmark, with their columns; none of an empty table.

    A document with a window of a single item has leaked that item, so a filter is stricter here than
    the ``contaminated`` mark of the query, which asks for two items.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    mark = F.xxhash64("doc_id", "text")
    marked = docs.select(mark.alias("doc_id"), "text")
    # written, so that its size is known: texts are shuffled for the join only where the marks are too many to broadcast
    out = durable(benchmark_matches(marked, items, slop=None).filter("n_hit > 0").select(F.col("doc_id").alias("mark")).distinct())
    return docs.select(F.struct(*columns).alias("row"), mark.alias("mark")).join(out, "mark", "left_anti").select("row.*")
