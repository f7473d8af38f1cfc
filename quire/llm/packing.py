"""Best-fit packing by exact-complement hashing.

Documents are tokenised, closed with the end id and cut into pieces of at most ``capacity`` tokens.
How the pieces combine depends only on how many there are of each length, a table of at most
``capacity`` counts.  ``plan`` works on that table alone: single lengths, pairs and triples are
indexed by their sum, each seed looks up its gap there and takes a combination that fills it exactly
as often as the counts allow, and what has no exact complement is packed best-fit.  Its slots say
which ranks of a length go to which sequences, so pieces find their places independently of each
other, without a global sort.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import durable

END_ID = 2
CAPACITY = 1024
TOKENIZER = "byte_bpe_50k.json"

#: Characters of white space in a row that the quicker library is trusted with: its pattern backtracks
#: over the whole run, and one of a million overflows its stack.
MAX_SPACE = 4_096
_SPACE = re.compile(r"\s{64,}")
#: How a byte-level pre-tokenizer splits a text.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, local_rank long"


def _byte_ranks(path: str) -> dict[bytes, int] | None:
    """The vocabulary as ranked byte strings, if the file is plain byte-level BPE in rank order."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    if spec["normalizer"] or pre.get("type") != "ByteLevel" or not pre.get("use_regex") or pre.get("add_prefix_space"):
        return None
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    special = {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(signs[c] for c in token): rank for token, rank in model["vocab"].items() if token not in special}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [model["vocab"]["".join(m)] for m in pairs]
    return ranks if order == sorted(order) and len(ranks) == len(order) + 256 else None


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes.

    Of the two libraries that read this vocabulary the quicker one encodes, where the file is plain
    byte-level BPE; a text with the string of a special token or with a run of more than ``MAX_SPACE``
    characters of white space, and every text of another kind of file, goes to the tokenizer of the
    file itself.  Ids are the same either way.
    """

    def __init__(self, path: str | None) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        self._tokenizer = Tokenizer.from_file(path)
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        ranks = _byte_ranks(path)
        self._quick = ranks and tiktoken.Encoding(path, pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, text: str) -> bytes:
        """The ids of one text, without the end id."""
        if self._quick and not any(s in text for s in self._special) and all(m.end() - m.start() <= MAX_SPACE for m in _SPACE.finditer(text)):
            return array("I", self._quick(text)).tobytes()
        return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


_encoders: dict[str | None, Encoder] = {}


def encoder(path: str | None) -> Encoder:
    """The encoder of this Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def token_pieces(docs: DataFrame, *, tokenizer_path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every document's ids, the end id after them, cut into pieces.

    Columns: doc_id, piece, start, length, ids_crc32 and the piece's ``local_rank`` among those of
    its length in its ``task``.  Only a document of more than ``capacity`` ids is cut; its first
    piece is then the shorter one.  A null or empty text is its end id alone.
    """
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def cut(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        ranks = np.zeros(capacity + 1, dtype=np.int64)
        encode = encoder(tokenizer_path).encode
        for batch in source:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                doc_ids = part.column(0).to_pylist()
                rows: list[tuple] = []
                for doc_id, text in zip(doc_ids, part.column(1).to_pylist(), strict=True):
                    ids = encode(text or "") + end
                    n = len(ids) // 4
                    first = n % capacity or capacity
                    edges = [0, *range(first, n + 1, capacity)] if n > capacity else [0, n]
                    for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                        rows.append((doc_id, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b]), task, int(ranks[b - a])))
                        ranks[b - a] += 1
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                names = [x.split()[0] for x in PIECE_SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECE_SCHEMA)


class Slot(NamedTuple):
    """Pieces of ``length`` from rank ``rank`` on: ``each`` of them at ``offset`` of every sequence from ``sequence`` on."""

    length: int
    rank: int
    sequence: int
    offset: int
    each: int


class _Packing:
    """Counts that are left of each length, and the slots that the rest went to."""

    def __init__(self, counts: np.ndarray) -> None:
        self.left = np.asarray(counts, dtype=np.int64).copy()
        self.used = np.zeros_like(self.left)
        self.slots: list[Slot] = []
        self.sequences = 0

    def put(self, length: int, sequence: int, offset: int, each: int, times: int) -> None:
        """``each`` pieces of ``length`` at ``offset`` of ``times`` sequences from ``sequence`` on."""
        self.slots.append(Slot(length, int(self.used[length]), sequence, offset, each))
        self.used[length] += each * times
        self.left[length] -= each * times

    def take(self, parts: list[int], times: int) -> None:
        """``times`` new sequences of these lengths."""
        offset = 0
        for length in dict.fromkeys(parts):
            each = parts.count(length)
            self.put(length, self.sequences, offset, each, times)
            offset += each * length
        self.sequences += times

    def often(self, parts: list[int]) -> int:
        """How often the counts allow a combination."""
        return min(int(self.left[x]) // parts.count(x) for x in set(parts))


class _Sums:
    """The index: which lengths, pairs and triples of lengths from ``least`` on have a given sum.

    Counts only fall, so an entry of a length that is used up never comes back; it goes when it is met.
    """

    def __init__(self, packing: _Packing, capacity: int, least: int = 1) -> None:
        self._packing, self._left, self._least = packing, packing.left, least
        lengths = np.flatnonzero(packing.left)[::-1]  # the longest first
        lengths = lengths[lengths >= least]
        #: Of each sum, the longer lengths of the pairs.
        self._pairs = [h[(packing.left[s - h] > 0) & (s - h >= least)] for s in range(capacity + 1) for h in [lengths[(2 * lengths >= s) & (lengths < s)]]]
        some = np.asarray([len(h) > 0 for h in self._pairs])
        #: Of each sum, the lengths that a pair completes.
        self._triples = [h[some[s - h]] for s in range(capacity + 1) for h in [lengths[lengths < s]]]

    def _alive(self, s: int) -> np.ndarray:
        high = self._pairs[s]
        self._pairs[s] = high[(self._left[high] > 0) & (self._left[s - high] > (2 * high == s))]
        return self._pairs[s]

    def complement(self, seed: int, gap: int, size: int) -> list[int] | None:
        """The seed and ``size`` lengths that sum to ``gap``, the longest as long as can be."""
        fits = self._packing.often
        if size == 0:
            return [seed] if gap == 0 else None
        if size == 1:
            return [seed, gap] if gap >= self._least and self._left[gap] and fits([seed, gap]) else None
        if size == 2:
            return next((parts for h in self._alive(gap) if fits(parts := [seed, int(h), gap - int(h)])), None)
        alive = self._triples[gap] = self._triples[gap][self._left[self._triples[gap]] > 0]
        dead = set()
        for h in map(int, alive):
            pairs = self._alive(gap - h)
            if not len(pairs):
                dead.add(h)
            for k in map(int, pairs):
                if fits(parts := [seed, h, k, gap - h - k]):
                    self._triples[gap] = alive[[x not in dead for x in alive.tolist()]] if dead else alive
                    return parts
        self._triples[gap] = alive[[x not in dead for x in alive.tolist()]] if dead else alive
        return None


def _exact_first(counts: np.ndarray, capacity: int, least: int, most: int = 3) -> _Packing:
    """Exact complements of up to ``most`` lengths, none below ``least``, then best fit.

    All seeds, the longest first, try single complements before any tries pairs, and pairs before triples.
    """
    packing = _Packing(counts)
    sums = _Sums(packing, capacity, least)
    for size in range(most + 1):
        for seed in range(capacity, least - 1, -1):
            while packing.left[seed] and (parts := sums.complement(seed, capacity - seed, size)) and (times := packing.often(parts)):
                packing.take(parts, times)
    _best_fit(packing, capacity)
    return packing


def _best_fit(packing: _Packing, capacity: int) -> None:
    """What is left, longest first, each piece where the least room remains (best-fit decreasing), by counts.

    Open sequences are held as runs of neighbours with the same room.
    """
    runs: dict[int, list[tuple[int, int]]] = {}  # room: (first sequence, how many)
    for length in range(capacity, 0, -1):
        for room in [*sorted(r for r in runs if r >= length), None]:
            while packing.left[length] and (room is None or runs.get(room)):
                n = int(packing.left[length])
                free = capacity if room is None else room
                each = min(free // length, n)  # a sequence with the least room takes all that fit before the next one
                if room is None:
                    first, times = packing.sequences, n // each
                    packing.sequences += times
                else:
                    first, many = runs[room].pop()
                    times = min(many, n // each)
                    if times < many:
                        runs[room].append((first + times, many - times))
                packing.put(length, first, capacity - free, each, times)
                if free > each * length:
                    runs.setdefault(free - each * length, []).append((first, times))


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[Slot]:
    """Slots for ``counts[n]`` pieces of each length ``n`` up to ``capacity``.

    Exact complements that take short pieces early leave long ones without a fit, so there are several
    tries: all complements, from a fourth, an eighth, a sixteenth of ``capacity`` on and of any length,
    single complements alone, and none.  The first with the fewest sequences counts, so the result is
    never worse than best-fit decreasing; one that needs no more than the tokens do ends the search.
    The number of slots depends on ``capacity`` alone and not on the number of pieces.
    """
    counts = np.asarray(counts, dtype=np.int64)
    bound = -(-int((np.arange(len(counts)) * counts).sum()) // capacity)
    best: _Packing | None = None
    for least, most in (*((max(capacity // part, 1), 3) for part in (4, 8, 16, capacity)), (1, 1), (1, 0)):
        found = _exact_first(counts, capacity, least, most)
        if best is None or found.sequences < best.sequences:
            best = found
        if best.sequences == bound:
            break
    return best.slots


def place(ranked: DataFrame, slots: list[Slot]) -> DataFrame:
    """Add sequence_id and offset to rows with a ``length`` and a ``rank`` within it."""
    slots = sorted(slots)
    table = np.asarray(slots, dtype=np.int64).reshape(-1, 5)
    keys = (table[:, 0] << 44) + table[:, 1]  # ranks of one length stay below 2**44

    def put(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            slot = table[np.searchsorted(keys, (length << 44) + rank, side="right") - 1]
            turn = rank - slot[:, 1]
            columns = [batch.column(x) for x in ("doc_id", "piece", "start", "length", "ids_crc32")]
            columns += [pa.array(slot[:, 2] + turn // slot[:, 4]), pa.array(slot[:, 3] + turn % slot[:, 4] * length)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(put, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack(docs: DataFrame, *, tokenizer_path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.  Null and empty
    texts are one piece, their end id; a text of any length is encoded whole, runs of white space
    included; repeated rows and repeated or null ids are packed row by row; an empty table gives no
    rows.  Other columns are ignored.
    """
    pieces = durable(token_pieces(docs, tokenizer_path=tokenizer_path, capacity=capacity, end_id=end_id))
    tasks = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in tasks.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["n"]
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = tasks.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = pieces.join(starts, ["length", "task"]).withColumn("rank", F.col("first") + F.col("local_rank"))
    return place(ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank"), plan(counts, capacity))
