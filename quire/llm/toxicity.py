"""Toxicity by non-negative positive-unlabelled learning.

A linear model over hashed word features is trained in numpy from confirmed toxic texts and
unlabelled ones.  The risk estimator is that of Kiryo et al. 2017: ``prior * P+ + max(0, U- - prior
* P-)``, where P and U are mean losses of the positive and the unlabelled sample and ``prior`` is
the share of toxic texts among labelled rows; where the corrected negative risk falls below zero, a
step undoes that instead of fitting further.

Only the fit sees a sample: at most ``MAX_POSITIVE`` and ``MAX_UNLABELLED`` texts, those of the
least hash, of each the ``MAX_WORDS`` distinct words of the least hash, so that what the driver gets
is bounded in bytes.  The prior counts the labels of all documents at hand and the scores are of all
documents, whole texts.
"""

from __future__ import annotations

import heapq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import alnum_words, batches, durable, utf8

MAX_POSITIVE = 4_000
MAX_UNLABELLED = 8_000
#: Distinct words of a text that the fit sees: 12,000 texts of 3,000 features of four bytes are 144 MB at most.
MAX_WORDS = 1_000
#: Rows whose crc32(doc_id as text) leaves 0 modulo this are held out.
FOLDS = 5
BITS = 18
#: Lengths in bytes of the word beginnings that are features beside the whole word.
PREFIXES = (4, 5)
STEPS = 600
BATCH = 1_024
RATE = 0.1
DECAY = 1e-5
#: A feature counts if so many toxic texts have it, and it is so many times as common there.
MIN_TEXTS = 3
MIN_LIFT = 3.0
#: Words whose features or weights a Python worker remembers.
CACHE_WORDS = 300_000
_FEATURES = 1 + len(PREFIXES)


def held_out(column: str = "doc_id") -> F.Column:
    """True for rows that no label may be learnt from; a null id is held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


class _Features(dict):
    """Feature numbers of a word."""

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        marks = [word, *(b"%d " % n + word[:n] for n in PREFIXES)]
        found = tuple(xxhash.xxh32_intdigest(m) >> (32 - BITS) for m in marks)
        if len(self) < CACHE_WORDS:
            self[word] = found
        return found


class _Weights(dict):
    """Summed weights of a word's features."""

    def __init__(self, weights: np.ndarray) -> None:
        super().__init__()
        self._weights, self._features = weights, _Features()

    def __missing__(self, word: bytes) -> float:
        found = float(self._weights[list(_Features.__missing__(self._features, word))].sum())
        if len(self) < CACHE_WORDS:
            self[word] = found
        return found


class Model(NamedTuple):
    weights: np.ndarray
    bias: float

    def scorer(self):
        """Function from a text to its score between 0 and 1."""
        of = _Weights(self.weights)

        def score(text: bytes | None) -> float:
            found = set(alnum_words(text))
            z = self.bias + (sum(map(of.__getitem__, found)) / len(found) ** 0.5 if found else 0.0)
            return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))

        return score


class _Sample:
    """Texts as rows of a sparse matrix of the features that count, scaled by their distinct words."""

    def __init__(self, texts: list[np.ndarray], number: np.ndarray) -> None:
        self.scales = np.asarray([max(len(t) / _FEATURES, 1) ** -0.5 for t in texts])
        self.rows = [n[n >= 0] for n in (number[t] for t in texts)]

    def batch(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features, the batch row of each, and its value."""
        rows = [self.rows[k] for k in chosen]
        sizes = [len(r) for r in rows]
        return np.concatenate(rows).astype(np.int64), np.repeat(np.arange(len(rows)), sizes), np.repeat(self.scales[chosen], sizes)


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, *, seed: int = 42) -> Model:
    """Minimise the non-negative risk by Adam; features are drawn in batches with a fixed seed."""
    every = np.zeros(1 << BITS, np.float32)
    if not positive or not unlabelled or not 0 < prior < 1:
        return Model(every, -60.0)
    toxic, plain = (np.bincount(np.concatenate([np.unique(r) for r in rows]), minlength=len(every)) for rows in (positive, unlabelled))
    lift = (toxic + 0.5) / (len(positive) + 1) / ((plain + 0.5) / (len(unlabelled) + 1))
    used = np.flatnonzero((toxic >= MIN_TEXTS) & (lift > MIN_LIFT))
    number = np.full(len(every), -1)
    number[used] = np.arange(len(used))
    size = len(used)
    weights, bias = np.zeros(size), 0.0
    rng = np.random.default_rng(seed)
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    samples = _Sample(positive, number), _Sample(unlabelled, number)
    for step in range(1, STEPS + 1):
        parts = []
        for s in samples:
            chosen = rng.choice(len(s.rows), min(BATCH, len(s.rows)), replace=False)
            index, of, value = s.batch(chosen)
            z = bias + np.bincount(of, weights=weights[index] * value, minlength=len(chosen))
            parts.append((index, of, value, 1 / (1 + np.exp(-np.clip(z, -60, 60))), len(chosen), z))
        (pi, po, pv, pp, pn, pz), (ui, uo, uv, up, un, uz) = parts
        negative = np.logaddexp(0, uz).mean() - prior * np.logaddexp(0, pz).mean()
        if negative >= 0:  # prior * P+ + U- - prior * P-
            gp, gu = prior * ((pp - 1) - pp) / pn, up / un
        else:  # undo the negative part
            gp, gu = prior * pp / pn, -up / un
        grad = np.bincount(pi, weights=gp[po] * pv, minlength=size) + np.bincount(ui, weights=gu[uo] * uv, minlength=size)
        grad = np.append(grad + DECAY * weights, gp.sum() + gu.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    every[used] = weights
    return Model(every, float(bias))


def _featured(docs: DataFrame, max_words: int) -> DataFrame:
    """Feature numbers of each text's distinct words, at most ``max_words`` of them."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        of = _Features().__getitem__
        texts = [set(alnum_words(t)) for t in batch.column(1).to_pylist()]
        chosen = [heapq.nsmallest(max_words, t, key=xxhash.xxh64_intdigest) if len(t) > max_words else t for t in texts]
        rows = [[f for w in sorted(t) for f in of(w)] for t in chosen]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int32()))], ["positive", "features"])

    return docs.select("positive", utf8("text")).mapInArrow(batches(make), "positive boolean, features array<int>")


def train(docs: DataFrame, labels: DataFrame, *, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED, max_words: int = MAX_WORDS) -> Model:
    """Fit on the training rows of ``docs``; labels of null ids, of null marks or of no document do not count.

    Repeated ids of ``labels`` count as toxic if any row does; of repeated ids of ``docs`` the sample
    has one text, that of the least hash.  Without toxic or other texts every score is next to zero.
    """
    known = labels.filter(~held_out() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    ids = docs.filter(~held_out()).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    known = durable(known.join(ids, "doc_id", "left_semi"))
    share = known.agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0]
    rank = F.xxhash64(F.col("doc_id"), F.lit("sample"))
    toxic = known.filter("toxic > 0").orderBy(rank, "doc_id").limit(max_positive).select("doc_id", F.lit(True).alias("positive"))
    # the corpus is sampled without regard to labels
    plain = ids.orderBy(rank, "doc_id").limit(max_unlabelled).select("doc_id", F.lit(False).alias("positive"))
    chosen = F.broadcast(toxic.unionByName(plain))  # bounded by the two parameters
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(chosen, "doc_id")
    texts = texts.groupBy("doc_id", "positive").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    sample = _featured(texts, max_words).toArrow()
    positive = np.asarray(sample.column("positive").to_pylist(), dtype=bool)
    lists = sample.column("features").combine_chunks() if sample.num_rows else None
    rows = [] if lists is None else np.split(lists.values.to_numpy(), lists.offsets.to_numpy()[1:-1])
    order = sorted(range(len(rows)), key=lambda k: (len(rows[k]), rows[k].tobytes()))  # not of the tasks' order
    return fit([rows[k] for k in order if positive[k]], [rows[k] for k in order if not positive[k]], share or 0.0)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, from its text alone.

    Null and empty texts score the model's bias; a text of any length is scored whole; equal texts
    score alike and repeated rows come out as often as they came in; other columns are ignored, those
    named like a result too; an empty table gives no rows.
    """

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        of = model.scorer()
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([of(t) for t in batch.column(2).to_pylist()], pa.float64())], ["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), utf8("text"))
    scored = rows.mapInArrow(batches(make), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
