"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Each text becomes a vector of variance-stabilised statistics.  Per language and source, the centre
and scatter of its most central ``SUPPORT`` share are sought by concentration steps (the C-steps of
FAST-MCD, Rousseeuw and Van Driessen 1999) from two deterministic starts as in DetMCD (Hubert et al.
2012); the start with the smaller determinant wins and rows beyond a chi-square cut-off of their
squared Mahalanobis distance are rejected.

A step covers all rows of all groups in one aggregation: rows are binned by the logarithm of their
distance, each bin sums its vectors and outer products, and the concentration happens on the bins
(some hundred at most for a group, whatever its size).  The trimmed subset therefore ends at a bin's
edge: it holds the smallest whole number of bins with at least the asked share.

Every language and source has its own estimate, however few its rows: a scatter of ``h`` rows counts
as ``h`` of ``h + PRIOR_ROWS`` parts, the rest being the least deviations ``FLOOR``, so one of few rows
changes smoothly into that of many, and no verdict depends on the size of another group.

Rows stay where they are while models come to them: those of groups with more than a ``HOT``-th of
all rows, fewer than ``HOT`` by count, by broadcast, the others by a join on the group.
"""

from __future__ import annotations

import math
from collections import Counter
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quire.llm.common import batches, durable, utf8

MIN_WORDS = 50
#: Share of a group's rows that the estimate rests on.
SUPPORT = 0.75
#: Rows that the least deviations count as in a group's scatter.
PRIOR_ROWS = 12
#: Groups with more than one in so many rows are joined by broadcast; there are fewer than that.
HOT = 1_024
STEPS = 5
#: Bins for each doubling of a squared distance.
BINS = 8
#: Chance that a clean row of a normal group is rejected.
TAIL = 1e-6
#: Least standard deviation of each statistic: what no group is too uniform for.  One statistic alone
#: needs 7.2 of these for the cut, so from a centre of 0 symbols reach it at 2 %, lines at 42 % and words at 33 %.
FLOOR = (0.12, 0.02, 0.09, 0.08, 0.06, 0.06)

SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_PUNCT = b"!\"'()+,-./:;=?@[\\]^_`{}~"
_CONTINUED = bytes(range(0x80, 0xC0))
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
DIMENSIONS = len(FLOOR)
_BASE_SCHEMA = ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, x array<double>"


def repeated_words(found: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    windows = list(zip(found, found[1:], found[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    total, covered = 0, 0
    for k, window in enumerate(windows):
        if times[window] > 1:
            total += k + 3 - max(k, covered)
            covered = k + 3
    return total


def statistics(text: bytes | None) -> tuple[list[int], bool, list[float]]:
    """The base counts, whether the base rules fail, and the transformed vector."""
    text = text or b""
    found = text.split()
    n = len(found)
    points = len(text.translate(None, _CONTINUED))
    word_chars = points - (len(text) - len(text.translate(None, b" \t\n\v\f\r")))
    n_symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    n_dup = len(lines) - len(set(lines))
    n_repeat = repeated_words(found)
    failed = n < MIN_WORDS or 100 * n_repeat > 50 * n
    upper = len(text) - len(text.translate(None, _UPPER))
    marks = len(text) - len(text.translate(None, _PUNCT))
    chars = max(word_chars, 1)
    x = [math.log(chars / max(n, 1)), *map(math.sqrt, (n_symbols / chars, n_dup / max(len(lines), 1), n_repeat / max(n, 1), upper / chars, marks / chars))]
    return [n, word_chars, n_symbols, n_dup, n_repeat], failed, x


def text_statistics(docs: DataFrame, *keep: F.Column) -> DataFrame:
    """The columns ``keep``, the row's group, and of its text the base counts, base_failed and the vector x.

    A group is a language and a source, null being a value of its own.
    """
    group = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in ("lang", "source")]), {"ignoreNullFields": "false"})
    source = docs.select(utf8("text").alias("__text"), *keep, F.md5(group).alias("grp"))
    names = source.columns[1:]

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [statistics(t) for t in batch.column(0).to_pylist()]
        counts = [pa.array(c, pa.int64()) for c in zip(*(f[0] for f in found), strict=True)]
        failed, x = pa.array([f[1] for f in found]), pa.array([f[2] for f in found], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([*batch.columns[1:], *counts, failed, x], [*names, *BASE, "base_failed", "x"])

    made = StructType.fromDDL(_BASE_SCHEMA)
    return source.mapInArrow(batches(make), StructType([*source.schema.fields[1:], *made.fields]))


class Hot(NamedTuple):
    """The groups with more than one in ``HOT`` of the rows, fewer than ``HOT``, and whether there are others."""

    groups: DataFrame
    others: bool


def hot_groups(rows: DataFrame) -> Hot:
    sizes = durable(rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n")))
    total, every = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    groups = sizes.filter(F.col("n") * HOT > total).select("grp")
    return Hot(groups, groups.count() < every)


def _with_models(rows: DataFrame, models: DataFrame, hot: Hot) -> DataFrame:
    """``rows`` with each model of their group; no row of a hot group is shuffled."""
    if not hot.others:
        return rows.join(F.broadcast(models), "grp")
    marked = rows.join(F.broadcast(hot.groups.withColumn("hot", F.lit(True))), "grp", "left")
    held = models.join(F.broadcast(hot.groups), "grp", "left_semi")
    rest = models.join(F.broadcast(hot.groups), "grp", "left_anti")
    near = marked.filter("hot").drop("hot").join(F.broadcast(held), "grp")
    return near.unionByName(marked.filter("hot is null").drop("hot").join(rest, "grp"))


def _distance(model: str) -> F.Column:
    """Squared Mahalanobis distance of x under a model's centre and flat precision matrix."""
    d = [F.col("x")[i] - F.col(f"{model}.centre")[i] for i in range(DIMENSIONS)]
    terms = [
        d[i] * d[j] * F.col(f"{model}.precision")[i * DIMENSIONS + j] * (1 if i == j else 2)
        for i in range(DIMENSIONS)
        for j in range(i, DIMENSIONS)
    ]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return F.greatest(total, F.lit(0.0))


_MODEL = "grp string, start int, model struct<centre:array<double>,precision:array<double>,logdet:double,scale:double>"
_SUMS = [f"s{i}" for i in range(DIMENSIONS)]
_OUTER = [f"o{i}_{j}" for i in range(DIMENSIONS) for j in range(i, DIMENSIONS)]


def _binned(rows: DataFrame, *by: str) -> DataFrame:
    """Count, sums and outer products of x for each group, start and distance bin."""
    x = [F.col("x")[i] for i in range(DIMENSIONS)]
    sums = [F.sum(x[i]).alias(_SUMS[i]) for i in range(DIMENSIONS)]
    outer = [F.sum(x[i] * x[j]).alias(f"o{i}_{j}") for i in range(DIMENSIONS) for j in range(i, DIMENSIONS)]
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *sums, *outer)


def regular(scatter: np.ndarray, held: int) -> np.ndarray:
    """The scatter of ``held`` rows with least deviations, mixed with these, for a centre that is as uncertain."""
    least = np.asarray(FLOOR) ** 2
    scatter = scatter + np.diag(np.maximum(least - np.diag(scatter), 0))
    return (held * scatter + PRIOR_ROWS * np.diag(least)) / (held + PRIOR_ROWS) * (1 + 1 / held)


def _model_row(grp: str, start: int, centre: np.ndarray, scatter: np.ndarray, held: int, scale: float) -> dict:
    scatter = regular(scatter, held)
    _, logdet = np.linalg.slogdet(scatter)
    precision = np.linalg.inv(scatter)
    return {"grp": grp, "start": start, "model": {"centre": centre.tolist(), "precision": precision.ravel().tolist(), "logdet": float(logdet), "scale": scale}}


def _tail(cut: float) -> float:
    """P(chi-square with DIMENSIONS degrees > cut), for an even number of degrees."""
    half = cut / 2
    return math.exp(-half) * sum(half**k / math.factorial(k) for k in range(DIMENSIONS // 2))


def chi2_cut(share: float) -> float:
    """The quantile of that distribution."""
    low, high = 0.0, 1e4
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _tail(mid) > 1 - share else (low, mid)
    return low


#: Factor that makes a scatter of the central SUPPORT share consistent for a normal group.
_CONSISTENT = SUPPORT / (1 - math.exp(-chi2_cut(SUPPORT) / 2) * sum((chi2_cut(SUPPORT) / 2) ** k / math.factorial(k) for k in range(DIMENSIONS // 2 + 1)))


def _concentrate(bins: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Mean, scatter and number of rows of the nearest bins that hold the asked share of a group."""
    bins = bins.sort_values("bin")
    n = bins["n"].to_numpy()
    last = int(np.searchsorted(np.cumsum(n), math.ceil(SUPPORT * n.sum()))) + 1
    held = bins.iloc[:last]
    total = held["n"].sum()
    centre = held[_SUMS].sum().to_numpy() / total
    scatter = np.zeros((DIMENSIONS, DIMENSIONS))
    for name in _OUTER:
        i, j = map(int, name[1:].split("_"))
        scatter[i, j] = scatter[j, i] = held[name].sum() / total - centre[i] * centre[j]
    return centre, scatter, int(total)


def estimates(rows: DataFrame, hot: Hot) -> DataFrame:
    """(grp, model) of rows (grp, x): the winning estimate of each group; ``hot`` are the groups to broadcast."""
    quantiles = F.percentile_approx(F.col("v"), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(1000)).alias("q")
    spread = rows.select("grp", F.posexplode("x").alias("i", "v")).groupBy("grp", "i").agg(quantiles, F.count(F.lit(1)).alias("n"))

    def first(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        q = np.stack(group.sort_values("i")["q"].to_list())
        deviation = np.maximum((q[:, 2] - q[:, 0]) / 1.349, FLOOR)
        return pd.DataFrame([_model_row(key[0], 0, q[:, 1], np.diag(deviation**2), int(group["n"].iloc[0]), 1.0)])

    start = durable(spread.groupBy("grp").applyInPandas(first, _MODEL))

    def signs(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        """The second start: scatter of the standardised directions from the median, at its scale."""
        row = group.iloc[0]
        deviation = 1 / np.sqrt(np.diag(np.asarray(row["precision"]).reshape(DIMENSIONS, DIMENSIONS)))
        scatter = np.zeros((DIMENSIONS, DIMENSIONS))
        for name in _OUTER:
            i, j = map(int, name[1:].split("_"))
            scatter[i, j] = scatter[j, i] = row[name] / row["n"]
        scatter = scatter * DIMENSIONS * np.outer(deviation, deviation)
        held = int(row["n"])
        plain = _model_row(key[0], 0, np.asarray(row["centre"]), np.diag(deviation**2), held, 1.0)
        return pd.DataFrame([plain, _model_row(key[0], 1, np.asarray(row["centre"]), scatter, held, 1.0)])

    near = _with_models(rows, start, hot)
    norm = F.greatest(F.sqrt(_distance("model")), F.lit(1e-9))
    unit = F.array(*[(F.col("x")[i] - F.col("model.centre")[i]) * F.sqrt(F.col("model.precision")[i * (DIMENSIONS + 1)]) / F.col("norm") for i in range(DIMENSIONS)])
    directions = _binned(near.withColumn("norm", norm).select("grp", unit.alias("x")), "grp")
    models = directions.join(start.select("grp", "model.centre", "model.precision"), "grp").groupBy("grp").applyInPandas(signs, _MODEL)

    def step(key: tuple, bins: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([_model_row(key[0], int(key[1]), *_concentrate(bins), _CONSISTENT)])

    models = durable(models)
    for _ in range(STEPS):
        near = _with_models(rows, models, hot)
        place = F.floor(F.log2(_distance("model") + 1e-6) * BINS).cast("int")
        models = _binned(near.select("grp", "start", "x", place.alias("bin")), "grp", "start", "bin").groupBy("grp", "start").applyInPandas(step, _MODEL)
        models = durable(models)
    best = F.min_by("model", F.struct("model.logdet", "start"))
    return models.groupBy("grp").agg(best.alias("model"))


def judge(rows: DataFrame, models: DataFrame, hot: Hot) -> DataFrame:
    """Rows of ``text_statistics`` with ``distance`` and ``kept``, under the ``fitted`` models.

    Rows that fail the base rules are not kept, and have no distance.
    """
    judged = _with_models(rows.filter("not base_failed"), models, hot).withColumn("distance", _distance("model") / F.col("model.scale"))
    judged = judged.withColumn("kept", F.col("distance") <= chi2_cut(1 - TAIL)).drop("model")
    failed = rows.filter("base_failed").withColumns({"distance": F.lit(None).cast("double"), "kept": F.lit(False)})
    return judged.unionByName(failed)


def fitted(rows: DataFrame) -> tuple[DataFrame, Hot]:
    """The models of the groups, and the hot groups; estimates rest on the rows that pass the base rules."""
    sound = rows.filter("not base_failed").select("grp", "x")
    hot = hot_groups(sound)
    return durable(estimates(sound, hot)), hot


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, kept and distance.

    A null text has no words and fails, as empty ones do; a text of any length is read whole.  Null
    languages and sources are values of their own, and a group of a single row has an estimate, too.
    Equal rows are judged alike; other columns are ignored; an empty table gives no rows.
    """
    rows = durable(text_statistics(docs, F.col("doc_id").cast("long").alias("doc_id")))
    return judge(rows, *fitted(rows)).select("doc_id", *BASE, "base_failed", "kept", "distance")


def keep_sound(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns; repeated rows stay repeated, none of an empty table.

    Statistics are taken anew where the verdict falls, so that no text is shuffled or stored for it
    but those of groups too small to be hot.
    """
    models = fitted(durable(text_statistics(docs).select("grp", "base_failed", "x")))
    rows = text_statistics(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).filter("not base_failed")
    return judge(rows, *models).filter("kept").select("row.*")
