"""Resumable state: run-state folds, pending requests, freshness, attempts; batch and streaming.

Streams keep the batch meaning: each function that folds takes a DataFrame, and ``stream_states``
runs the same fold with keyed state.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATUSES = ("failed", "gap", "pending", "translated")
#: Statuses that end an attempt.
ATTEMPTS = ("translated", "failed")
TRANSIENT = (429, 500, 503, 529)
HINTS = {401: "check the credentials", 403: "check the permissions", 404: "check the model's name", 413: "send less at once"}


def chunk_events(events: DataFrame) -> DataFrame:
    """Driver events as (chunk, seq, status, error)."""
    kind = F.col("event_type")
    status = F.when(kind == "signup", "pending").when(kind == "purchase", "translated").when(kind == "error", "failed").otherwise("gap")
    return events.select(F.col("user_id").alias("chunk"), F.col("event_id").alias("seq"), status.alias("status"), F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("error"))


def folded(events: DataFrame) -> DataFrame:
    """(chunk, status, attempts, last_error): the last status, the attempts so far, and the error if it failed."""
    last = F.max_by(F.struct("status", "error"), "seq")
    state = events.groupBy("chunk").agg(last.alias("last"), F.count_if(F.col("status").isin(*ATTEMPTS)).alias("attempts"))
    return state.select("chunk", "last.status", "attempts", F.when(F.col("last.status") == "failed", F.col("last.error")).alias("last_error"))


def stream_states(events: DataFrame) -> DataFrame:
    """The fold of ``folded`` over a stream: each micro-batch updates the chunks it has events of."""

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seq, status, attempts, error = state.get if state.exists else (-1, "", 0, None)
        for batch in batches:
            attempts += int(batch["status"].isin(ATTEMPTS).sum())
            last = batch.loc[batch["seq"].idxmax()]
            if last["seq"] > seq:
                seq, status, error = int(last["seq"]), last["status"], last["error"] if last["status"] == "failed" else None
        state.update((seq, status, attempts, error))
        yield pd.DataFrame({"chunk": [key[0]], "status": [status], "attempts": [attempts], "last_error": [error]})

    kinds = "chunk long, status string, attempts long, last_error string"
    return events.groupBy("chunk").applyInPandasWithState(fold, kinds, "seq long, status string, attempts long, last_error string", "update", GroupStateTimeout.NoTimeout)


def pending(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """Requests without an answer, each once; an answered one is never asked again."""
    return requests.select("id").distinct().join(answers.select("id"), "id", "left_anti")


def answered(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """Requests with their first answer."""
    first = answers.groupBy("id").agg(F.min_by("answer", "seq").alias("answer"))
    return requests.join(first, "id")


def barrier(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """One row: the requests that still wait, and whether the next stage may begin."""
    return pending(requests, answers).agg(F.count(F.lit(1)).alias("waiting")).withColumn("open", F.col("waiting") == 0)


def stale(source: DataFrame, made: DataFrame, *, strict: bool = False) -> DataFrame:
    """Sources (key, changed) whose output is missing or older; ``strict`` asks for a newer one."""
    fresh = F.col("made") > F.col("changed") if strict else F.col("made") >= F.col("changed")
    return source.join(made, "key", "left").filter(~F.coalesce(fresh, F.lit(False)))


def last_attempts(attempts: DataFrame, *, most: int) -> DataFrame:
    """(id, outcome, attempts): the last outcome of each request, and its attempts up to the budget."""
    found = attempts.groupBy("id").agg(F.max_by("outcome", "seq").alias("outcome"), F.count(F.lit(1)).alias("n"))
    return found.select("id", "outcome", F.least("n", F.lit(most)).cast("long").alias("attempts"))


def polled(answers: DataFrame, *, terminal: tuple[str, ...] = ("done", "failed")) -> DataFrame:
    """(batch, done, failed, waiting, ended): what the polls (batch, part, seq, state) of a batch have come to.

    A part is in the state of its last poll.  A batch has ended when no part waits, ``ended`` being the
    poll that said so; parts that failed do not keep the others back.
    """
    last = answers.groupBy("batch", "part").agg(F.max_by("state", "seq").alias("state"), F.min(F.when(F.col("state").isin(*terminal), F.col("seq"))).alias("since"))
    count = [F.count_if(F.col("state") == s).alias(s) for s in terminal]
    rest = F.count_if(~F.col("state").isin(*terminal)).alias("waiting")
    return last.groupBy("batch").agg(*count, rest, F.max("since").alias("latest")).select("batch", *terminal, "waiting", F.when(F.col("waiting") == 0, F.col("latest")).alias("ended"))


def resumed(sources: DataFrame, recorded: DataFrame, polls: DataFrame) -> DataFrame:
    """(source, batch, step) of sources (source, digest): what to do with each.

    A source whose batch is on record (source, digest, batch) under the same digest is ``collect``-ed if that has ended and
    ``poll``-ed if not; without a record, or with one of another digest, it is ``submit``-ted anew.
    """
    known = recorded.select("source", "digest", "batch").join(polled(polls).select("batch", F.col("ended").isNotNull().alias("over")), "batch", "left")
    met = sources.select("source", "digest").join(known, ["source", "digest"], "left")
    step = F.when(F.col("batch").isNull(), "submit").when(F.coalesce("over", F.lit(False)), "collect").otherwise("poll")
    return met.select("source", "batch", step.alias("step"))


def error_class(status: Column) -> Column:
    """``transient`` statuses are tried again, others are ``permanent``; null is no error."""
    return F.when(status.isin(*TRANSIENT), "transient").when(status.isNotNull(), "permanent")


def hint(status: Column, message: Column) -> Column:
    """The message, and what to do about a status that is known."""
    known = F.try_element_at(F.create_map(*[F.lit(x) for p in HINTS.items() for x in p]), status)
    return F.concat_ws(": ", message, known)


def accepted_follow_ups(before: DataFrame, after: DataFrame, answers: DataFrame) -> DataFrame:
    """Follow-up answers (key) whose own conflict went and that made no new one; both sides are (variant, key) conflicts."""
    mine = answers.join(after, ["variant", "key"], "left_anti")
    fresh = after.join(before.select("key").distinct(), "key", "left_anti").select("variant").distinct()
    return mine.join(fresh, "variant", "left_anti")


def upsert_stream(source: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream of new answers to a Parquet table, all there is, and stop; a rerun goes on after it."""
    return source.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
