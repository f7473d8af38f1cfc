"""Event-time additions: windows, deduplication and arriving answers, on batches and streams alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def landing(spark: SparkSession, path: str, schema: str, kind: str = "parquet") -> DataFrame:
    """A stream of the files that land in a folder."""
    return spark.readStream.schema(schema).format(kind).load(path)


def timed(events: DataFrame, late: str) -> DataFrame:
    """Events with ``ts`` as an instant; on a stream with a watermark."""
    found = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return found.withWatermark("ts", late) if events.isStreaming else found


def window_counts(events: DataFrame, size: str, *, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Events of each type in tumbling or sliding windows; a stream drops what comes after the watermark."""
    kept = timed(events, late)
    span = F.window("ts", size, slide) if slide else F.window("ts", size)
    return kept.groupBy(span.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def sessions(events: DataFrame, gap: str, *, late: str = "1 hour") -> DataFrame:
    """(user_id, start, end, n): runs of a user's events without a longer gap."""
    kept = timed(events, late)
    return kept.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def first_seen(events: DataFrame, *, late: str = "1 hour") -> DataFrame:
    """Each event id once; a stream remembers ids as long as the watermark asks."""
    return timed(events, late).dropDuplicatesWithinWatermark(["event_id"]) if events.isStreaming else events.dropDuplicates(["event_id"])


def with_answers(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """A stream of requests with the static table of answers; those without one come out null."""
    return requests.join(answers, "id", "left")
