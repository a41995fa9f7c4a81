"""Sessions of use: events of one user with no longer pause than a gap between them, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def sessions(events: DataFrame, user: list[str], time: str, gap: str, measures: dict[str, Column]) -> DataFrame:
    """``(user, session_start, session_end, events, measures)`` of events, a stream with a watermark or a table.

    A session ends ``gap`` after its last event. Measures are aggregates over a session's events.
    Events without a time belong to no session.
    """
    window = F.session_window(F.col(time), gap)
    grouped = events.groupBy(*user, window.alias("w")).agg(F.count("*").alias("events"), *(c.alias(n) for n, c in measures.items()))
    return grouped.select(*user, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "events", *measures)


def stream_sessions(
    spark: SparkSession,
    source: str,
    schema: str,
    target: str,
    checkpoint: str,
    user: list[str],
    time: str,
    gap: str,
    delay: str,
    measures: dict[str, Column],
    files_per_batch: int = 100,
) -> StreamingQuery:
    """Sessions of the JSON files in ``source``, written to ``target`` once no event can change them, then stop.

    An event may be late by ``delay``. Only open sessions are held as state: what ended more than
    that before the newest event is written and forgotten. Later runs go on from the checkpoint.
    """
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(source)
    return (
        sessions(events.withWatermark(time, delay), user, time, gap, measures)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
