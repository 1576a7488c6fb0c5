"""I8: velocity monitoring with event-time windows.

Tumbling 1 h and sliding 24 h (1 h step) windows per user, with a watermark
so that state for closed windows is dropped and rows later than the
watermark are ignored. The batch twin computes the same counts with
``groupBy(window(...))`` over a static DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hourly_counts(df: DataFrame, user: str, ts: str) -> DataFrame:
    """Rows per (user, 1-hour tumbling window); works on batch and stream."""
    w = F.window(F.col(ts), "1 hour")
    return df.where(F.col(ts).isNotNull()).groupBy(F.col(user).alias("user_id"), w.alias("w")).agg(
        F.count(F.lit(1)).cast("bigint").alias("txn_count")
    )


def daily_sliding_counts(df: DataFrame, user: str, ts: str) -> DataFrame:
    """Rows per (user, 24-hour window sliding by 1 hour), summed from the hourly counts.

    Only an hour's count is copied into its 24 windows, never a row. On a stream these are two stateful
    aggregates in a row; an hour reaches the second one when the watermark has passed its end.
    """
    hours = hourly_counts(df, user, ts)
    w = F.window(F.window_time("w"), "24 hours", "1 hour")
    return hours.groupBy("user_id", w.alias("day")).agg(F.sum("txn_count").cast("bigint").alias("txn_count")).withColumnRenamed("day", "w")


def flatten(df: DataFrame) -> DataFrame:
    """Window struct → epoch seconds of its start (time-zone free)."""
    start = F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("w.start").cast("timestamp_ntz"))
    return df.select("user_id", start.alias("window_start"), "txn_count")


def velocity_stream(
    stream: DataFrame,
    user: str,
    ts: str,
    watermark: str = "1 hour",
    end_marker: str | None = None,
    counts: Callable[[DataFrame, str, str], DataFrame] = hourly_counts,
) -> DataFrame:
    """Streaming window counts with a watermark (append mode emits a window
    once the watermark passes its end); ``counts`` is one of the functions
    above, hourly or sliding. Wall-clock (NTZ) times are read as
    session-time-zone timestamps, which watermarks require."""
    if stream.schema[ts].dataType.typeName() == "timestamp_ntz":
        stream = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    timed = stream.withWatermark(ts, watermark)
    if end_marker:  # the marker only moves event time forward
        from riskweave.streaming.source import drop_marker

        timed = drop_marker(timed, ts, end_marker)
    return counts(timed, user, ts)
