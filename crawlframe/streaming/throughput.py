"""Counts over event time with late rows dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_end(attempts: DataFrame, ends: DataFrame, time: str = "date_visited") -> DataFrame:
    """The stream and, of a stream of end marks, one row per moment with no other value.

    A mark later than any row by more than idle time, width and delay lets the
    watermark close all windows and sessions; its own never comes out.
    """
    marks = ends.select(
        *[
            (F.col(time) if name == time else F.lit(None)).cast(kind).alias(name)
            for name, kind in attempts.dtypes
        ]
    )
    return attempts.unionByName(marks)


def stream_throughput(
    attempts: DataFrame,
    width: str = "1 hour",
    slide: str | None = None,
    delay: str = "10 minutes",
    time: str = "date_visited",
) -> DataFrame:
    """``window_start, window_end, processed_status, n_attempts`` per window.

    Tumbling, or sliding with ``slide``.  In append mode a window comes out
    once the watermark (``delay`` behind the newest row) has passed its end.
    """
    window = F.window(time, width, slide) if slide else F.window(time, width)
    return (
        attempts.withWatermark(time, delay)
        .groupBy(window.alias("_w"), "processed_status")
        .agg(F.count("*").alias("n_attempts"))
        .select(
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            "processed_status",
            "n_attempts",
        )
    )


def stream_sessions(
    attempts: DataFrame, idle: str = "30 minutes", delay: str = "10 minutes",
    time: str = "date_visited",
) -> DataFrame:
    """Streaming form of worker sessions: ``claimed_by, session_start, session_end, n_attempts``.

    ``session_end`` is the last attempt plus the idle time.
    """
    return (
        attempts.withWatermark(time, delay)
        .groupBy("claimed_by", F.session_window(time, idle).alias("_s"))
        .agg(F.count("*").alias("n_attempts"))
        .select(
            "claimed_by",
            F.col("_s.start").alias("session_start"),
            F.col("_s.end").alias("session_end"),
            "n_attempts",
        )
    )
