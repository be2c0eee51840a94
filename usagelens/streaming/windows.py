"""Event-time aggregates over streams.

Windows are emitted once the watermark has passed their end. That a window had no rows at
all cannot come from a stream; the batch freshness model reports it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bounds() -> list[Column]:
    return [
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
    ]


def hourly_volume(
    stream: DataFrame, ts_col: str, table_col: str, rows_col: str, late: str = "3 hours"
) -> DataFrame:
    """Rows and writes per table and hour; rows up to ``late`` behind the newest count."""
    timed = stream.withColumn("_ts", F.col(ts_col).cast("timestamp")).withWatermark("_ts", late)
    counts = timed.groupBy(F.window("_ts", "1 hour").alias("w"), table_col).agg(
        F.sum(rows_col).alias("total_rows_inserted"), F.count("*").alias("n_queries")
    )
    return counts.select(*_bounds(), table_col, "total_rows_inserted", "n_queries")


def failed_logins(
    stream: DataFrame, n: int = 3, window: str = "5 minutes", late: str = "10 minutes"
) -> DataFrame:
    """Users with at least ``n`` failures in a window; only failures advance the watermark."""
    failed = stream.where(F.col("is_success") == "NO")
    timed = failed.withColumn("_ts", F.col("event_timestamp").cast("timestamp")).withWatermark(
        "_ts", late
    )
    counts = timed.groupBy(F.window("_ts", window).alias("w"), "user_name").agg(
        F.count("*").alias("failures")
    )
    return counts.where(F.col("failures") >= n).select("user_name", *_bounds(), "failures")


def activity_sessions(
    stream: DataFrame,
    ts_col: str = "start_time",
    keys: Sequence[str] = ("warehouse_name",),
    gap: str = "60 seconds",
    late: str = "1 hour",
) -> DataFrame:
    """Sessions of query starts per warehouse, a rough count of wake-ups.

    A session ends ``gap`` after its last start, however long that query ran, so the number
    is not equal to the batch model's wake-ups.
    """
    timed = stream.withColumn("_ts", F.col(ts_col).cast("timestamp")).withWatermark("_ts", late)
    sessions = timed.groupBy(F.session_window("_ts", gap).alias("w"), *keys).agg(
        F.count("*").alias("queries")
    )
    return sessions.select(*keys, *_bounds(), "queries")


def first_per_key(stream: DataFrame, key: str, ts_col: str, late: str = "6 hours") -> DataFrame:
    """First row seen per key within the watermark: for pushed files that never correct rows."""
    timed = stream.withColumn("_ts", F.col(ts_col).cast("timestamp")).withWatermark("_ts", late)
    return timed.dropDuplicatesWithinWatermark([key]).drop("_ts")
