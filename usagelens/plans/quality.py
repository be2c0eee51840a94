"""Data flow gaps and automation failures."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.functions.numeric import millis_to_seconds
from usagelens.functions.temporal import at, datediff_boundary, trunc_ts
from usagelens.plans.staging import since
from usagelens.sources.registry import hour_spine
from usagelens.sources.sinks import with_audit

ALERT_LEVELS = ("GAP_DETECTED", "SILENT_FAILURE", "TASK", "INGESTION_PIPE", "TRANSFORMATION_JOB")


def hourly_writes(qh: DataFrame, writes: DataFrame, start: datetime) -> DataFrame:
    """Rows and queries per hour and written table. A query that wrote several tables
    counts for each of them."""
    recent = qh.where(F.col("start_time") >= at(start)).select(
        "query_id", "start_time", "rows_inserted"
    )
    return (
        recent.join(writes.select("query_id", "full_table_name"), "query_id")
        .groupBy(trunc_ts("hour", F.col("start_time")).alias("event_hour"), "full_table_name")
        .agg(
            F.sum("rows_inserted").alias("rows"),
            F.count("query_id").alias("queries"),
        )
    )


def _status(mode: str, lag_min: int) -> Column:
    rows, queries, age = F.col("total_rows_inserted"), F.col("n_queries"), F.col("minutes_ago")
    if mode == "reference":
        # Every hour without rows is either recent or a gap: silent failures never surface.
        return (
            F.when(rows > 0, "HEALTHY")
            .when((rows == 0) & (age <= lag_min), "EXPECTED_LAG")
            .when((rows == 0) & (age > lag_min), "GAP_DETECTED")
            .otherwise("UNKNOWN")
        )
    if mode == "strict":
        return (
            F.when(rows > 0, "HEALTHY")
            .when((rows == 0) & (queries > 0), "SILENT_FAILURE")
            .when((rows == 0) & (age <= lag_min), "EXPECTED_LAG")
            .when((rows == 0) & (age > lag_min), "GAP_DETECTED")
            .otherwise("UNKNOWN")
        )
    raise ValueError(f"unknown mode {mode!r}")


def freshness_gaps(
    qh: DataFrame,
    writes: DataFrame,
    as_of: datetime,
    hours: int = 24,
    lag_min: int = 180,
    mode: str = "reference",
    write_slack: timedelta | None = timedelta(hours=1),
) -> DataFrame:
    """Status per hour of the last day and table written in it; an hour without any
    write keeps one row with a NULL table.

    ``mode="strict"`` reports an hour whose queries loaded nothing as SILENT_FAILURE. A write
    carries the start of its query, so only writes of the spine are read, with ``write_slack``
    before it; ``None`` reads the whole window of writes.
    """
    spine = hour_spine(qh.sparkSession, as_of, hours)
    start = as_of.replace(minute=0, second=0, microsecond=0) - timedelta(hours=hours)
    if write_slack is not None:
        writes = writes.where(F.col("query_start_time") >= at(start - write_slack))
    actual = hourly_writes(qh, writes, start)
    joined = spine.join(actual, F.col("check_hour") == F.col("event_hour"), "left").select(
        "check_hour",
        "full_table_name",
        F.coalesce("rows", F.lit(0)).alias("total_rows_inserted"),
        F.coalesce("queries", F.lit(0)).alias("n_queries"),
        datediff_boundary("minute", F.col("check_hour"), at(as_of)).alias("minutes_ago"),
    )
    return joined.withColumn("status", _status(mode, lag_min))


def automation_errors(qh: DataFrame, as_of: datetime, window_days: int = 30) -> DataFrame:
    """Failed runs of scheduled tasks, ingestion pipes and transformation jobs.

    A row with a NULL status is not a failure. The first matching kind wins.
    """
    user, text = F.col("user_name"), F.col("query_text")
    kind = (
        F.when(user.ilike("%SYSTEM%") | text.ilike("%EXECUTE TASK%"), "TASK")
        .when(text.ilike("%COPY INTO%") | text.ilike("%SNOWPIPE%"), "INGESTION_PIPE")
        .when(user.ilike("%DBT%") | user.ilike("%SERVICE%"), "TRANSFORMATION_JOB")
    )
    failed = qh.where(
        since("start_time", as_of, window_days)
        & ~F.col("execution_status").isin("SUCCESS", "RUNNING")
    )
    return failed.select(
        "query_id",
        "query_text",
        "user_name",
        "warehouse_name",
        "execution_status",
        "error_code",
        "error_message",
        "start_time",
        "end_time",
        millis_to_seconds(F.col("total_elapsed_time")).alias("duration_seconds"),
        kind.alias("automation_type"),
    ).where(F.col("automation_type").isNotNull())


def fct_quality_monitoring(gaps: DataFrame, errors: DataFrame, as_of: datetime) -> DataFrame:
    """Data-flow states and technical failures in one table."""
    status = F.col("status")
    flow_text = (
        F.when(status == "GAP_DETECTED", "No data received for > 3 hours")
        .when(status == "SILENT_FAILURE", "Queries running but 0 rows inserted")
        .otherwise("Normal operations")
    )
    flow = gaps.where(F.col("full_table_name").isNotNull()).select(
        F.col("check_hour").alias("event_timestamp"),
        F.lit("DATA_FLOW").alias("category"),
        status.alias("alert_level"),
        "full_table_name",
        "total_rows_inserted",
        "n_queries",
        flow_text.alias("event_description"),
        F.lit(None).cast("string").alias("error_message"),
    )
    kind = F.col("automation_type")
    technical = errors.select(
        F.col("start_time").alias("event_timestamp"),
        F.lit("TECHNICAL_ERROR").alias("category"),
        kind.alias("alert_level"),
        F.lit(None).cast("string").alias("full_table_name"),
        F.lit(None).cast("long").alias("total_rows_inserted"),
        F.lit(1).cast("long").alias("n_queries"),
        F.concat(F.lit("Failed "), kind, F.lit(": "), F.substring("query_text", 1, 50)).alias(
            "event_description"
        ),
        "error_message",
    )
    is_alert = F.when(F.col("alert_level").isin(*ALERT_LEVELS), F.lit(1)).otherwise(F.lit(0))
    return with_audit(flow.unionByName(technical).withColumn("is_alert", is_alert), as_of)


def critical_gaps(gaps: DataFrame) -> DataFrame:
    """Singular check: any row here is a failure."""
    return gaps.where(F.col("status") == "GAP_DETECTED")
