"""Query performance: skew, cache use, spilling, clustering cost, pruning."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions.naming import domain_from_database, domain_from_warehouse
from usagelens.functions.numeric import (
    bytes_to,
    count_where,
    millis_to_seconds,
    percentage,
    ratio,
    round_half_up,
)
from usagelens.functions.temporal import trunc_ts
from usagelens.plans.staging import since
from usagelens.sources.sinks import with_audit


def data_skew(
    qh: DataFrame,
    min_partitions: int = 50,
    spp: float = 0.5,
    potential_s: float = 60,
    critical_s: float = 300,
) -> DataFrame:
    seconds = millis_to_seconds(F.col("execution_time"))
    slow = F.col("seconds_per_partition") > spp
    took = F.col("total_exec_seconds")
    status = (
        F.when(slow & (took > critical_s), "CRITICAL_SKEW")
        .when(slow & (took > potential_s), "POTENTIAL_SKEW")
        .otherwise("BALANCED")
    )
    measured = qh.where(
        (F.col("execution_time") > 0) & (F.col("partitions_scanned") > min_partitions)
    ).select(
        "query_id",
        "user_name",
        "warehouse_name",
        "warehouse_size",
        seconds.alias("total_exec_seconds"),
        "partitions_scanned",
        ratio(seconds, F.col("partitions_scanned")).alias("seconds_per_partition"),
        "query_text",
    )
    return measured.select(
        *[c for c in measured.columns if c != "query_text"],
        status.alias("skew_status"),
        "query_text",
    )


def fct_data_skew(skew: DataFrame, as_of: datetime) -> DataFrame:
    return with_audit(
        skew.where(F.col("skew_status").isin("POTENTIAL_SKEW", "CRITICAL_SKEW")), as_of
    )


def autoclustering_daily(acl: DataFrame) -> DataFrame:
    keys = ["full_table_name", "database_name", "schema_name", "table_name"]
    named = acl.select(
        F.concat(
            "database_name", F.lit("."), "schema_name", F.lit("."), "table_name"
        ).alias("full_table_name"),
        "database_name",
        "schema_name",
        "table_name",
        trunc_ts("day", F.col("start_time")).alias("event_date"),
        trunc_ts("month", F.col("start_time")).alias("event_month"),
        "credits_used",
        "num_bytes_reclustered",
    )
    reclustered = bytes_to("gb", F.sum("num_bytes_reclustered"))
    return named.groupBy(*keys, "event_date", "event_month").agg(
        F.sum("credits_used").alias("daily_credits_used"),
        round_half_up(reclustered, 2).alias("daily_gb_reclustered"),
    )


def rpt_autoclustering_monthly(daily: DataFrame) -> DataFrame:
    """Monthly totals over the daily rows, whose volumes are already rounded."""
    keys = ["event_month", "full_table_name", "database_name", "schema_name", "table_name"]
    # Daily volumes carry two decimals; as decimals their sum does not depend on row order.
    volume = F.sum(F.col("daily_gb_reclustered").cast("decimal(28,2)")).cast("double")
    monthly = daily.groupBy(*keys).agg(
        F.sum("daily_credits_used").alias("total_monthly_credits"),
        volume.alias("total_monthly_gb_reclustered"),
        round_half_up(
            ratio(F.sum("daily_credits_used"), F.count("daily_credits_used")), 2
        ).alias("avg_daily_credits"),
    )
    return monthly.withColumn("domain", domain_from_database(F.col("database_name")))


def cache_performance(
    qh: DataFrame, as_of: datetime, window_days: int = 30, local: float = 0.50, remote: float = 0.20
) -> DataFrame:
    """Where each query's bytes came from. An unknown share is MIXED."""
    share, total = F.col("percentage_scanned_from_cache"), F.col("total_bytes_scanned")
    category = (
        F.when(share == 1, "RESULT_CACHE")
        .when(share > local, "LOCAL_EFFICIENT")
        .when((share < remote) & (total > 0), "REMOTE_HEAVY")
        .otherwise("MIXED")
    )
    sized = qh.where(since("start_time", as_of, window_days) & F.col("warehouse_size").isNotNull())
    return sized.select(
        "query_id",
        "warehouse_name",
        "start_time",
        "total_elapsed_time",
        "percentage_scanned_from_cache",
        total.alias("total_bytes"),
        (total * share).alias("bytes_from_cache"),
        (total * (1 - share)).alias("bytes_from_remote"),
        category.alias("cache_category"),
    )


def rpt_cache_performance(cache: DataFrame) -> DataFrame:
    """Share of query classes per warehouse; MIXED is not reported."""
    queries = F.count("query_id")

    def share(category: str):
        return percentage(count_where(F.col("cache_category") == category), queries)

    report = cache.groupBy("warehouse_name").agg(
        queries.alias("total_query_count"),
        round_half_up(bytes_to("gb", F.sum("total_bytes")), 2).alias("total_gb_scanned"),
        share("RESULT_CACHE").alias("pct_result_cache"),
        share("LOCAL_EFFICIENT").alias("pct_local_efficient"),
        share("REMOTE_HEAVY").alias("pct_remote_heavy"),
    )
    return report.withColumn("domain", domain_from_warehouse(F.col("warehouse_name")))


def spilling_performance(
    qh: DataFrame, as_of: datetime, window_days: int = 30, local: float = 0.30, remote: float = 0.01
) -> DataFrame:
    total = F.col("total_bytes_scanned")

    def over(spilled: str, limit: float):
        heavy = (total > 0) & (ratio(F.col(spilled), total) > limit)
        return F.when(heavy, F.lit(1)).otherwise(F.lit(0))

    sized = qh.where(since("start_time", as_of, window_days) & F.col("warehouse_size").isNotNull())
    return sized.select(
        "query_id",
        "query_text",
        "user_name",
        "warehouse_name",
        "start_time",
        "total_elapsed_time",
        "percentage_scanned_from_cache",
        F.col("bytes_spilled_to_local_storage").alias("bytes_local"),
        F.col("bytes_spilled_to_remote_storage").alias("bytes_remote"),
        total.alias("total_bytes"),
        over("bytes_spilled_to_local_storage", local).alias("is_bad_local_spill"),
        over("bytes_spilled_to_remote_storage", remote).alias("is_critical_remote_spill"),
    )


def fct_query_spilling(spilling: DataFrame) -> DataFrame:
    def megabytes(column: str):
        return round_half_up(bytes_to("mb", F.col(column)), 2)

    flagged = spilling.where(
        (F.col("is_bad_local_spill") == 1) | (F.col("is_critical_remote_spill") == 1)
    )
    return flagged.select(
        "query_id",
        "query_text",
        "user_name",
        "warehouse_name",
        "start_time",
        F.col("total_elapsed_time").alias("execution_time_ms"),
        megabytes("total_bytes").alias("total_mb_scanned"),
        megabytes("bytes_local").alias("spilled_local_mb"),
        megabytes("bytes_remote").alias("spilled_remote_mb"),
        "is_bad_local_spill",
        "is_critical_remote_spill",
        domain_from_warehouse(F.col("warehouse_name")).alias("domain"),
    )


def rpt_spilling_summary(spilling: DataFrame) -> DataFrame:
    queries = F.count("query_id")
    elapsed = ratio(F.sum("total_elapsed_time"), F.count("total_elapsed_time"))
    report = spilling.groupBy("warehouse_name").agg(
        queries.alias("total_query_count"),
        round_half_up(bytes_to("gb", F.sum("total_bytes")), 2).alias("total_gb_scanned"),
        round_half_up(elapsed, 2).alias("avg_execution_time_ms"),
        percentage(F.sum("is_bad_local_spill"), queries).alias("pct_bad_local_spilling"),
        percentage(F.sum("is_critical_remote_spill"), queries).alias("pct_critical_remote_spilling"),
    )
    return report.withColumn("domain", domain_from_warehouse(F.col("warehouse_name")))


def pruning_ratio(qh: DataFrame) -> DataFrame:
    """How much of its tables a query read, and how much of that came from cache."""
    return qh.select(
        "query_id",
        "warehouse_name",
        "partitions_scanned",
        "partitions_total",
        ratio(F.col("partitions_scanned"), F.col("partitions_total")).alias("pruning_ratio"),
        "percentage_scanned_from_cache",
    )
