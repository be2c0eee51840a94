"""Cleaned inputs: renamed, typed, windowed."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.functions.numeric import bytes_to, millis_to_seconds, to_whole
from usagelens.functions.temporal import at, datediff_boundary
from usagelens.functions.text import keep, name_part, surrogate_key, variant_path
from usagelens.operators.incremental import delete_insert, incremental_window


def since(ts_col: str, as_of: datetime, days: int):
    """Rolling window filter; the bound is a literal, so Parquet row groups can be skipped."""
    return F.col(ts_col) >= at(as_of - timedelta(days=days))


def stg_users(raw_users: DataFrame) -> DataFrame:
    return raw_users.select(
        "user_id",
        F.col("signup_date").cast("date").alias("signup_date"),
        F.col("country").alias("country_code"),
    )


def stg_transactions(raw_tx: DataFrame) -> DataFrame:
    return raw_tx.select(
        "transaction_id",
        "user_id",
        F.col("purchase_date").cast("date").alias("purchase_date"),
        F.col("amount").alias("transaction_amount_chf"),
    )


def typed_events(raw: DataFrame) -> DataFrame:
    """Six typed columns from a struct or variant ``value`` column."""
    if isinstance(raw.schema["value"].dataType, T.VariantType):
        value = F.col("value")
        return raw.select(
            variant_path(value, "event_id", "string").alias("event_id"),
            to_whole(variant_path(value, "customer_id", "double")).alias("customer_id"),
            variant_path(value, "event_type", "string").alias("event_type"),
            variant_path(value, "event_timestamp", "string")
            .cast("timestamp_ntz")
            .alias("event_timestamp"),
            variant_path(value, "metadata:channel", "string").alias("channel"),
            variant_path(value, "metadata:amount", "decimal(10,2)").alias("amount"),
        )
    return raw.select(
        F.col("value.event_id").cast("string").alias("event_id"),
        F.col("value.customer_id").cast("long").alias("customer_id"),
        F.col("value.event_type").cast("string").alias("event_type"),
        F.col("value.event_timestamp").cast("timestamp_ntz").alias("event_timestamp"),
        F.col("value.metadata.channel").cast("string").alias("channel"),
        F.col("value.metadata.amount").cast("decimal(10,2)").alias("amount"),
    )


def new_events(raw: DataFrame, target: DataFrame | None, lookback_hours: int = 6) -> DataFrame:
    """Events to (re)load: everything at first, later only the lookback before the newest."""
    wanted = incremental_window(target, "event_timestamp", timedelta(hours=lookback_hours))
    return typed_events(raw).where(wanted)


def stg_customer_events(
    raw: DataFrame, target: DataFrame | None = None, lookback_hours: int = 6
) -> DataFrame:
    return delete_insert(target, new_events(raw, target, lookback_hours), ["event_id"])


def stg_access_history_writes(ah: DataFrame, as_of: datetime, window_days: int = 30) -> DataFrame:
    """One row per table written by a query. Other objects are dropped inside the array,
    before it is exploded; a query without written tables disappears."""
    tables = keep(F.col("objects_modified"), lambda o: o["objectDomain"] == "Table")
    writes = ah.where(since("query_start_time", as_of, window_days)).select(
        "query_id",
        "query_start_time",
        F.explode(F.transform(tables, lambda o: o["objectName"])).alias("full_table_name"),
    )
    name = F.col("full_table_name")
    return writes.select(
        "*",
        name_part(name, 1).alias("database_name"),
        name_part(name, 2).alias("schema_name"),
        name_part(name, 3).alias("table_name"),
    )


def stg_autoclustering_history(src: DataFrame, as_of: datetime, window_days: int = 30) -> DataFrame:
    return src.where(since("start_time", as_of, window_days)).select(
        "table_id",
        "table_name",
        "schema_name",
        "database_name",
        "start_time",
        "end_time",
        "credits_used",
        "num_bytes_reclustered",
        "num_rows_reclustered",
    )


def clean_queries(src: DataFrame) -> DataFrame:
    return src.where(F.col("warehouse_name").isNotNull()).select(
        "query_id",
        "query_text",
        "database_name",
        "schema_name",
        "warehouse_name",
        "warehouse_size",
        "user_name",
        "role_name",
        "execution_status",
        "query_tag",
        "start_time",
        "end_time",
        "total_elapsed_time",
        datediff_boundary("second", F.col("start_time"), F.col("end_time")).alias(
            "execution_time_seconds"
        ),
        "rows_produced",
        F.col("bytes_scanned").alias("total_bytes_scanned"),
        "percentage_scanned_from_cache",
        "bytes_spilled_to_local_storage",
        "bytes_spilled_to_remote_storage",
        bytes_to("gb", F.col("bytes_scanned")).alias("gb_scanned"),
        bytes_to("gb", F.col("bytes_spilled_to_local_storage")).alias("gb_spilled_local"),
        bytes_to("gb", F.col("bytes_spilled_to_remote_storage")).alias("gb_spilled_remote"),
        "rows_inserted",
        "partitions_scanned",
        "partitions_total",
        "execution_time",
        "error_code",
        "error_message",
        millis_to_seconds(F.col("compilation_time")).alias("compilation_time_s"),
        millis_to_seconds(F.col("queued_overload_time")).alias("queued_overload_time_s"),
    )


def stg_query_history(
    src: DataFrame,
    as_of: datetime,
    target: DataFrame | None = None,
    lookback_days: int = 3,
    window_days: int = 30,
) -> DataFrame:
    """First run: the last ``window_days``. Later: ``lookback_days`` before the newest row
    of ``target``, replacing its rows by ``query_id``; old rows are never purged."""
    wanted = incremental_window(
        target, "start_time", timedelta(days=lookback_days), as_of - timedelta(days=window_days)
    )
    return delete_insert(target, clean_queries(src.where(wanted)), ["query_id"])


def stg_warehouse_metering(src: DataFrame, as_of: datetime, window_days: int = 30) -> DataFrame:
    return src.where(since("start_time", as_of, window_days)).select(
        surrogate_key(F.col("warehouse_name"), F.col("start_time")).alias("metering_id"),
        "warehouse_name",
        "start_time",
        "end_time",
        datediff_boundary("second", F.col("start_time"), F.col("end_time")).alias("billed_seconds"),
        "credits_used",
        "credits_used_compute",
        "credits_used_cloud_services",
    )
