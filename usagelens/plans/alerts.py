"""Alert rules: each returns the rows to alert on."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usagelens.functions.temporal import at
from usagelens.plans.performance import fct_query_spilling


def alert_credit_quota(metering: DataFrame, quota: float | Decimal) -> DataFrame:
    """Warehouse days above the daily credit quota."""
    daily = metering.groupBy(
        "warehouse_name", F.col("start_time").cast("date").alias("day")
    ).agg(F.sum("credits_used").alias("credits"))
    return daily.where(F.col("credits") > F.lit(quota))


def alert_zero_rows(
    qh: DataFrame,
    writes: DataFrame,
    as_of: datetime,
    hours: int = 4,
    write_slack: timedelta = timedelta(hours=1),
) -> DataFrame:
    """Tables written in the window of ``writes`` that gained no row in the last hours.

    A write carries the start of its query, so only writes of those hours, and ``write_slack``
    before them, are joined.
    """
    since = as_of - timedelta(hours=hours)
    recent = writes.where(F.col("query_start_time") >= at(since - write_slack))
    loads = (
        qh.where((F.col("start_time") >= at(since)) & (F.col("rows_inserted") > 0))
        .select("query_id")
        .join(recent.select("query_id", "full_table_name"), "query_id")
        .select("full_table_name")
        .distinct()
    )
    known = writes.select("full_table_name").distinct()
    return known.join(loads, "full_table_name", "left_anti")


def alert_failed_logins(
    logins: DataFrame, n: int = 3, window: timedelta = timedelta(minutes=5), stretch: int = 12
) -> DataFrame:
    """Moments at which a user's failed logins of the last ``window`` number at least ``n``.

    The window slides with every failure, both ends included. Failures of one moment are
    counted before the shuffle, and a user's time is cut into stretches of so many windows,
    each with the last window before it, so a user under attack does not fill one task.
    """
    width = window // timedelta(microseconds=1)
    length = width * stretch
    failed = logins.where((F.col("is_success") == "NO") & F.col("event_timestamp").isNotNull())
    moments = failed.groupBy(
        "user_name", F.unix_micros(F.col("event_timestamp").cast("timestamp")).alias("_at")
    ).agg(F.count("*").alias("_n"))
    own = F.floor(F.col("_at") / length)
    needed_next = F.col("_at") >= (own + 1) * length - width
    stretches = F.when(needed_next, F.array(own, own + 1)).otherwise(F.array(own))
    last = Window.partitionBy("user_name", "_stretch").orderBy("_at").rangeBetween(-width, 0)
    counted = moments.select(
        "user_name", "_at", "_n", own.alias("_own"), F.explode(stretches).alias("_stretch")
    ).withColumn("failures", F.sum("_n").over(last))
    hit = counted.where((F.col("_stretch") == F.col("_own")) & (F.col("failures") >= n))
    return hit.select(
        "user_name",
        F.timestamp_micros(F.col("_at") - width).cast("timestamp_ntz").alias("window_start"),
        F.timestamp_micros("_at").cast("timestamp_ntz").alias("window_end"),
        "failures",
    )


def alert_spilling(spilling: DataFrame) -> DataFrame:
    return fct_query_spilling(spilling)


def alert_long_queries(qh: DataFrame, limit_s: float) -> DataFrame:
    return qh.where(F.col("execution_time_seconds") > limit_s).select(
        "query_id", "warehouse_name", "user_name", "start_time", "execution_time_seconds"
    )


def alert_large_transaction(tx: DataFrame, limit: float | Decimal) -> DataFrame:
    return tx.where(F.col("transaction_amount_chf") > F.lit(limit))


def serverless_cost_rollup(services: dict[str, DataFrame]) -> DataFrame:
    """Credits per serverless service and day, over histories with ``start_time`` and
    ``credits_used``."""
    combined = None
    for name, history in services.items():
        part = history.select(
            F.lit(name).alias("service"),
            F.col("start_time").cast("date").alias("day"),
            F.col("credits_used").cast("decimal(38,9)").alias("credits_used"),
        )
        combined = part if combined is None else combined.unionByName(part)
    return combined.groupBy("service", "day").agg(F.sum("credits_used").alias("credits"))
