"""Warehouse cost: idle gaps, wake-ups, billed against worked time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions.naming import domain_from_warehouse, environment_from_name
from usagelens.functions.numeric import count_where, percentage, ratio, round_half_up
from usagelens.functions.temporal import datediff_boundary, trunc_ts
from usagelens.operators.ordered import lag_by_key
from usagelens.session import Settings


def query_behavior(
    qh: DataFrame, suspend_s: int = 60, short_s: int = 5, slices: int | None = None
) -> DataFrame:
    """Gap to the previous query of the warehouse and what it says about wake-ups.

    The gap is negative when queries overlap. A previous row without an end time counts
    as no previous row. Equal start times are ordered by query id.
    """
    base = qh.select(
        "query_id",
        "warehouse_name",
        "user_name",
        "role_name",
        "start_time",
        "end_time",
        "execution_time_seconds",
    )
    lagged = lag_by_key(
        base, ["warehouse_name"], ["start_time", "query_id"], "end_time", "_previous_end", slices
    )
    previous = F.col("_previous_end")
    gap = datediff_boundary("second", previous, F.col("start_time"))
    first = previous.isNull()
    wakeup = first | F.coalesce(gap >= suspend_s, F.lit(False))
    isolated = F.coalesce(F.col("execution_time_seconds") < short_s, F.lit(False)) & wakeup
    return lagged.select(
        *base.columns,
        gap.alias("idle_gap_seconds"),
        first.alias("is_first_query_in_window"),
        wakeup.alias("is_potential_wakeup"),
        isolated.alias("is_isolated_expensive_query"),
    )


def rpt_warehouse_behavior(behavior: DataFrame) -> DataFrame:
    return behavior.groupBy(
        "warehouse_name",
        "user_name",
        "role_name",
        trunc_ts("day", F.col("start_time")).alias("execution_date"),
        domain_from_warehouse(F.col("warehouse_name")).alias("domain"),
    ).agg(
        F.count("query_id").alias("total_queries"),
        F.sum("execution_time_seconds").alias("total_execution_time_seconds"),
        count_where(F.col("is_potential_wakeup")).alias("wakeup_count"),
        count_where(F.col("is_isolated_expensive_query")).alias("isolated_query_count"),
    )


def warehouse_efficiency_summary(
    metering: DataFrame, qh: DataFrame, cfg: Settings = Settings()
) -> DataFrame:
    """Compute credits against executed seconds per warehouse.

    Both sides are aggregated to one row per warehouse before they meet. Inputs must
    cover the same window.
    """
    billing = metering.groupBy("warehouse_name").agg(
        F.sum("credits_used_compute").alias("total_compute_credits")
    )
    work = qh.groupBy("warehouse_name").agg(
        F.sum("execution_time_seconds").alias("work"), F.count("query_id").alias("queries")
    )
    credits = F.col("total_compute_credits")
    return billing.join(work, "warehouse_name", "left").select(
        "warehouse_name",
        "total_compute_credits",
        (credits * cfg.seconds_per_credit).alias("total_billed_seconds"),
        F.coalesce("work", F.lit(0)).alias("total_work_seconds"),
        F.coalesce("queries", F.lit(0)).alias("total_queries_executed"),
        (credits * F.lit(cfg.credit_price_usd)).alias("total_compute_cost_usd"),
    )


def rpt_warehouse_efficiency(summary: DataFrame) -> DataFrame:
    """Efficiency and wasted cost. Nothing billed gives 0 % and a NULL waste; more work
    than billed time gives over 100 % and a negative waste."""
    work, billed = F.col("total_work_seconds"), F.col("total_billed_seconds")
    wasted = F.col("total_compute_cost_usd").cast("double") * (1 - ratio(work, billed))
    name = F.col("warehouse_name")
    return summary.select(
        "warehouse_name",
        "total_compute_credits",
        "total_compute_cost_usd",
        "total_billed_seconds",
        "total_work_seconds",
        "total_queries_executed",
        F.coalesce(percentage(work, billed), F.lit(0.0)).alias("efficiency_percentage"),
        round_half_up(wasted, 2).alias("wasted_cost_usd"),
        environment_from_name(name).alias("environment"),
        domain_from_warehouse(name).alias("domain"),
    )
