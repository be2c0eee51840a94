"""Drill-down reports over the marts, with their headline figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions.numeric import percentage, round_half_up
from usagelens.functions.temporal import trunc_ts
from usagelens.functions.text import blank_to, regexp_first
from usagelens.operators.ordered import page as page_rows


def efficiency_by_domain(efficiency: DataFrame) -> DataFrame:
    """Totals per domain; the efficiency is the ratio of the sums."""
    credits, work = F.sum("total_compute_credits"), F.sum("total_work_seconds")
    return (
        efficiency.groupBy("domain")
        .agg(
            credits.alias("total_compute_credits"),
            (credits.cast("double") - work / 3600).alias("idle_credits"),
            percentage(work, F.sum("total_billed_seconds")).alias("efficiency_percentage"),
        )
        .orderBy(F.col("total_compute_credits").desc_nulls_first(), "domain")
    )


def behavior_by_domain_day(
    behavior: DataFrame, sort_by: str = "date", ascending: bool = False
) -> DataFrame:
    """Daily wake-up and isolated-query rates, sorted by any of the columns."""
    queries = F.sum("total_queries")
    wakeups, isolated = F.sum("wakeup_count"), F.sum("isolated_query_count")
    report = behavior.groupBy("domain", F.col("execution_date").cast("date").alias("date")).agg(
        queries.alias("total_queries"),
        wakeups.alias("wakeup_count"),
        isolated.alias("isolated_query_count"),
        percentage(wakeups, queries).alias("pct_wakeup"),
        percentage(isolated, queries).alias("pct_isolated"),
    )
    return sorted_by(report, sort_by, ascending, ["domain", "date"])


def sorted_by(
    df: DataFrame, column: str, ascending: bool = False, then: Sequence[str] = ()
) -> DataFrame:
    """Sort on a column the caller picked; names outside the schema are refused."""
    if column not in df.columns:
        raise ValueError(f"no column {column!r} in {df.columns}")
    first = F.col(column).asc_nulls_last() if ascending else F.col(column).desc_nulls_first()
    return df.orderBy(first, *[c for c in then if c != column])


def cache_report(cache: DataFrame) -> DataFrame:
    return cache.orderBy(F.col("total_query_count").desc(), "warehouse_name")


def cache_kpis(cache: DataFrame) -> DataFrame:
    def mean(column: str):
        # Two-decimal values: a decimal sum does not depend on row order.
        total = F.sum(F.col(column).cast("decimal(20,2)")).cast("double")
        return round_half_up(total / F.nullif(F.count(column), F.lit(0)), 1)

    return cache.agg(
        mean("pct_result_cache").alias("avg_result_cache"),
        mean("pct_local_efficient").alias("avg_local_efficient"),
        mean("pct_remote_heavy").alias("avg_remote_heavy"),
    )


def spilling_report(summary: DataFrame) -> DataFrame:
    return summary.orderBy(
        F.col("pct_critical_remote_spilling").desc_nulls_first(), "warehouse_name"
    )


def worst_spilling_queries(details: DataFrame, n: int = 50) -> DataFrame:
    return details.orderBy(F.col("execution_time_ms").desc_nulls_first(), "query_id").limit(n)


def clustering_report(monthly: DataFrame) -> DataFrame:
    return monthly.orderBy(
        F.col("total_monthly_credits").desc_nulls_first(), "event_month", "full_table_name"
    )


def clustering_kpis(monthly: DataFrame) -> DataFrame:
    return monthly.agg(F.sum("total_monthly_credits").alias("total_clustering_credits"))


def data_flow_gaps(monitoring: DataFrame) -> DataFrame:
    gaps = monitoring.where(
        (F.col("category") == "DATA_FLOW")
        & F.col("alert_level").isin("GAP_DETECTED", "SILENT_FAILURE")
    )
    return gaps.select(
        trunc_ts("day", F.col("event_timestamp")).alias("event_date"),
        "event_timestamp",
        "full_table_name",
        "alert_level",
        "total_rows_inserted",
        "n_queries",
        "event_description",
    ).orderBy(F.col("event_timestamp").desc(), "full_table_name")


def data_flow_kpis(gaps: DataFrame) -> DataFrame:
    level = F.col("alert_level")
    return gaps.agg(
        F.count_if(level == "GAP_DETECTED").alias("gap_detected"),
        F.count_if(level == "SILENT_FAILURE").alias("silent_failures"),
    )


def automation_failures(errors: DataFrame) -> DataFrame:
    kind, text = F.col("automation_type"), F.col("query_text")
    name = (
        F.when(
            (kind == "TASK") & text.ilike("%EXECUTE TASK%"),
            regexp_first(text, r"EXECUTE\s+TASK\s+([\w.]+)"),
        )
        .when(
            (kind == "INGESTION_PIPE") & text.ilike("%COPY INTO%"),
            regexp_first(text, r"COPY\s+INTO\s+([\w.]+)"),
        )
        .otherwise(blank_to(F.col("user_name"), "UNKNOWN"))
    )
    return errors.select(
        "query_id",
        "start_time",
        "automation_type",
        name.alias("object_name"),
        "execution_status",
        "error_message",
        round_half_up(F.col("duration_seconds"), 1).alias("duration_seconds"),
    ).orderBy(F.col("start_time").desc(), "query_id")


def automation_kpis(errors: DataFrame) -> DataFrame:
    kind = F.col("automation_type")
    return errors.agg(
        F.count_if(kind == "TASK").alias("task_failures"),
        F.count_if(kind == "INGESTION_PIPE").alias("pipe_failures"),
        F.count_if(kind == "TRANSFORMATION_JOB").alias("transformation_failures"),
    )


def audit_filter(
    log: DataFrame,
    user: str,
    action: str | None = None,
    env: str | None = None,
    object_type: str | None = None,
) -> DataFrame:
    """Entries of one user matching every given condition. Values are literals, never SQL text."""
    wanted = {"user_name": user, "action_type": action, "env": env, "object_type": object_type}
    for column, value in wanted.items():
        if value is not None:
            log = log.where(F.col(column) == F.lit(value))
    return log


def audit_search(
    log: DataFrame,
    user: str,
    action: str | None = None,
    env: str | None = None,
    object_type: str | None = None,
    page: int = 0,
    page_size: int = 10,
    slices: int | None = None,
) -> tuple[DataFrame, int]:
    """A page of the user's audit entries, newest first, and the number of pages."""
    found = audit_filter(log, user, action, env, object_type)
    order = ["action_timestamp", "action_id"]
    rows, pages = page_rows(found, order, page, page_size, slices=slices)
    return (
        rows.select(
            "action_timestamp",
            "action_type",
            F.col("user_name").alias("user"),
            "domain",
            "role_assigned",
            "object_type",
            "env",
            "comment",
            "performed_by",
            "role_used",
        ),
        pages,
    )


def user_list(users: DataFrame, column: str = "user") -> DataFrame:
    return users.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)
