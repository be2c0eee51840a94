"""Every registered query: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.functions import naming, temporal, text
from usagelens.operators import checks, incremental, ordered
from usagelens.plans import (
    access,
    alerts,
    attribution,
    build,
    cost,
    performance,
    quality,
    reports,
    retention,
    staging,
)
from usagelens.plans.model_checks import EVENT_TYPES, MODEL_CHECKS
from usagelens.session import scratch_path, use_utc
from usagelens.sources import registry as sources
from usagelens.sources import sample_logs as logs
from usagelens.sources.sinks import VersionedTable, append_audit, overwrite_partitions, write_table
from usagelens.streaming import ingest, keyed, windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
AS_OF = logs.AS_OF
MIDDLE = datetime(2024, 1, 16)


def plain(df: DataFrame, nullable: tuple[str, ...]) -> DataFrame:
    """Decimals, and whole numbers that can be NULL, as doubles: both engines print those
    alike. Audit stamps are left out."""
    for field in df.schema.fields:
        if isinstance(field.dataType, T.DecimalType) or field.name in nullable:
            df = df.withColumn(field.name, F.col(field.name).cast("double"))
    return df


def query(name: str, nullable: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(use_utc(spark), sf_dir), nullable)

        QUERIES[name] = run
        return fn

    return register


# --- models, composed as the pipeline composes them -----------------------------------


def qh(spark, sf):
    return staging.stg_query_history(logs.query_history(spark, sf), AS_OF)


def metering(spark, sf):
    return staging.stg_warehouse_metering(logs.warehouse_metering(spark, sf), AS_OF)


def writes(spark, sf):
    return staging.stg_access_history_writes(logs.access_history(spark, sf), AS_OF)


def acl(spark, sf):
    return staging.stg_autoclustering_history(logs.autoclustering_history(spark, sf), AS_OF)


def users(spark, sf):
    return staging.stg_users(logs.raw_users(spark, sf))


def transactions(spark, sf):
    return staging.stg_transactions(logs.raw_transactions(spark, sf))


def crm_events(spark, sf):
    return staging.stg_customer_events(logs.customer_events(spark, sf))


query("stg_users")(users)
query("stg_transactions")(transactions)
query("stg_customer_events")(crm_events)
query("stg_access_history_writes")(writes)
query("stg_autoclustering_history")(acl)
query("stg_query_history")(qh)
query("stg_warehouse_metering")(metering)


@query("query_behavior", nullable=("idle_gap_seconds",))
def behavior(spark, sf):
    return cost.query_behavior(qh(spark, sf))


@query("query_behavior_sliced", nullable=("idle_gap_seconds",))
def behavior_sliced(spark, sf):
    """More range partitions than warehouses: carries cross many of them."""
    return cost.query_behavior(qh(spark, sf), slices=32)


@query("warehouse_efficiency_summary")
def efficiency_summary(spark, sf):
    return cost.warehouse_efficiency_summary(metering(spark, sf), qh(spark, sf))


@query("data_skew")
def skew(spark, sf):
    return performance.data_skew(qh(spark, sf))


@query("autoclustering_daily")
def clustering_daily(spark, sf):
    return performance.autoclustering_daily(acl(spark, sf))


@query("cache_performance")
def cache(spark, sf):
    return performance.cache_performance(qh(spark, sf), AS_OF)


@query("spilling_performance")
def spilling(spark, sf):
    return performance.spilling_performance(qh(spark, sf), AS_OF)


@query("freshness_gaps")
def gaps(spark, sf):
    return quality.freshness_gaps(qh(spark, sf), writes(spark, sf), AS_OF)


@query("freshness_gaps_strict")
def gaps_strict(spark, sf):
    return quality.freshness_gaps(qh(spark, sf), writes(spark, sf), AS_OF, mode="strict")


@query("automation_errors")
def errors(spark, sf):
    return quality.automation_errors(qh(spark, sf), AS_OF)


@query("user_transactions", nullable=("month_number",))
def joined_transactions(spark, sf):
    return retention.user_transactions(users(spark, sf), transactions(spark, sf))


@query("rpt_warehouse_efficiency")
def efficiency(spark, sf):
    return cost.rpt_warehouse_efficiency(efficiency_summary(spark, sf))


@query("rpt_warehouse_behavior")
def behavior_report(spark, sf):
    return cost.rpt_warehouse_behavior(behavior(spark, sf))


@query("fct_data_skew")
def skew_fact(spark, sf):
    return performance.fct_data_skew(skew(spark, sf), AS_OF)


@query("fct_query_spilling")
def spilling_fact(spark, sf):
    return performance.fct_query_spilling(spilling(spark, sf))


@query("rpt_autoclustering_monthly")
def clustering_monthly(spark, sf):
    return performance.rpt_autoclustering_monthly(clustering_daily(spark, sf))


@query("rpt_cache_performance")
def cache_summary(spark, sf):
    return performance.rpt_cache_performance(cache(spark, sf))


@query("rpt_spilling_summary")
def spilling_summary(spark, sf):
    return performance.rpt_spilling_summary(spilling(spark, sf))


@query("fct_quality_monitoring", nullable=("total_rows_inserted",))
def monitoring(spark, sf):
    return quality.fct_quality_monitoring(gaps(spark, sf), errors(spark, sf), AS_OF)


@query("rpt_cohort_retention", nullable=("month_number", "total_cohort_users"))
def cohort_report(spark, sf):
    return retention.rpt_cohort_retention(users(spark, sf), joined_transactions(spark, sf))


@query("cohort_retention", nullable=("month_number", "total_cohort_users"))
def cohort_direct(spark, sf):
    return retention.cohort_retention(users(spark, sf), transactions(spark, sf))


# --- drill-down reports ---------------------------------------------------------------

query("efficiency_by_domain")(lambda s, d: reports.efficiency_by_domain(efficiency(s, d)))
query("behavior_by_domain_day")(lambda s, d: reports.behavior_by_domain_day(behavior_report(s, d)))
query("cache_report")(lambda s, d: reports.cache_report(cache_summary(s, d)))
query("cache_kpis")(lambda s, d: reports.cache_kpis(cache_summary(s, d)))
query("spilling_report")(lambda s, d: reports.spilling_report(spilling_summary(s, d)))
query("worst_spilling_queries")(lambda s, d: reports.worst_spilling_queries(spilling_fact(s, d)))
query("clustering_report")(lambda s, d: reports.clustering_report(clustering_monthly(s, d)))
query("clustering_kpis")(lambda s, d: reports.clustering_kpis(clustering_monthly(s, d)))
query("data_flow_gaps")(lambda s, d: reports.data_flow_gaps(monitoring(s, d)))
query("data_flow_kpis")(lambda s, d: reports.data_flow_kpis(reports.data_flow_gaps(monitoring(s, d))))
query("automation_failures")(lambda s, d: reports.automation_failures(errors(s, d)))
query("automation_kpis")(lambda s, d: reports.automation_kpis(errors(s, d)))


@query("audit_search")
def audit_page(spark, sf):
    rows, _ = reports.audit_search(logs.activity_log(spark, sf), "U3", env="UAT", page=2)
    return rows


@query("audit_search_deep_page")
def audit_deep_page(spark, sf):
    rows, _ = reports.audit_search(logs.activity_log(spark, sf), "U3", page=12, slices=16)
    return rows


@query("user_list")
def all_users(spark, sf):
    return reports.user_list(logs.users(spark, sf))


# --- access ---------------------------------------------------------------------------


@query("domain_grant_levels")
def levels(spark, sf):
    return access.domain_grant_levels(logs.user_roles(spark, sf), logs.users(spark, sf))


@query("grant_changes")
def changes(spark, sf):
    return access.grant_changes(levels(spark, sf), logs.desired_levels(spark, sf))


query("grant_statements")(lambda s, d: access.grant_statements(changes(s, d)))


@query("audit_log_rows")
def audit_rows(spark, sf):
    actions = access.update_actions(changes(spark, sf), "OPERATOR", "SECURITYADMIN")
    return access.audit_log_rows(actions, AS_OF)


@query("audit_log_rows_created")
def audit_rows_created(spark, sf):
    """New users, and users enabled and disabled, who leave no row."""
    people, by = logs.users(spark, sf), ("OPERATOR", "SECURITYADMIN")
    actions = access.create_actions(cloned(spark, sf), *by)
    for enable in (True, False):
        actions = actions.unionByName(access.status_actions(people, enable, *by))
    return access.audit_log_rows(actions, AS_OF)


@query("audit_append")
def audit_appended(spark, sf):
    """The log after the same change was written twice."""
    location = scratch_path(spark, "audit")
    for _ in range(2):
        append_audit(audit_rows(spark, sf), location, "action_id")
    return spark.read.parquet(location)


@query("clone_access")
def cloned(spark, sf):
    names = logs.table(spark, sf, "supplier").select(
        F.concat("s_name", F.lit(", ,"), F.lower("s_name"), F.lit(" , x"), "s_suppkey").alias("names")
    )
    new_users = access.normalised_users(names, "names")
    return access.clone_access(levels(spark, sf), "U14", new_users)


@query("created_user_count")
def created(spark, sf):
    return access.created_user_count(cloned(spark, sf))


query("active_domains")(lambda s, d: access.active_domains(levels(s, d)))


@query("effective_roles")
def all_roles(spark, sf):
    return access.effective_roles(logs.user_roles(spark, sf), logs.role_edges(spark))


@query("mask_email")
def masked(spark, sf):
    email = F.when(F.col("c_custkey") % 10 != 0, F.concat(F.lower("c_name"), F.lit("@x.com")))
    return logs.table(spark, sf, "customer").select(
        "c_custkey",
        text.mask_email(email, {"SALES_READ_FR"}).alias("masked"),
        text.mask_email(email, {"PAYROLL_PII"}).alias("clear"),
    )


@query("row_filter_by_country")
def visible_rows(spark, sf):
    country = F.when(F.col("c_custkey") % 3 == 0, "FR").when(F.col("c_custkey") % 3 == 1, "US")
    rows = logs.table(spark, sf, "customer").select("c_custkey", country.alias("country_code"))
    return access.row_filter_by_country(rows, "country_code", {"SALES_READ_FR"})


query("tag_value_violations")(lambda s, d: access.tag_value_violations(logs.object_tags(s, d)))

# --- attribution and alerts -----------------------------------------------------------


@query("cost_by_cost_center")
def center_costs(spark, sf):
    return attribution.cost_by_cost_center(
        metering(spark, sf), logs.warehouse_cost_config(spark), logs.cost_centers(spark)
    )


@query("attribute_query_tags")
def tagged(spark, sf):
    tags = qh(spark, sf).select("query_id", "query_tag")
    return attribution.attribute_query_tags(tags, logs.query_tag_rules(spark))


@query("attribute_query_tags_many_rules")
def tagged_by_many(spark, sf):
    """A rule per part, next to two of wildcards alone."""
    tags = qh(spark, sf).select(
        "query_id", F.concat("query_tag", F.lit("/"), "query_id").alias("query_tag")
    )
    return attribution.attribute_query_tags(tags, logs.part_tag_rules(spark, sf))


@query("budget_alerts")
def budgets(spark, sf):
    monthly = attribution.monthly_center_credits(
        metering(spark, sf), logs.warehouse_cost_config(spark)
    )
    return attribution.budget_alerts(monthly, logs.cost_centers(spark))


query("alert_credit_quota")(lambda s, d: alerts.alert_credit_quota(metering(s, d), 10))
query("alert_zero_rows")(lambda s, d: alerts.alert_zero_rows(qh(s, d), writes(s, d), AS_OF))
query("alert_failed_logins")(
    lambda s, d: alerts.alert_failed_logins(logs.login_history(s, d), n=2, window=timedelta(hours=1))
)
query("alert_spilling")(lambda s, d: alerts.alert_spilling(spilling(s, d)))
query("alert_long_queries")(lambda s, d: alerts.alert_long_queries(qh(s, d), 3600))
query("alert_large_transaction")(
    lambda s, d: alerts.alert_large_transaction(transactions(s, d), 400000)
)


@query("serverless_cost_rollup")
def serverless(spark, sf):
    return alerts.serverless_cost_rollup(
        {"AUTOMATIC_CLUSTERING": acl(spark, sf), "PIPE_USAGE": metering(spark, sf)}
    )


query("pruning_ratio")(lambda s, d: performance.pruning_ratio(qh(s, d)))

# --- table maintenance ----------------------------------------------------------------


@query("append")
def appended(spark, sf):
    events = logs.table(spark, sf, "events").select("event_id", "event_type")
    return incremental.append(events, events.where(F.col("event_type") == "click"))


@query("stg_query_history_incremental")
def qh_incremental(spark, sf):
    """Target loaded up to mid-month with other texts, then a lookback run."""
    source = logs.query_history(spark, sf)
    target = staging.clean_queries(source.where(F.col("start_time") < temporal.at(MIDDLE)))
    target = target.withColumn("query_text", F.lit("OLD"))
    return staging.stg_query_history(source, AS_OF, target).select(
        "query_id", "query_text", "warehouse_name", "start_time"
    )


@query("stg_customer_events_incremental")
def crm_incremental(spark, sf):
    raw = logs.customer_events(spark, sf)
    target = staging.typed_events(raw.where(F.col("value.event_timestamp") < temporal.at(MIDDLE)))
    target = target.withColumn("channel", F.lit("old"))
    return staging.stg_customer_events(raw, target)


def _versions(spark, sf, label):
    return logs.table(spark, sf, "events").select(
        "event_id", F.lit(label).alias("version"), "value", "ts"
    )


@query("delete_insert")
def replaced(spark, sf):
    target = _versions(spark, sf, "old").where("event_id % 3 <> 0")
    batch = _versions(spark, sf, "new").where("event_id % 2 = 0")
    twice = batch.unionByName(batch.where("event_id % 4 = 0"))
    return incremental.delete_insert(target, twice, ["event_id"])


@query("upsert")
def upserted(spark, sf):
    target = _versions(spark, sf, "old").where("event_id % 3 <> 0")
    batch = _versions(spark, sf, "new").where("event_id % 2 = 0")
    later = batch.withColumns(
        {"version": F.lit("newer"), "ts": temporal.dateadd("hour", 1, F.col("ts"))}
    )
    return incremental.upsert(target, batch.unionByName(later), ["event_id"], ["ts"])


@query("latest_by_key")
def latest(spark, sf):
    rows = logs.landing_rows(spark, sf)
    return ordered.latest_by_key(
        rows, ["id"], ["updated_at", "seq"], exclude=["ingested_at", "is_deleted"]
    )


@query("latest_is_deleted")
def latest_deleted(spark, sf):
    rows = logs.landing_rows(spark, sf)
    gone = ordered.latest_by_key(
        rows, ["id"], ["updated_at", "seq"], where=F.col("is_deleted")
    )
    return gone.select("id", "updated_at")


@query("cdc_apply")
def cdc(spark, sf):
    rows = logs.landing_rows(spark, sf)
    arguments = (["id"], ["updated_at", "seq"], "is_deleted", "ingested_at")
    first = incremental.cdc_apply(None, rows.where(F.col("ingested_at") < temporal.at(MIDDLE)), *arguments)
    return incremental.cdc_apply(first, rows, *arguments)


@query("snapshot_check")
def snapshot(spark, sf):
    raw = logs.raw_users(spark, sf)
    key = F.col("user_id")
    before = raw.where(key % 10 != 9)
    after = raw.where(key % 10 != 8).withColumn(
        "plan", F.when(key % 5 == 0, "CHANGED").otherwise(F.col("plan"))
    )
    tracked = ["country", "plan", "status"]
    history = incremental.snapshot_check(None, before, "user_id", tracked, datetime(2024, 1, 1))
    return incremental.snapshot_check(history, after, "user_id", tracked, datetime(2024, 1, 31))


# --- table loaders: an empty first load, then the same load twice ------------------------


@query("load_query_history")
def loaded_queries(spark, sf):
    source, location = logs.query_history(spark, sf), scratch_path(spark, "load-queries")
    for rows in (source.where(F.lit(False)), source, source):
        table = build.load_query_history(spark, rows, location, AS_OF)
    return table


@query("load_customer_events")
def loaded_events(spark, sf):
    source, location = logs.customer_events(spark, sf), scratch_path(spark, "load-events")
    for rows in (source.where(F.lit(False)), source, source):
        table = build.load_customer_events(spark, rows, location)
    return table


@query("load_snapshot")
def loaded_snapshot(spark, sf):
    raw, location = logs.raw_users(spark, sf), scratch_path(spark, "load-snapshot")
    key, tracked = F.col("user_id"), ["country", "plan", "status"]
    after = raw.where(key % 10 != 8).withColumn(
        "plan", F.when(key % 5 == 0, "CHANGED").otherwise(F.col("plan"))
    )
    runs = (
        (raw.where(F.lit(False)), datetime(2023, 12, 31)),
        (raw.where(key % 10 != 9), datetime(2024, 1, 1)),
        (after, datetime(2024, 1, 31)),
        (after, datetime(2024, 2, 1)),
    )
    for rows, as_of in runs:
        table = build.load_snapshot(spark, rows, location, "user_id", tracked, as_of)
    return table


@query("changed_keys")
def key_diff(spark, sf):
    raw = logs.raw_users(spark, sf)
    key = F.col("user_id")
    after = raw.where(key % 10 != 8).withColumn(
        "plan", F.when(key % 5 == 0, "CHANGED").otherwise(F.col("plan"))
    )
    return incremental.changed_keys(raw.where(key % 10 != 9), after, "user_id", ["country", "plan", "status"])


@query("active_count")
def gold(spark, sf):
    return incremental.active_count(latest(spark, sf), "country", "id")


def _daily_events(spark, sf):
    return logs.table(spark, sf, "events").select(
        "event_id", "value", F.col("ts").cast("date").alias("day")
    )


@query("overwrite_partitions")
def partitions_replaced(spark, sf):
    location = scratch_path(spark, "overwrite-partitions")
    daily = _daily_events(spark, sf)
    overwrite_partitions(daily, location, "day")
    fixed = daily.where(F.col("day") >= temporal.on("2024-01-20")).withColumn("value", -F.col("value"))
    overwrite_partitions(fixed, location, "day")
    return spark.read.parquet(location)


@query("run_microbatches")
def microbatched(spark, sf):
    location = scratch_path(spark, "microbatches")
    daily = _daily_events(spark, sf)

    def load(start: date, end: date) -> None:
        day = F.col("day")
        batch = daily.where((day >= temporal.on(start)) & (day < temporal.on(end)))
        overwrite_partitions(batch, location, "day")

    incremental.run_microbatches(load, *incremental.date_range(daily, "day"), step_days=10)
    return spark.read.parquet(location)


@query("swap_table")
def swapped(spark, sf):
    table = VersionedTable(spark, scratch_path(spark, "swap"))
    daily = _daily_events(spark, sf)
    table.swap(daily)
    backfill = daily.withColumn("value", F.col("value") + 1)
    table.swap(backfill, validate=lambda new: not new.where("value is null").limit(1).count())
    return table.read()


@query("replace_range")
def backfilled(spark, sf):
    target = _versions(spark, sf, "old")
    batch = _versions(spark, sf, "fixed").where("event_id % 2 = 0")
    return incremental.replace_range(target, batch, "ts", datetime(2024, 1, 10), datetime(2024, 1, 20))


def _sales_rules():
    return {
        "chk_amount": F.col("amount") > 20000,
        "chk_date": F.when(F.col("sale_id") % 9 != 0, F.col("sale_date") >= temporal.on("1996-01-01")),
    }


@query("enforce_accepted")
def accepted(spark, sf):
    return incremental.enforce(logs.sales(spark, sf), _sales_rules(), "quarantine")[0]


@query("enforce_rejected")
def rejected(spark, sf):
    bad = incremental.enforce(logs.sales(spark, sf), _sales_rules(), "quarantine")[1]
    return bad.withColumn("violations", F.array_join("violations", ","))


# --- windows, functions, sampling -----------------------------------------------------


@query("running_monthly_total")
def monthly_running(spark, sf):
    monthly = logs.sales(spark, sf).withColumn("sale_month", temporal.trunc_date("month", F.col("sale_date")))
    return ordered.running_sum(monthly, ["sale_month"], ["sale_date", "sale_id"], "amount", "cumulative")


@query("running_monthly_total_sliced")
def monthly_running_sliced(spark, sf):
    monthly = logs.sales(spark, sf).withColumn("sale_month", temporal.trunc_date("month", F.col("sale_date")))
    order = ["sale_date", "sale_id"]
    return ordered.running_sum(monthly, ["sale_month"], order, "amount", "cumulative", slices=150)


@query("running_total_with_peers")
def peers_running(spark, sf):
    return ordered.running_sum_with_peers(
        logs.sales(spark, sf), ["customer_id"], "sale_date", "amount", "cumulative"
    )


@query("running_total_with_peers_sliced")
def peers_running_sliced(spark, sf):
    return ordered.running_sum_with_peers(
        logs.sales(spark, sf), ["customer_id"], "sale_date", "amount", "cumulative", slices=64
    )


@query("domain_mapping")
def mapped_names(spark, sf):
    names = logs.query_history(spark, sf).select("query_id", "warehouse_name", "database_name")
    return names.select(
        "query_id",
        naming.domain_from_warehouse(F.col("warehouse_name")).alias("wh_domain"),
        naming.domain_from_warehouse(F.col("warehouse_name"), extended=True).alias("wh_domain_ext"),
        naming.domain_from_database(F.col("database_name")).alias("db_domain"),
        naming.environment_from_name(F.col("warehouse_name")).alias("environment"),
    )


@query("date_functions")
def dates(spark, sf):
    ts, later = F.col("ts"), temporal.dateadd("second", 90061, F.col("ts"))
    as_text = F.when(F.col("event_id") % 2 == 0, "2024-02-30").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    as_moment = F.when(F.col("event_id") % 3 == 0, "later").otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    )
    return logs.table(spark, sf, "events").select(
        "event_id",
        temporal.date_part("YEAR", ts).cast("long").alias("year"),
        F.extract(F.lit("DOY"), ts).cast("long").alias("day_of_year"),
        temporal.trunc_ts("hour", ts).alias("hour"),
        temporal.trunc_date("month", ts.cast("date")).alias("month"),
        temporal.datediff_boundary("second", ts, later).alias("seconds"),
        temporal.datediff_boundary("minute", ts, later).alias("minutes"),
        temporal.datediff_boundary("hour", ts, later).alias("hours"),
        temporal.datediff_boundary("day", ts, later).cast("long").alias("days"),
        temporal.datediff_boundary("month", ts, later).cast("long").alias("months"),
        temporal.dateadd("month", 1, ts).alias("next_month"),
        F.try_to_date(as_text, "yyyy-MM-dd").alias("maybe_date"),
        F.to_date(F.date_format("ts", "yyyy-MM-dd")).alias("parsed_date"),
        temporal.to_timestamp(as_moment).alias("parsed_time"),
    )


@query("array_functions")
def arrays(spark, sf):
    k = F.col("k").cast("long")
    items = F.array(k, k % 7, k % 3, k % 7)
    return logs.events(spark, sf).select("event_id", items.alias("items")).select(
        "event_id",
        F.array_join(text.keep(F.col("items"), lambda x: x > 2), ",").alias("kept"),
        F.size(F.array_distinct("items")).cast("long").alias("n_distinct"),
        text.any_match(F.col("items"), lambda x: x > 90).alias("any_over_90"),
        text.all_match(F.col("items"), lambda x: x >= 1).alias("all_positive"),
        F.array_join(F.transform("items", lambda x: x * 2), ",").alias("doubled"),
        text.total(F.col("items")).alias("total"),
        F.array_min("items").alias("smallest"),
        F.array_max("items").alias("largest"),
    )


@query("variant_events")
def variant_rows(spark, sf):
    """The event model over a semi-structured column instead of a struct."""
    as_json = F.to_json("value", {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"})
    raw = logs.customer_events(spark, sf).select(text.parse_json(as_json).alias("value"))
    return staging.typed_events(raw)


@query("sample_window")
def sampled(spark, sf):
    events = logs.table(spark, sf, "events").select("event_id", "ts")
    return sources.sample_window(events, "ts", last="3 days", as_of=AS_OF)


# --- checks ---------------------------------------------------------------------------

_MODELS = {
    "raw_users": logs.raw_users,
    "raw_transactions": logs.raw_transactions,
    "stg_users": users,
    "stg_transactions": transactions,
    "stg_customer_events": crm_events,
    "stg_warehouse_metering": metering,
    "stg_query_history": qh,
    "stg_autoclustering_history": acl,
    "query_behavior": behavior,
    "warehouse_efficiency_summary": efficiency_summary,
    "user_transactions": joined_transactions,
    "data_skew": skew,
    "freshness_gaps": gaps,
    "automation_errors": errors,
    "rpt_warehouse_efficiency": efficiency,
    "rpt_warehouse_behavior": behavior_report,
    "rpt_cohort_retention": cohort_report,
    "fct_query_spilling": spilling_fact,
    "rpt_autoclustering_monthly": clustering_monthly,
    "rpt_cache_performance": cache_summary,
    "rpt_spilling_summary": spilling_summary,
    "fct_quality_monitoring": monitoring,
}


def _declared(model: str) -> Query:
    return lambda s, d: checks.run_checks(_MODELS[model](s, d), MODEL_CHECKS[model])


for _model in MODEL_CHECKS:
    query(f"checks_{_model}")(_declared(_model))


@query("check_not_null")
def missing_sizes(spark, sf):
    return checks.not_null(qh(spark, sf), "warehouse_size").select("query_id")


@query("check_unique")
def repeated_orders(spark, sf):
    return checks.unique(logs.table(spark, sf, "lineitem"), "l_orderkey")


@query("check_accepted_values")
def unknown_events(spark, sf):
    return checks.accepted_values(crm_events(spark, sf), "event_type", EVENT_TYPES)


@query("check_expression_is_true")
def critical_skew(spark, sf):
    rows = checks.expression_is_true(skew(spark, sf), F.expr("skew_status != 'CRITICAL_SKEW'"))
    return rows.select("query_id", "skew_status")


@query("source_freshness")
def freshness(spark, sf):
    return checks.source_freshness(logs.query_history(spark, sf), "start_time", AS_OF, 24, 48)


def _sources(spark, sf):
    """Every source with declared limits, and what the build reads besides."""
    return {
        "query_history": logs.query_history(spark, sf),
        "warehouse_metering_history": logs.warehouse_metering(spark, sf),
        "login_history": logs.login_history(spark, sf),
        "access_history": logs.access_history(spark, sf),
        "automatic_clustering_history": logs.autoclustering_history(spark, sf),
        "ext_customer_events": logs.customer_events(spark, sf),
        "raw_users": logs.raw_users(spark, sf),
        "raw_transactions": logs.raw_transactions(spark, sf),
    }


@query("source_freshness_all")
def all_freshness(spark, sf):
    return checks.source_freshness_all(_sources(spark, sf), sources.freshness_limits(), AS_OF)


query("assert_no_critical_gaps")(lambda s, d: quality.critical_gaps(gaps(s, d)))

# --- sources written as files and scanned by name; the build and its sinks -------------


def _scanned(spark: SparkSession, sf: str, name: str, sample: str | None = None) -> DataFrame:
    location = scratch_path(spark, name)
    write_table(_sources(spark, sf)[name], location)
    return sources.source(spark, name, location, sample, AS_OF)


@query("source_usage_log")
def scanned_queries(spark, sf):
    return staging.stg_query_history(_scanned(spark, sf, "query_history"), AS_OF)


@query("source_sample")
def sampled_logins(spark, sf):
    return _scanned(spark, sf, "login_history", "3 days")


query("source_app_table")(lambda s, d: staging.stg_users(_scanned(s, d, "raw_users")))


@query("seed_calendar")
def seeded(spark, sf):
    """A CSV with a header row and dates, as a seed."""
    nation = logs.table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("long").alias("code"),
        F.col("n_name").alias("name"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("n_nationkey").cast("int")).alias("opened"),
    )
    location = scratch_path(spark, "seed")
    nation.write.option("header", True).csv(location)
    return sources.load_seed(spark, location, nation.schema)


@query("source_event_files")
def refreshed_events(spark, sf):
    """Event files pushed in two turns, read anew after each."""
    location, raw = scratch_path(spark, "event-files"), logs.customer_events(spark, sf)
    first = F.col("value.event_timestamp") < temporal.at(MIDDLE)
    target = None
    for part in (raw.where(first), raw.where(~first)):
        part.write.mode("append").parquet(location)
        # Kept as a table, as the load would: the next turn appends to the files read here.
        kept = scratch_path(spark, "event-table")
        write_table(staging.stg_customer_events(sources.read_events(spark, location), target), kept)
        target = spark.read.parquet(kept)
    return target


@query("empty_run")
def validated(spark, sf):
    """Every mart built from sources without rows: plans and schemas hold, nothing is read."""
    nothing = {name: sources.empty_like(df) for name, df in _sources(spark, sf).items()}
    tables = build.build_marts(spark, nothing, scratch_path(spark, "empty-marts"), AS_OF)
    counts = [
        table.agg(F.count("*").alias("rows")).select(F.lit(name).alias("model"), "rows")
        for name, table in sorted(tables.items())
    ]
    return reduce(DataFrame.unionByName, counts)


@query("built_mart")
def built(spark, sf):
    out = scratch_path(spark, "marts")
    build.build_marts(spark, _sources(spark, sf), out, AS_OF)
    return spark.read.parquet(f"{out}/rpt_warehouse_efficiency")


@query("built_views")
def viewed(spark, sf):
    """Marts as views, asked in SQL."""
    build.register_views(build.build_marts(spark, _sources(spark, sf), scratch_path(spark, "marts"), AS_OF))
    return spark.sql(
        """SELECT s.warehouse_name, s.queries, v.versions, e.events
        FROM (SELECT warehouse_name, count(*) AS queries FROM stg_query_history GROUP BY ALL) s,
          (SELECT count(*) AS versions FROM snp_users) v, (SELECT count(*) AS events FROM stg_customer_events) e"""
    )


@query("build_checks")
def build_checked(spark, sf):
    """The declared checks over raw, staged, intermediate and final tables of one build."""
    tables = build.build_marts(spark, _sources(spark, sf), scratch_path(spark, "marts"), AS_OF)
    return build.check_tables(tables, raise_on=lambda severity: False)


# --- streams, run over what is there and read back ------------------------------------


def _run(stream: DataFrame, label: str) -> DataFrame:
    spark = stream.sparkSession
    root = scratch_path(spark, label)
    ingest.land(stream, f"{root}/data", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/data")


def _windows(aggregate: DataFrame, keys: list[str]) -> DataFrame:
    """Every window's last state."""
    log = ingest.EventLog(aggregate.sparkSession, scratch_path(aggregate.sparkSession, "windows"), "window_key")
    ingest.upsert_windows(aggregate, log, keys).awaitTermination()
    return log.current().drop("window_key")


@query("stream_landing")
def landed(spark, sf):
    columns = {"event_id": "id", "event_type": "kind", "ts": "ts"}
    schema = logs.table(spark, sf, "events").schema
    stream = ingest.stream_events(spark, sf, schema, columns, glob="events.parquet")
    return _run(stream, "landing")


@query("stream_hourly_volume")
def volume_stream(spark, sf):
    stream = logs.event_stream(spark, sf).select(
        "ts",
        F.concat(F.lit("DB.S.T"), (F.col("k") % 5).cast("string")).alias("full_table_name"),
        F.col("k").cast("long").alias("rows_inserted"),
    )
    volume = windows.hourly_volume(stream, "ts", "full_table_name", "rows_inserted")
    return _windows(volume, ["window_start", "full_table_name"])


@query("stream_failed_logins")
def login_stream(spark, sf):
    stream = logs.logins_of(logs.event_stream(spark, sf))
    return _windows(windows.failed_logins(stream, n=2, window="1 hour"), ["window_start", "user_name"])


def _pushed(spark: SparkSession, sf: str, by: Column, parts: int = 3) -> DataFrame:
    """The events as a stream of several files, cut by ``by``, one file a micro-batch."""
    folder = scratch_path(spark, "pushed")
    source = logs.table(spark, sf, "events")
    source.repartitionByRange(parts, by).write.parquet(folder)
    reader = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1)
    return logs.with_k(reader.parquet(folder))


@query("stream_activity_sessions")
def session_stream(spark, sf):
    stream = logs.queries_of(_pushed(spark, sf, F.col("ts")))
    active = stream.where(F.col("warehouse_name").isNotNull()).select("warehouse_name", "start_time")
    table = keyed.SessionTable(spark, scratch_path(spark, "sessions"), ["warehouse_name"])
    # Files are listed in no order of time.
    table.feed(active, "start_time", late="60 days").awaitTermination()
    return table.read()


@query("stream_first_per_key")
def first_stream(spark, sf):
    events = logs.event_stream(spark, sf).select("event_id", "event_type", "ts")
    return _run(windows.first_per_key(events, "event_id", "ts"), "first")


@query("stream_event_log")
def event_log_stream(spark, sf):
    log = ingest.EventLog(spark, scratch_path(spark, "event-log"), "event_id")
    stream = staging.typed_events(logs.event_values(logs.event_stream(spark, sf)))
    # The second stream starts from a checkpoint of its own and reads everything again.
    for name in ("first", "second"):
        checkpoint = f"{log.root}/checkpoint-{name}"
        ingest.ingest_events(stream, log, "event_timestamp", checkpoint=checkpoint).awaitTermination()
    return log.current()


@query("stream_backfill")
def backfilled_stream(spark, sf):
    """The sign-ups of the second week take the place of all its rows."""
    log = ingest.EventLog(spark, scratch_path(spark, "event-log"), "event_id")
    stream = staging.typed_events(logs.event_values(logs.event_stream(spark, sf)))
    ingest.ingest_events(stream, log, "event_timestamp").awaitTermination()
    again = crm_events(spark, sf).where(F.col("event_type") == "signup")
    log.backfill(again, "event_timestamp", datetime(2024, 1, 8), datetime(2024, 1, 15))
    # A second stream reads everything again; the backfill's range stays the backfill's.
    second = f"{log.root}/checkpoint-second"
    ingest.ingest_events(stream, log, "event_timestamp", None, checkpoint=second).awaitTermination()
    return log.current()


def _latest_users(spark, sf):
    """Latest event per user, from files that hold times in no order."""
    stream = _pushed(spark, sf, F.xxhash64("event_id")).select(
        F.col("user_id").alias("id"), "event_type", "value", "ts", "event_id"
    )
    location = scratch_path(spark, "latest")
    table = keyed.LatestTable(spark, location, ["id"], ["ts", "event_id"], group="event_type")
    table.feed(stream).awaitTermination()
    return table


@query("stream_latest_state")
def latest_stream(spark, sf):
    return _latest_users(spark, sf).read()


@query("stream_active_count")
def active_stream(spark, sf):
    """Counts kept by the stream; the group of a landing row is its event type."""
    return _latest_users(spark, sf).counts().withColumnRenamed("event_type", "country")
