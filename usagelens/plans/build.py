"""Batch build: staging tables once, then every mart from them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.functions.temporal import at
from usagelens.operators.checks import run_checks
from usagelens.operators.incremental import high_water_mark, snapshot_check
from usagelens.plans import cost, performance, quality, retention, staging
from usagelens.plans.model_checks import MODEL_CHECKS
from usagelens.session import Settings, scratch_path
from usagelens.sources.sinks import (
    overwrite_partitions,
    replace_keys,
    table_or_none,
    write_table,
)


# Columns whose change opens a new version of a user.
SNAPSHOT_COLUMNS = ("country", "plan", "status")


class CheckFailure(ValueError):
    """A check of severity ``error`` found failing rows."""


def load_query_history(
    spark: SparkSession,
    src: DataFrame,
    location: str,
    as_of: datetime,
    cfg: Settings = Settings(),
    start_times_fixed: bool = False,
) -> DataFrame:
    """Incremental staging table of queries, partitioned by start day.

    It feeds seven models, so it is written once and read back with only the columns each
    of them needs. A later run rewrites the days its keys touch, not the table. With
    ``start_times_fixed`` (the source never restates when a query began) it looks for its
    keys in the days of the lookback only.
    """


    def dated_since(start: datetime) -> DataFrame:
        batch = staging.clean_queries(src.where(F.col("start_time") >= at(start)))
        return batch.withColumn("start_day", F.col("start_time").cast("date"))

    first = as_of - timedelta(days=cfg.window_days)
    schema = dated_since(first).schema
    newest = high_water_mark(table_or_none(spark, location, schema), "start_time")
    start = first if newest is None else newest - timedelta(days=cfg.lookback_days)
    dated = dated_since(start)
    since = start.date() if start_times_fixed else None
    replace_keys(spark, location, dated, ["query_id"], "start_day", since)
    return spark.read.schema(schema).parquet(location).drop("start_day")


def load_customer_events(
    spark: SparkSession, raw: DataFrame, location: str, cfg: Settings = Settings()
) -> DataFrame:
    """Incremental staging table of customer events, partitioned by event day."""

    def dated(events: DataFrame) -> DataFrame:
        return events.withColumn("event_day", F.col("event_timestamp").cast("date"))

    schema = dated(staging.new_events(raw, None, cfg.event_lookback_hours)).schema
    target = table_or_none(spark, location, schema)
    batch = dated(staging.new_events(raw, target, cfg.event_lookback_hours))
    replace_keys(spark, location, batch, ["event_id"], "event_day")
    return spark.read.schema(schema).parquet(location).drop("event_day")


def load_snapshot(
    spark: SparkSession,
    current: DataFrame,
    location: str,
    key: str,
    check_cols: Sequence[str],
    as_of: datetime,
) -> DataFrame:
    """Slowly changing history as two tables that only grow: versions as they were opened, and
    when versions were closed.

    A run adds rows for the keys it opens or closes a version of, in partitions of its own,
    and rewrites nothing. It does not look at what it wrote itself, so a run that died can be
    repeated with the same input.
    """
    versions, closings = f"{location}/versions", f"{location}/closings"
    run, stamp = f"run {as_of:%Y%m%dT%H%M%S}", at(as_of)
    schema = snapshot_check(None, current, key, check_cols, as_of).drop("valid_to").schema
    opened = T.StructType([*schema.fields, T.StructField("opened_in", T.StringType())])
    closed = T.StructType.fromDDL("scd_id string, valid_to timestamp_ntz, closed_in string")

    def history(but: str | None) -> DataFrame | None:
        known = table_or_none(spark, versions, opened)
        if known is None:
            return None
        ends = table_or_none(spark, closings, closed)
        if but is not None:
            known = known.where(F.col("opened_in") != but)
            ends = ends.where(F.col("closed_in") != but) if ends is not None else None
        if ends is None:
            ends = spark.createDataFrame([], closed)
        return known.drop("opened_in").join(ends.select("scd_id", "valid_to"), "scd_id", "left").select(
            *schema.fieldNames(), "valid_to"
        )

    before = history(run)
    if before is not None:
        before = before.where(F.col("valid_to").isNull())
    after = snapshot_check(before, current, key, check_cols, as_of)
    touched = after.where((F.col("valid_from") == stamp) | (F.col("valid_to") == stamp))
    staged = scratch_path(spark, "snapshot")
    write_table(touched, staged)
    touched = spark.read.schema(after.schema).parquet(staged)
    new = touched.where(F.col("valid_to").isNull()).drop("valid_to")
    overwrite_partitions(new.withColumn("opened_in", F.lit(run)), versions, "opened_in")
    ended = touched.where(F.col("valid_to").isNotNull()).select("scd_id", "valid_to")
    overwrite_partitions(ended.withColumn("closed_in", F.lit(run)), closings, "closed_in")
    done = history(None)
    return spark.createDataFrame([], after.schema) if done is None else done


def build_marts(
    spark: SparkSession,
    inputs: Mapping[str, DataFrame],
    out: str,
    as_of: datetime,
    cfg: Settings = Settings(),
) -> dict[str, DataFrame]:
    """Build every mart from the source tables and write it under ``out``.

    ``inputs`` holds the registered sources by name. Work and billing use the same window.
    Besides the written tables the result holds the raw and intermediate ones that have
    declared checks.
    """
    tables: dict[str, DataFrame] = {name: inputs[name] for name in ("raw_users", "raw_transactions")}

    def written(name: str, df: DataFrame) -> DataFrame:
        write_table(df, f"{out}/{name}")
        tables[name] = spark.read.parquet(f"{out}/{name}")
        return tables[name]

    qh = load_query_history(spark, inputs["query_history"], f"{out}/stg_query_history", as_of, cfg)
    tables["stg_query_history"] = qh
    recent = qh.where(staging.since("start_time", as_of, cfg.window_days))
    metering = written(
        "stg_warehouse_metering",
        staging.stg_warehouse_metering(
            inputs["warehouse_metering_history"], as_of, cfg.window_days
        ),
    )
    writes = staging.stg_access_history_writes(inputs["access_history"], as_of, cfg.window_days)
    acl = staging.stg_autoclustering_history(
        inputs["automatic_clustering_history"], as_of, cfg.window_days
    )
    users = written("stg_users", staging.stg_users(inputs["raw_users"]))
    tx = written("stg_transactions", staging.stg_transactions(inputs["raw_transactions"]))
    tables["stg_autoclustering_history"] = acl
    tables["stg_customer_events"] = load_customer_events(
        spark, inputs["ext_customer_events"], f"{out}/stg_customer_events", cfg
    )
    tables["snp_users"] = load_snapshot(
        spark, inputs["raw_users"], f"{out}/snp_users", "user_id", SNAPSHOT_COLUMNS, as_of
    )

    tables["warehouse_efficiency_summary"] = cost.warehouse_efficiency_summary(metering, recent, cfg)
    written("rpt_warehouse_efficiency", cost.rpt_warehouse_efficiency(tables["warehouse_efficiency_summary"]))
    tables["query_behavior"] = cost.query_behavior(qh)
    written("rpt_warehouse_behavior", cost.rpt_warehouse_behavior(tables["query_behavior"]))
    tables["data_skew"] = performance.data_skew(qh)
    written("fct_data_skew", performance.fct_data_skew(tables["data_skew"], as_of))
    spilling = performance.spilling_performance(qh, as_of, cfg.window_days)
    written("fct_query_spilling", performance.fct_query_spilling(spilling))
    written("rpt_spilling_summary", performance.rpt_spilling_summary(spilling))
    cache = performance.cache_performance(qh, as_of, cfg.window_days)
    written("rpt_cache_performance", performance.rpt_cache_performance(cache))
    daily = performance.autoclustering_daily(acl)
    written("rpt_autoclustering_monthly", performance.rpt_autoclustering_monthly(daily))
    gaps = written("freshness_gaps", quality.freshness_gaps(qh, writes, as_of))
    errors = written("automation_errors", quality.automation_errors(qh, as_of, cfg.window_days))
    written("fct_quality_monitoring", quality.fct_quality_monitoring(gaps, errors, as_of))
    tables["user_transactions"] = retention.user_transactions(users, tx)
    written("rpt_cohort_retention", retention.cohort_retention(users, tx))
    return tables


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make built tables available to ``spark.sql`` under their model names."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def check_tables(
    tables: Mapping[str, DataFrame], raise_on: Callable[[str], bool] = lambda s: s == "error"
) -> DataFrame:
    """Run the declared checks over built tables: one row per table and check."""
    results = None
    for name, table in tables.items():
        if name in MODEL_CHECKS:
            part = run_checks(table, MODEL_CHECKS[name]).select(F.lit(name).alias("model"), "*")
            results = part if results is None else results.unionByName(part)
    failed = [
        f"{row['model']}.{row['check']}"
        for row in results.where(~F.col("passed")).collect()
        if raise_on(row["severity"])
    ]
    if failed:
        raise CheckFailure(", ".join(failed))
    return results
