from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, SAMPLE
from usagelens.operators.incremental import snapshot_check
from usagelens.plans import build
from usagelens.plans.model_checks import MODEL_CHECKS
from usagelens.session import scratch_path
from usagelens.sources import sample_logs as logs
from usagelens.sources.sinks import overwrite_partitions, partitions_holding, replace_keys

from registry.spark_queries import QUERIES

MARTS = (
    "rpt_warehouse_efficiency", "rpt_warehouse_behavior", "fct_data_skew", "fct_query_spilling", "rpt_spilling_summary",
    "rpt_cache_performance", "rpt_autoclustering_monthly", "freshness_gaps", "automation_errors", "fct_quality_monitoring",
    "rpt_cohort_retention",
)


def inputs(spark):
    return {
        "query_history": logs.query_history(spark, SAMPLE),
        "warehouse_metering_history": logs.warehouse_metering(spark, SAMPLE),
        "access_history": logs.access_history(spark, SAMPLE),
        "automatic_clustering_history": logs.autoclustering_history(spark, SAMPLE),
        "raw_users": logs.raw_users(spark, SAMPLE),
        "raw_transactions": logs.raw_transactions(spark, SAMPLE),
        "ext_customer_events": logs.customer_events(spark, SAMPLE),
    }


def as_text(df):
    doubles = [F.col(c).cast("double").alias(c) if t.startswith("decimal") or t in ("int", "bigint") else F.col(c) for c, t in df.dtypes]
    return sorted(map(repr, df.select(*doubles).collect()))


def test_build_equals_lazy_models(spark):
    out = scratch_path(spark, "marts")
    tables = build.build_marts(spark, inputs(spark), out, AS_OF)
    for name in MARTS:
        lazy = QUERIES[name](spark, SAMPLE)
        assert as_text(tables[name].select(*lazy.columns)) == as_text(lazy), name
    assert tables["stg_customer_events"].count() == inputs(spark)["ext_customer_events"].count()
    assert tables["snp_users"].where("valid_to IS NULL").count() == tables["raw_users"].count()
    found = build.check_tables(tables, raise_on=lambda severity: False)
    models = {r.model for r in found.select("model").distinct().collect()}
    assert models == set(MODEL_CHECKS) & set(tables) and len(models) >= 20
    assert models >= {"raw_users", "stg_users", "query_behavior", "data_skew", "user_transactions", "rpt_cohort_retention"}
    build.register_views(tables)
    worst = spark.sql("SELECT max(execution_time_ms) FROM fct_query_spilling").first()[0]
    assert worst == tables["fct_query_spilling"].agg({"execution_time_ms": "max"}).first()[0]
    with pytest.raises(build.CheckFailure, match="rpt_cohort_retention"):
        # Orphan transactions give a row without a cohort.
        orphaned = dict(inputs(spark))
        orphaned["raw_users"] = orphaned["raw_users"].where("user_id > 5")
        build.check_tables(build.build_marts(spark, orphaned, scratch_path(spark, "marts"), AS_OF))


@pytest.mark.parametrize("fixed", [False, True])
def test_second_load_rewrites_only_touched_days(spark, fixed):
    location = scratch_path(spark, "qh")
    source = logs.query_history(spark, SAMPLE)
    middle = datetime(2024, 1, 20)
    build.load_query_history(spark, source.where(F.col("start_time") < F.lit("2024-01-20").cast("timestamp_ntz")), location, AS_OF)
    files = lambda: {r[0] for r in spark.read.parquet(location).select(F.input_file_name()).distinct().collect()}
    before = files()
    build.load_query_history(spark, source, location, AS_OF, start_times_fixed=fixed)
    kept = {f.split("start_day=")[1][:10] for f in before & files()}
    newest = (middle - timedelta(days=1)).date()
    assert kept and max(kept) < str(newest - timedelta(days=2))
    loaded = spark.read.parquet(location)
    everything = QUERIES["stg_query_history"](spark, SAMPLE)
    assert loaded.count() == everything.count() == loaded.select("query_id").distinct().count()


def test_replace_keys_moves_and_empties_partitions(spark, rows):
    location = scratch_path(spark, "keys")
    overwrite_partitions(spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "b", "x"), (4, "c", "x")], "id int, p string, v string"), location, "p")
    batch = spark.createDataFrame([(3, "d", "new"), (1, "a", "new")], "id int, p string, v string")
    touched = replace_keys(spark, location, batch, ["id"], "p")
    assert sorted(touched) == ["a", "b", "d"]
    expected = [(1, "a", "new"), (2, "a", "x"), (3, "d", "new"), (4, "c", "x")]
    assert rows(spark.read.parquet(location), "id", "p", "v") == expected
    replace_keys(spark, location, batch, ["id"], "p")
    assert rows(spark.read.parquet(location), "id", "p", "v") == expected


def test_key_search_opens_no_partition_of_the_table(spark, rows):
    location = scratch_path(spark, "crm")
    raw = logs.customer_events(spark, SAMPLE)
    build.load_customer_events(spark, raw, location)
    table = spark.read.parquet(location)
    batch = spark.createDataFrame([("e3",), ("e500",), (None,)], "event_id string")
    found = partitions_holding(spark, location, table, batch, ["event_id"], "event_day")
    expected = table.where("event_id IN ('e3', 'e500')").select("event_day").distinct()
    assert rows(found) == rows(expected) and 1 <= expected.count() <= 2
    scans = [
        line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line
    ]
    assert scans and all("PartitionFilters: [bucket#" in line or "), (bucket#" in line or "[isnotnull(bucket" in line for line in scans)
    assert found.inputFiles() and all(f"{location}_keys/bucket=" in file for file in found.inputFiles())
    buckets = {r.bucket for r in spark.read.parquet(f"{location}_keys").select("bucket").distinct().collect()}
    assert len(buckets) == 32
    # A table older than its index gets one.
    bare = scratch_path(spark, "bare")
    overwrite_partitions(table, bare, "event_day")
    assert rows(partitions_holding(spark, bare, table, batch, ["event_id"], "event_day")) == rows(expected)


def test_replace_keys_with_null_partition(spark, rows):
    location = scratch_path(spark, "nulls")
    shape = "id int, p string, v string"
    overwrite_partitions(spark.createDataFrame([(1, None, "x"), (2, None, "x"), (3, "b", "x")], shape), location, "p")
    replace_keys(spark, location, spark.createDataFrame([(1, None, "new")], shape), ["id"], "p")
    assert rows(spark.read.parquet(location), "id", "p", "v") == [(1, None, "new"), (2, None, "x"), (3, "b", "x")]
    replace_keys(spark, location, spark.createDataFrame([(1, "b", "moved"), (2, "b", "moved")], shape), ["id"], "p")
    assert rows(spark.read.parquet(location), "id", "p", "v") == [(1, "b", "moved"), (2, "b", "moved"), (3, "b", "x")]


def test_customer_events_load(spark):
    location = scratch_path(spark, "crm")
    raw = logs.customer_events(spark, SAMPLE)
    early = raw.where(F.col("value.event_timestamp") < F.lit("2024-01-20").cast("timestamp_ntz"))
    build.load_customer_events(spark, early, location)
    assert build.load_customer_events(spark, raw, location).count() == raw.count()


def test_snapshot_table_equals_pure_history(spark, rows):
    location, history = scratch_path(spark, "snapshot"), None
    states = ([(1, "a"), (2, "a")], [(1, "b"), (3, "a")], [(1, "b"), (3, "a")], [(1, "a"), (2, "c")])
    for day, state in enumerate(states, start=1):
        current = spark.createDataFrame(state, "user_id int, plan string")
        arguments = ("user_id", ["plan"], datetime(2024, 1, day))
        history = snapshot_check(history, current, *arguments)
        stored = build.load_snapshot(spark, current, location, *arguments)
        stored = build.load_snapshot(spark, current, location, *arguments)   # again: no change
        assert rows(stored, *history.columns) == rows(history)
    # Every run wrote what it opened and closed, and nothing again.
    versions = spark.read.parquet(f"{location}/versions")
    assert versions.count() == history.count() == versions.select("scd_id").distinct().count()
    assert versions.where("opened_in = 'run 20240103T000000'").isEmpty()
    assert spark.read.parquet(f"{location}/closings").count() == history.where("valid_to IS NOT NULL").count()
