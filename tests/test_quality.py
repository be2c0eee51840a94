from datetime import datetime, timedelta

import pytest

from usagelens.operators import checks
from usagelens.plans import alerts, quality, reports
from usagelens.sources import registry

AS_OF = datetime(2024, 1, 31, 1, 30)


def inputs(spark, *loads):
    """Loads: (start, tables, rows)."""
    qh = spark.createDataFrame(
        [(f"q{i}", start, rows) for i, (start, _, rows) in enumerate(loads)],
        "query_id string, start_time timestamp_ntz, rows_inserted long",
    )
    writes = spark.createDataFrame(
        [(f"q{i}", start, table) for i, (start, tables, _) in enumerate(loads) for table in tables],
        "query_id string, query_start_time timestamp_ntz, full_table_name string",
    )
    return qh, writes


def test_spine_and_ladder(spark):
    qh, writes = inputs(
        spark,
        (datetime(2024, 1, 30, 5, 10), ["A", "B"], 7),
        (datetime(2024, 1, 30, 22, 59), ["A"], 0),   # 210 minutes ago
        (datetime(2024, 1, 30, 23, 1), ["A"], 0),    # 150 minutes ago
        (datetime(2024, 1, 30, 0, 59), ["A"], 9),    # before the spine
    )
    gaps = quality.freshness_gaps(qh, writes, AS_OF)
    assert gaps.select("check_hour").distinct().count() == 25
    found = {(r.check_hour.hour, r.full_table_name): (r.total_rows_inserted, r.n_queries, r.status) for r in gaps.where("full_table_name is not null").collect()}
    assert found == {
        (5, "A"): (7, 1, "HEALTHY"),
        (5, "B"): (7, 1, "HEALTHY"),
        (22, "A"): (0, 1, "GAP_DETECTED"),
        (23, "A"): (0, 1, "EXPECTED_LAG"),
    }
    strict = quality.freshness_gaps(qh, writes, AS_OF, mode="strict").where("full_table_name is not null")
    assert sorted(r.status for r in strict.collect()) == ["HEALTHY", "HEALTHY", "SILENT_FAILURE", "SILENT_FAILURE"]
    assert quality.critical_gaps(gaps).where("full_table_name is null").count() > 0


@pytest.mark.parametrize("minute, status", [(0, "EXPECTED_LAG"), (1, "GAP_DETECTED")])
def test_lag_boundary(spark, minute, status):
    qh, writes = inputs(spark, (datetime(2024, 1, 30, 22, 10), ["A"], 0))
    gaps = quality.freshness_gaps(qh, writes, datetime(2024, 1, 31, 1, minute))
    row = gaps.where("full_table_name = 'A'").first()
    assert (row.minutes_ago, row.status) == (180 + minute, status)


QH = (
    "query_id string, query_text string, user_name string, warehouse_name string, execution_status string, "
    "error_code string, error_message string, start_time timestamp_ntz, end_time timestamp_ntz, total_elapsed_time long"
)


def failures(spark, *entries):
    start = datetime(2024, 1, 20)
    rows = [(f"q{i}", text, user, "W", status, "1", "boom", start, start, 1250) for i, (text, user, status) in enumerate(entries)]
    return quality.automation_errors(spark.createDataFrame(rows, QH), AS_OF)


def test_automation_ladder_and_report(spark):
    errors = failures(
        spark,
        ("execute task a.b", "X", "FAIL"),
        ("copy into t.x from @s", "my_system", "FAIL"),   # user wins
        ("Copy Into t.x from @s", "dbt_run", "FAIL"),
        ("select", "a_Service", "ERROR"),
        ("select", "nobody", "FAIL"),
        ("execute task a", "X", "SUCCESS"),
        ("execute task a", "X", None),
    )
    report = {r.query_id: (r.automation_type, r.object_name, r.duration_seconds) for r in reports.automation_failures(errors).collect()}
    assert report == {
        "q0": ("TASK", "a.b", 1.3),
        "q1": ("TASK", "my_system", 1.3),
        "q2": ("INGESTION_PIPE", "t.x", 1.3),
        "q3": ("TRANSFORMATION_JOB", "a_Service", 1.3),
    }
    kpis = reports.automation_kpis(errors).first()
    assert tuple(kpis) == (2, 1, 1)


def test_monitoring_union(spark):
    qh, writes = inputs(spark, (datetime(2024, 1, 30, 5), ["A"], 0), (datetime(2024, 1, 30, 6), ["A"], 3))
    gaps = quality.freshness_gaps(qh, writes, AS_OF)
    facts = quality.fct_quality_monitoring(gaps, failures(spark, ("EXECUTE TASK " + "x" * 80, "U", "FAIL")), AS_OF)
    got = {r.alert_level: (r.category, r.total_rows_inserted, r.n_queries, r.is_alert, r.error_message) for r in facts.collect()}
    assert got == {
        "GAP_DETECTED": ("DATA_FLOW", 0, 1, 1, None),
        "HEALTHY": ("DATA_FLOW", 3, 1, 0, None),
        "TASK": ("TECHNICAL_ERROR", None, 1, 1, "boom"),
    }
    text = facts.where("alert_level = 'TASK'").first().event_description
    assert text == "Failed TASK: " + ("EXECUTE TASK " + "x" * 80)[:50]
    flow = reports.data_flow_gaps(facts)
    assert flow.count() == 1 and tuple(reports.data_flow_kpis(flow).first()) == (1, 0)


def test_checks_both_ways(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c"), (None, "a")], "id int, v string")
    clean = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert [tuple(r) for r in checks.unique(df, "id").collect()] == [(1, 2)]
    assert checks.not_null(df, "id").count() == 2
    assert [r.v for r in checks.accepted_values(df, "v", ["a", "b"]).collect()] == ["c"]
    from pyspark.sql import functions as F

    assert checks.expression_is_true(df, F.col("id") < 2).count() == 3
    for failing in (checks.unique(clean, "id"), checks.not_null(clean, "id"), checks.accepted_values(clean, "v", ["a", "b"])):
        assert failing.count() == 0
    declared = [checks.Check("unique", "id"), checks.Check("not_null", "id"), checks.Check("accepted_values", "v", ("a", "b"), severity="warn")]
    result = {r.check: (r.severity, r.failures, r.passed) for r in checks.run_checks(df, declared).collect()}
    assert result == {"unique_id": ("error", 1, False), "not_null_id": ("error", 2, False), "accepted_values_v": ("warn", 1, False)}
    assert all(r.passed for r in checks.run_checks(clean, declared).collect())


def test_source_freshness(spark):
    def status(ts):
        df = spark.createDataFrame([(ts,)], "ts timestamp_ntz")
        return checks.source_freshness(df, "ts", AS_OF, 24, 48).first().status

    assert status(datetime(2024, 1, 30, 1, 30)) == "pass"
    assert status(datetime(2024, 1, 30, 1, 29)) == "warn"
    assert status(datetime(2024, 1, 29, 1, 29)) == "error"
    empty = spark.createDataFrame([], "ts timestamp_ntz")
    assert checks.source_freshness(empty, "ts", AS_OF, 24, 48).first().status == "error"


def test_writes_bounded_by_the_spine_give_the_same_gaps(spark):
    from conftest import SAMPLE
    from registry.spark_queries import qh, writes

    arguments = qh(spark, SAMPLE), writes(spark, SAMPLE), AS_OF
    bounded = quality.freshness_gaps(*arguments)
    whole = quality.freshness_gaps(*arguments, write_slack=None)
    assert sorted(map(repr, bounded.collect())) == sorted(map(repr, whole.collect()))


def test_freshness_reads_the_writes_of_the_spine_only(spark):
    from conftest import SAMPLE
    from registry.spark_queries import qh
    from usagelens.plans import staging
    from usagelens.session import scratch_path
    from usagelens.sources import sample_logs as logs

    path = scratch_path(spark, "access")
    logs.access_history(spark, SAMPLE).write.parquet(path)
    writes = staging.stg_access_history_writes(spark.read.parquet(path), AS_OF)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    for plan in (quality.freshness_gaps(qh(spark, SAMPLE), writes, AS_OF), alerts.alert_zero_rows(qh(spark, SAMPLE), writes, AS_OF)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        pushed = [line for line in text.splitlines() if "PushedFilters" in line and "query_start_time" in line]
        assert any("query_start_time,2024-01-30T" in line for line in pushed), text
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_freshness_of_every_source(spark):
    limits = registry.freshness_limits()
    assert limits["ext_customer_events"] == ("value.event_timestamp", 2, 6) and len(limits) == 6
    tables = {
        "a": spark.createDataFrame([(AS_OF - timedelta(hours=3),)], "ts timestamp_ntz"),
        "b": spark.createDataFrame([], "ts timestamp_ntz"),
    }
    found = checks.source_freshness_all(tables, {"a": ("ts", 2, 6), "b": ("ts", 2, 6)}, AS_OF)
    assert [(r.source, r.age_hours, r.status) for r in found.orderBy("source").collect()] == [("a", 3.0, "warn"), ("b", None, "error")]
