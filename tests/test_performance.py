from datetime import datetime
from decimal import Decimal

from usagelens.plans import performance

AS_OF = datetime(2024, 1, 31)
QH = (
    "query_id string, query_text string, user_name string, warehouse_name string, warehouse_size string, "
    "start_time timestamp_ntz, total_elapsed_time long, execution_time long, partitions_scanned long, partitions_total long, "
    "percentage_scanned_from_cache double, total_bytes_scanned long, bytes_spilled_to_local_storage long, "
    "bytes_spilled_to_remote_storage long"
)


def history(spark, *entries, start=datetime(2024, 1, 10)):
    base = dict(
        text="T", user="U", wh="ECO_WH", size="S", start=start, elapsed=1000, execution=1000,
        scanned=100, partitions=1000, cache=0.3, bytes=1000, local=0, remote=0,
    )
    rows = [(f"q{i}", *{**base, **entry}.values()) for i, entry in enumerate(entries)]
    return spark.createDataFrame(rows, QH)


def column(df, name):
    return [r[name] for r in df.orderBy("query_id").collect()]


def test_skew_thresholds(spark):
    df = history(
        spark,
        dict(execution=300_001, scanned=51),   # critical
        dict(execution=300_000, scanned=51),   # exactly 300 s
        dict(execution=60_000, scanned=51),    # exactly 60 s
        dict(execution=60_001, scanned=51),
        dict(execution=400_000, scanned=800),  # exactly 0.5 s per partition
        dict(execution=900_000, scanned=50),   # too few partitions
        dict(execution=0, scanned=60),
    )
    skew = performance.data_skew(df)
    assert column(skew, "skew_status") == ["CRITICAL_SKEW", "POTENTIAL_SKEW", "BALANCED", "POTENTIAL_SKEW", "BALANCED"]
    fact = performance.fct_data_skew(skew, AS_OF)
    assert fact.count() == 3 and fact.first()["updated_at"] == AS_OF


def test_cache_classes(spark):
    df = history(
        spark,
        dict(cache=1.0), dict(cache=0.51), dict(cache=0.50), dict(cache=0.20), dict(cache=0.19),
        dict(cache=0.19, bytes=0), dict(cache=None), dict(size=None),
    )
    cache = performance.cache_performance(df, AS_OF)
    assert column(cache, "cache_category") == [
        "RESULT_CACHE", "LOCAL_EFFICIENT", "MIXED", "MIXED", "REMOTE_HEAVY", "MIXED", "MIXED",
    ]
    row = performance.rpt_cache_performance(cache).first()
    assert (row.total_query_count, row.pct_result_cache, row.pct_remote_heavy) == (7, 14.29, 14.29)


def test_window_excludes_older_queries(spark):
    old = history(spark, dict(), start=datetime(2023, 12, 31, 23, 59))
    assert performance.cache_performance(old, AS_OF).count() == 0
    edge = history(spark, dict(), start=datetime(2024, 1, 1))
    assert performance.cache_performance(edge, AS_OF).count() == 1


def test_spill_flags(spark):
    df = history(
        spark,
        dict(local=300), dict(local=301), dict(remote=10), dict(remote=11), dict(bytes=0, local=5, remote=5),
    )
    spill = performance.spilling_performance(df, AS_OF)
    assert column(spill, "is_bad_local_spill") == [0, 1, 0, 0, 0]
    assert column(spill, "is_critical_remote_spill") == [0, 0, 0, 1, 0]
    assert performance.fct_query_spilling(spill).count() == 2
    row = performance.rpt_spilling_summary(spill).first()
    assert (row.pct_bad_local_spilling, row.pct_critical_remote_spilling, row.avg_execution_time_ms) == (20.0, 20.0, 1000.0)


def test_monthly_volume_sums_rounded_days(spark):
    gib = 1024**3
    rows = [
        (1, "T", "S", "FINANCE_DB", datetime(2024, 1, day), datetime(2024, 1, day), Decimal("0.5"), int(gib * 0.004), 1)
        for day in (1, 2, 3)
    ] + [(1, "T", "S", "FINANCE_DB", datetime(2024, 1, 4), datetime(2024, 1, 4), Decimal("1"), int(gib * 0.006), 1)]
    schema = (
        "table_id long, table_name string, schema_name string, database_name string, start_time timestamp_ntz, "
        "end_time timestamp_ntz, credits_used decimal(38,9), num_bytes_reclustered long, num_rows_reclustered long"
    )
    daily = performance.autoclustering_daily(spark.createDataFrame(rows, schema))
    row = performance.rpt_autoclustering_monthly(daily).first()
    assert row.total_monthly_gb_reclustered == 0.01
    assert (row.total_monthly_credits, row.avg_daily_credits, row.domain) == (Decimal("2.5"), 0.63, "FINANCE")


def test_pruning_ratio(spark):
    got = column(performance.pruning_ratio(history(spark, dict(), dict(partitions=0))), "pruning_ratio")
    assert got == [0.1, None]
