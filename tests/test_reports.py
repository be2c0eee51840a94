from datetime import datetime
from decimal import Decimal

import pytest

from usagelens.plans import reports


def test_efficiency_by_domain_is_ratio_of_sums(spark):
    rows = [
        ("FINANCE", Decimal("2"), 3600, Decimal("7200")),
        ("FINANCE", Decimal("1"), 3600, Decimal("3600")),
        ("OTHER", Decimal("0"), 50, Decimal("0")),
    ]
    df = spark.createDataFrame(rows, "domain string, total_compute_credits decimal(38,9), total_work_seconds long, total_billed_seconds decimal(38,9)")
    got = [(r.domain, float(r.total_compute_credits), r.idle_credits, r.efficiency_percentage) for r in reports.efficiency_by_domain(df).collect()]
    assert got == [("FINANCE", 3.0, 1.0, 66.67), ("OTHER", 0.0, -50 / 3600, None)]


def behavior(spark):
    rows = [
        ("A", datetime(2024, 1, 1), 4, 1, 1), ("A", datetime(2024, 1, 1), 2, 2, 0),
        ("B", datetime(2024, 1, 2), 3, 0, 0), ("A", datetime(2024, 1, 2), 1, 1, 1),
    ]
    return spark.createDataFrame(rows, "domain string, execution_date timestamp_ntz, total_queries long, wakeup_count long, isolated_query_count long")


def test_behavior_report_sorting(spark):
    default = reports.behavior_by_domain_day(behavior(spark)).collect()
    assert [(str(r.date), r.domain, r.pct_wakeup) for r in default] == [("2024-01-02", "A", 100.0), ("2024-01-02", "B", 0.0), ("2024-01-01", "A", 50.0)]
    by_queries = reports.behavior_by_domain_day(behavior(spark), "total_queries", ascending=True).collect()
    assert [r.total_queries for r in by_queries] == [1, 3, 6]
    with pytest.raises(ValueError, match="no column"):
        reports.behavior_by_domain_day(behavior(spark), "1; drop table x")


def test_nulls_sort_first_when_descending(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,)], "x double")
    assert [r.x for r in reports.sorted_by(df, "x").collect()] == [None, 2.0, 1.0]
    assert [r.x for r in reports.sorted_by(df, "x", ascending=True).collect()] == [1.0, 2.0, None]


def test_top_n_breaks_ties_by_id(spark):
    df = spark.createDataFrame([(f"q{i:02}", i // 2) for i in range(10)], "query_id string, execution_time_ms long")
    assert [r.query_id for r in reports.worst_spilling_queries(df, 3).collect()] == ["q08", "q09", "q06"]


def test_cache_kpis(spark):
    df = spark.createDataFrame([(10.0, 20.0, None), (20.0, 20.1, 5.0)], "pct_result_cache double, pct_local_efficient double, pct_remote_heavy double")
    assert tuple(reports.cache_kpis(df).first()) == (15.0, 20.1, 5.0)
