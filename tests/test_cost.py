from datetime import datetime, timedelta
from decimal import Decimal

from usagelens.plans import cost

QH = (
    "query_id string, warehouse_name string, user_name string, role_name string, "
    "start_time timestamp_ntz, end_time timestamp_ntz, execution_time_seconds long"
)
START = datetime(2024, 1, 10, 12)


def history(spark, *entries, warehouse="FIN_WH"):
    """Entries: (id, start second, end second or None, execution seconds)."""
    rows = [
        (
            qid, warehouse, "U", "R",
            START + timedelta(seconds=start),
            None if end is None else START + timedelta(seconds=end),
            took,
        )
        for qid, start, end, took in entries
    ]
    return spark.createDataFrame(rows, QH)


def flags(df):
    return {
        r.query_id: (r.idle_gap_seconds, r.is_first_query_in_window, r.is_potential_wakeup, r.is_isolated_expensive_query)
        for r in df.collect()
    }


def test_gap_and_wakeup_thresholds(spark):
    df = history(
        spark,
        ("a", 0, 10, 10),
        ("b", 69, 70, 4),      # gap 59
        ("c", 130, 131, 4),    # gap 60, short
        ("d", 191, 300, 5),    # gap 60, not short
        ("e", 250, 260, 1),    # overlaps: negative gap
    )
    assert flags(cost.query_behavior(df)) == {
        "a": (None, True, True, False),
        "b": (59, False, False, False),
        "c": (60, False, True, True),
        "d": (60, False, True, False),
        "e": (-50, False, False, False),
    }


def test_previous_row_without_end_counts_as_first(spark):
    df = history(spark, ("a", 0, None, None), ("b", 5, 6, 1))
    assert flags(cost.query_behavior(df))["b"] == (None, True, True, True)
    assert flags(cost.query_behavior(df))["a"] == (None, True, True, False)


def test_ties_follow_query_id(spark):
    df = history(spark, ("b", 0, 100, 1), ("a", 0, 30, 1), ("c", 0, 7, 1))
    assert {k: v[0] for k, v in flags(cost.query_behavior(df)).items()} == {"a": None, "b": -30, "c": -100}


def test_behavior_report_counts(spark):
    df = cost.query_behavior(history(spark, ("a", 0, 10, 10), ("b", 100, 101, 1)))
    row = cost.rpt_warehouse_behavior(df).first()
    assert (row.total_queries, row.total_execution_time_seconds, row.wakeup_count, row.isolated_query_count) == (2, 11, 2, 1)
    assert (row.domain, row.execution_date) == ("FINANCE", datetime(2024, 1, 10))


def test_efficiency_edge_cases(spark):
    metering = spark.createDataFrame(
        [("FIN_WH", Decimal("1")), ("FIN_WH", Decimal("1")), ("ZERO_WH", Decimal("0")), ("IDLE_WH_PROD", Decimal("0.5"))],
        "warehouse_name string, credits_used_compute decimal(38,9)",
    )
    qh = history(spark, ("a", 0, 1, 10800)).unionByName(history(spark, ("z", 0, 1, 5), warehouse="ZERO_WH"))
    report = cost.rpt_warehouse_efficiency(cost.warehouse_efficiency_summary(metering, qh))
    got = {
        r.warehouse_name: (r.total_work_seconds, r.total_queries_executed, r.efficiency_percentage, r.wasted_cost_usd, r.environment)
        for r in report.collect()
    }
    assert got == {
        "FIN_WH": (10800, 1, 150.0, -4.0, "DEV"),
        "ZERO_WH": (5, 1, 0.0, None, "DEV"),
        "IDLE_WH_PROD": (0, 0, 0.0, 2.0, "PROD"),
    }
