"""Checks declared on the models' outputs."""

from __future__ import annotations

from usagelens.functions.naming import DOMAIN_NAMES, ENVIRONMENTS
from usagelens.operators.checks import Check

# Accepted states and event types.
EVENT_TYPES = ("signup", "purchase", "upgrade", "downgrade", "churn", "reactivation")
FLOW_STATES = ("HEALTHY", "EXPECTED_LAG", "GAP_DETECTED", "SILENT_FAILURE", "UNKNOWN")
AUTOMATION_TYPES = ("TASK", "INGESTION_PIPE", "TRANSFORMATION_JOB")


def _keys(*columns: str) -> list[Check]:
    """Primary key: unique and present."""
    return [Check(kind, column) for column in columns for kind in ("unique", "not_null")]


def _present(*columns: str) -> list[Check]:
    return [Check("not_null", column) for column in columns]


MODEL_CHECKS: dict[str, list[Check]] = {
    "raw_users": _keys("user_id"),
    "raw_transactions": _keys("transaction_id"),
    "stg_users": _keys("user_id") + _present("signup_date"),
    "stg_transactions": _keys("transaction_id") + _present("user_id"),
    "stg_customer_events": _keys("event_id")
    + _present("customer_id", "event_timestamp")
    + [Check("accepted_values", "event_type", EVENT_TYPES)],
    "stg_warehouse_metering": _keys("metering_id") + _present("warehouse_name", "credits_used"),
    "stg_query_history": _keys("query_id") + _present("warehouse_name"),
    "stg_autoclustering_history": _present("table_name", "credits_used"),
    "query_behavior": _present("query_id", "warehouse_name"),
    "warehouse_efficiency_summary": _keys("warehouse_name"),
    "user_transactions": _keys("transaction_id") + _present("user_id"),
    "data_skew": _keys("query_id")
    + [
        Check(
            "expression_is_true",
            condition="skew_status != 'CRITICAL_SKEW'",
            severity="warn",
            label="warn_on_critical_data_skew",
        )
    ],
    "freshness_gaps": _present("check_hour") + [Check("accepted_values", "status", FLOW_STATES)],
    "automation_errors": _keys("query_id")
    + [Check("accepted_values", "automation_type", AUTOMATION_TYPES)],
    "rpt_warehouse_efficiency": _keys("warehouse_name")
    + _present("environment", "efficiency_percentage")
    + [Check("accepted_values", "environment", ENVIRONMENTS)],
    "rpt_warehouse_behavior": _present("warehouse_name"),
    "rpt_cohort_retention": _present("cohort_month", "month_number"),
    "fct_query_spilling": _keys("query_id")
    + _present("warehouse_name", "domain")
    + [Check("accepted_values", "domain", DOMAIN_NAMES)],
    "rpt_autoclustering_monthly": _present("full_table_name", "domain"),
    "rpt_cache_performance": _keys("warehouse_name") + _present("domain"),
    "rpt_spilling_summary": _keys("warehouse_name") + _present("domain"),
    "fct_quality_monitoring": _present("event_timestamp", "category", "is_alert")
    + [
        Check("accepted_values", "category", ("DATA_FLOW", "TECHNICAL_ERROR")),
        Check("accepted_values", "is_alert", (0, 1)),
    ],
}
