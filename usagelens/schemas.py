"""Declared schemas of the input tables. Sources are checked against these, never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, LONG, DOUBLE, BOOL = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
DATE, STAMP = T.DateType(), T.TimestampNTZType()
CREDITS = T.DecimalType(38, 9)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


QUERY_HISTORY = _table(
    query_id=TEXT,
    query_text=TEXT,
    database_name=TEXT,
    schema_name=TEXT,
    warehouse_name=TEXT,
    warehouse_size=TEXT,
    user_name=TEXT,
    role_name=TEXT,
    execution_status=TEXT,
    query_tag=TEXT,
    start_time=STAMP,
    end_time=STAMP,
    total_elapsed_time=LONG,
    rows_produced=LONG,
    bytes_scanned=LONG,
    percentage_scanned_from_cache=DOUBLE,
    bytes_spilled_to_local_storage=LONG,
    bytes_spilled_to_remote_storage=LONG,
    rows_inserted=LONG,
    partitions_scanned=LONG,
    partitions_total=LONG,
    execution_time=LONG,
    error_code=TEXT,
    error_message=TEXT,
    compilation_time=LONG,
    queued_overload_time=LONG,
)
WAREHOUSE_METERING = _table(
    warehouse_name=TEXT,
    start_time=STAMP,
    end_time=STAMP,
    credits_used=CREDITS,
    credits_used_compute=CREDITS,
    credits_used_cloud_services=CREDITS,
)
ACCESS_HISTORY = _table(
    query_id=TEXT,
    query_start_time=STAMP,
    objects_modified=T.ArrayType(_table(objectName=TEXT, objectDomain=TEXT)),
)
AUTOCLUSTERING_HISTORY = _table(
    table_id=LONG,
    table_name=TEXT,
    schema_name=TEXT,
    database_name=TEXT,
    start_time=STAMP,
    end_time=STAMP,
    credits_used=CREDITS,
    num_bytes_reclustered=LONG,
    num_rows_reclustered=LONG,
)
LOGIN_HISTORY = _table(
    event_timestamp=STAMP,
    user_name=TEXT,
    is_success=TEXT,
)
RAW_USERS = _table(
    user_id=LONG,
    signup_date=DATE,
    country=TEXT,
    plan=TEXT,
    status=TEXT,
)
RAW_TRANSACTIONS = _table(
    transaction_id=LONG,
    user_id=LONG,
    purchase_date=DATE,
    amount=T.DecimalType(10, 2),
)
CUSTOMER_EVENTS = _table(
    value=_table(event_id=TEXT, customer_id=LONG, event_type=TEXT, event_timestamp=STAMP, metadata=_table(channel=TEXT, amount=T.DecimalType(10, 2))),
)
USER_ACTIVITY_LOG = _table(
    action_id=LONG,
    action_type=TEXT,
    user_name=TEXT,
    performed_by=TEXT,
    role_used=TEXT,
    env=TEXT,
    domain=TEXT,
    role_assigned=TEXT,
    object_type=TEXT,
    grants_detail=TEXT,
    comment=TEXT,
    action_timestamp=STAMP,
)
COST_CENTERS = _table(
    cost_center_code=TEXT,
    cost_center_name=TEXT,
    domain=TEXT,
    department=TEXT,
    budget_monthly_credits=T.DecimalType(12, 2),
    owner_email=TEXT,
    is_active=BOOL,
    created_at=STAMP,
    updated_at=STAMP,
)
WAREHOUSE_COST_CONFIG = _table(
    warehouse_name=TEXT,
    domain=TEXT,
    cost_center_code=TEXT,
    credit_price_usd=T.DecimalType(10, 4),
    alert_threshold_pct=T.DecimalType(5, 2),
    is_active=BOOL,
    created_at=STAMP,
    updated_at=STAMP,
)
QUERY_TAG_RULES = _table(
    tag_pattern=TEXT,
    domain=TEXT,
    cost_center_code=TEXT,
    pipeline_name=TEXT,
    description=TEXT,
    is_active=BOOL,
    created_at=STAMP,
)
USER_ROLES = _table(
    user=TEXT,
    role=TEXT,
)
ROLE_EDGES = _table(
    role=TEXT,
    inherits=TEXT,
)
OBJECT_TAGS = _table(
    object_name=TEXT,
    tag_name=TEXT,
    tag_value=TEXT,
)
