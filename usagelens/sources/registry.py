"""Named source tables: schema, load-time column and freshness limits."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens import schemas as S
from usagelens.functions.temporal import at


@dataclass(frozen=True)
class SourceSpec:
    name: str
    schema: T.StructType
    loaded_at: str | None = None
    warn_hours: int | None = None
    error_hours: int | None = None


SOURCES = {
    spec.name: spec
    for spec in (
        SourceSpec("query_history", S.QUERY_HISTORY, "start_time", 24, 48),
        SourceSpec("warehouse_metering_history", S.WAREHOUSE_METERING, "start_time", 24, 48),
        SourceSpec("login_history", S.LOGIN_HISTORY, "event_timestamp", 24, 48),
        SourceSpec("access_history", S.ACCESS_HISTORY, "query_start_time", 24, 48),
        SourceSpec("automatic_clustering_history", S.AUTOCLUSTERING_HISTORY, "start_time", 24, 48),
        SourceSpec("raw_users", S.RAW_USERS),
        SourceSpec("raw_transactions", S.RAW_TRANSACTIONS),
        SourceSpec("ext_customer_events", S.CUSTOMER_EVENTS, "value.event_timestamp", 2, 6),
        SourceSpec("user_activity_log", S.USER_ACTIVITY_LOG, "action_timestamp"),
        SourceSpec("cost_center_mapping", S.COST_CENTERS),
        SourceSpec("warehouse_cost_config", S.WAREHOUSE_COST_CONFIG),
        SourceSpec("query_tag_rules", S.QUERY_TAG_RULES),
        SourceSpec("user_roles", S.USER_ROLES),
        SourceSpec("role_edges", S.ROLE_EDGES),
    )
}


def freshness_limits() -> dict[str, tuple[str, float, float]]:
    """Load-time column and limits in hours of the sources that declare them."""
    return {
        spec.name: (spec.loaded_at, spec.warn_hours, spec.error_hours)
        for spec in SOURCES.values()
        if spec.loaded_at is not None and spec.error_hours is not None
    }


_WIDENING = {
    ("int", "bigint"),
    ("smallint", "bigint"),
    ("float", "double"),
    ("timestamp", "timestamp_ntz"),
}


def _widens(have: T.DataType, want: T.DataType) -> bool:
    """Whether every value of ``have`` is one of ``want``."""
    if isinstance(have, T.DecimalType) and isinstance(want, T.DecimalType):
        whole = have.precision - have.scale <= want.precision - want.scale
        return whole and have.scale <= want.scale
    pair = (have.simpleString(), want.simpleString())
    return pair in _WIDENING or isinstance(have, T.NullType)


def conform(df: DataFrame, schema: T.StructType, name: str = "source") -> DataFrame:
    """Project onto the declared columns; a missing or incompatible column is an error."""
    found = {field.name: field.dataType for field in df.schema.fields}
    columns = []
    for field in schema.fields:
        if field.name not in found:
            raise ValueError(f"{name}: column {field.name} is missing")
        have, want = found[field.name], field.dataType
        if have == want:
            columns.append(F.col(field.name))
            continue
        if not _widens(have, want):
            raise ValueError(
                f"{name}: column {field.name} is {have.simpleString()}, expected {want.simpleString()}"
            )
        columns.append(F.col(field.name).cast(want).alias(field.name))
    return df.select(columns)


def source(
    spark: SparkSession,
    name: str,
    location: str,
    sample: str | tuple[str, str] | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """Scan a registered table from a Parquet path or catalog table name.

    ``sample`` limits a time-keyed table to a window for trial runs; without it the
    whole table is read.
    """
    spec = SOURCES[name]
    is_path = "/" in location
    if not is_path:
        spark.catalog.refreshTable(location)
    raw = spark.read.parquet(location) if is_path else spark.table(location)
    df = conform(raw, spec.schema, name)
    if sample is None or spec.loaded_at is None:
        return df
    if isinstance(sample, str):
        return sample_window(df, spec.loaded_at, last=sample, as_of=as_of)
    return sample_window(df, spec.loaded_at, start=sample[0], end=sample[1])


def load_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header row and ISO dates; a malformed row is an error."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("dateFormat", "yyyy-MM-dd")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Event files as pushed so far; files are listed anew on every call."""
    return conform(spark.read.parquet(path), S.CUSTOMER_EVENTS, "ext_customer_events")


def sample_window(
    df: DataFrame,
    ts_col: str,
    last: str | None = None,
    as_of: datetime | None = None,
    start: str | datetime | None = None,
    end: str | datetime | None = None,
) -> DataFrame:
    """Rows of the last ``"3 days"`` / ``"6 hours"`` before ``as_of``, or of ``[start, end)``."""
    ts = F.col(ts_col)
    if last is not None:
        if as_of is None:
            raise ValueError("a relative sample needs as_of")
        amount, unit = last.split()
        unit = unit.rstrip("s") + "s"
        return df.where(ts >= at(as_of - timedelta(**{unit: int(amount)})))
    if start is not None:
        df = df.where(ts >= at(start))
    if end is not None:
        df = df.where(ts < at(end))
    return df


def empty_like(df: DataFrame) -> DataFrame:
    """Same schema and plan, no rows: validates a pipeline without reading data."""
    return df.where(F.lit(False))


def hour_spine(spark: SparkSession, as_of: datetime, hours: int = 24) -> DataFrame:
    """``hours + 1`` hourly marks ending at the hour of ``as_of``."""
    last = as_of.replace(minute=0, second=0, microsecond=0)
    first = last - timedelta(hours=hours)
    marks = F.sequence(at(first), at(last), F.expr("interval 1 hour"))
    return spark.range(1, numPartitions=1).select(F.explode(marks).alias("check_hour"))
