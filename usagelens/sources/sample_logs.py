"""Usage logs derived from the sample star-schema tables.

The sample folder holds no usage logs; every log here is a projection or aggregation of
one of its tables, so it grows with them.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens import schemas as S
from usagelens.functions.temporal import dateadd, trunc_ts
from usagelens.functions.text import constant_rows
from usagelens.plans.access import DOMAIN_PREFIXES, ENV_SUFFIXES
from usagelens.streaming.ingest import stream_events

AS_OF = datetime(2024, 1, 31, 1, 30)

# Fixed values of the derivation.
WAREHOUSES = (
    "FIN_WH_DEV",
    "MKT_WH_UAT",
    "ECO_WH",
    "RET_WH_PROD",
    "ANA_WH_DEV",
    "LOY_WH_UAT",
    "MGMT_WH",
    "TRANSFORM_WH_DEV",
    "SAL_WH_DEV",
    "HR_WH_DEV",
    "COMPUTE_WH",
)
DATABASES = (
    "FINANCE_DB_DEV",
    "MARKETING_DB_DEV",
    "ECOMMERCE_DB",
    "RETAIL_DB_UAT",
    "ANALYTICS_DB",
    "LOYALTY_DB",
    "MGMT_DB",
    "SALES_DB",
    "HR_DB",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: Column, values) -> Column:
    """Element at a 0-based index, NULL past the end."""
    listed = ", ".join(f"'{value}'" for value in values)
    return F.get(F.expr(f"array({listed})"), index.cast("int"))


def with_k(events: DataFrame) -> DataFrame:
    # Generated rather than projected, so that filters on what is derived from it are not
    # rewritten into repeated parsing of the JSON text.
    parsed = F.get_json_object("props", "$.k").cast("int")
    return events.select("*", F.explode(F.array(parsed)).alias("k"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_k(table(spark, sf_dir, "events"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return with_k(stream_events(spark, sf_dir, schema, glob="events.parquet"))


def query_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries_of(events(spark, sf_dir))


def queries_of(frame: DataFrame) -> DataFrame:
    k, value, user = F.col("k"), F.col("value"), F.col("user_id")
    kind = F.col("event_type")
    millis = F.when(k % 3 == 0, (k * 100).cast("long")).otherwise(
        F.floor(value * 40000).cast("long")
    )
    scanned = F.when(k == 0, F.lit(0).cast("long")).otherwise(F.floor(value * 8388608).cast("long"))
    text = (
        F.when(kind == "signup", F.concat(F.lit("EXECUTE TASK OPS.T"), (k % 7).cast("string")))
        .when(kind == "purchase", "COPY INTO RAW.ORDERS FROM @S")
        .when(kind == "view", "INSERT INTO MARTS.F")
        .otherwise("SELECT 1")
    )
    status = (
        F.when((kind == "error") | (k % 7 == 0), "FAIL").when(k == 1, "RUNNING").otherwise("SUCCESS")
    )
    failed = F.col("execution_status") == "FAIL"
    share = F.when(k % 33 == 5, None).when(k % 20 == 0, 1.0).otherwise(k / F.lit(100.0))
    user_name = (
        F.when(user % 5 == 0, "SYSTEM")
        .when(user % 5 == 1, "DBT_RUNNER")
        .when(user % 5 == 2, "SVC_SERVICE")
        .otherwise("ANALYST")
    )
    loaded = F.when(kind.isin("signup", "view") & (k % 4 != 0), k).otherwise(0).cast("long")
    base = frame.select(
        "k",
        "ts",
        "value",
        "user_id",
        "event_type",
        F.concat(F.lit("q"), "event_id").alias("query_id"),
        millis.alias("exec_ms"),
        scanned.alias("scanned"),
        status.alias("execution_status"),
    )
    return base.select(
        "query_id",
        text.alias("query_text"),
        _pick(user % 9, DATABASES).alias("database_name"),
        F.lit("MARTS").alias("schema_name"),
        _pick(user % 12, WAREHOUSES).alias("warehouse_name"),
        F.when(k % 10 == 9, None).otherwise("XSMALL").alias("warehouse_size"),
        user_name.alias("user_name"),
        _pick(user % 3, ("ADMIN", "READER", "ANALYST")).alias("role_name"),
        "execution_status",
        F.concat(F.lit('{"team":"t'), (k % 4).cast("string"), F.lit('"}')).alias("query_tag"),
        F.col("ts").alias("start_time"),
        dateadd("second", F.floor(F.col("exec_ms") / 1000), F.col("ts")).alias("end_time"),
        F.col("exec_ms").alias("total_elapsed_time"),
        (k * 10).cast("long").alias("rows_produced"),
        F.col("scanned").alias("bytes_scanned"),
        share.alias("percentage_scanned_from_cache"),
        F.floor(F.col("scanned") * (k % 5) * 0.11).cast("long").alias("bytes_spilled_to_local_storage"),
        F.when(k % 11 == 0, F.floor(F.col("scanned") * 0.02).cast("long"))
        .otherwise(0)
        .alias("bytes_spilled_to_remote_storage"),
        loaded.alias("rows_inserted"),
        (k * 40).cast("long").alias("partitions_scanned"),
        F.lit(4000).cast("long").alias("partitions_total"),
        F.col("exec_ms").alias("execution_time"),
        F.when(failed, F.concat(F.lit("E"), (k % 7).cast("string"))).alias("error_code"),
        F.when(failed, F.concat(F.lit("failed at step "), k.cast("string"))).alias("error_message"),
        (k * 7).cast("long").alias("compilation_time"),
        (k * 3).cast("long").alias("queued_overload_time"),
    )


def warehouse_metering(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = F.col("i")
    credits = F.when(index == 9, F.lit(0.0)).otherwise(F.col("n") * (index * 0.05 + 0.10))
    hourly = (
        table(spark, sf_dir, "events")
        .where(F.col("user_id") % 12 < 11)
        .groupBy((F.col("user_id") % 12).alias("i"), trunc_ts("hour", F.col("ts")).alias("start_time"))
        .agg(F.count("*").alias("n"))
        .select(
            _pick(index, WAREHOUSES).alias("warehouse_name"),
            "start_time",
            credits.cast("decimal(18,4)").alias("compute"),
        )
    )
    idle = spark.range(1).select(
        F.lit("IDLE_WH").alias("warehouse_name"),
        F.lit("2024-01-30 00:00:00").cast("timestamp_ntz").alias("start_time"),
        F.lit("0.5").cast("decimal(18,4)").alias("compute"),
    )
    compute = F.col("compute")
    return hourly.unionByName(idle).select(
        "warehouse_name",
        "start_time",
        dateadd("hour", 1, F.col("start_time")).alias("end_time"),
        (compute + F.lit("0.01").cast("decimal(18,4)")).cast("decimal(38,9)").alias("credits_used"),
        compute.cast("decimal(38,9)").alias("credits_used_compute"),
        F.lit("0.01").cast("decimal(38,9)").alias("credits_used_cloud_services"),
    )


def access_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    def thing(name: Column, domain: str) -> Column:
        return F.struct(name.alias("objectName"), F.lit(domain).alias("objectDomain"))

    k, kind = F.col("k"), F.col("event_type")
    usual = F.array(
        thing(F.concat(F.lit("DB.S.T"), (k % 5).cast("string")), "Table"),
        thing(F.lit("DB.S.V1"), "View"),
    )
    extra = F.array_append(usual, thing(F.lit("DB.S.X"), "Table"))
    nothing = F.filter(usual, lambda _: F.lit(False))
    objects = (
        F.when(kind == "click", nothing)
        .when(kind == "error", None)
        .when(k % 4 == 0, extra)
        .otherwise(usual)
    )
    return events(spark, sf_dir).select(
        F.concat(F.lit("q"), "event_id").alias("query_id"),
        F.col("ts").alias("query_start_time"),
        objects.alias("objects_modified"),
    )


def autoclustering_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, value = F.col("k"), F.col("value")
    return events(spark, sf_dir).where(F.col("event_type") == "view").select(
        (k % 6).cast("long").alias("table_id"),
        F.concat(F.lit("T"), (k % 6).cast("string")).alias("table_name"),
        F.lit("MARTS").alias("schema_name"),
        _pick(F.col("user_id") % 9, DATABASES).alias("database_name"),
        F.col("ts").alias("start_time"),
        dateadd("minute", 5, F.col("ts")).alias("end_time"),
        (value / 100).cast("decimal(18,6)").cast("decimal(38,9)").alias("credits_used"),
        F.floor(value * 100000000).cast("long").alias("num_bytes_reclustered"),
        k.cast("long").alias("num_rows_reclustered"),
    )


def login_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logins_of(table(spark, sf_dir, "events"))


def logins_of(frame: DataFrame) -> DataFrame:
    return frame.select(
        F.col("ts").alias("event_timestamp"),
        F.concat(F.lit("U"), (F.col("user_id") % 7).cast("string")).alias("user_name"),
        F.when(F.col("event_type").isin("error", "click"), "NO").otherwise("YES").alias("is_success"),
    )


def customer_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One semi-structured ``value`` per event."""
    return event_values(events(spark, sf_dir))


def event_values(frame: DataFrame) -> DataFrame:
    channel = _pick(F.col("k") % 3, ("web", "store", "app"))
    return frame.select(
        F.struct(
            F.concat(F.lit("e"), "event_id").alias("event_id"),
            F.col("user_id").alias("customer_id"),
            "event_type",
            F.col("ts").alias("event_timestamp"),
            F.struct(
                channel.alias("channel"), F.col("value").cast("decimal(10,2)").alias("amount")
            ).alias("metadata"),
        ).alias("value")
    )


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            key.alias("user_id"),
            F.date_add(F.lit("1995-01-01").cast("date"), (key % 730).cast("int")).alias("signup_date"),
            F.col("n_name").alias("country"),
            F.col("c_mktsegment").alias("plan"),
            F.when(key % 7 == 0, "churned").otherwise("active").alias("status"),
        )
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").cast("date").alias("purchase_date"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("amount"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("U"), "c_custkey").alias("user")
    )


def user_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Admin and reader roles by customer key; every user also holds an analyst role."""
    key = F.col("c_custkey")
    i, prefix, suffix = F.col("i"), F.col("prefix"), F.col("suffix")
    roles = F.array_compact(
        F.array(
            F.when((key + i) % 7 == 0, F.concat(prefix, F.lit("_ADMIN"), suffix)),
            F.when((key + i) % 3 == 0, F.concat(prefix, F.lit("_READER"), suffix)),
            F.when((key + i) % 24 == 0, F.concat(prefix, F.lit("_ANALYST"), suffix)),
        )
    )
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey", F.inline(places()))
        .select(F.concat(F.lit("U"), "c_custkey").alias("user"), F.explode(roles).alias("role"))
    )


def role_edges(spark: SparkSession) -> DataFrame:
    """Role bundles: warehouse use below reader, reader below analyst, analyst below admin,
    admin below the system role."""
    rows = []
    for prefix in DOMAIN_PREFIXES.values():
        for suffix in ENV_SUFFIXES.values():
            chain = [
                "SYSADMIN",
                *[f"{prefix}_{tier}{suffix}" for tier in ("ADMIN", "ANALYST", "READER")],
                f"{prefix}_WH{suffix}_USER",
            ]
            rows += list(zip(chain, chain[1:]))
    return spark.createDataFrame(rows, S.ROLE_EDGES)


def object_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    tag = _pick(key % 5, ("OWNER", "DOMAIN", "COST_CENTER", "DATA_SENSITIVITY", "DATA_CLASSIFICATION"))
    value = (
        F.when(key % 5 == 0, _pick(F.floor(key / 5) % 3, ("data_team", "finance_team", "night_team")))
        .when(key % 5 == 1, _pick(F.floor(key / 5) % 3, ("finance", "Finance", "retail")))
        .when(key % 5 == 2, F.col("p_brand"))
        .when(key % 5 == 3, _pick(F.floor(key / 5) % 3, ("PII", "PCI", "SECRET")))
        .otherwise(_pick(F.floor(key / 5) % 3, ("PUBLIC", "INTERNAL", "HIDDEN")))
    )
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("DB.S.P"), "p_partkey").alias("object_name"),
        tag.alias("tag_name"),
        value.alias("tag_value"),
    )


def warehouse_cost_config(spark: SparkSession) -> DataFrame:
    rows = [
        (name, None, f"CC{i % 4}", None if i % 5 == 4 else f"{2 + i % 3}.5", "80" if i % 2 else "60", i != 8)
        for i, name in enumerate(WAREHOUSES)
    ]
    schema = "warehouse_name string, domain string, cost_center_code string, p string, t string, is_active boolean"
    return spark.createDataFrame(rows, schema).select(
        "warehouse_name", "domain", "cost_center_code",
        F.col("p").cast("decimal(10,4)").alias("credit_price_usd"),
        F.col("t").cast("decimal(5,2)").alias("alert_threshold_pct"),
        "is_active",
    )


def cost_centers(spark: SparkSession) -> DataFrame:
    rows = [(f"CC{i}", f"Center {i}", f"Dept {i % 2}", f"{100 * (i + 1)}", i != 3) for i in range(4)]
    schema = "cost_center_code string, cost_center_name string, department string, b string, is_active boolean"
    return spark.createDataFrame(rows, schema).select(
        "cost_center_code", "cost_center_name", "department",
        F.col("b").cast("decimal(12,2)").alias("budget_monthly_credits"),
        "is_active",
    )


def query_tag_rules(spark: SparkSession) -> DataFrame:
    rows = [
        ('%"team":"t0"%', "FINANCE", "CC0", "ledger", True),
        ('%"team":"t1"%', "RETAIL", "CC1", "stock", True),
        ('%"team":"t_"%', "OTHER", "CC2", "any", True),
        ('%"t2"%', "SALES", "CC3", "deals", True),
        ('%"team":"t3"%', "HR", "CC3", "payroll", False),
    ]
    schema = "tag_pattern string, domain string, cost_center_code string, pipeline_name string, is_active boolean"
    return spark.createDataFrame(rows, schema)


def part_tag_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many rules as parts: a team and the last digits of a query id."""
    key = F.col("p_partkey")
    team = F.concat(F.lit('%"t'), (key % 4).cast("string"), F.lit('"}/%'), key.cast("string"))
    ends = F.concat(F.lit("%_"), key.cast("string"), F.lit("_"))
    pattern = F.when(key == 1, "%").when(key == 2, F.repeat(F.lit("_"), 17))
    return table(spark, sf_dir, "part").select(
        pattern.when(key % 3 == 0, ends).otherwise(team).alias("tag_pattern"),
        F.col("p_brand").alias("domain"),
        F.concat(F.lit("CC"), (key % 5).cast("string")).alias("cost_center_code"),
        F.concat(F.lit("pipeline "), key.cast("string")).alias("pipeline_name"),
        (key % 11 != 0).alias("is_active"),
    )


def places() -> Column:
    """Domain x environment combinations in a fixed order, numbered from 0."""
    combos = [
        (d, p, e, s) for d, p in DOMAIN_PREFIXES.items() for e, s in ENV_SUFFIXES.items()
    ]
    return constant_rows(
        ["i", "domain", "prefix", "env", "suffix"],
        [(i, *combo) for i, combo in enumerate(combos)],
    )


def desired_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted levels for three quarters of each customer's places."""
    turn = (F.col("c_custkey") + F.col("i")) % 4
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey", F.inline(places()))
        .where(turn < 3)
        .select(
            F.concat(F.lit("U"), "c_custkey").alias("user"),
            "domain",
            "env",
            _pick(turn, ("none", "select", "all")).alias("level"),
        )
    )


def activity_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    return events(spark, sf_dir).select(
        F.col("event_id").alias("action_id"),
        _pick(k % 3, ("CREATE_USER", "UPDATE_GRANTS", "DISABLE_USER")).alias("action_type"),
        F.concat(F.lit("U"), (F.col("user_id") % 5).cast("string")).alias("user_name"),
        F.lit("OPERATOR").alias("performed_by"),
        F.lit("SYSADMIN").alias("role_used"),
        _pick(F.floor(k / 3) % 3, tuple(ENV_SUFFIXES)).alias("env"),
        _pick(k % 8, tuple(DOMAIN_PREFIXES)).alias("domain"),
        F.concat(F.lit("ROLE_"), (k % 11).cast("string")).alias("role_assigned"),
        F.when(k % 2 == 0, "DATABASE").otherwise("WAREHOUSE").alias("object_type"),
        F.lit("{}").alias("grants_detail"),
        F.concat(F.lit("entry "), "event_id").alias("comment"),
        F.col("ts").alias("action_timestamp"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("sale_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("sale_date"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
    )


def landing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records per user: the payload, when it was synced, whether it deletes."""
    return events(spark, sf_dir).select(
        F.col("user_id").alias("id"),
        F.col("event_type").alias("country"),
        F.col("value").alias("score"),
        F.col("ts").alias("updated_at"),
        F.col("event_id").alias("seq"),
        (F.col("k") % 13 == 0).alias("is_deleted"),
        F.col("ts").alias("ingested_at"),
    )
