from datetime import datetime

import pytest
from pyspark.sql import functions as F

from usagelens import schemas
from usagelens.session import scratch_path, shared_dir
from usagelens.sources import registry
from usagelens.sources.sinks import append_audit, with_audit, write_table

LOGINS = "event_timestamp timestamp_ntz, user_name string, is_success string"


def logins(spark):
    return spark.createDataFrame(
        [(datetime(2024, 1, d), f"U{d}", "NO") for d in (1, 5, 9)], LOGINS
    )


def test_source_reads_declared_columns(spark):
    path = scratch_path(spark, "logins")
    logins(spark).withColumn("extra", F.lit(1)).write.parquet(path)
    df = registry.source(spark, "login_history", path)
    assert df.schema.simpleString() == schemas.LOGIN_HISTORY.simpleString()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "extra" not in plan
    recent = registry.source(spark, "login_history", path, sample="3 days", as_of=datetime(2024, 1, 10))
    assert [r.user_name for r in recent.collect()] == ["U9"]
    ranged = registry.source(spark, "login_history", path, sample=("2024-01-01", "2024-01-05"))
    assert [r.user_name for r in ranged.collect()] == ["U1"]


def test_source_refuses_other_schemas(spark):
    df = logins(spark)
    with pytest.raises(ValueError, match="missing"):
        registry.conform(df.drop("is_success"), schemas.LOGIN_HISTORY)
    with pytest.raises(ValueError, match="expected string"):
        registry.conform(df.withColumn("user_name", F.lit(1)), schemas.LOGIN_HISTORY)
    wider = registry.conform(spark.range(1).select(F.col("id").cast("int").alias("user_id"), F.lit("2024-01-01").cast("date").alias("signup_date"), *[F.lit("x").alias(c) for c in ("country", "plan", "status")]), schemas.RAW_USERS)
    assert wider.schema["user_id"].dataType.simpleString() == "bigint"


def test_catalog_table(spark):
    write_table(logins(spark), "login_copy")
    assert registry.source(spark, "login_history", "login_copy").count() == 3
    spark.sql("DROP TABLE login_copy")


def test_spine_and_empty(spark):
    spine = registry.hour_spine(spark, datetime(2024, 1, 31, 1, 30))
    marks = [r.check_hour for r in spine.orderBy("check_hour").collect()]
    assert (len(marks), marks[0], marks[-1]) == (25, datetime(2024, 1, 30, 1), datetime(2024, 1, 31, 1))
    empty = registry.empty_like(logins(spark))
    assert empty.count() == 0 and empty.schema == logins(spark).schema


def test_sinks(spark):
    path = scratch_path(spark, "audit")
    append_audit(with_audit(logins(spark), datetime(2024, 2, 1)), path)
    append_audit(with_audit(logins(spark), datetime(2024, 2, 2)), path)
    assert spark.read.parquet(path).select("updated_at").distinct().count() == 2
    keyed = scratch_path(spark, "audit")
    for rows in (logins(spark).limit(2), logins(spark)):
        append_audit(rows, keyed, "user_name")
    assert spark.read.parquet(keyed).count() == 3


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_conform_refuses_to_narrow(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    def declared(kind):
        return T.StructType([T.StructField("x", kind)])

    one = spark.range(1)
    day = one.select(F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("x"))
    fine = one.select(F.lit("1.23456789").cast("decimal(20,9)").alias("x"))
    with pytest.raises(ValueError):
        registry.conform(day, declared(T.DateType()))
    with pytest.raises(ValueError):
        registry.conform(fine, declared(T.DecimalType(20, 2)))
    with pytest.raises(ValueError):
        registry.conform(fine, declared(T.DecimalType(12, 9)))
    assert registry.conform(fine, declared(T.DecimalType(38, 10))).first().x == fine.first().x
