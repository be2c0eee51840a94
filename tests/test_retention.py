from datetime import date
from decimal import Decimal

import pytest

from usagelens import schemas
from usagelens.plans import retention, staging
from usagelens.sources.registry import load_seed

USERS = """user_id,signup_date,country,plan,status
11,2023-05-03,IT,gold,active
12,2023-05-30,AT,free,closed
13,2023-06-01,IT,free,active
14,2023-06-18,NL,gold,active
15,2023-06-30,NL,silver,active
"""
TRANSACTIONS = """transaction_id,user_id,purchase_date,amount
501,11,2023-05-03,10.25
502,11,2023-05-31,4.75
503,12,2023-06-02,20.00
504,11,2023-06-30,1.10
505,13,2023-06-15,7.00
506,14,2023-08-01,3.33
507,15,2023-08-31,6.67
508,13,2023-08-05,2.00
509,12,2023-09-09,0.99
"""
GOLDEN = [
    ("2023-05", 2, 0, 1, 50.0, "15.00"),
    ("2023-05", 2, 1, 2, 100.0, "21.10"),
    ("2023-05", 2, 4, 1, 50.0, "0.99"),
    ("2023-06", 3, 0, 1, 33.33, "7.00"),
    ("2023-06", 3, 2, 3, 100.0, "12.00"),
]


@pytest.fixture(scope="module")
def seeds(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("seeds")
    (folder / "users.csv").write_text(USERS)
    (folder / "tx.csv").write_text(TRANSACTIONS)
    users = load_seed(spark, str(folder / "users.csv"), schemas.RAW_USERS)
    tx = load_seed(spark, str(folder / "tx.csv"), schemas.RAW_TRANSACTIONS)
    return staging.stg_users(users), staging.stg_transactions(tx)


def listed(report):
    return [
        (r.cohort_month.strftime("%Y-%m") if r.cohort_month else None, r.total_cohort_users, r.month_number, r.active_users, r.retention_rate_percentage, str(r.total_revenue_chf))
        for r in report.collect()
    ]


def test_golden_report(seeds):
    users, tx = seeds
    assert listed(retention.rpt_cohort_retention(users, retention.user_transactions(users, tx))) == GOLDEN
    assert listed(retention.cohort_retention(users, tx)) == GOLDEN


def test_orphans_and_early_purchases(spark, seeds):
    users, tx = seeds
    extra = spark.createDataFrame(
        [(1, 999, date(2023, 5, 1), Decimal("5.00")), (2, 15, date(2023, 3, 31), Decimal("7.00")), (3, None, date(2023, 5, 1), Decimal("1.00"))],
        tx.schema,
    )
    both = tx.unionByName(extra)
    joined = retention.user_transactions(users, both)
    assert joined.where("user_id = 999").first().cohort_month is None
    assert joined.where("transaction_id = 2").first().month_number == -3
    direct, by_row = (
        sorted(listed(r), key=repr)
        for r in (retention.cohort_retention(users, both), retention.rpt_cohort_retention(users, joined))
    )
    assert direct == by_row
    assert (None, None, None, 1, None, "6.00") in direct
    assert ("2023-06", 3, -3, 1, 33.33, "7.00") in direct


def test_hot_user_is_split_in_the_row_level_join(spark, tmp_path):
    """One user owns a third of the transactions: adaptive execution splits their partition."""
    from pyspark.sql import functions as F

    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        n = 60_000
        user = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000)
        tx = spark.range(0, n, 1, 8).select(
            F.col("id").alias("transaction_id"),
            user.alias("user_id"),
            F.lit("2026-02-01").cast("date").alias("purchase_date"),
            F.col("id").cast("decimal(10,2)").alias("transaction_amount_chf"),
        )
        users = spark.range(5000).select(
            F.col("id").alias("user_id"), F.lit("2026-01-01").cast("date").alias("signup_date"), F.lit("CH").alias("country_code")
        )
        joined = retention.user_transactions(users, tx)
        assert len(joined.collect()) == n
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
