"""User cohorts: who signed up when, and who still buys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions.numeric import percentage
from usagelens.functions.temporal import datediff_boundary, trunc_date


def user_transactions(users: DataFrame, tx: DataFrame) -> DataFrame:
    """Transactions with their user's cohort. Months are negative before signup; a
    transaction without a known user keeps NULLs."""
    joined = tx.join(users, "user_id", "left").select(
        "transaction_id",
        "user_id",
        "country_code",
        "signup_date",
        "purchase_date",
        trunc_date("month", F.col("signup_date")).alias("cohort_month"),
        trunc_date("month", F.col("purchase_date")).alias("purchase_month"),
        "transaction_amount_chf",
    )
    months = datediff_boundary("month", F.col("cohort_month"), F.col("purchase_month"))
    return joined.withColumn("month_number", months)


def cohort_sizes(users: DataFrame) -> DataFrame:
    return users.groupBy(trunc_date("month", F.col("signup_date")).alias("cohort_month")).agg(
        F.count_distinct("user_id").alias("total_cohort_users")
    )


def _retention(activity: DataFrame, sizes: DataFrame) -> DataFrame:
    return activity.join(sizes, "cohort_month", "left").select(
        "cohort_month",
        "total_cohort_users",
        "month_number",
        "active_users",
        percentage(F.col("active_users"), F.col("total_cohort_users")).alias(
            "retention_rate_percentage"
        ),
        "total_revenue_chf",
    ).orderBy("cohort_month", "month_number")


def rpt_cohort_retention(users: DataFrame, joined: DataFrame) -> DataFrame:
    """Retention from row-level user transactions."""
    activity = joined.groupBy("cohort_month", "month_number").agg(
        F.count_distinct("user_id").alias("active_users"),
        F.sum("transaction_amount_chf").alias("total_revenue_chf"),
    )
    return _retention(activity, cohort_sizes(users))


def cohort_retention(users: DataFrame, tx: DataFrame) -> DataFrame:
    """Same report straight from users and transactions, for large inputs.

    Transactions are reduced to one row per user and month before they meet the users, so
    a user who owns a large share of them costs no more in the join than any other.
    """
    monthly = tx.groupBy(
        "user_id", trunc_date("month", F.col("purchase_date")).alias("purchase_month")
    ).agg(F.sum("transaction_amount_chf").alias("amount"))
    cohort = trunc_date("month", F.col("signup_date"))
    joined = monthly.join(users.select("user_id", cohort.alias("cohort_month")), "user_id", "left")
    activity = joined.groupBy(
        "cohort_month",
        datediff_boundary("month", F.col("cohort_month"), F.col("purchase_month")).alias(
            "month_number"
        ),
    ).agg(
        F.count_distinct("user_id").alias("active_users"),
        F.sum("amount").alias("total_revenue_chf"),
    )
    return _retention(activity, cohort_sizes(users))
