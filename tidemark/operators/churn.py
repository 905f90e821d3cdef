"""Churn: inactivity tiers, the feature table for scoring, and the monthly rate."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.dates import as_of_date, month_start
from tidemark.functions.measures import percent, raw_percent
from tidemark.functions.tiers import churn_tier
from tidemark.operators.skew import HOT_ROWS, left_join_lookups


def inactivity_tiers(
    df: DataFrame,
    customer: str,
    last_seen: str,
    is_active: str,
    as_of: dt.date | str | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Days since the last login and the tier of every active customer."""
    days = F.datediff(as_of_date(as_of), F.col(last_seen))
    result = (
        df.where(F.col(is_active))
        .select(customer, last_seen, days.alias("days_inactive"))
        .withColumn("churn_risk_tier", churn_tier(F.col("days_inactive")))
    )
    return result.orderBy(F.desc("days_inactive"), customer) if ordered else result


def add_churn_tier(df: DataFrame, days_col: str, thresholds: Mapping[str, int] | None = None) -> DataFrame:
    return df.withColumn("churn_risk_tier", churn_tier(F.col(days_col), thresholds))


def tier_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("churn_risk_tier").agg(F.count(F.lit(1)).alias("customers"))


def churn_features(
    customers: DataFrame,
    logins: DataFrame,
    transactions: DataFrame,
    support: DataFrame,
    features: DataFrame,
    billing: DataFrame,
    customer: str = "customer_id",
    as_of: dt.date | str | None = None,
    check_unique: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row of churn signals and the label per customer, from five summary tables.

    A summary row that is missing leaves recency unknown and makes counts 0. Two summary rows for one
    customer give two result rows; ``check_unique`` looks for that first and raises.
    """
    counts = {
        "transactions": ["transactions_last_90d"],
        "support": ["support_tickets_last_90d"],
        "features": ["features_used_last_30d"],
        "billing": ["failed_payments_last_6m", "billing_disputes"],
    }
    lookups = [
        logins.select(customer, "last_login_date"),
        transactions.select(customer, "last_transaction_date", *counts["transactions"]),
        support.select(customer, *counts["support"]),
        features.select(customer, *counts["features"]),
        billing.select(customer, *counts["billing"]),
    ]
    if check_unique:
        for lookup in lookups:
            require_unique(lookup, customer)
    today = as_of_date(as_of)
    base = customers.select(customer, "plan_type", "signup_date", "churned_date")
    joined = left_join_lookups(base, lookups, customer, hot_rows)
    return joined.select(
        customer,
        "plan_type",
        "signup_date",
        F.datediff(today, "signup_date").alias("tenure_days"),
        F.datediff(today, "last_login_date").alias("days_since_login"),
        F.datediff(today, "last_transaction_date").alias("days_since_purchase"),
        *[F.coalesce(name, F.lit(0)).alias(name) for names in counts.values() for name in names],
        F.when(F.col("churned_date").isNotNull(), 1).otherwise(0).alias("is_churned"),
    )


def require_unique(df: DataFrame, key: str) -> None:
    repeated = df.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"more than one row for some {key}")


def monthly_churn_rate(df: DataFrame, customer: str, period: str, churned: str) -> DataFrame:
    """Churn rate per month and its change in points, taken before rounding."""
    people = df.groupBy(month_start(period).alias("month"), customer).agg(
        F.max(F.col(churned).cast("int")).alias("_churned")
    )
    months = people.groupBy("month").agg(
        F.count(customer).alias("total_customers"),
        F.count(F.when(F.col("_churned") == 1, F.col(customer))).alias("churned_customers"),
    )
    parts = F.col("churned_customers"), F.col("total_customers")
    rate = raw_percent(*parts)
    return months.select(
        "month",
        "total_customers",
        "churned_customers",
        percent(*parts, 2).alias("churn_rate_pct"),
        F.round(rate - F.lag(rate).over(Window.orderBy("month")), 2).alias("churn_rate_change_ppt"),
    ).orderBy("month")
