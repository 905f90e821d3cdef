"""Extracts: the filters and columns are part of the scan, so only they are read."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.dates import days_ago


def extract_transactions(
    transactions: DataFrame, as_of: dt.date | str | None = None, lookback_days: int = 365
) -> DataFrame:
    """Completed transactions of the look-back window, its first day included."""
    return transactions.where(
        (F.col("transaction_date") >= days_ago(as_of, lookback_days)) & (F.col("status") == "completed")
    ).select("customer_id", "transaction_id", "transaction_date", "amount", "product_line", "region")


def extract_funnel_events(funnel_stages: DataFrame) -> DataFrame:
    """The current stage of each lead."""
    return funnel_stages.where("is_current_stage").select(
        "lead_id", "customer_id", "stage_name", "stage_entered_at", "sales_rep_id", "segment"
    )


def extract_customer_logins(
    logins: DataFrame, as_of: dt.date | str | None = None, lookback_days: int = 90
) -> DataFrame:
    """Last login and number of logins per customer within the look-back window.

    Customers without a login in the window are not in the result, so a window of 90 days cannot
    show anyone as inactive for more than 90 days.
    """
    return (
        logins.where(F.col("login_date") >= days_ago(as_of, lookback_days))
        .groupBy("customer_id")
        .agg(F.max("login_date").alias("last_login_date"), F.count(F.lit(1)).alias("total_logins_90d"))
    )
