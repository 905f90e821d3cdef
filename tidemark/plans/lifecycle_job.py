"""The lifecycle job: three extracts, five transforms, four tables.

``spark-submit ... -m tidemark.plans.lifecycle_job --source analytics --dataset analytics_output``
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.cleaning import clean, transform_churn_risk, transform_transactions
from tidemark.operators.cohorts import retention_matrix
from tidemark.operators.funnel import listed_funnel
from tidemark.operators.rfm import rfm_by_quantile
from tidemark.session import get_session
from tidemark.sources.extracts import extract_customer_logins, extract_funnel_events, extract_transactions
from tidemark.sources.releases import publish
from tidemark.sources.warehouse import months_as_text

# The stages of the sales funnel, top to bottom.
FUNNEL_STAGES = ("Lead Created", "Demo Scheduled", "Proposal Sent", "Contract Signed", "Closed Won")


def transform_rfm(transactions: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    return rfm_by_quantile(transactions, "customer_id", "transaction_date", "amount", as_of)


def transform_funnel(funnel_events: DataFrame) -> DataFrame:
    """Customers now in each stage; as no one is in two stages, a rate may be above 100 %."""
    return listed_funnel(clean(funnel_events), "stage_name", "customer_id", FUNNEL_STAGES)


def transform_cohorts(transactions: DataFrame) -> DataFrame:
    return retention_matrix(transactions, "customer_id", "transaction_date")


def run_job(
    transactions: DataFrame,
    logins: DataFrame,
    funnel_stages: DataFrame,
    dataset: str,
    as_of: dt.date | str | None = None,
    login_lookback_days: int = 90,
) -> dict[str, bool]:
    """Fill the four results in ``dataset``; False marks one that was empty and stays as it was.

    All four are computed first and shown to readers in one step (``releases``), so a failure anywhere leaves all old results or
    all new ones. The cleaned transactions feed two results and are cached for them; lost blocks are recomputed.
    """
    spark = transactions.sparkSession
    cleaned = transform_transactions(extract_transactions(transactions, as_of)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        results = {
            "churn_risk_scores": transform_churn_risk(
                extract_customer_logins(logins, as_of, login_lookback_days), as_of
            ),
            "rfm_scores": transform_rfm(cleaned, as_of),
            "funnel_conversion": transform_funnel(extract_funnel_events(funnel_stages)),
            "cohort_retention": transform_cohorts(cleaned),
        }
        return publish(spark, dataset, {name: months_as_text(result) for name, result in results.items()})
    finally:
        cleaned.unpersist()


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(description="Fill the lifecycle result tables")
    parser.add_argument("--source", default="analytics", help="database with the input tables")
    parser.add_argument("--dataset", default="analytics_output", help="database for the results")
    parser.add_argument("--as-of", default=None, help="date to count from (default: today)")
    options = parser.parse_args(arguments)
    spark = spark or get_session("lifecycle")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {options.dataset}")
    run_job(
        spark.table(f"{options.source}.transactions"),
        spark.table(f"{options.source}.customer_logins"),
        spark.table(f"{options.source}.funnel_stages"),
        options.dataset,
        options.as_of,
    )


if __name__ == "__main__":
    main()
