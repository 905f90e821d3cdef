"""Retention kept up to date: a table of month bitmaps that takes in one delta after the other.

A customer's row holds the bits of all months seen so far. Taking in rows sets bits, so a delta that comes late, twice, or
overlaps another gives the same state, and the state after any deltas is that of all their rows together. A daily run
reads the delta and one row per customer, never the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.bitmaps import activity_bitmaps, merge_bitmaps, month_number
from tidemark.operators.cohorts import cohort_activity, retention_of
from tidemark.sources.warehouse import replace_table

CUSTOMER = "customer_id"


def take_in(spark: SparkSession, table: str, delta: DataFrame, customer: str, date: str) -> None:
    """Adds the rows of ``delta`` to the state in ``table``, which is made where there is none.

    Rows without a customer are left out, as in ``cohorts.monthly_retention``.
    """
    rows = delta.where(F.col(customer).isNotNull()).withColumnRenamed(customer, CUSTOMER)
    bitmaps = activity_bitmaps(rows, CUSTOMER, month_number(date))
    if spark.catalog.tableExists(table):
        bitmaps = merge_bitmaps(spark.table(table), bitmaps, CUSTOMER)
    replace_table(bitmaps, table)


def retention_so_far(spark: SparkSession, table: str) -> DataFrame:
    """What ``cohorts.monthly_retention`` gives for all rows taken in."""
    return retention_of(cohort_activity(spark.table(table)))
