"""Counts and totals over the partitioned event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.measures import money_sum


def partition_event_counts(events: DataFrame, event_date: str, region: str) -> DataFrame:
    """Events per customer and type in one partition; the scan reads no other partition."""
    return (
        events.where((F.col("event_date") == event_date) & (F.col("region") == region))
        .groupBy("customer_id", "event_type")
        .agg(F.count(F.lit(1)).alias("event_count"))
    )


def event_totals(events: DataFrame, first_date: str, last_date: str) -> DataFrame:
    """Events, customers and value per type and region between two dates, both included.

    A first step totals per customer, spread over all customers of a group; the second adds those
    up. A group with a third of the events, or a customer with that many, is combined before each
    shuffle and meets no other step that is as large.
    """
    per_customer = (
        events.where(F.col("event_date").between(first_date, last_date))
        .groupBy("event_type", "region", "customer_id")
        .agg(F.count(F.lit(1)).alias("_events"), money_sum("event_value").alias("_value"))
    )
    return per_customer.groupBy("event_type", "region").agg(
        F.sum("_events").alias("event_count"),
        F.count("customer_id").alias("unique_customers"),
        money_sum("_value").alias("total_value"),
    )
