"""Relations that must hold between results, whatever the data."""

import pytest
from helpers import day

from pyspark.sql import functions as F

from tidemark.catalog import inputs
from tidemark.catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def total(df, column: str):
    return df.agg(F.sum(column)).first()[0]


def test_streak_days_are_the_distinct_active_days(spark):
    days = inputs.customer_activity(spark, SF_DIR)
    assert total(QUERIES["w7_activity_streaks"](spark, SF_DIR), "streak_length_days") == days.distinct().count()
    assert total(QUERIES["w7_activity_streaks_every_row"](spark, SF_DIR), "streak_length_days") == days.count()


def test_every_cohort_starts_at_100_percent_and_the_matrix_has_the_same_figures(spark):
    long = {(row.cohort_month, row.period): row.retention_pct for row in QUERIES["k1_monthly_retention"](spark, SF_DIR).collect()}
    assert {pct for (_, period), pct in long.items() if period == 0} == {100.0}
    wide = {
        (day(row["key"]), int(row["item"].removeprefix("period_"))): row["value"]
        for row in QUERIES["k5_retention_matrix"](spark, SF_DIR).collect()
    }
    assert wide == long


def test_each_converted_customer_has_one_first_and_one_last_touch(spark):
    result = QUERIES["f5_touch_attribution"](spark, SF_DIR)
    buyers = inputs.converted_customers(spark, SF_DIR).distinct()
    met = inputs.marketing_touches(spark, SF_DIR).join(buyers, "customer_id", "left_semi").select("customer_id").distinct().count()
    assert total(result, "first_touch_conversions") == total(result, "last_touch_conversions") == met


def test_tiers_cover_all_customers(spark):
    assert total(QUERIES["h5_tier_counts"](spark, SF_DIR), "customers") == inputs.last_logins(spark, SF_DIR).count()


@pytest.mark.parametrize("name, of", [("w1_running_total", "transactions"), ("w5_first_and_last", "customer_events"), ("h3_churn_features", "customers"), ("w6_spend_quartiles_sliced", "customer_spend")])
def test_no_row_is_lost(spark, name, of):
    assert QUERIES[name](spark, SF_DIR).count() == getattr(inputs, of)(spark, SF_DIR).count()


def test_last_running_total_is_the_sum(spark):
    result = QUERIES["w1_running_total_hot"](spark, SF_DIR)
    last = result.groupBy("product_line").agg(F.max("running_total").alias("last"), F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("sum"))
    assert last.where("last <> sum").isEmpty()
