"""Sums lose nothing: small, huge, infinite and undefined values count as in a plain sum, in every operator that adds."""

import datetime as dt
import math

import pytest
from helpers import day, rows

from pyspark.sql import functions as F

from tidemark.functions.measures import money_avg, money_sum
from tidemark.operators import cohorts, rfm, rollups, windows
from tidemark.plans import reports
from tidemark.sources import layout

CASES = [
    [0.00001, 0.00002],
    [1e15, 1.0],
    [1e300, 1.0, 0.1],
    [1e-12, 1.0],
    [math.inf, 1.0],
    [math.inf, -math.inf],
    [math.nan, 1.0],
    [0.1] * 10,
    [None, 0.25],
    [None, None],
]


def alike(left, right):
    if left is None or right is None:
        return left is right
    return (math.isnan(left) and math.isnan(right)) or left == right or math.isclose(left, right, rel_tol=1e-12)


def plain(values):
    known = [value for value in values if value is not None]
    return sum(known) if known else None


@pytest.mark.parametrize("values", CASES)
def test_every_operator_sums_like_a_plain_sum(spark, database, values):
    data = [(1, n, day("2024-01-02"), value, "x") for n, value in enumerate(values)]
    df = spark.createDataFrame(data, "customer_id long, id long, d date, amount double, kind string")
    expected = plain(values)

    def check(result, column, digits=None):
        wanted = expected if digits is None or expected is None or not math.isfinite(expected) else round(expected, digits)
        assert alike(result.first()[column], wanted), column

    check(df.agg(money_sum("amount").alias("s")), "s")
    for hot_rows in (1000, 1):
        totals = windows.running_total(df, "customer_id", "d", "amount", ["id"], hot_rows=hot_rows)
        assert alike(totals.orderBy(F.desc("id")).first()["running_total"], expected)
    events = df.select("customer_id", F.col("kind").alias("event_type"), F.col("kind").alias("region"), F.lit("2024-01-02").alias("event_date"), F.col("amount").alias("event_value"))
    check(rollups.event_totals(events, "2024-01-01", "2024-01-03"), "total_value")
    check(rfm.rfm_by_ntile(df, "customer_id", "d", "amount", "id", "2024-01-31"), "monetary", 2)
    layout.write_bucketed(df.limit(1).select("customer_id", F.col("kind").alias("segment")), f"{database}.people", "customer_id", 2)
    layout.write_bucketed(df.select("customer_id", "amount"), f"{database}.payments", "customer_id", 2)
    check(layout.bucketed_spend(spark, f"{database}.people", f"{database}.payments"), "total_spend")
    weekly = df.select(F.col("d").alias("event_date"), "customer_id", F.col("amount").alias("revenue"), F.col("id").alias("order_id"))
    check(reports.executive_summary(weekly, "2024-01-31"), "total_revenue", 2)
    summary = df.select("customer_id", F.lit("s").alias("segment"), F.lit("p").alias("plan_type"), F.col("amount").alias("mrr"), F.lit(1).alias("tenure_days"), F.lit(False).alias("is_churned"), F.col("amount").alias("lifetime_value"))
    check(reports.segment_performance(summary), "total_mrr", 2)


def test_adoption_value_may_be_infinite(spark):
    customers = spark.createDataFrame([(1, day("2024-01-01"))], "id long, signup date")
    usage = spark.createDataFrame([], "id long, feature string, d date")
    stats = spark.createDataFrame([(1, math.inf, 1, False)], "id long, lifetime_value double, tenure_days int, is_churned boolean")
    assert cohorts.adoption_cohorts(customers, usage, stats, "id", "signup", "feature", "d", "payroll").first()["avg_ltv"] == math.inf


def test_quantile_scores_keep_an_infinite_total(spark):
    data = [(c, dt.date(2024, 1, 1 + 2 * c), math.inf if c == 3 else float(c)) for c in range(1, 7)]
    df = spark.createDataFrame(data, "customer long, date date, amount double")
    result = {row.customer: row for row in rfm.rfm_by_quantile(df, "customer", "date", "amount", "2024-01-31").collect()}
    assert result[3].monetary == math.inf and result[3].m_score == 5


def test_sums_of_decimals_and_whole_numbers(spark):
    df = spark.createDataFrame([(1, 2), (3, 4)], "a long, b long").withColumn("d", (F.col("b") / 8).cast("decimal(38,18)"))
    assert rows(df.agg(money_sum("a"), money_sum("d"), money_avg("a"))) == [(4.0, 0.75, 2.0)]


def test_a_wrong_date_loses_no_period(spark):
    df = spark.createDataFrame([(1, day("2024-01-01")), (1, day("2024-05-01")), (2, day("2024-01-09"))], "id long, d date")
    assert cohorts.retention_matrix(df, "id", "d").columns == ["cohort_month", *[f"period_{n}" for n in range(5)]]
    wrong = spark.createDataFrame([(1, day("0024-01-01")), (2, day("9999-02-01"))], "id long, d date")
    matrix = cohorts.retention_matrix(df.unionByName(wrong), "id", "d")
    assert matrix.columns == ["cohort_month", "period_0", "period_24000", "period_24004", "period_95701"]
    assert rows(matrix) == [(day("0024-01-01"), 100.0, 100.0, 100.0, None), (day("2024-01-01"), 100.0, None, None, 100.0)]
