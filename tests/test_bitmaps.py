"""Activity bitmaps, and retention kept up to date from them, against distinct rows and windows."""

import datetime as dt
import random

import pytest
from helpers import rows
from pyspark.sql import Window, functions as F

from tidemark.operators import bitmaps, cohorts, retention_state
from tidemark.operators.streaks import activity_streaks


def activity(spark, seed, span=900, customers=40, odd=True):
    chance = random.Random(seed)
    start = dt.date(1969, 6, 1)
    data = [(chance.randrange(customers), start + dt.timedelta(days=chance.randrange(span))) for _ in range(1500)]
    if odd:
        data += [(1, None), (None, start), (None, None), (900, None), (901, dt.date(9999, 12, 31)), (902, dt.date(1, 1, 1)), (2, dt.date(2999, 1, 1))]
    return spark.createDataFrame(data, "customer long, date date")


@pytest.mark.parametrize("word_columns", [8, 0])
@pytest.mark.parametrize("unit", [bitmaps.month_number, bitmaps.day_number])
def test_bits_are_the_distinct_numbers(spark, word_columns, unit):
    df = activity(spark, 1)
    found = bitmaps.activity_bitmaps(df, "customer", unit("date"), word_columns)
    numbers = found.select("customer", "first", bitmaps.active_numbers().alias("numbers"), "undated")
    expected = df.groupBy("customer").agg(
        F.min(unit("date")).alias("first"), F.sort_array(F.collect_set(unit("date"))).alias("numbers"), F.max(F.col("date").isNull()).alias("undated")
    )
    assert rows(numbers, "customer") == rows(expected, "customer")


def test_merged_bitmaps_are_those_of_all_rows(spark):
    parts = [activity(spark, seed) for seed in (1, 2, 3)]
    whole = bitmaps.activity_bitmaps(parts[0].unionByName(parts[1]).unionByName(parts[2]), "customer", bitmaps.day_number("date"))
    one, two, three = (bitmaps.activity_bitmaps(part, "customer", bitmaps.day_number("date")) for part in parts)
    for order in ([one, two, three, one], [three, one, two, two]):
        merged = order[0]
        for part in order[1:]:
            merged = bitmaps.merge_bitmaps(merged, part, "customer")
        assert rows(merged, "customer") == rows(whole, "customer")


def test_ranges_of_bits(spark):
    df = activity(spark, 4, odd=False)
    people = bitmaps.activity_bitmaps(df, "customer", bitmaps.day_number("date"))
    for low, high in ((1, 30), (0, 0), (31, 200), (63, 64), (5, 4), (-70, -1)):
        between = bitmaps.active_between(F.col("first") + low, F.col("first") + high)
        plain = F.exists(bitmaps.active_numbers(), lambda n: (n >= F.col("first") + low) & (n <= F.col("first") + high))
        assert people.where(between != plain).isEmpty()


def test_months_have_their_first_day(spark):
    days = spark.sql("SELECT explode(sequence(DATE '0001-01-15', DATE '0003-01-01', INTERVAL 1 MONTH)) AS d UNION ALL SELECT DATE '1969-12-31' UNION ALL SELECT DATE '9999-12-31'")
    assert days.where(bitmaps.month_of(bitmaps.month_number("d")) != F.trunc("d", "MM")).isEmpty()


def plain_retention(df):
    months = df.where("customer IS NOT NULL").select("customer", F.trunc("date", "MM").alias("m")).distinct()
    first = F.min("m").over(Window.partitionBy("customer"))
    period = (F.year("m") - F.year("c")) * 12 + F.month("m") - F.month("c")
    return months.withColumn("c", first).groupBy(F.col("c").alias("cohort_month"), period.alias("period")).agg(F.count(F.lit(1)).alias("active_customers"))


def test_retention_from_bits(spark):
    df = activity(spark, 5)
    counted = cohorts.monthly_retention(df, "customer", "date").select("cohort_month", "period", "active_customers")
    order = ("cohort_month", "period")
    assert rows(counted, *order) == rows(plain_retention(df), *order)


def test_state_after_any_deltas_is_that_of_all_rows(spark, database):
    """A late day, a repeated one, one without rows, and rows without customer or date."""
    parts = [activity(spark, seed, span=400 * seed) for seed in (3, 1, 2)]
    table = f"{database}.state"
    for delta in (parts[0], parts[1], parts[1].limit(0), parts[2], parts[0]):
        retention_state.take_in(spark, table, delta, "customer", "date")
    whole = cohorts.monthly_retention(parts[0].unionByName(parts[1]).unionByName(parts[2]), "customer", "date")
    assert rows(retention_state.retention_so_far(spark, table)) == rows(whole)
    assert spark.table(table).count() == spark.table(table).select("customer_id").distinct().count()


def test_streaks_from_bits(spark):
    df = activity(spark, 6, span=120)
    days = df.distinct()
    run = F.unix_date("date") - F.row_number().over(Window.partitionBy("customer").orderBy("date"))
    plain = days.withColumn("run", run).groupBy("customer", "run").agg(F.min("date").alias("a"), F.max("date").alias("b"), F.count(F.lit(1)).alias("n")).drop("run")
    assert rows(activity_streaks(df, "customer", "date"), "customer", "streak_start") == rows(plain, "customer", "a")
