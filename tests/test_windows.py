import datetime as dt

import pytest
from helpers import day, rows

from tidemark.operators import streaks, windows


def test_running_total_orders_ties_by_tie_breaker(spark):
    df = spark.createDataFrame(
        [(1, 2, day("2024-01-01"), 5.0), (1, 1, day("2024-01-01"), 1.5), (1, 3, day("2024-01-02"), None), (2, 4, None, 7.0)],
        "customer_id long, id long, d date, amount double",
    )
    result = windows.running_total(df, "customer_id", "d", "amount", ["id"]).select("id", "running_total")
    assert rows(result, "id") == [(1, 1.5), (2, 6.5), (3, 6.5), (4, 7.0)]


def test_rankings_with_ties_nulls_and_a_group_of_one(spark):
    df = spark.createDataFrame(
        [(1, "a", 5.0), (2, "a", 5.0), (3, "a", 5.0), (4, "a", 9.0), (5, "a", None), (6, "a", 1.0), (7, "b", 2.0)],
        "rep long, region string, revenue double",
    )
    result = windows.rankings(df, "region", "revenue", ["rep"]).select("rep", "rank", "dense_rank", "row_num")
    expected = [(1, 2, 2, 2), (2, 2, 2, 3), (3, 2, 2, 4), (4, 1, 1, 1), (5, 6, 4, 6), (6, 5, 3, 5), (7, 1, 1, 1)]
    assert rows(result, "rep") == expected


def test_growth_after_a_zero_month_is_unknown(spark):
    df = spark.createDataFrame(
        [(day("2024-01-01"), 10.0), (day("2024-02-01"), 0.0), (day("2024-03-01"), 5.0)], "month date, revenue double"
    )
    result = rows(windows.period_over_period(df, "month", "revenue"), "month")
    assert [row[2:] for row in result] == [(None, 0.0, None), (10.0, 5.0, -100.0), (0.0, None, None)]


def test_moving_average_counts_rows_not_days(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=3 * n) for n in range(9)]
    df = spark.createDataFrame([(d, 10 * n) for n, d in enumerate(days)], "d date, users long")
    result = rows(windows.moving_average(df, "d", "users"))
    assert [row[2] for row in result] == [0.0, 5.0, 10.0, 15.0, 20.0, 25.0, 30.0, 40.0, 50.0]


def test_first_date_is_null_when_one_date_is(spark):
    df = spark.createDataFrame(
        [(1, day("2024-01-05"), "a"), (1, None, "b"), (2, day("2024-01-02"), "a"), (2, day("2024-01-03"), "a")],
        "customer_id long, d date, kind string",
    )
    result = windows.first_and_last(df, "customer_id", "d").select("customer_id", "first_event_date", "last_event_date")
    assert set(rows(result)) == {(1, None, day("2024-01-05")), (2, day("2024-01-02"), day("2024-01-03"))}


@pytest.mark.parametrize("one_task_rows", [1_000_000, 2])
def test_quartiles_and_medians(spark, one_task_rows):
    spend = [("x", 10.0), ("x", 20.0), ("x", 40.0), ("x", 100.0), ("y", 7.0), ("y", 7.0), ("y", None)]
    df = spark.createDataFrame([(n, s, v) for n, (s, v) in enumerate(spend)], "customer_id long, segment string, spend double")
    result = windows.spend_quartiles(df, "customer_id", "spend", "segment", one_task_rows=one_task_rows)
    assert rows(result, "customer_id") == [
        (0, 10.0, 2, 30.0),
        (1, 20.0, 2, 30.0),
        (2, 40.0, 1, 30.0),
        (3, 100.0, 1, 30.0),
        (4, 7.0, 3, 7.0),
        (5, 7.0, 3, 7.0),
        (6, None, 4, 7.0),
    ]


ACTIVITY = [
    ("a", "2024-02-28"),
    ("a", "2024-02-29"),
    ("a", "2024-02-29"),
    ("a", "2024-03-01"),
    ("a", "2024-03-03"),
    ("b", "2023-12-31"),
    ("b", "2024-01-01"),
    ("c", None),
    ("c", None),
]


def test_streaks_over_leap_day_and_year_end(spark):
    df = spark.createDataFrame([(c, day(d)) for c, d in ACTIVITY], "customer_id string, d date")
    assert rows(streaks.activity_streaks(df, "customer_id", "d", ordered=True)) == [
        ("a", day("2024-02-28"), day("2024-03-01"), 3),
        ("a", day("2024-03-03"), day("2024-03-03"), 1),
        ("b", day("2023-12-31"), day("2024-01-01"), 2),
        ("c", None, None, 1),
    ]


def test_a_repeated_day_shifts_streaks_when_every_row_counts(spark):
    """The repeat on 29 February makes up for the gap on 2 March."""
    df = spark.createDataFrame([(c, day(d)) for c, d in ACTIVITY], "customer_id string, d date")
    result = streaks.activity_streaks(df, "customer_id", "d", dedupe=False)
    assert rows(result, "customer_id", "streak_start", "streak_length_days") == [
        ("a", day("2024-02-28"), day("2024-03-03"), 3),
        ("a", day("2024-02-29"), day("2024-03-01"), 2),
        ("b", day("2023-12-31"), day("2024-01-01"), 2),
        ("c", None, None, 2),
    ]
