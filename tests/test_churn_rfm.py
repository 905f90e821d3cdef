import datetime as dt

import pytest
from helpers import day, rows


from tidemark.operators import churn, rfm

TIERS = {0: "active", 30: "active", 31: "low_risk", 60: "low_risk", 61: "medium_risk", 90: "medium_risk", 91: "high_risk", None: "active"}


def test_tier_limits(spark):
    df = spark.createDataFrame([(days,) for days in TIERS], "days int")
    tiered = churn.add_churn_tier(df, "days")
    assert dict(rows(tiered)) == TIERS
    assert dict(rows(churn.tier_counts(tiered))) == {"active": 3, "low_risk": 2, "medium_risk": 2, "high_risk": 1}


def test_own_thresholds(spark):
    df = spark.createDataFrame([(5,), (3,), (2,), (1,)], "days int")
    tiers = [row[1] for row in rows(churn.add_churn_tier(df, "days", {"high": 4, "medium": 2, "low": 1}), "days")]
    assert tiers == ["active", "low_risk", "medium_risk", "high_risk"]


def test_inactive_customers_are_left_out(spark):
    df = spark.createDataFrame(
        [(1, day("2024-01-01"), True), (2, day("2023-01-01"), False), (3, None, True), (4, day("2023-01-01"), None)],
        "id long, seen date, is_active boolean",
    )
    result = churn.inactivity_tiers(df, "id", "seen", "is_active", "2024-03-01", ordered=True)
    assert rows(result) == [(1, day("2024-01-01"), 60, "low_risk"), (3, None, None, "active")]


def test_monthly_change_is_taken_before_rounding(spark):
    data = [(n, "2024-01-15", n < 1) for n in range(3)] + [(n, "2024-02-01", n < 2) for n in range(7)]
    data += [(0, "2024-01-20", False)]
    df = spark.createDataFrame([(n, day(d), c) for n, d, c in data], "id long, d date, churned boolean")
    assert rows(churn.monthly_churn_rate(df, "id", "d", "churned")) == [
        (day("2024-01-01"), 3, 1, 33.33, None),
        (day("2024-02-01"), 7, 2, 28.57, -4.76),
    ]


def test_a_repeated_summary_row_is_found(spark):
    with pytest.raises(ValueError, match="more than one row"):
        churn.require_unique(spark.createDataFrame([(1,), (1,)], "id long"), "id")
    churn.require_unique(spark.createDataFrame([(1,), (None,), (None,)], "id long"), "id")


@pytest.mark.parametrize("one_task_rows", [None, 2])
def test_quantile_scores_by_hand(spark, one_task_rows):
    """Six customers; the edges of recency (10, 20, ... 60 days) lie at 20, 30, 40 and 50, a customer at an edge is below it."""
    as_of, data = dt.date(2024, 6, 1), []
    for customer, (days, times, amount) in enumerate([(10, 6, 1.0), (20, 5, 4.0), (30, 4, 9.0), (40, 3, 16.0), (50, 2, 25.0), (60, 1, 120.0)], 1):
        data += [(customer, as_of - dt.timedelta(days=days), amount)] * times
    df = spark.createDataFrame(data, "customer long, date date, amount double")
    result = rfm.rfm_by_quantile(df, "customer", "date", "amount", as_of.isoformat(), one_task_rows=one_task_rows)
    # Places 1 to 6 fall into fifths 1, 1, 2, 3, 4, 5, by frequency from customer 6 up, by total from customer 1 up.
    assert rows(result, "customer") == [
        (1, 10, 6, 6.0, 5, 5, 1, 11, "Loyal"),
        (2, 20, 5, 20.0, 5, 4, 1, 10, "Loyal"),
        (3, 30, 4, 36.0, 4, 3, 2, 9, "At Risk"),
        (4, 40, 3, 48.0, 3, 2, 3, 8, "At Risk"),
        (5, 50, 2, 50.0, 2, 1, 4, 7, "At Risk"),
        (6, 60, 1, 120.0, 1, 1, 5, 7, "At Risk"),
    ]


@pytest.mark.parametrize("days", [[5, 5, 5, 5, 5, 9, 12], [3]])
def test_equal_recency_edges_raise(spark, days):
    data = [(n, day(f"2024-01-{31 - gone:02d}"), 1.0) for n, gone in enumerate(days)]
    df = spark.createDataFrame(data, "customer long, date date, amount double")
    with pytest.raises(ValueError, match="edges"):
        rfm.rfm_by_quantile(df, "customer", "date", "amount", "2024-01-31")


@pytest.mark.parametrize("n", [3, 7])
def test_ntile_scores_with_all_values_tied(spark, n):
    data = [(c, 100 + c, day("2024-01-01"), 9.0) for c in range(n)]
    df = spark.createDataFrame(data, "customer long, id long, date date, amount double")
    written = rfm.rfm_by_ntile(df, "customer", "date", "amount", "id", "2024-01-31")
    tiles = {3: [1, 2, 3], 7: [1, 1, 2, 2, 3, 4, 5]}[n]
    assert [row[4:7] for row in rows(written, "customer")] == [(tile, tile, tile) for tile in tiles]
    best = rfm.rfm_by_ntile(df, "customer", "date", "amount", "id", "2024-01-31", polarity="best_high")
    assert [row.r_score for row in best.orderBy("customer").collect()] == [6 - tile for tile in tiles]


def test_the_lookback_day_itself_counts(spark):
    data = [(1, 1, day("2023-01-31"), 1.0), (2, 2, day("2023-01-30"), 1.0)]
    df = spark.createDataFrame(data, "customer long, id long, date date, amount double")
    result = rfm.rfm_by_ntile(df, "customer", "date", "amount", "id", "2024-01-31")
    assert [row[0] for row in rows(result)] == [1]
