import pytest
from helpers import day, rows

from tidemark.operators import cohorts

PURCHASES = [
    (1, "2023-12-31"),
    (1, "2024-01-01"),
    (1, "2024-01-31"),
    (2, "2023-12-01"),
    (3, "2024-01-31"),
    (3, "2024-02-01"),
    (3, "2024-04-30"),
    (None, "2024-01-01"),
]


@pytest.fixture
def purchases(spark):
    return spark.createDataFrame([(c, day(d)) for c, d in PURCHASES], "customer_id long, d date")


def test_months_are_calendar_months(purchases):
    assert rows(cohorts.monthly_retention(purchases, "customer_id", "d")) == [
        (day("2023-12-01"), 0, 2, 100.0),
        (day("2023-12-01"), 1, 1, 50.0),
        (day("2024-01-01"), 0, 1, 100.0),
        (day("2024-01-01"), 1, 1, 100.0),
        (day("2024-01-01"), 3, 1, 100.0),
    ]


def test_matrix_has_a_column_for_each_month_of_the_data(purchases):
    matrix = cohorts.retention_matrix(purchases, "customer_id", "d")
    assert matrix.columns == ["cohort_month", *[f"period_{n}" for n in range(5)]]
    assert rows(matrix) == [
        (day("2023-12-01"), 100.0, 50.0, None, None, None),
        (day("2024-01-01"), 100.0, 100.0, None, 100.0, None),
    ]


def test_cutover_day_belongs_to_the_later_group(spark):
    customers = spark.createDataFrame(
        [(1, day("2023-12-31")), (2, day("2024-01-01")), (3, None), (4, day("2023-05-01")), (4, day("2024-05-01"))],
        "id long, signup date",
    )
    status = spark.createDataFrame([(1, True), (1, False), (2, None), (4, True)], "id long, is_active boolean")
    result = cohorts.cutover_retention(customers, status, "id", "signup", "is_active", "2024-01-01")
    assert rows(result, "cohort_type") == [("post_migration", 2, 1, 50.0), ("pre_migration", 2, 2, 100.0)]


def test_adoption_segments(spark):
    customers = spark.createDataFrame(
        [(n, day("2024-01-31")) for n in (1, 2, 3, 4, 6)] + [(5, None)], "id long, signup date"
    )
    used = [(1, "2024-01-01"), (2, "2024-03-01"), (3, "2024-03-02"), (5, "2024-01-01"), (6, "2024-01-31")]
    usage = spark.createDataFrame(
        [(c, "payroll", day(d)) for c, d in used] + [(4, "other", day("2024-01-31"))], "id long, feature string, d date"
    )
    stats = spark.createDataFrame(
        [(1, 10.0, 5, True), (1, 20.0, 6, False), (2, 1.0, 1, False), (3, 3.0, 3, None), (4, None, 4, False), (5, 5.0, 6, True)],
        "id long, lifetime_value double, tenure_days int, is_churned boolean",
    )
    result = cohorts.adoption_cohorts(customers, usage, stats, "id", "signup", "feature", "d", "payroll")
    # Customer 6 has no stats; customer 1 has two rows, and each counts in the averages.
    assert rows(result) == [
        ("never_adopted", 1, None, 4.0, 0.0),
        ("early_adopter", 2, 10.33, 4.0, 50.0),
        ("late_adopter", 2, 4.0, 5.0, 50.0),
    ]


def test_billing_cohorts(spark):
    df = spark.createDataFrame(
        [(1, "monthly", "2024-01-05", 3, True), (1, "monthly", "2024-01-09", 4, False), (2, "annual", "2024-01-09", 4, None)],
        "id long, cycle string, signup string, months int, churned boolean",
    ).selectExpr("id", "cycle", "date(signup) AS signup", "months", "churned")
    result = cohorts.billing_cohorts(df, "id", "cycle", "signup", "months", "churned")
    assert rows(result) == [("annual", day("2024-01-01"), 1, 4.0, 0.0), ("monthly", day("2024-01-01"), 1, 3.5, 50.0)]


def test_day_windows_are_open_below_and_closed_above(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01"), (1, "2024-01-31"), (2, "2024-01-01"), (2, "2024-02-01"), (2, "2024-03-31"), (3, "2024-01-02"), (3, "2024-01-02")],
        "id long, d string",
    ).selectExpr("id", "date(d) AS d")
    result = rows(cohorts.day_window_retention(df, "id", "d"))
    assert result == [(day("2024-01-01"), 3, 1, 1, 1, 33.3, 33.3, 33.3)]
