import pytest
from helpers import day, rows

from tidemark.catalog import inputs
from tidemark.plans import lifecycle_job, reports

SF_DIR = "/root/testdata/sf0.001"


def test_weeks_start_on_sunday(spark):
    orders = spark.createDataFrame(
        [
            (day("2024-03-02"), 1, 10.0, 1),  # Saturday
            (day("2024-03-03"), 1, 0.0, 2),  # Sunday
            (day("2024-03-04"), 2, 0.0, 3),  # Monday
            (day("2024-03-10"), 2, 5.0, 4),
            (day("2024-03-10"), 2, 2.5, 4),
            (day("2023-12-16"), 9, 5.0, 5),  # the first day of the window is the 17th
        ],
        "event_date date, customer_id long, revenue double, order_id long",
    )
    assert rows(reports.executive_summary(orders, "2024-03-10")) == [
        (day("2024-03-10"), 1, 7.5, 1, 3.75, 7.5, None),
        (day("2024-03-03"), 2, 0.0, 2, 0.0, -10.0, -100.0),
        (day("2024-02-25"), 1, 10.0, 1, 10.0, None, None),
    ]


@pytest.fixture
def accounts(spark):
    gone = {1: 91, 2: 61, 3: 60, 4: None, 5: 200, 6: 95, 7: 91}
    mrr = {1: 10.0, 2: 99.0, 3: 5.0, 4: 5.0, 5: 5.0, 6: None, 7: 20.0}
    customers = spark.createDataFrame(
        [(c, f"n{c}", "o", "p", mrr[c], None, c != 5) for c in gone],
        "customer_id long, account_name string, csm_owner string, plan_type string, mrr double, signup_date date, is_active boolean",
    )
    logins = spark.createDataFrame([(c, days) for c, days in gone.items() if days], "customer_id long, days int").selectExpr(
        "customer_id", "date_sub(DATE'2024-06-01', days) AS last_login_date"
    )
    support = spark.createDataFrame([(1, 4)], "customer_id long, open_support_tickets long")
    billing = spark.createDataFrame([(2, 5)], "customer_id long, failed_payments_last_90d long")
    return customers, logins, support, billing


@pytest.mark.parametrize(
    "min_risk, expected",
    [("medium_risk", [7, 1, 6, 2]), ("high_risk", [7, 1, 6]), ("low_risk", [7, 1, 6, 2, 3, 4]), ("other", [7, 1, 6, 2, 3, 4])],
)
def test_risk_report_keeps_and_sorts(accounts, min_risk, expected):
    for hot_rows in (1000, 0):
        report = reports.churn_risk_report(*accounts, as_of="2024-06-01", min_risk=min_risk, hot_rows=max(hot_rows, 1))
        assert [row.customer_id for row in report.collect()] == expected
        assert report.columns[-1] == "churn_risk_tier"


def test_choice_of_reports(spark, tmp_path):
    tables = {"customer_summary": inputs.customer_mrr(spark, SF_DIR), "orders": inputs.weekly_orders(spark, SF_DIR)}
    assert list(reports.build_reports(tables, "segment")) == ["segment_performance"]
    paths = reports.run_reports(tables, str(tmp_path), "exec_summary", inputs.AS_OF)
    assert [path.rsplit("/", 1)[1] for path in paths] == ["executive_summary"]
    with pytest.raises(ValueError):
        reports.build_reports(tables, "everything")


def test_report_command(spark, database, tmp_path):
    inputs.customer_mrr(spark, SF_DIR).write.saveAsTable(f"{database}.customer_summary")
    reports.main(["--database", database, "--output", str(tmp_path), "--report", "segment"], spark)
    written = spark.read.option("header", True).csv(f"{tmp_path}/segment_performance")
    assert written.count() == reports.segment_performance(inputs.customer_mrr(spark, SF_DIR)).count()


def test_job_command_fills_four_tables(spark, database):
    inputs.transactions_with_region(spark, SF_DIR).write.saveAsTable(f"{database}.transactions")
    inputs.customer_logins(spark, SF_DIR).write.saveAsTable(f"{database}.customer_logins")
    inputs.funnel_stages(spark, SF_DIR).write.saveAsTable(f"{database}.funnel_stages")
    lifecycle_job.main(["--source", database, "--dataset", database, "--as-of", inputs.AS_OF], spark)
    for table in ("churn_risk_scores", "rfm_scores", "funnel_conversion", "cohort_retention"):
        assert not spark.table(f"{database}.{table}").isEmpty()
    assert spark.table(f"{database}.cohort_retention").schema["cohort_month"].dataType.simpleString() == "string"
    # With the default look-back nobody can have been away for more than 90 days.
    assert spark.table(f"{database}.churn_risk_scores").where("churn_risk_tier = 'high_risk'").isEmpty()
