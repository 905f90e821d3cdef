"""Reports: weekly KPIs, accounts at risk, segments. ``python -m tidemark.plans.reports --help``."""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.functions.dates import as_of_date, days_ago, week_start
from tidemark.functions.measures import money_avg, money_sum, percent
from tidemark.functions.tiers import CHURN_TIERS, churn_tier
from tidemark.operators.skew import HOT_ROWS, left_join_lookups
from tidemark.session import get_session
from tidemark.sources.export import export_csv



def executive_summary(orders: DataFrame, as_of: dt.date | str | None = None, weeks: int = 12) -> DataFrame:
    """KPIs per week (from Sunday) of the last weeks, newest first, with the change on the week before.

    The first week is partial when the window starts within it. An order's value is averaged per row.
    """
    week = week_start("event_date")
    recent = orders.where(F.col("event_date") >= days_ago(as_of, 7 * weeks)).withColumn("week_start", week)
    # Counted apart, as two distinct counts in one pass would carry every order three times.
    per_order = recent.groupBy("week_start", "order_id").agg(
        money_sum("revenue").alias("_revenue"), F.count("revenue").alias("_values")
    )
    by_orders = per_order.groupBy("week_start").agg(
        F.count("order_id").alias("total_orders"),
        money_sum("_revenue").alias("_revenue"),
        F.try_divide(money_sum("_revenue"), F.sum("_values")).alias("_average"),
    )
    per_customer = recent.select("week_start", "customer_id").distinct()
    by_customers = per_customer.groupBy("week_start").agg(F.count("customer_id").alias("active_customers"))
    weekly = by_orders.join(by_customers, "week_start")
    previous = F.lag("_revenue").over(Window.orderBy("week_start"))
    change = F.col("_revenue") - previous
    return weekly.select(
        "week_start",
        "active_customers",
        F.round("_revenue", 2).alias("total_revenue"),
        "total_orders",
        F.round("_average", 2).alias("avg_order_value"),
        F.round(change, 2).alias("revenue_wow_change"),
        F.round(change / F.nullif(previous, F.lit(0)) * F.lit(100), 1).alias("revenue_wow_pct"),
    ).orderBy(F.desc("week_start"))


def churn_risk_report(
    customers: DataFrame,
    logins: DataFrame,
    support: DataFrame,
    billing: DataFrame,
    as_of: dt.date | str | None = None,
    min_risk: str = "medium_risk",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Active accounts at ``min_risk`` or worse, highest risk and revenue first.

    ``medium_risk`` and ``high_risk`` filter; any other value keeps every account.
    """
    days = F.datediff(as_of_date(as_of), "last_login_date")
    columns = ("customer_id", "account_name", "csm_owner", "plan_type", "mrr", "signup_date")
    accounts = customers.where("is_active").select(*columns)
    lookups = [
        logins.select("customer_id", "last_login_date"),
        support.select("customer_id", "open_support_tickets"),
        billing.select("customer_id", "failed_payments_last_90d"),
    ]
    kept = {"high_risk": CHURN_TIERS[:1], "medium_risk": CHURN_TIERS[:2]}.get(min_risk, CHURN_TIERS)
    # The tier depends on the first lookup alone, so the filter moves in front of the other joins.
    detailed = (
        left_join_lookups(accounts, lookups, "customer_id", hot_rows)
        .withColumns({"days_since_login": days, "churn_risk_tier": churn_tier(days)})
        .where(F.col("churn_risk_tier").isin(*kept))
    )
    rank = F.array_position(F.array(*map(F.lit, CHURN_TIERS)), F.col("churn_risk_tier"))
    return detailed.select(
        *columns, "days_since_login", "open_support_tickets", "failed_payments_last_90d", "churn_risk_tier"
    ).orderBy(rank, F.desc_nulls_last("mrr"), "customer_id")


def segment_performance(summary: DataFrame) -> DataFrame:
    """Customers, revenue, tenure and churn per segment and plan, highest revenue first."""
    churned = F.sum(F.when(F.col("is_churned"), 1).otherwise(0))
    return (
        summary.groupBy("segment", "plan_type")
        .agg(
            F.count_distinct("customer_id").alias("total_customers"),
            F.round(money_sum("mrr"), 2).alias("total_mrr"),
            F.round(money_avg("mrr"), 2).alias("avg_mrr"),
            F.round(F.avg("tenure_days"), 0).alias("avg_tenure_days"),
            percent(churned, F.count(F.lit(1)), 2).alias("churn_rate_pct"),
            F.round(money_avg("lifetime_value"), 2).alias("avg_ltv"),
        )
        .orderBy(F.desc_nulls_last("total_mrr"), "segment", "plan_type")
    )


# Each report by the name it is asked for: the name of its result, its tables, and what makes it of them.
REPORTS: dict[str, tuple[str, tuple[str, ...], Callable[..., DataFrame]]] = {
    "exec_summary": ("executive_summary", ("orders",), executive_summary),
    "churn_risk": (
        "churn_risk_report",
        ("customers", "login_summary", "support_summary", "billing_summary"),
        churn_risk_report,
    ),
    "segment": ("segment_performance", ("customer_summary",), lambda summary, as_of: segment_performance(summary)),
}


def chosen_reports(which: str) -> list[str]:
    if which != "all" and which not in REPORTS:
        raise ValueError(f"unknown report {which!r}")
    return [name for name in REPORTS if which in (name, "all")]


def build_reports(
    tables: dict[str, DataFrame], which: str = "all", as_of: dt.date | str | None = None
) -> dict[str, DataFrame]:
    """The chosen reports by the name of their result, from ``tables`` by name."""
    chosen = [REPORTS[name] for name in chosen_reports(which)]
    return {result: make(*[tables[table] for table in needed], as_of=as_of) for result, needed, make in chosen}


def run_reports(
    tables: dict[str, DataFrame], folder: str, which: str = "all", as_of: dt.date | str | None = None
) -> list[str]:
    return export_csv(build_reports(tables, which, as_of), folder)


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(description="Write the chosen reports as CSV")
    parser.add_argument("--database", default="analytics", help="database with the input tables")
    parser.add_argument("--output", default="data/output", help="folder for the CSV files")
    parser.add_argument("--report", default="all", choices=[*REPORTS, "all"])
    parser.add_argument("--as-of", default=None, help="date to count from (default: today)")
    options = parser.parse_args(arguments)
    spark = spark or get_session("reports")
    needed = {table for name in chosen_reports(options.report) for table in REPORTS[name][1]}
    tables = {table: spark.table(f"{options.database}.{table}") for table in needed}
    run_reports(tables, options.output, options.report, options.as_of)


if __name__ == "__main__":
    main()
