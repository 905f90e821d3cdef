"""Cohorts: monthly retention, before/after a cut-over, feature adoption, billing cycle.

Retention reduces its input to one row per customer, whose active months (or days) are bits that are combined before the shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.dates import month_start, months_apart
from tidemark.functions.measures import money_sum, percent
from tidemark.operators.bitmaps import active_between, active_numbers, activity_bitmaps, day_number, month_number, month_of
from tidemark.session import settle


def _cohort_activity(df: DataFrame, customer: str, date: str) -> DataFrame:
    """Active customers per cohort month and number of months since (NULL for rows without a date)."""
    return cohort_activity(activity_bitmaps(df.where(F.col(customer).isNotNull()), customer, month_number(date)))


def cohort_activity(bitmaps: DataFrame) -> DataFrame:
    """The same from month bitmaps of customers, as ``activity_bitmaps`` gives and ``retention_state`` keeps them."""
    periods = F.transform(active_numbers(), lambda number: number - F.col("first"))
    undated = F.when(F.col("undated"), F.array(F.lit(None).cast("int"))).otherwise(F.array().cast("array<int>"))
    rows = bitmaps.select(month_of("first").alias("cohort_month"), F.explode(F.concat(periods, undated)).alias("period"))
    return rows.groupBy("cohort_month", "period").agg(F.count(F.lit(1)).alias("active_customers"))


def monthly_retention(df: DataFrame, customer: str, date: str) -> DataFrame:
    """Retention per cohort month and period, in long form."""
    return retention_of(_cohort_activity(df, customer, date))


def retention_of(activity: DataFrame) -> DataFrame:
    """Retention from the counts of ``cohort_activity``."""
    base = F.first("active_customers").over(Window.partitionBy("cohort_month").orderBy("period"))
    return activity.withColumn("retention_pct", percent(F.col("active_customers"), base, 1)).orderBy("cohort_month", "period")


def retention_matrix(df: DataFrame, customer: str, date: str, most_periods: int = 1200) -> DataFrame:
    """Retention with one row per cohort month and one column per period; NULL where nobody was active.

    The columns cover the whole span of the data, which is read from the aggregated months. Where that is more than
    ``most_periods`` months (a century), as a wrong date makes it, there are columns only for the periods that occur: no period
    of any customer is ever left out.
    """
    dated = df.where(F.col(date).isNotNull() & F.col(customer).isNotNull())
    activity = settle(_cohort_activity(dated, customer, date))
    month = F.add_months("cohort_month", F.col("period"))
    span = activity.agg(months_apart(F.max(month), F.min("cohort_month")).alias("last")).first()
    last = span["last"] or 0
    base = F.max(F.when(F.col("period") == 0, F.col("active_customers"))).over(Window.partitionBy("cohort_month"))
    rates = activity.withColumn("retention_pct", percent(F.col("active_customers"), base, 1))
    periods = list(range(last + 1))
    if last > most_periods:
        periods = sorted(row["period"] for row in activity.select("period").distinct().collect())
    matrix = rates.groupBy("cohort_month").pivot("period", periods).agg(F.first("retention_pct"))
    return matrix.withColumnsRenamed({str(period): f"period_{period}" for period in periods}).orderBy("cohort_month")


def cutover_retention(
    customers: DataFrame,
    status: DataFrame,
    customer: str,
    signup: str,
    is_active: str,
    cutover: dt.date | str,
) -> DataFrame:
    """Share of customers still active, by whether they signed up before the cut-over day or from it on.

    A customer without a signup date is in neither group.
    """
    day_of_change = F.lit(str(cutover)).cast("date")
    group = F.when(F.col(signup) < day_of_change, "pre_migration").when(
        F.col(signup) >= day_of_change, "post_migration"
    )
    grouped = customers.select(customer, group.alias("cohort_type")).where("cohort_type IS NOT NULL").distinct()
    active = status.where(F.col(is_active)).select(customer).distinct().withColumn("_active", F.lit(1))
    return (
        grouped.join(active, customer, "left")
        .groupBy("cohort_type")
        .agg(
            F.count(customer).alias("total_customers"),
            F.count("_active").alias("active_customers"),
        )
        .withColumn("retention_pct", percent(F.col("active_customers"), F.col("total_customers"), 1))
    )


def adoption_cohorts(
    customers: DataFrame,
    usage: DataFrame,
    stats: DataFrame,
    customer: str,
    signup: str,
    feature_col: str,
    used_on: str,
    feature: str,
    early_days: int = 30,
) -> DataFrame:
    """Value, tenure and churn of customers who adopted a feature early, late or never.

    ``stats`` has ``lifetime_value``, ``tenure_days`` and ``is_churned``. A customer with several
    rows in ``customers`` or ``stats`` weighs as many rows in the averages as the plain join would
    give; the join itself only sees sums, one row per customer.
    """
    adopted = (
        usage.where(F.col(feature_col) == feature).groupBy(customer).agg(F.min(used_on).alias("_adopted"))
    )
    people = customers.groupBy(customer, signup).agg(F.count(F.lit(1)).alias("_times"))
    per_customer = stats.groupBy(customer).agg(
        money_sum("lifetime_value").alias("_value"),
        F.count("lifetime_value").alias("_values"),
        F.sum(F.col("tenure_days").cast("bigint")).alias("_days"),
        F.count("tenure_days").alias("_tenures"),
        F.max(F.col("is_churned").cast("int")).alias("_churned"),
    )
    segment = (
        F.when(F.col("_adopted").isNull(), "never_adopted")
        .when(F.datediff("_adopted", signup) <= early_days, "early_adopter")
        .otherwise("late_adopter")
    )
    joined = people.join(adopted, customer, "left").join(per_customer, customer)
    # A customer may fall into a segment with more than one signup date, so count each once.
    placed = joined.groupBy(segment.alias("adoption_segment"), customer).agg(
        money_sum(F.col("_value") * F.col("_times")).alias("_value"),
        F.sum(F.col("_values") * F.col("_times")).alias("_values"),
        F.sum(F.col("_days") * F.col("_times")).alias("_days"),
        F.sum(F.col("_tenures") * F.col("_times")).alias("_tenures"),
        F.max("_churned").alias("_churned"),
    )
    churned = F.count(F.when(F.col("_churned") == 1, 1))
    return (
        placed.groupBy("adoption_segment")
        .agg(
            F.count(customer).alias("customers"),
            F.round(F.try_divide(money_sum("_value"), F.sum("_values")), 2).alias("avg_ltv"),
            F.round(F.try_divide(F.sum("_days"), F.sum("_tenures")), 0).alias("avg_tenure_days"),
            percent(churned, F.count(customer), 1).alias("churn_pct"),
        )
        .orderBy("churn_pct", "adoption_segment")
    )


def billing_cohorts(
    df: DataFrame, customer: str, cycle: str, signup: str, months_active: str, is_churned: str
) -> DataFrame:
    """Size, mean active months and churn rate per billing cycle and signup month."""
    churned = F.sum(F.when(F.col(is_churned), 1).otherwise(0))
    return (
        df.groupBy(cycle, month_start(signup).alias("cohort_month"))
        .agg(
            F.count_distinct(customer).alias("cohort_size"),
            F.round(F.avg(months_active), 1).alias("avg_months_active"),
            percent(churned, F.count(F.lit(1)), 1).alias("churn_rate_pct"),
        )
        .orderBy("cohort_month", cycle)
    )


def day_window_retention(df: DataFrame, customer: str, date: str, width: int = 30, windows: int = 3) -> DataFrame:
    """Share of each cohort month's customers active again in days (0, 30], (30, 60] and (60, 90]."""
    dated = df.where(F.col(customer).isNotNull() & F.col(date).isNotNull())
    people = activity_bitmaps(dated, customer, day_number(date))

    def active_within(index: int) -> Column:
        return active_between(F.col("first") + width * index + 1, F.col("first") + width * (index + 1)).cast("int")

    ends = [width * (index + 1) for index in range(windows)]
    cohort = month_start(F.date_from_unix_date("first"))
    per_customer = people.select(cohort.alias("cohort_month"), *[active_within(index).alias(f"_in_{end}") for index, end in enumerate(ends)])
    counted = per_customer.groupBy("cohort_month").agg(
        F.count(F.lit(1)).alias("cohort_size"), *[F.sum(f"_in_{end}").alias(f"retained_{end}d") for end in ends]
    )
    rates = {f"retention_{end}d_pct": percent(F.col(f"retained_{end}d"), F.col("cohort_size"), 1) for end in ends}
    return counted.withColumns(rates).orderBy("cohort_month")
