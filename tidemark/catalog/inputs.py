"""The tables that the operators expect, derived from the star schema.

Each function returns one logical table; ``oracle.py`` holds the same derivations as SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.dates import day, month_start
from tidemark.functions.measures import money_sum
from tidemark.plans.lifecycle_job import FUNNEL_STAGES

AS_OF = "2001-08-02"  # the day after the last order
CUTOVER = "1995-07-01"


# Declared, so that no job has to look into the files for them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "orders": """o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp_ntz""",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def star(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _before_as_of(days: int) -> Column:
    return F.date_sub(F.lit(AS_OF).cast("date"), days)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "open")
    return star(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("transaction_id"),
        day("o_orderdate").alias("transaction_date"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("product_line"),
        status.otherwise("pending").alias("status"),
    )


def _home_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        star(spark, sf_dir, "customer")
        .join(star(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(star(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("c_custkey").alias("customer_id"), "r_name")
    )


def transactions_with_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    homes = _home_regions(spark, sf_dir).withColumnRenamed("r_name", "region")
    return transactions(spark, sf_dir).join(homes, "customer_id")


def sales_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    sold = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    revenue = (
        star(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey")
        .agg(F.round(F.sum(sold.cast("decimal(18,4)")), 2).cast("double").alias("revenue"))
    )
    return (
        revenue.join(star(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(star(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(star(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("sales_rep_id"), F.col("r_name").alias("region"), "revenue")
    )


def sales_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales lines in price bands: few values, so that ranks have many ties."""
    return star(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("sales_rep_id"),
        F.col("o_orderpriority").alias("region"),
        F.floor(F.col("o_totalprice") / F.lit(10000.0)).cast("double").alias("revenue"),
    )


def monthly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star(spark, sf_dir, "orders")
    return orders.groupBy(month_start("o_orderdate").alias("month")).agg(money_sum("o_totalprice").alias("revenue"))


def daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = star(spark, sf_dir, "events")
    return events.groupBy(day("ts").alias("event_date")).agg(
        F.count_distinct("user_id").alias("daily_active_users")
    )


def customer_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir, "events").select(
        F.col("user_id").alias("customer_id"), day("ts").alias("event_date"), "event_type"
    )


def customer_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    spend = star(spark, sf_dir, "orders").groupBy("o_custkey").agg(money_sum("o_totalprice").alias("total_spend"))
    return star(spark, sf_dir, "customer").join(spend, F.col("c_custkey") == F.col("o_custkey")).select(
        F.col("c_custkey").alias("customer_id"), "total_spend", F.col("c_mktsegment").alias("segment")
    )


def customer_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir, "events").select(F.col("user_id").alias("customer_id"), day("ts").alias("activity_date"))


def _stage_rules() -> list[Column]:
    return [
        F.lit(True),
        F.col("l_linestatus") == "F",
        F.col("l_returnflag").isin("A", "R"),
        F.col("l_quantity") > 25,
        F.col("l_discount") >= 0.05,
    ]


def _reached(place: int) -> Column:
    """Whether a line got to a stage: each rule counts only after all rules before it."""
    return reduce(lambda a, b: a & b, _stage_rules()[:place])


def _stage() -> Column:
    """The furthest stage of a line."""
    last = len(FUNNEL_STAGES)
    furthest = F.when(_reached(last), last)
    for place in range(last - 1, 0, -1):
        furthest = furthest.when(_reached(place), place)
    return furthest


def stage_tables(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    lines = star(spark, sf_dir, "lineitem").withColumn("customer_id", F.col("l_orderkey"))
    return [
        (name, lines.where(_reached(place)).select("customer_id"))
        for place, name in enumerate(FUNNEL_STAGES, start=1)
    ]


def funnel_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*map(F.lit, FUNNEL_STAGES))
    lines = star(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("customer_id"), _stage().alias("stage"))
    return lines.select("customer_id", F.explode(F.sequence(F.lit(1), "stage")).alias("stage_order")).withColumn(
        "funnel_stage", F.element_at(names, F.col("stage_order"))
    )


def stage_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = day("l_shipdate")
    joined = star(spark, sf_dir, "lineitem").join(
        star(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return joined.where(shipped >= day("o_orderdate")).select(
        F.col("l_returnflag").alias("stage_name"),
        day("o_orderdate").alias("stage_enter_date"),
        F.when(F.col("l_linestatus") == "F", shipped).alias("stage_exit_date"),
    )


def customer_funnel_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = star(spark, sf_dir, "orders").join(
        star(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).select("o_orderkey", F.col("c_mktsegment").alias("segment"))
    lines = star(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("customer_id"), _stage().alias("stage"))
    return lines.join(segments, F.col("customer_id") == F.col("o_orderkey")).select("customer_id", "segment", "stage")


def marketing_touches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir, "events").select(
        F.col("user_id").alias("customer_id"),
        F.col("event_type").alias("channel"),
        F.col("ts").alias("touched_at"),
        "event_id",
    )


def converted_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    bought = (F.col("event_type") == "purchase") & (F.col("value") > 200)
    return star(spark, sf_dir, "events").where(bought).select(F.col("user_id").alias("customer_id"))


def funnel_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("lead_id"),
        F.col("l_orderkey").alias("customer_id"),
        F.element_at(F.array(*map(F.lit, FUNNEL_STAGES)), _stage()).alias("stage_name"),
        F.col("l_shipdate").alias("stage_entered_at"),
        F.col("l_suppkey").alias("sales_rep_id"),
        F.col("l_returnflag").alias("segment"),
        (F.col("l_linenumber") == 1).alias("is_current_stage"),
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"), day("o_orderdate").alias("purchase_date")
    )


def _order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.min(day("o_orderdate")).alias("first_order"),
        F.max(day("o_orderdate")).alias("last_order"),
        money_sum("o_totalprice").alias("spend"),
        F.count_distinct(month_start("o_orderdate")).cast("int").alias("order_months"),
    )


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = star(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "customer_id")
    return customer.join(_order_dates(spark, sf_dir), "customer_id").withColumns(
        {
            "signup_date": F.date_sub("first_order", 2 * F.col("c_nationkey")),
            "plan_type": F.when(F.col("c_acctbal") < 2500, "basic").when(F.col("c_acctbal") < 6000, "plus").otherwise("pro"),
            "is_active": F.col("c_acctbal") >= 0,
            "is_churned": F.col("last_order") < _before_as_of(180),
        }
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = star(spark, sf_dir, "nation")
    return _people(spark, sf_dir).join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "customer_id",
        "signup_date",
        "plan_type",
        F.when(F.col("is_churned"), F.date_add("last_order", 180)).alias("churned_date"),
        F.col("c_name").alias("account_name"),
        F.col("n_name").alias("csm_owner"),
        F.col("c_acctbal").alias("mrr"),
        "is_active",
    )


def customer_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only customers with an order in the last two years have a status."""
    seen = _order_dates(spark, sf_dir).where(F.col("last_order") >= _before_as_of(730))
    return seen.select("customer_id", (F.col("last_order") >= _before_as_of(180)).alias("is_active"))


def feature_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    feature = F.when(F.col("o_orderpriority") == "1-URGENT", "payroll").otherwise(F.col("o_orderpriority"))
    return star(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        feature.alias("feature_name"),
        day("o_orderdate").alias("feature_used_date"),
    )


def customer_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _people(spark, sf_dir).select(
        "customer_id",
        F.col("spend").alias("lifetime_value"),
        F.datediff(F.lit(AS_OF).cast("date"), "signup_date").alias("tenure_days"),
        "is_churned",
    )


def customer_billing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _people(spark, sf_dir).select(
        "customer_id",
        F.when(F.col("c_nationkey") < 13, "monthly").otherwise("annual").alias("billing_cycle"),
        "signup_date",
        F.col("order_months").alias("months_active"),
        "is_churned",
    )


def last_logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _people(spark, sf_dir).select("customer_id", F.col("last_order").alias("last_login_date"), "is_active")


def customer_logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"), day("o_orderdate").alias("login_date")
    )


def _orders_with_status(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    orders = star(spark, sf_dir, "orders").where(F.col("o_orderstatus") == status)
    return orders.withColumnRenamed("o_custkey", "customer_id").withColumn("ordered", day("o_orderdate"))


def login_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    opened = _orders_with_status(spark, sf_dir, "O")
    return opened.groupBy("customer_id").agg(F.max("ordered").alias("last_login_date"))


def transaction_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = _orders_with_status(spark, sf_dir, "F")
    return done.groupBy("customer_id").agg(
        F.max("ordered").alias("last_transaction_date"),
        F.count(F.when(F.col("ordered") >= _before_as_of(90), 1)).alias("transactions_last_90d"),
    )


def support_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = star(spark, sf_dir, "events").where(F.col("event_type") == "error")
    return errors.groupBy(F.col("user_id").alias("customer_id")).agg(
        F.count(F.lit(1)).alias("support_tickets_last_90d"),
        F.count(F.when(F.col("value") > 100, 1)).alias("open_support_tickets"),
    )


def feature_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = star(spark, sf_dir, "events").where(F.col("value") > 150)
    return used.groupBy(F.col("user_id").alias("customer_id")).agg(
        F.count_distinct("event_type").alias("features_used_last_30d")
    )


def billing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = _orders_with_status(spark, sf_dir, "P")
    return failed.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("failed_payments_last_6m"),
        F.count(F.when(F.col("o_totalprice") > 400000, 1)).alias("billing_disputes"),
        F.count(F.when(F.col("ordered") >= _before_as_of(90), 1)).alias("failed_payments_last_90d"),
    )


def customer_monthly_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = purchases(spark, sf_dir).select("customer_id", month_start("purchase_date").alias("period_date")).distinct()
    dates = _order_dates(spark, sf_dir).select("customer_id", "last_order")
    left = (F.col("period_date") == month_start("last_order")) & (F.col("last_order") < _before_as_of(180))
    return months.join(dates, "customer_id").select("customer_id", "period_date", left.alias("churned"))


def raw_customer_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events, to be loaded into the partitioned table."""
    market = F.when(F.col("r_name") == "AMERICA", "US").when(F.col("r_name") == "EUROPE", "EU").otherwise("APAC")
    events = star(spark, sf_dir, "events").withColumnRenamed("user_id", "customer_id")
    return events.join(_home_regions(spark, sf_dir), "customer_id").select(
        "customer_id",
        "event_type",
        F.col("value").alias("event_value"),
        F.col("event_id").cast("string").alias("session_id"),
        F.when(F.col("event_type").isin("view", "click"), "web").otherwise("mobile").alias("platform"),
        F.col("ts").alias("created_at"),
        market.alias("region"),
    )


def dated_customer_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_customer_events(spark, sf_dir).withColumn("event_date", F.date_format("created_at", "yyyy-MM-dd"))


def flat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir, "events").select(
        F.col("user_id").alias("customer_id"), "event_type", F.col("ts").alias("event_timestamp")
    )


def weekly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir, "orders").select(
        day("o_orderdate").alias("event_date"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("revenue"),
        F.col("o_orderkey").alias("order_id"),
    )


def customer_mrr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _people(spark, sf_dir).select(
        "customer_id",
        F.col("c_mktsegment").alias("segment"),
        "plan_type",
        F.col("c_acctbal").alias("mrr"),
        F.datediff(F.lit(AS_OF).cast("date"), "signup_date").alias("tenure_days"),
        "is_churned",
        F.col("spend").alias("lifetime_value"),
    )
