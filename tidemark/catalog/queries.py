"""Runnable queries: every operator on tables derived from the star schema."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog import inputs
from tidemark.catalog.inputs import AS_OF, CUTOVER
from tidemark.functions.dates import month_start
from tidemark.functions.tiers import CHURN_TIERS
from tidemark.operators import churn, cleaning, cohorts, funnel, retention_state, rfm, rollups, sessions, sketches, streaks, windows
from tidemark.plans import lifecycle_job, reports
from tidemark.session import scratch_path, settle
from tidemark.sources import export, extracts, layout, releases, statistics, warehouse
from tidemark.streaming import sessions as stream_sessions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Groups larger than this take the plans for hot keys in the queries named *_hot and *_sliced.
SMALL_GROUP = 1000


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _long(df: DataFrame, key: str, items: dict[str, str], **labels: str) -> DataFrame:
    """One row (label, key, item, value) for each of the named figures in each row; figures that are NULL stay."""
    figures = F.explode(F.array(*[F.struct(F.lit(name).alias("item"), F.col(column).cast("double").alias("value")) for name, column in items.items()]))
    named = [F.lit(text).alias(label) for label, text in labels.items()]
    return df.select(*named, F.col(key).cast("string").alias("key"), figures.alias("f")).select(*labels, "key", "f.item", "f.value")


def _periods(matrix: DataFrame) -> dict[str, str]:
    return {column: column for column in matrix.columns if column.startswith("period_")}


def _fresh(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


_databases: list[str] = []


def _database(spark: SparkSession) -> str:
    """A new database whose tables live in the shared folder, until ``drop_databases``."""
    name = f"tidemark_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    _databases.append(name)
    return name


def drop_databases(spark: SparkSession) -> None:
    """Drops what queries have created; their results cannot be read afterwards."""
    while _databases:
        spark.sql(f"DROP DATABASE IF EXISTS {_databases.pop()} CASCADE")


# Windows


@query
def w1_running_total(spark, d):
    rows = inputs.transactions(spark, d).select("customer_id", "transaction_id", "transaction_date", "amount")
    result = windows.running_total(rows, "customer_id", "transaction_date", "amount", ["transaction_id"])
    return result.drop("transaction_id")


@query
def w1_running_total_hot(spark, d):
    """Every product line is larger than a task should take."""
    rows = inputs.transactions(spark, d).select("product_line", "transaction_id", "transaction_date", "amount")
    return windows.running_total(
        rows, "product_line", "transaction_date", "amount", ["transaction_id"], hot_rows=SMALL_GROUP
    )


@query
def w2_rankings(spark, d):
    sales = settle(inputs.sales_performance(spark, d))
    return windows.rankings(sales, "region", "revenue", ["sales_rep_id"])


@query
def w2_rankings_hot(spark, d):
    """Groups larger than a task should take, with long ties."""
    bands = inputs.sales_bands(spark, d)
    return windows.rankings(bands, "region", "revenue", ["sales_rep_id"], hot_rows=SMALL_GROUP)


@query
def w2_top_3_per_region(spark, d):
    return windows.top_n_per_group(inputs.sales_performance(spark, d), "region", "revenue", 3, ["sales_rep_id"])


@query
def w3_period_over_period(spark, d):
    return windows.period_over_period(inputs.monthly_revenue(spark, d), "month", "revenue")


@query
def w4_moving_average(spark, d):
    return windows.moving_average(inputs.daily_metrics(spark, d), "event_date", "daily_active_users")


@query
def w5_first_and_last(spark, d):
    return windows.first_and_last(inputs.customer_events(spark, d), "customer_id", "event_date")


@query
def w5_first_and_last_hot(spark, d):
    rows = inputs.customer_events(spark, d)
    return windows.first_and_last(rows, "event_type", "event_date", hot_rows=SMALL_GROUP)


@query
def w6_spend_quartiles(spark, d):
    return windows.spend_quartiles(inputs.customer_spend(spark, d), "customer_id", "total_spend", "segment")


@query
def w6_spend_quartiles_sliced(spark, d):
    rows = inputs.customer_spend(spark, d)
    return windows.spend_quartiles(rows, "customer_id", "total_spend", "segment", one_task_rows=100)


@query
def w7_activity_streaks(spark, d):
    return streaks.activity_streaks(inputs.customer_activity(spark, d), "customer_id", "activity_date")


@query
def w7_activity_streaks_every_row(spark, d):
    rows = inputs.customer_activity(spark, d)
    return streaks.activity_streaks(rows, "customer_id", "activity_date", dedupe=False)


# Funnels


@query
def f1_stage_conversion(spark, d):
    return funnel.stage_conversion(inputs.stage_tables(spark, d), "customer_id")


@query
def f2_stage_drop_off(spark, d):
    return funnel.stage_drop_off(inputs.funnel_events(spark, d), "customer_id", "funnel_stage", "stage_order")


@query
def f3_time_in_stage(spark, d):
    rows = inputs.stage_transitions(spark, d)
    return funnel.time_in_stage(rows, "stage_name", "stage_enter_date", "stage_exit_date")


@query
def f3_bucketed_times(spark, d):
    """Bounds of the median and the 90th percentile in seconds, from buckets kept per stage and day."""
    rows = inputs.stage_transitions(spark, d)
    seconds = F.datediff("stage_exit_date", "stage_enter_date").cast("bigint") * 86400
    daily = settle(sketches.value_buckets(rows, ["stage_name", "stage_enter_date"], seconds))
    return sketches.quantile_bounds(daily, ["stage_name"], {"median": 50, "p90": 90})


@query
def f4_conversion_by_segment(spark, d):
    return funnel.conversion_by_segment(inputs.customer_funnel_stages(spark, d), "segment", "customer_id", "stage")


@query
def f5_touch_attribution(spark, d):
    return funnel.touch_attribution(
        inputs.marketing_touches(spark, d),
        inputs.converted_customers(spark, d),
        "customer_id",
        "channel",
        "touched_at",
        ["event_id"],
    )


@query
def f6_listed_funnel(spark, d):
    current = inputs.funnel_stages(spark, d).where("is_current_stage")
    return funnel.listed_funnel(current, "stage_name", "customer_id", lifecycle_job.FUNNEL_STAGES)


# Cohorts


@query
def k1_monthly_retention(spark, d):
    return cohorts.monthly_retention(inputs.purchases(spark, d), "customer_id", "purchase_date")


@query
def k1_incremental_retention(spark, d):
    """The state after the purchases of four periods, the last first and one of them twice."""
    table, purchases = f"{_database(spark)}.retention_state", inputs.purchases(spark, d)
    period = F.coalesce(F.pmod(F.year("purchase_date"), F.lit(4)), F.lit(0))
    for part in (3, 1, 0, 2, 1):
        retention_state.take_in(spark, table, purchases.where(period == part), "customer_id", "purchase_date")
    return retention_state.retention_so_far(spark, table)


@query
def k2_cutover_retention(spark, d):
    return cohorts.cutover_retention(
        inputs.customers(spark, d), inputs.customer_status(spark, d), "customer_id", "signup_date", "is_active", CUTOVER
    )


@query
def k3_adoption_cohorts(spark, d):
    return cohorts.adoption_cohorts(
        inputs.customers(spark, d),
        inputs.feature_usage(spark, d),
        inputs.customer_stats(spark, d),
        "customer_id",
        "signup_date",
        "feature_name",
        "feature_used_date",
        "payroll",
    )


@query
def k4_billing_cohorts(spark, d):
    rows = inputs.customer_billing_summary(spark, d)
    return cohorts.billing_cohorts(rows, "customer_id", "billing_cycle", "signup_date", "months_active", "is_churned")


@query
def k5_retention_matrix(spark, d):
    """The matrix, one row per cell in use, as its number of columns depends on the data."""
    matrix = cohorts.retention_matrix(inputs.purchases(spark, d), "customer_id", "purchase_date")
    return _long(matrix, "cohort_month", _periods(matrix)).where("value IS NOT NULL")


@query
def k6_day_window_retention(spark, d):
    return cohorts.day_window_retention(inputs.purchases(spark, d), "customer_id", "purchase_date")


# Churn, RFM, sessions


@query
def h1_inactivity_tiers(spark, d):
    return churn.inactivity_tiers(inputs.last_logins(spark, d), "customer_id", "last_login_date", "is_active", AS_OF)


def _rfm_by_ntile(spark, d, **options):
    rows = inputs.transactions(spark, d)
    return rfm.rfm_by_ntile(rows, "customer_id", "transaction_date", "amount", "transaction_id", AS_OF, **options)


@query
def h2_rfm_by_ntile(spark, d):
    return _rfm_by_ntile(spark, d)


@query
def h2_rfm_by_ntile_best_high_sliced(spark, d):
    return _rfm_by_ntile(spark, d, polarity="best_high", one_task_rows=100)


@query
def h3_churn_features(spark, d):
    return churn.churn_features(
        settle(inputs.customers(spark, d).select("customer_id", "plan_type", "signup_date", "churned_date")),
        inputs.login_summary(spark, d),
        inputs.transaction_summary(spark, d),
        inputs.support_summary(spark, d),
        inputs.feature_summary(spark, d),
        inputs.billing_summary(spark, d),
        as_of=AS_OF,
    )


@query
def h4_monthly_churn_rate(spark, d):
    return churn.monthly_churn_rate(inputs.customer_monthly_status(spark, d), "customer_id", "period_date", "churned")


@query
def h5_churn_tier(spark, d):
    logins = inputs.last_logins(spark, d)
    days = F.datediff(F.lit(AS_OF).cast("date"), "last_login_date").alias("days")
    return churn.add_churn_tier(logins.select("customer_id", days), "days")


@query
def h5_tier_counts(spark, d):
    return churn.tier_counts(h5_churn_tier(spark, d))


def _rfm_by_quantile(spark, d, **options):
    rows = inputs.transactions(spark, d)
    return rfm.rfm_by_quantile(rows, "customer_id", "transaction_date", "amount", AS_OF, **options)


@query
def h6_rfm_by_quantile(spark, d):
    return _rfm_by_quantile(spark, d)


@query
def h6_rfm_by_quantile_sliced(spark, d):
    return _rfm_by_quantile(spark, d, one_task_rows=100)


@query
def e1_sessions(spark, d):
    return sessions.sessionize(inputs.flat_events(spark, d), "customer_id", "event_timestamp")


@query
def e1_streamed_sessions(spark, d):
    """The same from a stream of files; an event of nobody, in a second run, moves the watermark past all sessions."""
    rows = inputs.flat_events(spark, d).select("customer_id", "event_timestamp").where("event_timestamp IS NOT NULL")
    span = rows.agg(F.min("event_timestamp").alias("first"), F.max("event_timestamp").alias("last"))
    delay = span.select(F.datediff("last", "first") + 1).first()[0] or 1  # files come in any order, and no row is late
    end = span.select(F.lit(None).cast("long").alias("customer_id"), F.expr(f"last + INTERVAL {2 * delay + 1} DAYS").alias("event_timestamp"))
    folder = _fresh(spark, "event-stream")
    for arrived in (rows.repartition(6, "event_timestamp"), end):
        arrived.write.mode("append").parquet(f"{folder}/in")
        arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")
        stream = stream_sessions.sessionize_stream(arriving, "customer_id", "event_timestamp", delay=f"{delay} days")
        writer = stream.writeStream.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True)
        writer.format("parquet").start(f"{folder}/out").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


# Cleaning


@query
def c1_clean(spark, d):
    accounts = inputs.star(spark, d, "customer")
    name, segment = F.col("c_name"), F.col("c_mktsegment")

    def written(before: str, after: str) -> DataFrame:
        return accounts.select(
            F.col("c_custkey").alias(" Customer ID "),
            F.concat(F.lit(before), name, F.lit(after)).alias("Account Name"),
            F.concat(F.lit(after), segment, F.lit(before)).alias("segment"),
            F.col("c_acctbal").alias("MRR"),
        )

    return cleaning.clean(written(" \t", "\n").unionByName(written("", "  ")))


@query
def c2_date_parts(spark, d):
    rows = inputs.transactions(spark, d).select("transaction_id", "transaction_date")
    return cleaning.add_date_parts(rows, "transaction_date")


def _text_amounts(spark, d):
    rows = inputs.transactions(spark, d)
    text = F.when(F.col("product_line") == "5-LOW", "n/a").when(
        F.col("product_line") != "2-HIGH", F.concat(F.lit(" "), F.col("amount").cast("decimal(18,2)").cast("string"))
    )
    return rows.select("transaction_id", "transaction_date", text.alias("Amount"))


@query
def c3_transform_transactions(spark, d):
    return cleaning.transform_transactions(_text_amounts(spark, d))


@query
def c4_transform_churn_risk(spark, d):
    logins = extracts.extract_customer_logins(inputs.customer_logins(spark, d), AS_OF)
    return cleaning.transform_churn_risk(logins, AS_OF)


def _clean_transactions(spark, d):
    return cleaning.transform_transactions(
        extracts.extract_transactions(inputs.transactions_with_region(spark, d), AS_OF)
    )


@query
def c5_transform_rfm(spark, d):
    return lifecycle_job.transform_rfm(_clean_transactions(spark, d), AS_OF)


@query
def c5_transform_funnel(spark, d):
    return lifecycle_job.transform_funnel(extracts.extract_funnel_events(inputs.funnel_stages(spark, d)))


@query
def c5_transform_cohorts(spark, d):
    matrix = lifecycle_job.transform_cohorts(_clean_transactions(spark, d))
    return _long(matrix, "cohort_month", _periods(matrix)).where("value IS NOT NULL")


# Sources, sinks and layout


@query
def s1_run_query(spark, d):
    inputs.transactions(spark, d).createOrReplaceTempView("transactions")
    sql = """
        SELECT product_line, count(*) AS orders FROM transactions
        WHERE status = :status AND transaction_date >= CAST(:since AS DATE) GROUP BY product_line
    """
    result = warehouse.run_query(spark, sql, {"status": "completed", "since": "1998-01-01"})
    spark.catalog.dropTempView("transactions")
    return result


@query
def s2_load_table(spark, d):
    table = f"{_database(spark)}.purchases"
    rows = inputs.transactions(spark, d).select("transaction_id", "status", "amount")
    warehouse.load_table(rows, table, "WRITE_EMPTY")
    warehouse.load_table(rows.where("status = 'open'"), table, "WRITE_TRUNCATE")
    warehouse.load_table(rows.where("status <> 'open'"), table)
    return spark.table(table)


@query
def s2_load_keeps_layout(spark, d):
    """An ORC table in partitions and buckets, with a property, in a place of its own, after a truncate and an append."""
    table = f"{_database(spark)}.purchases"
    spark.sql(
        f"""CREATE TABLE {table} (transaction_id BIGINT, amount DOUBLE, status STRING) USING ORC
        OPTIONS ('compression' 'snappy') PARTITIONED BY (status) CLUSTERED BY (transaction_id) INTO 4 BUCKETS
        LOCATION '{_fresh(spark, "purchases")}' TBLPROPERTIES ('team' = 'finance')"""
    )
    rows = inputs.transactions(spark, d).select("status", "transaction_id", "amount")
    warehouse.load_table(rows, table, "WRITE_EMPTY")
    warehouse.load_table(rows.where("status <> 'open'"), table, "WRITE_TRUNCATE")
    warehouse.load_table(rows.where("status = 'open'"), table)
    layout.compact_table(spark, table)
    details = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    kept = [details[name] for name in ("Provider", "Type", "Num Buckets", "Bucket Columns")]
    codecs = [row["codec"] for row in layout.file_codecs(spark, table).collect()]
    owned = "team=finance" in details["Table Properties"]
    partitions = ",".join(sorted(row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()))
    counted = spark.table(table).groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("layout", F.lit(" ".join([*kept, *codecs, str(owned), partitions])))


@query
def s3_query_to_table(spark, d):
    database = _database(spark)
    inputs.transactions(spark, d).createOrReplaceTempView("transactions")
    table = f"{database}.lines"
    warehouse.query_to_table(spark, "SELECT product_line, status, count(*) AS n FROM transactions GROUP BY ALL", table)
    warehouse.query_to_table(spark, f"SELECT product_line, sum(n) AS orders FROM {table} GROUP BY product_line", table)
    spark.catalog.dropTempView("transactions")
    return spark.table(table)


@query
def s4_extract_transactions(spark, d):
    return extracts.extract_transactions(inputs.transactions_with_region(spark, d), AS_OF)


@query
def s5_extract_funnel_events(spark, d):
    return extracts.extract_funnel_events(inputs.funnel_stages(spark, d))


@query
def s6_extract_customer_logins(spark, d):
    return extracts.extract_customer_logins(inputs.customer_logins(spark, d), AS_OF)


@query
def s7_load_results(spark, d):
    table = f"{_database(spark)}.revenue"
    revenue = inputs.monthly_revenue(spark, d)
    warehouse.load_results(revenue, table)
    warehouse.load_results(revenue.where("revenue < 0"), table)  # empty: the table stays as it is
    return spark.table(table)


@query
def s7_published_results(spark, d):
    """Two results, shown together: one gains rows with the second release, of which the other has none and stays."""
    database, revenue = _database(spark), inputs.monthly_revenue(spark, d)
    daily = inputs.daily_metrics(spark, d).select("event_date", F.col("daily_active_users").cast("double").alias("value"))
    releases.publish(spark, database, {"revenue": revenue.where("month < DATE'1995-01-01'"), "activity": daily})
    releases.publish(spark, database, {"revenue": revenue.select("month", "revenue"), "activity": daily.where("value < 0")})
    releases.prune(spark, database, keep=1)
    shown = spark.table(f"{database}.revenue").select(F.lit("revenue").alias("result"), F.col("month").alias("day"), F.col("revenue").alias("value"))
    return shown.unionByName(spark.table(f"{database}.activity").select(F.lit("activity").alias("result"), F.col("event_date").alias("day"), "value"))


@query
def s8_export_csv(spark, d):
    results = {
        "revenue": inputs.monthly_revenue(spark, d).withColumn("month", F.col("month").cast("string")),
        "activity": inputs.daily_metrics(spark, d),
    }
    paths = export.export_csv(results, _fresh(spark, "csv"))
    schemas = ("day string, value double", "day string, value long")
    read = [spark.read.option("header", True).schema(schema).csv(path) for path, schema in zip(paths, schemas)]
    return reduce(
        DataFrame.unionByName,
        [df.select(F.lit(name).alias("result"), "day", F.col("value").cast("double")) for name, df in zip(results, read)],
    )


def _event_table(spark, d):
    table = f"{_database(spark)}.customer_events"
    layout.create_event_table(spark, table)
    layout.load_event_partitions(inputs.raw_customer_events(spark, d), table, "2024-01-01")
    return table


@query
def s9_partitioned_event_table(spark, d):
    return spark.table(_event_table(spark, d))


@query
def s9_codec(spark, d):
    """The codecs of the event table's files, after the load and after a compaction."""
    table = _event_table(spark, d)
    loaded = layout.file_codecs(spark, table).select("codec").collect()
    layout.compact_table(spark, table)
    compacted = layout.file_codecs(spark, table).select("codec").collect()
    found = [("loaded", row["codec"]) for row in loaded] + [("compacted", row["codec"]) for row in compacted]
    return spark.createDataFrame(found, "state string, codec string")


@query
def s10_partition_event_counts(spark, d):
    return rollups.partition_event_counts(spark.table(_event_table(spark, d)), "2024-01-15", "US")


@query
def s11_load_event_partitions(spark, d):
    """A second load brings only purchases from the 15th on; it replaces the partitions that it reaches."""
    table = _event_table(spark, d)
    purchases = inputs.raw_customer_events(spark, d).where("event_type = 'purchase'")
    layout.load_event_partitions(purchases, table, "2024-01-15")
    return spark.table(table)


def _bucketed_tables(spark, d):
    database = _database(spark)
    spend = inputs.customer_spend(spark, d)
    layout.write_bucketed(
        spend.select("customer_id", "segment", F.col("total_spend").alias("lifetime_value")),
        f"{database}.customer_bucketed",
        "customer_id",
        buckets=8,
    )
    payments = inputs.transactions(spark, d).select("customer_id", "amount")
    layout.write_bucketed(payments, f"{database}.transactions_bucketed", "customer_id", buckets=8)
    return f"{database}.customer_bucketed", f"{database}.transactions_bucketed"


@query
def s12_write_bucketed(spark, d):
    return spark.table(_bucketed_tables(spark, d)[0])


@query
def s13_bucketed_spend(spark, d):
    return layout.bucketed_spend(spark, *_bucketed_tables(spark, d))


@query
def s13_bucketed_spend_hot(spark, d):
    return layout.bucketed_spend(spark, *_bucketed_tables(spark, d), hot_rows=1)


@query
def s14_event_totals(spark, d):
    return rollups.event_totals(spark.table(_event_table(spark, d)), "2024-01-01", "2024-01-31")


@query
def s14_distinct_from_sketches(spark, d):
    """Customers of January by region, from sketches kept per day and region."""
    events = inputs.dated_customer_events(spark, d)
    daily = settle(sketches.distinct_sketches(events, ["event_date", "region"], "customer_id"))
    january = daily.where("event_date BETWEEN '2024-01-01' AND '2024-01-31'")
    return sketches.distinct_over(january, ["region"])


@query
def s15_write_orc(spark, d):
    paths = {tier: _fresh(spark, f"orc-{tier}") for tier in layout.CODECS}
    rows = inputs.transactions(spark, d).select("transaction_id", "status", "amount")
    layout.write_orc(rows.where("status = 'open'"), paths["hot"], "hot")
    layout.write_orc(rows.where("status <> 'open'"), paths["cold"], "cold")
    stored = [spark.read.orc(path).withColumn("tier", F.lit(tier)) for tier, path in paths.items()]
    return reduce(DataFrame.unionByName, stored)


@query
def s16_compact(spark, d):
    table = f"{_database(spark)}.purchases"
    rows = inputs.transactions(spark, d).select("transaction_id", "customer_id", "amount")
    rows.repartition(32, "transaction_id").write.format("orc").saveAsTable(table)
    layout.compact_table(spark, table)
    return spark.table(table)


@query
def s17_analyze(spark, d):
    table = _event_table(spark, d)
    layout.analyze_table(spark, table)
    layout.analyze_table(spark, table, {"event_date": "2024-01-15", "region": "US"})
    layout.analyze_table(spark, table, columns=["customer_id", "event_type"])
    column = spark.sql(f"DESCRIBE EXTENDED {table} customer_id").where("info_name IN ('min', 'max', 'num_nulls')")
    rows = F.regexp_extract("data_type", r"(\d+) rows", 1)

    def stored(of: str, name: str) -> DataFrame:
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {of}")
        found = described.where(rows != "").select(rows.alias("info_value")).distinct()
        return found.select(F.lit(name).alias("info_name"), "info_value")

    partition = stored("PARTITION (event_date = '2024-01-15', region = 'US')", "partition_rows")
    # The description of a partition repeats the table's statistics beneath its own.
    partition = partition.orderBy(F.col("info_value").cast("bigint")).limit(1)
    return column.unionByName(stored("", "table_rows")).unionByName(partition)


@query
def s17_hot_keys_from_statistics(spark, d):
    """Customers with many transactions, from statistics; after an append these are stale, and the keys are searched."""
    table = f"{_database(spark)}.payments"
    payments = inputs.transactions(spark, d).select("customer_id", "amount")
    payments.write.format("orc").saveAsTable(table)
    statistics.keep_key_statistics(spark, table, "customer_id", least_rows=5)

    def found(state: str, keys: DataFrame | None) -> DataFrame:
        none = payments.select("customer_id").limit(0)
        return (none if keys is None else keys).select(F.lit(state).alias("state"), "customer_id")

    fresh = statistics.known_hot_keys(spark, table, "customer_id", 12)
    known = found("fresh" if fresh else "none", settle(fresh[0]) if fresh and fresh[0] else None)
    warehouse.load_table(payments.where("amount > 200000"), table)
    stale = statistics.known_hot_keys(spark, table, "customer_id", 12) is None
    searched = statistics.hot_keys_of(spark, table, "customer_id", 12)[0]
    return known.unionByName(found("stale" if stale else "wrong", searched))


# Reports and jobs


@query
def r1_executive_summary(spark, d):
    return reports.executive_summary(inputs.weekly_orders(spark, d), AS_OF)


def _report_tables(spark, d):
    return {
        "orders": inputs.weekly_orders(spark, d),
        "customers": settle(inputs.customers(spark, d).where("is_active")),
        "login_summary": inputs.login_summary(spark, d),
        "support_summary": inputs.support_summary(spark, d),
        "billing_summary": inputs.billing_summary(spark, d),
        "customer_summary": inputs.customer_mrr(spark, d),
    }


@query
def r2_churn_risk_report(spark, d):
    tables = _report_tables(spark, d)
    names = ("customers", "login_summary", "support_summary", "billing_summary")
    return reports.churn_risk_report(*[tables[name] for name in names], as_of=AS_OF)


@query
def r3_segment_performance(spark, d):
    return reports.segment_performance(inputs.customer_mrr(spark, d))


@query
def p1_lifecycle_job(spark, d):
    """Runs the whole job and returns the figures of its four tables."""
    dataset = _database(spark)
    lifecycle_job.run_job(
        inputs.transactions_with_region(spark, d),
        inputs.customer_logins(spark, d),
        inputs.funnel_stages(spark, d),
        dataset,
        AS_OF,
    )
    tier_place = F.array_position(F.array(*map(F.lit, CHURN_TIERS)), F.col("churn_risk_tier"))
    churn_scores = spark.table(f"{dataset}.churn_risk_scores").withColumn("tier_place", tier_place)
    rfm_scores = spark.table(f"{dataset}.rfm_scores").withColumn("monetary", F.round("monetary", 2))
    conversion, matrix = (spark.table(f"{dataset}.{name}") for name in ("funnel_conversion", "cohort_retention"))

    def same(*names: str) -> dict[str, str]:
        return {name: name for name in names}

    held = [
        _long(churn_scores, "customer_id", same("days_since_login", "tier_place"), result="churn_risk_scores"),
        _long(rfm_scores, "customer_id", same("recency_days", "frequency", "monetary", "r_score", "f_score", "m_score"), result="rfm_scores"),
        _long(conversion, "stage", same("users", "prev_users", "conversion_pct", "pct_of_total"), result="funnel_conversion"),
        _long(matrix, "cohort_month", _periods(matrix), result="cohort_retention").where("value IS NOT NULL"),
    ]
    return reduce(DataFrame.unionByName, held)


@query
def p2_report_job(spark, d):
    """Writes the three reports as CSV and returns the figures in the files."""
    paths = reports.run_reports(_report_tables(spark, d), _fresh(spark, "reports"), "all", AS_OF)
    weekly, risk, segments = (spark.read.option("header", True).csv(path) for path in paths)

    def same(*names: str) -> dict[str, str]:
        return {name: name for name in names}

    segments = segments.withColumn("group", F.concat(F.coalesce("segment", F.lit("")), F.lit("/"), F.coalesce("plan_type", F.lit(""))))
    held = [
        _long(weekly, "week_start", same("active_customers", "total_revenue", "total_orders", "avg_order_value", "revenue_wow_pct"), report="executive_summary"),
        _long(risk, "customer_id", same("mrr", "days_since_login", "open_support_tickets", "failed_payments_last_90d"), report="churn_risk_report"),
        _long(segments, "group", same("total_customers", "total_mrr", "avg_mrr", "churn_rate_pct", "avg_ltv"), report="segment_performance"),
    ]
    return reduce(DataFrame.unionByName, held)
