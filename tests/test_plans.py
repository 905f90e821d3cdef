"""What the plans must, and must not, contain."""

import contextlib
import io
import re

import pytest

from pyspark.sql import functions as F

from tidemark.catalog import inputs
from tidemark.catalog.queries import QUERIES
from tidemark.operators import ordering, rfm, rollups, windows
from tidemark.session import settings, settle
from tidemark.sources import layout

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    printed = io.StringIO()
    with settings(df.sparkSession, spark__sql__maxMetadataStringLength="10000"), contextlib.redirect_stdout(printed):
        df.explain()
    return printed.getvalue()


def shuffles(df) -> int:
    return len(re.findall(r"\bExchange (?:hash|range|SinglePartition)", plan(df)))


@pytest.fixture
def events(spark, database):
    table = f"{database}.events"
    layout.create_event_table(spark, table)
    layout.load_event_partitions(inputs.raw_customer_events(spark, SF_DIR), table, "2024-01-01")
    return spark.table(table)


def test_only_the_wanted_partition_is_read(events):
    scan = plan(rollups.partition_event_counts(events, "2024-01-15", "US"))
    assert re.search(r"PartitionFilters: \[.*2024-01-15.*US", scan)
    assert "ReadSchema: struct<customer_id:bigint,event_type:string>" in scan


def test_bucketed_join_does_not_shuffle(spark, database):
    spend = inputs.customer_spend(spark, SF_DIR).withColumnRenamed("total_spend", "lifetime_value")
    layout.write_bucketed(spend, f"{database}.people", "customer_id", buckets=8)
    payments = inputs.transactions(spark, SF_DIR).select("customer_id", "amount")
    layout.write_bucketed(payments, f"{database}.payments", "customer_id", buckets=8)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        result = layout.bucketed_spend(spark, f"{database}.people", f"{database}.payments")
        assert shuffles(result) == 0
        assert "SortMergeJoin" in plan(result)


def test_sliced_ranking_has_no_single_task_window(spark, monkeypatch):
    """Looked at before each checkpoint, as the plan of the result begins at the last one only."""
    plans = []

    def seen(df):
        plans.append(plan(df))
        return settle(df)

    for module in (ordering, rfm, windows):
        monkeypatch.setattr(module, "settle", seen)
    transactions = inputs.transactions(spark, SF_DIR)
    scores = rfm.rfm_by_ntile(transactions, "customer_id", "transaction_date", "amount", "transaction_id", inputs.AS_OF, one_task_rows=10)
    quantiles = rfm.rfm_by_quantile(transactions, "customer_id", "transaction_date", "amount", inputs.AS_OF, one_task_rows=10)
    spend = windows.spend_quartiles(inputs.customer_spend(spark, SF_DIR), "customer_id", "total_spend", "segment", one_task_rows=10)
    plans += [plan(df) for df in (scores, quantiles, spend)]
    assert len(plans) >= 6
    assert not any("SinglePartition" in text for text in plans)
    # Scores come from cuts: customers are neither sorted nor moved once they are added up.
    for scored in (scores, quantiles):
        assert shuffles(scored) == 0 and "Sort" not in plan(scored) and "Window" not in plan(scored)


def test_top_n_drops_rows_before_the_shuffle(spark):
    top = plan(QUERIES["w2_top_3_per_region"](spark, SF_DIR))
    assert top.count("WindowGroupLimit") == 2


@pytest.mark.parametrize(
    "name, columns",
    [
        ("k1_monthly_retention", "o_custkey:bigint,o_orderdate:timestamp_ntz"),
        ("e1_sessions", "ts:timestamp_ntz,user_id:bigint"),
        ("f2_stage_drop_off", "l_orderkey:bigint,l_quantity:double,l_discount:double,l_returnflag:string,l_linestatus:string"),
    ],
)
def test_only_needed_columns_are_read(spark, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan(QUERIES[name](spark, SF_DIR))


def test_filters_reach_the_scan(spark):
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(event_type,error\)", plan(inputs.support_summary(spark, SF_DIR)))


def test_totals_read_only_the_partitions_of_their_dates(events):
    assert re.search(r"PartitionFilters: \[[^\]]*event_date[^\]]*2024-01-05", plan(rollups.event_totals(events, "2024-01-05", "2024-01-06")))


def test_rankings_take_one_sort(spark):
    assert len(re.findall(r"\bSort \[", plan(windows.rankings(inputs.sales_performance(spark, SF_DIR), "region", "revenue", ["sales_rep_id"])))) == 1


def test_events_are_read_once_for_sessions(spark):
    with settings(spark, spark__sql__adaptive__enabled="false"):  # otherwise exchanges are shared only once they run
        text = plan(QUERIES["e1_sessions"](spark, SF_DIR))
    assert len(re.findall(r"FileScan parquet", text)) - len(re.findall(r"ReusedExchange", text)) <= 1


def test_attribution_sifts_below_the_aggregate(spark):
    """In the plan's text a child stands below its parent: the filter's join lies under the partial aggregate of the touches."""
    text = plan(QUERIES["f5_touch_attribution"](spark, SF_DIR))
    aggregates = [match.start() for match in re.finditer("partial_min", text)]
    assert aggregates and text.find("_word", aggregates[0]) > aggregates[0]
    assert "BroadcastHashJoin" in text[aggregates[0] :]


def test_two_distinct_counts_do_not_triple_the_rows(spark):
    assert "Expand" not in plan(QUERIES["r1_executive_summary"](spark, SF_DIR))


def test_medians_are_broadcast(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(QUERIES["w6_spend_quartiles"](spark, SF_DIR))
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


@pytest.mark.parametrize("name, most", [("k1_monthly_retention", 6), ("e1_sessions", 4), ("w7_activity_streaks", 3), ("f4_conversion_by_segment", 6)])
def test_number_of_shuffles(spark, name, most):
    assert shuffles(QUERIES[name](spark, SF_DIR)) <= most


def test_no_python_in_any_plan(spark):
    for name in ("k1_monthly_retention", "e1_sessions", "h3_churn_features", "w1_running_total", "c3_transform_transactions", "f5_touch_attribution"):
        assert not re.search("Python|ArrowEval|MapInPandas", plan(QUERIES[name](spark, SF_DIR)))


def test_hot_rows_are_not_shuffled_by_key(spark):
    """All event types are hot: the rows keep their place and the ends of each key are broadcast."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        rows = inputs.customer_events(spark, SF_DIR)
        hot = windows.first_and_last(rows, "event_type", "event_date", hot_rows=10)
        assert "SortMergeJoin" not in plan(hot)
        assert plan(hot).count("BroadcastHashJoin") >= 3


def test_sliced_windows_are_per_slice(spark):
    text = plan(QUERIES["w1_running_total_hot"](spark, "/root/testdata/sf0.01"))
    assert re.search(r"Exchange hashpartitioning\(_slice#\d+L, product_line#\d+", text)
