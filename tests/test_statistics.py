"""Key statistics: used while fresh, noticed when stale."""

import pytest
from helpers import rows

from tidemark.operators.skew import hot_keys
from tidemark.sources import layout, statistics


def payments(spark, database):
    table = f"{database}.payments"
    df = spark.range(1000).selectExpr("IF(id % 3 = 0, NULL, IF(id % 3 = 1, 7, id)) AS customer_id", "CAST(id AS double) AS amount", "concat('k', id % 4) AS kind")
    layout.write_bucketed(df, table, "customer_id", buckets=4)
    return table, df


def test_fresh_statistics_equal_a_search(spark, database):
    table, df = payments(spark, database)
    assert statistics.known_hot_keys(spark, table, "customer_id", 100) is None
    for column in ("customer_id", "kind"):
        statistics.keep_key_statistics(spark, table, column, least_rows=50)
    for column, limit in (("customer_id", 50), ("customer_id", 332), ("customer_id", 333), ("kind", 249), ("kind", 250), ("customer_id", 5000)):
        found, n = statistics.known_hot_keys(spark, table, column, limit)
        searched, m = hot_keys(df, [column], limit)
        assert (found is None) == (searched is None) and n == m
        if found is not None:
            assert found.schema[column].dataType == df.schema[column].dataType
            assert sorted(rows(found), key=str) == sorted(rows(searched), key=str)
    assert statistics.known_hot_keys(spark, table, "customer_id", 49) is None  # only larger keys are kept
    assert statistics.known_hot_keys(spark, table, "amount", 100) is None


def test_no_rows_are_searched_while_statistics_are_fresh(spark, database, monkeypatch):
    table, df = payments(spark, database)
    people = f"{database}.people"
    layout.write_bucketed(df.selectExpr("customer_id", "'s' AS segment").distinct(), people, "customer_id", buckets=4)
    expected = sorted(rows(layout.bucketed_spend(spark, people, table, hot_rows=100)), key=str)
    statistics.keep_key_statistics(spark, table, "customer_id", least_rows=50)

    def search(*_):
        raise AssertionError("searched")

    monkeypatch.setattr(statistics, "hot_keys", search)
    assert sorted(rows(layout.bucketed_spend(spark, people, table, hot_rows=100)), key=str) == expected
    df.where("amount < 5").write.insertInto(table)  # the files are others now
    assert statistics.known_hot_keys(spark, table, "customer_id", 100) is None
    with pytest.raises(AssertionError, match="searched"):
        layout.bucketed_spend(spark, people, table, hot_rows=100)
    statistics.keep_key_statistics(spark, table, "customer_id", least_rows=50)
    assert statistics.known_hot_keys(spark, table, "customer_id", 100)[1] == 336 + 335
