"""Plans for hot keys give the same rows as the plain plans."""

import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from tidemark.operators import ordering, skew, streaks, windows
from tidemark.operators.churn import churn_features
from tidemark.operators.sessions import sessionize


def skewed_rows(n: int, seed: int) -> list[tuple]:
    """A third of the rows have one key, another part is NULL, and many rows are copies."""
    rand = random.Random(seed)
    out = []
    for row in range(n):
        key = rand.choice([7, 7, 7, None, *range(10, 16)])
        when = rand.choice([None, dt.date(2024, 1, 1) + dt.timedelta(days=rand.randrange(20))])
        amount = rand.choice([None, 1.25, 2.5, 10.0])
        out.append((key, when, rand.randrange(n // 3), amount))
    return out + out[: n // 4] + [(7, dt.date(2024, 1, 5), 1, 2.5)] * (n // 5)


SCHEMA = "k long, d date, id long, amount double"


def same(left, right) -> bool:
    columns = left.columns
    return sorted(map(str, left.select(*columns).collect())) == sorted(map(str, right.select(*columns).collect()))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_running_total(spark, seed):
    df = spark.createDataFrame(skewed_rows(300, seed), SCHEMA)
    # Copies may come in any order among themselves, and so may rows that differ in the amount alone.
    unique = df.dropDuplicates(["k", "d", "id"])
    for rows in (df.withColumn("amount", F.col("id") / 4.0), unique):
        plain = windows.running_total(rows, "k", "d", "amount", ["id"])
        assert same(windows.running_total(rows, "k", "d", "amount", ["id"], hot_rows=20), plain)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rankings(spark, seed):
    df = spark.createDataFrame(skewed_rows(300, seed), SCHEMA).select("k", "amount", "id")
    plain = windows.rankings(df, "k", "amount", ["id"])
    assert same(windows.rankings(df, "k", "amount", ["id"], hot_rows=20), plain)


def test_rankings_with_one_tie_over_many_slices(spark):
    df = spark.range(4000).select(F.lit(1).alias("k"), F.lit(5.0).alias("v"), "id")
    df = df.unionByName(spark.range(4000, 4010).select(F.lit(1).alias("k"), F.lit(1.0).alias("v"), "id"))
    with_slices = windows.rankings(df, "k", "v", ["id"], hot_rows=100)
    assert same(with_slices, windows.rankings(df, "k", "v", ["id"]))
    slices = ordering.ordered_slices(df, [F.col("v"), F.col("id")], 41)
    assert slices.select("_slice").distinct().count() > 30


def test_slices_do_not_multiply_with_small_limits(spark, monkeypatch):
    """The driver gets sampled rows for each slice, so tiny limits give slices of more rows instead of thousands of slices."""
    asked, sliced = [], ordering.ordered_slices

    def recorded(df, order, slices):
        asked.append(slices)
        return sliced(df, order, slices)

    for module in (ordering, windows):
        monkeypatch.setattr(module, "ordered_slices", recorded)
    monkeypatch.setattr(ordering, "SLICES", 20, raising=False)
    df = spark.range(3000).selectExpr("id % 2 AS k", "cast(id % 7 AS double) AS amount", "id")
    plain = windows.running_total(df, "k", "amount", "amount", ["id"])
    assert same(windows.running_total(df, "k", "amount", "amount", ["id"], hot_rows=10), plain)
    assert same(windows.rankings(df, "k", "amount", ["id"], hot_rows=10), windows.rankings(df, "k", "amount", ["id"]))
    quartiles = windows.spend_quartiles(df, "id", "amount", "k", one_task_rows=10)
    assert same(quartiles, windows.spend_quartiles(df, "id", "amount", "k"))
    assert asked == [20, 20, 20]
    monkeypatch.setattr(ordering, "ONE_TASK_BYTES", 1000)  # large rows still get as many slices as their bytes ask for
    assert same(windows.running_total(df, "k", "amount", "amount", ["id"], hot_rows=10), plain)
    assert asked[3] == 120


def test_copies_of_one_row(spark):
    """Copies that would fill several slices are counted first, and all of them come back."""
    many = spark.range(3000).selectExpr("1L AS k", "DATE'2024-01-01' AS d", "7L AS id", "0.25D AS amount")
    few = spark.range(500).selectExpr("1L AS k", "DATE'2024-01-01' + cast(id % 3 AS int) AS d", "id", "1.0D AS amount")
    df = many.unionByName(few)
    for hot_rows in (100, 3200):  # with and without counting the copies
        total = windows.running_total(df, "k", "d", "amount", ["id"], hot_rows=hot_rows)
        assert same(total, windows.running_total(df, "k", "d", "amount", ["id"]))
        ranked = windows.rankings(df.drop("d"), "k", "amount", ["id"], hot_rows=hot_rows)
        assert same(ranked, windows.rankings(df.drop("d"), "k", "amount", ["id"]))


def test_first_and_last(spark):
    df = spark.createDataFrame(skewed_rows(300, 4), SCHEMA)
    for rows in (df, df.where("d IS NOT NULL")):
        plain = windows.first_and_last(rows, "k", "d")
        assert same(windows.first_and_last(rows, "k", "d", hot_rows=20), plain)


def test_lookups(spark):
    df = spark.createDataFrame(skewed_rows(300, 5), SCHEMA)
    one = spark.createDataFrame([(7, "seven"), (11, "eleven"), (None, "none")], "k long, name string")
    two = spark.createDataFrame([(7, 70), (12, 120)], "k long, number int")
    plain = df.join(one, "k", "left").join(two, "k", "left")
    assert same(skew.left_join_lookups(df, [one, two], "k", hot_rows=20), plain)
    assert same(skew.left_join_lookups(df, [one, two], "k"), plain)


def test_churn_features_with_a_hot_null_key(spark):
    ids = [None] * 40 + list(range(10))
    customers = spark.createDataFrame(
        [(n, "basic", dt.date(2024, 1, 1), None) for n in ids],
        "customer_id long, plan_type string, signup_date date, churned_date date",
    )
    lookups = [
        spark.createDataFrame([(3, dt.date(2024, 1, 9))], "customer_id long, last_login_date date"),
        spark.createDataFrame([(3, dt.date(2024, 1, 9), 2)], "customer_id long, last_transaction_date date, transactions_last_90d long"),
        spark.createDataFrame([(4, 1)], "customer_id long, support_tickets_last_90d long"),
        spark.createDataFrame([(4, 1)], "customer_id long, features_used_last_30d long"),
        spark.createDataFrame([(5, 1, 2)], "customer_id long, failed_payments_last_6m long, billing_disputes long"),
    ]
    plain = churn_features(customers, *lookups, as_of="2024-02-01", check_unique=True)
    assert same(churn_features(customers, *lookups, as_of="2024-02-01", hot_rows=20), plain)
    assert plain.count() == 50


@pytest.mark.parametrize("chunk", [1, 3, 100])
def test_copies_unfold_whole(spark, chunk):
    df = spark.createDataFrame([("a", 1), ("b", 7), (None, 3)], "name string, n long")
    unfolded = skew.expand_copies(df, "n", "i", chunk).groupBy("name").agg(F.sort_array(F.collect_list("i")).alias("i"))
    assert {row.name: row.i for row in unfolded.collect()} == {"a": [1], "b": [1, 2, 3, 4, 5, 6, 7], None: [1, 2, 3]}


def test_hot_keys_are_found_with_null(spark):
    df = spark.createDataFrame([(None,)] * 5 + [(1,)] * 6 + [(2,)] * 2, "k long")
    keys, rows = skew.hot_keys(df, ["k"], 4)
    assert {row.k for row in keys.collect()} == {None, 1}
    assert rows == 11
    assert skew.hot_keys(df, ["k"], 6) == (None, 0)


def test_hot_keys_are_found_in_a_sample(spark):
    df = spark.range(600_000).selectExpr("if(id % 3 = 0, -1, id % 50) AS k")
    keys, rows = skew.hot_keys(df, ["k"], 50_000)
    assert [row.k for row in keys.collect()] == [-1]
    assert 180_000 < rows < 220_000


def test_a_third_of_all_events_from_one_customer(spark):
    hot = spark.range(20000).selectExpr("1L AS c", "timestamp_seconds(1700000000 + id % 7000 * 3) AS t")
    cold = spark.range(20000).selectExpr("id % 500 + 2 AS c", "timestamp_seconds(1700000000 + id * 97) AS t")
    events = hot.unionByName(cold)
    result = sessionize(events, "c", "t")
    assert result.agg(F.sum("events_in_session")).first()[0] == 40000
    assert [row.events_in_session for row in result.where("c = 1").collect()] == [20000]
    days = events.selectExpr("c", "date(t) AS d")
    for dedupe, expected in ((True, days.distinct().count()), (False, 40000)):
        streak = streaks.activity_streaks(days, "c", "d", dedupe)
        assert streak.agg(F.sum("streak_length_days")).first()[0] == expected
