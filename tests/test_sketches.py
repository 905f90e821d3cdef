"""Value buckets and distinct sketches against exact figures."""

import random

from helpers import rows
from pyspark.sql import functions as F

from tidemark.operators import sketches


def test_buckets_bound_the_exact_quantiles(spark):
    chance = random.Random(1)
    data = [(s, d, int(chance.choice([1, -1, 1, 1]) * 10 ** chance.uniform(0, 17))) for s in "ab" for d in range(5) for _ in range(300)]
    data += [("a", 1, None), ("c", 1, None), ("a", 2, 2**63 - 1), ("b", 2, -(2**63) + 1), ("b", 0, 0)]
    df = spark.createDataFrame(data, "stage string, day int, v long")
    daily = sketches.value_buckets(df, ["stage", "day"], F.col("v"))
    shares = {"p1": 1, "median": 50, "p90": 90, "all": 100}
    found = {row["stage"]: row for row in sketches.quantile_bounds(daily, ["stage"], shares).collect()}
    assert set(found) == {"a", "b"}
    for stage, row in found.items():
        values = sorted(v for s, _, v in data if s == stage and v is not None)
        assert row["n"] == len(values)
        for name, share in shares.items():
            exact = next(v for place, v in enumerate(values, 1) if place * 100 >= len(values) * share)
            low, high = row[f"{name}_low"], row[f"{name}_high"]
            assert low <= exact <= high
            assert high - low <= max(abs(low), abs(high)) / 2 ** (sketches.KEPT_BITS - 1)


def test_buckets_add_up_in_any_order(spark):
    df = spark.range(5000).selectExpr("id % 7 AS day", "id * id * 31 AS v")
    daily = {d: sketches.value_buckets(df.where(F.col("day") == d), ["day"], F.col("v")) for d in range(7)}
    whole = sketches.value_buckets(df, [], F.col("v"))
    for order in ([0, 1, 2, 3, 4, 5, 6], [6, 2, 0, 5, 1, 3, 4]):
        merged = daily[order[0]]
        for d in order[1:]:
            merged = merged.unionByName(daily[d])
        summed = merged.groupBy("low", "high").agg(F.sum("n").alias("n"))
        assert rows(summed, "low") == rows(whole, "low")


def test_distinct_sketches(spark):
    df = spark.range(60_000).selectExpr("id % 10 AS day", "id % 3 AS region", "CAST(id * 7919 % 20011 AS string) AS who").unionByName(
        spark.createDataFrame([(1, 9, None)], "day long, region long, who string")
    )
    exact = {tuple(row)[0]: row["n"] for row in df.groupBy("region").agg(F.count_distinct("who").alias("n")).collect()}
    daily = sketches.distinct_sketches(df, ["day", "region"], "who", 16)
    assert {row["region"]: row["distinct_values"] for row in sketches.distinct_over(daily, ["region"], 16).collect()} == exact
    small = sketches.distinct_sketches(df, ["day", "region"], "who", 12)
    orders = [small.orderBy("day"), small.orderBy(F.desc("day")), small.unionByName(small)]
    for sketched in orders:
        for row in sketches.distinct_over(sketched, ["region"], 12).collect():
            n = exact[row["region"]]
            assert abs(row["distinct_values"] - n) <= 4 * n / 2**6
    assert sketches.distinct_over(daily.limit(0), ["region"]).collect() == []
