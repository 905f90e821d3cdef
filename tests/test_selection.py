"""Cuts found by counting, against windows over all rows."""

import random

import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from tidemark.operators.selection import SAMPLE_ROWS, Term, ntile_ends, number_of_tile, quantile_ends, rows_at
from tidemark.session import settle


def tiles_by_cuts(df, order, ends, one_task_rows):
    rows = df.count()
    cuts = rows_at(df, {"it": (order, ends)}, rows, one_task_rows)["it"]
    return df.withColumn("ours", number_of_tile(df, order, cuts))


@pytest.mark.parametrize("tiles", [4, 5, 7])
def test_ends_equal_ntile(spark, tiles):
    for n in (1, 3, 5, 7, 23, 50):
        sizes = [0] * tiles
        for place in range(1, n + 1):
            sizes[sum(place > end for end in ntile_ends(n, tiles))] += 1
        builtin = spark.range(n).select(F.ntile(tiles).over(Window.orderBy("id")).alias("t")).groupBy("t").count().orderBy("t")
        assert [size for size in sizes if size] == [row["count"] for row in builtin.collect()]
    assert ntile_ends(0, tiles) == []


def test_quantile_ends_equal_qcut_of_ranks():
    for n in (2, 3, 6, 7, 11, 23, 100, 151):
        ours = [1 + sum(place > end for end in quantile_ends(n, 5)) for place in range(1, n + 1)]
        assert ours == pd.qcut(pd.Series(range(1, n + 1)), 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()


@pytest.mark.parametrize("one_task_rows", [1, 100, 10_000])
def test_tiles_of_any_values(spark, one_task_rows):
    """NULL, NaN, infinities, both zeros, long ties, and texts, against a window over all rows."""
    chance = random.Random(1)
    odd = [None, float("nan"), float("inf"), -float("inf"), 0.0, -0.0, 1.5]
    rows = [(i, chance.choice(odd + [7.0] * 10 + [chance.gauss(0, 1)]), chance.choice([None, "", "a", "é", "zz"])) for i in range(3000)] + [(None, 2.0, "a")]
    df = settle(spark.createDataFrame(rows, "id long, v double, s string"))
    for order in ([Term("v"), Term("id")], [Term("v", True), Term("id")], [Term("s", True), Term("v"), Term("id", True)]):
        found = tiles_by_cuts(df, order, ntile_ends(3001, 5), one_task_rows)
        builtin = F.ntile(5).over(Window.orderBy(*[term.sorted() for term in order]))
        assert found.withColumn("builtin", builtin).where("ours <> builtin").isEmpty()


def test_many_rows_take_few_passes(spark, monkeypatch):
    """More rows than a sample has, a third of them equal in value: each pass leaves a small part of the interval."""
    from tidemark.operators import selection

    passes = []
    narrow = selection._narrow
    monkeypatch.setattr(selection, "_narrow", lambda df, cuts, step: (passes.append(len(cuts)), narrow(df, cuts, step)))
    df = settle(spark.range(30 * SAMPLE_ROWS).selectExpr("id", "IF(id % 3 = 0, 50, id * 7919 % 101) AS v"))
    n = 30 * SAMPLE_ROWS
    ranks = [1, n // 4, n // 2, n]
    found = rows_at(df, {"up": ([Term("v"), Term("id")], ranks), "down": ([Term("v", True), Term("id")], ranks)}, n, 500)
    for name, order in {"up": ["v", "id"], "down": [F.desc("v"), "id"]}.items():
        placed = df.withColumn("at", F.row_number().over(Window.orderBy(*order)))
        expected = [(row["v"], row["id"]) for row in placed.where(F.col("at").isin(ranks)).orderBy("at").collect()]
        assert [(row["v"], row["id"]) for row in found[name]] == expected
    assert len(passes) <= 4


def test_no_rows(spark):
    df = spark.createDataFrame([], "id long, v double")
    assert tiles_by_cuts(df, [Term("v"), Term("id")], ntile_ends(0, 5), 10).collect() == []
