"""Results that change together, with failures at every step."""

import pytest
from helpers import rows

from tidemark.sources import releases


def numbers(spark, *values, extra=False):
    df = spark.createDataFrame([(v, f"t{v}") for v in values], "n long, t string")
    return df.selectExpr("n", "t", "n * 2 AS twice") if extra else df


def seen(spark, database):
    spark.catalog.refreshTable(f"{database}.releases__")
    return [[row["n"] for row in spark.table(f"{database}.{name}").orderBy("n").collect()] for name in ("a", "b")]


@pytest.mark.parametrize("step", ["stage", "_show", "switch"])
@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("call", [0, 1])
def test_a_failure_leaves_all_old_or_all_new(spark, database, monkeypatch, step, after, call):
    releases.publish(spark, database, {"a": numbers(spark, 1, 2), "b": numbers(spark, 3)})
    calls, function = [], getattr(releases, step)

    def failing(*arguments):
        calls.append(step)
        if len(calls) - 1 != call:
            return function(*arguments)
        if after:
            function(*arguments)
        raise OSError("lost")

    monkeypatch.setattr(releases, step, failing)
    new = {"a": numbers(spark, 10, extra=True), "b": numbers(spark, 11, 12, extra=True)}
    try:
        releases.publish(spark, database, new)
        failed = False
    except OSError:
        failed = True
    assert failed == (len(calls) > call)
    assert seen(spark, database) in ([[[1, 2], [3]], [[10], [11, 12]]] if failed else [[[10], [11, 12]]])
    monkeypatch.undo()
    releases.publish(spark, database, new)
    assert seen(spark, database) == [[10], [11, 12]]
    assert spark.table(f"{database}.a").columns == ["n", "t", "twice"]


def test_a_result_that_fails_shows_none(spark, database):
    releases.publish(spark, database, {"a": numbers(spark, 1), "b": numbers(spark, 2)})
    broken = numbers(spark, 3).selectExpr("n", "CAST(raise_error('no') AS string) AS t")
    with pytest.raises(Exception, match="no"):
        releases.publish(spark, database, {"a": numbers(spark, 4), "b": broken})
    assert seen(spark, database) == [[1], [2]]
    with pytest.raises(ValueError, match="types"):
        releases.publish(spark, database, {"a": numbers(spark, 4), "b": numbers(spark, 5).selectExpr("CAST(n AS string) AS n", "t")})
    assert seen(spark, database) == [[1], [2]]


def test_empty_results_stay_and_columns_come_and_go(spark, database):
    assert releases.publish(spark, database, {"a": numbers(spark), "b": numbers(spark, 1)}) == {"a": False, "b": True}
    assert not spark.catalog.tableExists(f"{database}.a")
    releases.publish(spark, database, {"a": numbers(spark, 5, extra=True), "b": numbers(spark)})
    assert rows(spark.table(f"{database}.a")) == [(5, "t5", 10)] and rows(spark.table(f"{database}.b")) == [(1, "t1")]
    releases.publish(spark, database, {"a": numbers(spark, 6)})
    assert spark.table(f"{database}.a").columns == ["n", "t"] and rows(spark.table(f"{database}.a")) == [(6, "t6")]


def test_a_plain_table_becomes_the_first_version(spark, database):
    numbers(spark, 7).write.saveAsTable(f"{database}.a")
    releases.publish(spark, database, {"a": numbers(spark), "b": numbers(spark, 1)})
    assert seen(spark, database) == [[7], [1]]
    releases.publish(spark, database, {"a": numbers(spark, 8)})
    assert seen(spark, database) == [[8], [1]]


def test_old_versions_go(spark, database):
    for n in range(4):
        releases.publish(spark, database, {"a": numbers(spark, n)} | ({"b": numbers(spark, 9)} if n == 0 else {}))
    releases.stage(numbers(spark, 99), database, "a", 1)  # left behind by a run that failed
    assert releases.prune(spark, database, keep=2) == 3
    assert seen(spark, database) == [[3], [9]]
    assert sorted(row["n"] for row in spark.table(f"{database}.a__versions").collect()) == [2, 3]
    assert releases.prune(spark, database, keep=1) == 1 and seen(spark, database) == [[3], [9]]
    with pytest.raises(ValueError):
        releases.prune(spark, database, keep=0)


def test_only_the_shown_version_is_read(spark, database):
    for n in range(3):
        releases.publish(spark, database, {"a": numbers(spark, n, n + 100)})
    result = spark.table(f"{database}.a")
    assert result.count() == 2 and len(result.inputFiles()) >= 1
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "version__" in plan[plan.find("PartitionFilters") :]
