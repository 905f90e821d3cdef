"""Window patterns: running totals, rankings, period over period, moving averages, tiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.measures import exact_part, rest_part, total
from tidemark.operators.ordering import (
    ordered_slices,
    ranked_in_slices,
    rows_in_one_task,
    running_sum_in_slices,
    slices_of,
)
from tidemark.operators.skew import BROADCAST_BYTES, HOT_ROWS, Split, match, row_bytes, split_hot
from tidemark.operators.selection import Term, ntile_ends, number_of_tile, rows_at
from tidemark.session import settle


def running_total(
    df: DataFrame,
    key: str,
    order: str,
    amount: str,
    tie_breakers: Sequence[str],
    out: str = "running_total",
    ordered: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Cumulative amount per key, row by row (``tie_breakers`` settle rows of equal order)."""
    columns = [F.col(order), *map(F.col, tie_breakers)]
    split = split_hot(df, [key], hot_rows)
    up_to_here = Window.partitionBy(key).orderBy(*columns).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    result = split.cold.withColumn(out, total(F.sum(exact_part(amount)).over(up_to_here), F.sum(rest_part(amount)).over(up_to_here)))
    if split.hot is not None:
        result = result.unionByName(running_sum_in_slices(split, [key], columns, amount, out))
    return result.orderBy(key, *columns) if ordered else result


def rankings(
    df: DataFrame, key: str, value: str, tie_breakers: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """RANK, DENSE_RANK and ROW_NUMBER within each key, highest value first."""
    order = [F.col(value).desc_nulls_last(), *map(F.col, tie_breakers)]
    names = ("rank", "dense_rank", "row_num")
    split = split_hot(df, [key], hot_rows)
    by_value = Window.partitionBy(key).orderBy(order[0])
    # Numbered first: rows in the longer order are in the shorter one too, so one sort serves all three.
    numbered = split.cold.withColumn("row_num", F.row_number().over(Window.partitionBy(key).orderBy(*order)).cast("bigint"))
    result = numbered.withColumns(
        {"rank": F.rank().over(by_value).cast("bigint"), "dense_rank": F.dense_rank().over(by_value).cast("bigint")}
    ).select(*df.columns, *names)
    if split.hot is not None:
        result = result.unionByName(ranked_in_slices(split, [key], value, order, *names))
    return result


def top_n_per_group(df: DataFrame, key: str, value: str, n: int, tie_breakers: Sequence[str]) -> DataFrame:
    """The ``n`` highest rows of each key; each task drops all but its own top ``n`` before the shuffle."""
    order = Window.partitionBy(key).orderBy(F.col(value).desc_nulls_last(), *map(F.col, tie_breakers))
    return df.withColumn("row_num", F.row_number().over(order)).where(F.col("row_num") <= n)


def period_over_period(df: DataFrame, period: str, value: str) -> DataFrame:
    """Previous and next value and growth in percent. ``df`` has one row per period."""
    timeline = Window.orderBy(period)
    previous = F.lag(value).over(timeline)
    growth = (F.col(value) - previous) / F.nullif(previous, F.lit(0)) * F.lit(100)
    return df.select(
        period,
        value,
        previous.alias("prev_month_revenue"),
        F.lead(value).over(timeline).alias("next_month_revenue"),
        F.round(growth, 2).alias("mom_growth_pct"),
    )


def moving_average(
    df: DataFrame, period: str, value: str, rows: int = 7, out: str = "rolling_7day_avg", digits: int = 0
) -> DataFrame:
    """Mean of this and the ``rows - 1`` rows before it. ``df`` has one row per period.

    Rows are counted, not days: a missing day makes the span longer.
    """
    frame = Window.orderBy(period).rowsBetween(1 - rows, Window.currentRow)
    return df.select(period, value, F.round(F.avg(value).over(frame), digits).alias(out)).orderBy(period)


def first_and_last(df: DataFrame, key: str, date: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Each row with its key's first and last date; a NULL date sorts first, as in the window form."""
    split = split_hot(df, [key], hot_rows)
    whole = Window.partitionBy(key).orderBy(date).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    result = split.cold.withColumns(
        {"first_event_date": F.first(date).over(whole), "last_event_date": F.last(date).over(whole)}
    )
    if split.hot is None:
        return result
    # One row per hot key; hot rows themselves are not shuffled.
    ends = split.hot.groupBy(key).agg(
        F.when(F.count(date) == F.count(F.lit(1)), F.min(date)).alias("first_event_date"),
        F.max(date).alias("last_event_date"),
    )
    return result.unionByName(match(split.hot, F.broadcast(ends), [key], "inner"))


def spend_quartiles(
    df: DataFrame,
    customer: str,
    spend: str,
    segment: str,
    tiles: int = 4,
    one_task_rows: int | None = None,
) -> DataFrame:
    """Spend tier over all customers (1 = highest) and the median spend of the customer's segment.

    The rows at the cuts between tiers are found by counting; rows that agree on spend and customer are told apart by their place.
    """
    base = settle(df.select(customer, spend, segment).withColumn("_row", F.monotonically_increasing_id()))
    one_task_rows = rows_in_one_task(base, one_task_rows)
    highest_first = [Term(spend, descending=True), Term(customer), Term("_row")]
    rows = base.count()
    cuts = rows_at(base, {"tier": (highest_first, ntile_ends(rows, tiles))}, rows, one_task_rows)
    tiered = base.withColumn("spend_quartile", number_of_tile(base, highest_first, cuts["tier"])).drop("_row")
    split = split_hot(base, [segment], one_task_rows)
    medians = settle(split.cold.groupBy(segment).agg(F.median(spend).alias("median_spend_by_segment")))
    if medians.count() * row_bytes(medians) <= BROADCAST_BYTES:  # one row per segment; few segments have many customers
        medians = F.broadcast(medians)
    if split.hot is None:
        joined = match(tiered, medians, [segment], "left")
    else:
        hot_medians = _medians_in_slices(split, segment, spend, customer)
        keys = F.broadcast(split.keys)
        joined = match(match(tiered, keys, [segment], "left_anti"), medians, [segment], "left").unionByName(
            match(match(tiered, keys, [segment], "left_semi"), F.broadcast(hot_medians), [segment], "left")
        )
    return joined.select(customer, spend, "spend_quartile", "median_spend_by_segment")


def _medians_in_slices(split: Split, key: str, value: str, tie_breaker: str) -> DataFrame:
    """Exact median per hot key: find the place of the middle rows and read only those."""
    known = split.hot.where(F.col(value).isNotNull())
    slices = ordered_slices(known, [F.col(key), F.col(value), F.col(tie_breaker)], slices_of(split))
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice and hot key.
    counts = (
        slices.groupBy("_slice", key)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_from"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("_rows", F.sum("_n").over(Window.partitionBy(key)))
    )
    position = F.col("_before") + F.col("_place") - F.col("_from") + 1
    middle = [F.floor((F.col("_rows") + 1) / F.lit(2)), F.ceil((F.col("_rows") + 1) / F.lit(2))]
    return (
        match(slices, F.broadcast(counts), ["_slice", key], "inner")
        .where(position.isin(*middle))
        .groupBy(key)
        .agg(F.avg(value).alias("median_spend_by_segment"))
    )
