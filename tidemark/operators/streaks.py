"""Gaps and islands: runs of consecutive days."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.operators.bitmaps import active_numbers, activity_bitmaps, day_number
from tidemark.operators.skew import expand_copies


def activity_streaks(df: DataFrame, customer: str, date: str, dedupe: bool = True, ordered: bool = False) -> DataFrame:
    """Start, end and length of each run of consecutive active days.

    A day with several rows counts once. ``dedupe=False`` counts every row, so that a repeated day
    cuts a streak, and may tie it to days after a gap. Days of a customer are combined before the shuffle, as bits or as one row per
    day, so what a window has to hold is bounded by the calendar, however busy the customer.
    """
    if dedupe:
        result = _streaks_of_days(df, customer, date)
        return result.orderBy(customer, "streak_start") if ordered else result
    days = df.groupBy(customer, date).agg(F.count(F.lit(1)).alias("_rows"))
    number = F.unix_date(date).cast("bigint")
    timeline = Window.partitionBy(customer).orderBy(date)
    before = F.coalesce(F.sum("_rows").over(timeline.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    undated = F.col(date).isNull()
    counted = days.withColumn("_run", number - before)
    counted = counted.withColumn("_weight", F.when(undated, F.col("_rows")).otherwise(1))
    counted = counted.withColumn("_rows", F.when(undated, 1).otherwise(F.col("_rows")))
    marked = expand_copies(counted, "_rows", "_copy").withColumn("_run", F.col("_run") - F.col("_copy"))
    streaks = marked.groupBy(customer, "_run").agg(
        F.min(date).alias("streak_start"),
        F.max(date).alias("streak_end"),
        F.sum("_weight").alias("streak_length_days"),
    )
    result = streaks.select(customer, "streak_start", "streak_end", "streak_length_days")
    return result.orderBy(customer, "streak_start") if ordered else result


def _streaks_of_days(df: DataFrame, customer: str, date: str) -> DataFrame:
    """Streaks from day bitmaps; rows without a date make one streak of no days that counts 1, as they stand for one day."""
    people = activity_bitmaps(df, customer, day_number(date))
    undated = F.when(F.col("undated"), F.array(F.lit(None).cast("int"))).otherwise(F.array().cast("array<int>"))
    days = people.select(customer, F.explode(F.concat(active_numbers(), undated)).alias("_day"))
    run = F.col("_day") - F.row_number().over(Window.partitionBy(customer).orderBy("_day"))
    streaks = days.withColumn("_run", run).groupBy(customer, "_run").agg(F.min("_day").alias("_from"), F.max("_day").alias("_to"), F.count(F.lit(1)).alias("_n"))
    ends = [F.date_from_unix_date(end).alias(name) for end, name in (("_from", "streak_start"), ("_to", "streak_end"))]
    return streaks.select(customer, *ends, F.col("_n").alias("streak_length_days"))
