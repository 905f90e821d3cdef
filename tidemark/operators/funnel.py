"""Funnels: conversion, drop-off, time in stage, by segment, and first/last-touch attribution."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.measures import percent
from tidemark.operators.bloom import MOST_WORDS, bloom_filter, filter_words, sift
from tidemark.session import settle


def stage_conversion(stages: Sequence[tuple[str, DataFrame]], customer: str) -> DataFrame:
    """Customers at each stage and as a share of the first stage that has any.

    ``stages`` pairs each stage name, in order, with the table of the customers who reached it. The
    stages are counted on their own; nothing checks that a customer passed the earlier ones.
    """
    labelled = [
        table.select(customer, F.lit(name).alias("funnel_stage"), F.lit(place).alias("stage_order"))
        for place, (name, table) in enumerate(stages, start=1)
    ]
    counts = (
        reduce(DataFrame.unionByName, labelled)
        .groupBy("funnel_stage", "stage_order")
        .agg(F.count_distinct(customer).alias("users_at_stage"))
    )
    top = F.first("users_at_stage").over(Window.orderBy("stage_order"))
    return (
        counts.withColumn("pct_of_top_of_funnel", percent(F.col("users_at_stage"), top, 1))
        .orderBy("stage_order")
        .select("funnel_stage", "users_at_stage", "pct_of_top_of_funnel")
    )


def stage_drop_off(df: DataFrame, customer: str, stage: str, stage_order: str) -> DataFrame:
    """Customers lost from each stage to the next; negative where a stage grows."""
    counts = df.groupBy(stage_order, stage).agg(F.count_distinct(customer).alias("users"))
    previous = F.lag("users").over(Window.orderBy(stage_order))
    return (
        counts.withColumn("prev_stage_users", previous)
        .withColumn(
            "drop_off_pct", percent(F.col("prev_stage_users") - F.col("users"), F.col("prev_stage_users"), 1)
        )
        .orderBy(stage_order)
        .select(stage, "users", "prev_stage_users", "drop_off_pct")
    )


def time_in_stage(df: DataFrame, stage: str, entered: str, exited: str) -> DataFrame:
    """Mean, extremes, median and 90th percentile of the days between entry and exit.

    Rows are first counted per stage and number of days, which is a small table at any scale, and all
    figures are read from those counts.
    """
    closed = df.where(F.col(exited).isNotNull()).select(stage, F.datediff(exited, entered).alias("days"))
    counts = closed.groupBy(stage, "days").agg(F.count(F.lit(1)).alias("_rows"))
    by_days = Window.partitionBy(stage).orderBy("days")
    # A row whose entry is unknown has no days and takes no part in the figures.
    known = F.when(F.col("days").isNotNull(), F.col("_rows")).otherwise(0)
    summed = counts.withColumn("_known", known).withColumns(
        {"_upto": F.sum("_known").over(by_days), "_all": F.sum("_known").over(Window.partitionBy(stage))}
    )

    def at(percentage: int) -> Column:
        reached = F.col("_upto") * 100 >= F.col("_all") * percentage
        return F.min(F.when((F.col("_known") > 0) & reached, F.col("days")))

    result = summed.groupBy(stage).agg(
        F.round(F.try_divide(F.sum(F.col("days") * F.col("_known")), F.sum("_known")), 1).alias("avg_days"),
        F.min("days").alias("min_days"),
        F.max("days").alias("max_days"),
        at(50).alias("median_days"),
        at(90).alias("p90_days"),
    )
    return result.orderBy(F.desc("avg_days"), stage)


def conversion_by_segment(
    df: DataFrame, segment: str, customer: str, stage: str, stages: Mapping[str, int] | None = None
) -> DataFrame:
    """Customers per segment who got at least as far as each named stage.

    One row per customer and segment (the furthest stage) is enough for all the counts.
    """
    # Column name of each count and the stage number it starts from.
    stages = stages or {"leads": 1, "demos": 2, "proposals": 3, "closed": 4}
    furthest = df.groupBy(segment, customer).agg(F.max(stage).alias("_furthest"))
    reached = {
        name: F.count(F.when(F.col("_furthest") >= least, F.col(customer))) for name, least in stages.items()
    }
    first, *_, last = stages
    return (
        furthest.groupBy(segment)
        .agg(*[count.alias(name) for name, count in reached.items()])
        .withColumn("overall_conversion_pct", percent(F.col(last), F.col(first), 1))
        .orderBy(F.desc("overall_conversion_pct"), segment)
    )


def touch_attribution(
    touches: DataFrame,
    converted: DataFrame,
    customer: str,
    channel: str,
    touched_at: str,
    tie_breakers: Sequence[str] = (),
    most_words: int = MOST_WORDS,
) -> DataFrame:
    """First- and last-touch conversions of every channel that a converted customer met.

    Touches of customers who did not convert are sifted out where they are read, by a Bloom filter of at most ``most_words`` words;
    the few that pass it go with the join. What is left shrinks to the first and last of each customer and channel before
    anything is joined, so a customer then has no more rows than there are channels.
    """
    moment = F.struct(touched_at, *tie_breakers)
    buyers = settle(converted.where(F.col(customer).isNotNull()).select(customer).distinct())
    words = filter_words(buyers.count(), most_words)
    near = sift(touches, [customer], bloom_filter(buyers, [customer], words), words)
    per_channel = near.groupBy(customer, channel).agg(F.min(moment).alias("_first"), F.max(moment).alias("_last"))
    met = per_channel.join(buyers, customer)
    path = Window.partitionBy(customer)
    first, last = F.struct("_first", channel), F.struct("_last", channel)
    flagged = met.select(
        channel,
        (first == F.min(first).over(path)).alias("_is_first"),
        (last == F.max(last).over(path)).alias("_is_last"),
    )
    return (
        flagged.groupBy(channel)
        .agg(
            F.count(F.when(F.col("_is_first"), 1)).alias("first_touch_conversions"),
            F.count(F.when(F.col("_is_last"), 1)).alias("last_touch_conversions"),
        )
        .orderBy(F.desc("first_touch_conversions"), channel)
    )


def listed_funnel(df: DataFrame, stage: str, customer: str, stage_order: Sequence[str]) -> DataFrame:
    """Funnel over a given list of stages; a listed stage that nobody is in counts 0.

    A stage after an empty one has no rate (NULL). The first stage is 100 % and loses nothing.
    """
    listed = F.posexplode(F.array(*map(F.lit, stage_order))).alias("_index", "stage")
    places = df.sparkSession.range(1).select(listed).select("stage", (F.col("_index") + 1).alias("stage_order"))
    counts = df.groupBy(F.col(stage).alias("stage")).agg(F.count_distinct(customer).alias("users"))
    line = Window.orderBy("stage_order")
    is_first = F.col("stage_order") == 1
    return (
        places.join(counts, "stage", "left")
        .withColumn("users", F.coalesce("users", F.lit(0)))
        .withColumn("prev_users", F.lag("users").over(line))
        .withColumn("_rate", percent(F.col("users"), F.col("prev_users"), 1))
        .withColumn("pct_of_total", percent(F.col("users"), F.first("users").over(line), 1))
        .select(
            "stage",
            "stage_order",
            "users",
            "prev_users",
            F.when(is_first, 100.0).otherwise(F.col("_rate")).alias("conversion_pct"),
            F.when(is_first, 0.0).otherwise(F.round(100 - F.col("_rate"), 1)).alias("drop_off_pct"),
            "pct_of_total",
        )
        .orderBy("stage_order")
    )
