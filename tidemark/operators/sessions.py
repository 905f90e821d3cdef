"""Sessions: events of one customer with no long pause between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.dates import epoch_seconds
from tidemark.operators.skew import expand_copies


def sessionize(
    df: DataFrame, customer: str, time: str, gap_seconds: int = 1800, ordered: bool = False
) -> DataFrame:
    """Start, end, events and minutes of each session; a gap longer than ``gap_seconds`` starts a new one.

    Two events that fall into the same clock cell of ``gap_seconds`` are less than a gap apart, so
    they belong to one session. Events are combined to one row per customer and cell before the
    shuffle, and only cells are put in order: a customer with a third of all events takes no more
    than one row for each cell of the period.

    Events without a time are sessions of their own, numbered before the others.
    """
    cells = df.groupBy(customer, F.floor(epoch_seconds(df, time) / F.lit(gap_seconds)).alias("_cell")).agg(
        F.min(time).alias("_start"), F.max(time).alias("_end"), F.count(F.lit(1)).alias("_events")
    )
    timeline = Window.partitionBy(customer).orderBy("_cell")  # events without a time come first
    pause = epoch_seconds(cells, "_start") - F.lag(epoch_seconds(cells, "_end")).over(timeline)
    starts = (
        F.when(F.col("_cell").isNull(), F.col("_events")).when(pause.isNull() | (pause > gap_seconds), 1).otherwise(0)
    )
    numbered = cells.withColumn("_new", starts).withColumn(
        "session_id", F.sum("_new").over(timeline.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    sessions = (
        numbered.where(F.col("_cell").isNotNull())
        .groupBy(customer, "session_id")
        .agg(
            F.min("_start").alias("session_start"),
            F.max("_end").alias("session_end"),
            F.sum("_events").alias("events_in_session"),
        )
    )
    minutes = (epoch_seconds(sessions, "session_end") - epoch_seconds(sessions, "session_start")) / F.lit(60)
    timed = sessions.withColumn("session_duration_mins", F.round(minutes, 1))
    # Their cell has no start; said this way, the events are not read again for them.
    untimed = cells.where(F.col("_start").isNull()).select(customer, "_start", "_end", F.col("_events").alias("_untimed"))
    alone = expand_copies(untimed, "_untimed", "session_id").select(
        customer,
        "session_id",
        F.col("_start").alias("session_start"),
        F.col("_end").alias("session_end"),
        F.lit(1).cast("bigint").alias("events_in_session"),
        F.lit(None).cast("double").alias("session_duration_mins"),
    )
    result = timed.unionByName(alone)
    return result.orderBy(customer, "session_id") if ordered else result
