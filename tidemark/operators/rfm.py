"""Recency, frequency and monetary scores.

Transactions shrink to one row per customer, which is kept in reliable storage because it is read several times: the customers
at the cuts between scores are found by counting, for all scores at once, and each row is then held against them. Customers are
not sorted.
"""

from __future__ import annotations

import datetime as dt
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import as_of_date, day, days_ago
from tidemark.functions.measures import money_sum
from tidemark.functions.tiers import (
    NTILE_REMAINDER,
    NTILE_SEGMENTS,
    QUANTILE_REMAINDER,
    QUANTILE_SEGMENTS,
    by_floor,
)
from tidemark.operators.ordering import rows_in_one_task
from tidemark.operators.selection import Term, ntile_ends, number_of_tile, quantile_ends, rows_at
from tidemark.session import settle

TILES = 5


def rfm_by_ntile(
    df: DataFrame,
    customer: str,
    date: str,
    amount: str,
    transaction: str,
    as_of: dt.date | str | None = None,
    lookback_days: int = 365,
    polarity: str = "as_written",
    ordered: bool = False,
    one_task_rows: int | None = None,
) -> DataFrame:
    """NTILE(5) scores and segments of the customers with a transaction in the look-back window.

    With polarity ``as_written``, tile 1 holds the best customers while the highest totals are named
    'Champions', so the names run against the scores. ``best_high`` gives 5 to the best customers.
    """
    if polarity not in ("as_written", "best_high"):
        raise ValueError(f"unknown polarity {polarity!r}")
    people = settle(
        df.where(F.col(date) >= days_ago(as_of, lookback_days))
        .groupBy(customer)
        .agg(
            F.datediff(as_of_date(as_of), F.max(day(date))).alias("recency_days"),
            F.count_distinct(transaction).alias("frequency"),
            money_sum(amount).alias("monetary"),
        )
    )
    id_last = Term(customer)
    best_first = {
        "r_score": [Term("recency_days"), id_last],
        "f_score": [Term("frequency", descending=True), id_last],
        "m_score": [Term("monetary", descending=True), id_last],
    }
    rows = people.count()
    ends = ntile_ends(rows, TILES)
    cuts = rows_at(people, {score: (order, ends) for score, order in best_first.items()}, rows, rows_in_one_task(people, one_task_rows))
    scored = people
    for score, order in best_first.items():
        tiles = number_of_tile(people, order, cuts[score])
        scored = scored.withColumn(score, tiles if polarity == "as_written" else TILES + 1 - tiles)
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    result = scored.select(
        customer,
        "recency_days",
        "frequency",
        F.round("monetary", 2).alias("monetary"),
        "r_score",
        "f_score",
        "m_score",
        total.alias("rfm_total"),
        by_floor(total, NTILE_SEGMENTS, NTILE_REMAINDER).alias("customer_segment"),
    )
    return result.orderBy(F.desc("rfm_total"), customer) if ordered else result


def rfm_by_quantile(
    df: DataFrame,
    customer: str,
    date: str,
    amount: str,
    snapshot: dt.date | str | None = None,
    one_task_rows: int | None = None,
) -> DataFrame:
    """Quintile scores (5 = best) and segments.

    Recency is cut at the quintiles of its values, so customers with equal recency score alike;
    frequency and monetary value are ranked first, ties by customer id, and the ranks are cut. A
    customer without any date has no total and no segment.
    """
    people = settle(
        df.where(F.col(customer).isNotNull())
        .groupBy(customer)
        .agg(
            F.datediff(as_of_date(snapshot), F.max(day(date))).alias("recency_days"),
            F.count(date).alias("frequency"),
            F.coalesce(money_sum(amount), F.lit(0.0)).alias("monetary"),
        )
    )
    scored, rows = people.withColumn("r_score", _recency_score(people, "recency_days")), people.count()
    orders = {"f_score": [Term("frequency"), Term(customer)], "m_score": [Term("monetary"), Term(customer)]}
    ends = quantile_ends(rows, TILES)
    cuts = rows_at(people, {score: (order, ends) for score, order in orders.items()}, rows, rows_in_one_task(people, one_task_rows))
    for score, order in orders.items():
        scored = scored.withColumn(score, number_of_tile(people, order, cuts[score]))
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    segment = by_floor(F.col("rfm_total"), QUANTILE_SEGMENTS, QUANTILE_REMAINDER)
    return scored.withColumn("rfm_total", total).withColumn(
        "rfm_segment", F.when(F.col("rfm_total").isNotNull(), segment)
    )


def _recency_score(people: DataFrame, column: str) -> Column:
    """5 for the most recent fifth of the values, down to 1; raises where two edges fall together.

    The edges are interpolated between neighbouring values. Five times an edge is a whole number, so
    whole numbers are compared. Only the distinct numbers of days reach the driver.
    """
    counts = people.where(F.col(column).isNotNull()).groupBy(column).count().orderBy(column).collect()
    values = [row[column] for row in counts]
    upto = list(accumulate(row["count"] for row in counts))
    last = (upto[-1] if upto else 0) - 1

    def value_at(place: int) -> int:
        return next(value for value, end in zip(values, upto) if place < end)

    edges = []
    for part in range(TILES + 1) if last >= 0 else ():
        place, rest = divmod(part * last, TILES)
        low, high = value_at(place), value_at(min(place + 1, last))
        edges.append(TILES * low + (high - low) * rest)
    if len(set(edges)) < TILES + 1:
        raise ValueError(f"the quintile edges of {column} are not all different")
    scaled = F.col(column) * TILES
    score = F.when(scaled <= edges[1], TILES)
    for part in range(2, TILES + 1):
        score = score.when(scaled <= edges[part], TILES + 1 - part)
    return score
