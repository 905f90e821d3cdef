"""Rows at given places of an order, found without sorting: the cuts between tiles of all rows.

A cut lies in an interval of the order, at first that of all rows. A sample of the interval's rows gives two pivots that
most likely enclose the cut; one pass then counts, for all cuts at once, the rows below and between the pivots, and
the interval shrinks to a twentieth or so. Samples only choose pivots; counts decide, so results are exact. When an interval
is small enough for one task, the row is read from it. No row is moved but samples and those of the last intervals.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

#: Rows of an interval that are looked at for pivots, and rows of an interval at least that are worth narrowing.
SAMPLE_ROWS = 10_000
LEAST_ROWS = 64


class Term(NamedTuple):
    """A column to order by: NULL first if ascending, last if descending."""

    name: str
    descending: bool = False

    def sorted(self) -> Column:
        return F.col(self.name).desc_nulls_last() if self.descending else F.col(self.name).asc_nulls_first()


@dataclass
class _Cut:
    order: Sequence[Term]
    rank: int  # place among all rows, from 1
    inside: int  # rows of the interval, which are those after ``low`` and not after ``high``
    before: int = 0  # rows up to ``low``
    low: Row | None = None
    high: Row | None = None

    def holds(self, df: DataFrame) -> Column:
        above = F.lit(True) if self.low is None else is_after(df, self.order, self.low)
        return above if self.high is None else above & ~is_after(df, self.order, self.high)

    def window(self):
        return Window.orderBy(*[term.sorted() for term in self.order])


def is_after(df: DataFrame, order: Sequence[Term], row: Row) -> Column:
    """Whether a row of ``df`` comes after ``row`` in the order."""
    after = F.lit(False)
    for name, descending in reversed(order):
        value, other = F.col(name), F.lit(row[name]).cast(df.schema[name].dataType)
        # Structs compare as rows are sorted: NULL is the least, NaN the greatest value.
        beyond = F.struct(value) < F.struct(other) if descending else F.struct(value) > F.struct(other)
        after = beyond | (value.eqNullSafe(other) & after)
    return after


def rows_at(df: DataFrame, wanted: Mapping[str, tuple[Sequence[Term], Sequence[int]]], rows: int, one_task_rows: int) -> dict[str, list[Row]]:
    """For each name the rows of ``df`` at the given places (from 1, at most ``rows``) of its order.

    ``df`` has ``rows`` rows, no two of which agree on all columns of an order; it is read several times, so pass a
    table or a settled result. An interval of at most ``one_task_rows`` rows is sorted by one task.
    """
    cuts = {(name, place): _Cut(order, rank, rows) for name, (order, ranks) in wanted.items() for place, rank in enumerate(ranks)}
    columns = list(dict.fromkeys(term.name for order, _ in wanted.values() for term in order))
    df = df.select(*columns)
    enough = max(one_task_rows, LEAST_ROWS)
    step = 0
    while open_cuts := [cut for cut in cuts.values() if cut.inside > enough]:
        _narrow(df, open_cuts, step)
        step += 1

    def picked(number: int, cut: _Cut) -> DataFrame:
        numbered = df.where(cut.holds(df)).withColumn("_at", F.row_number().over(cut.window()))
        return numbered.where(F.col("_at") == cut.rank - cut.before).withColumn("_cut", F.lit(number))

    found = {row["_cut"]: row for row in _union([picked(n, cut) for n, cut in enumerate(cuts.values())])}
    by_name: dict[str, list[Row]] = {name: [] for name in wanted}
    for number, (name, _) in enumerate(cuts):
        by_name[name].append(found[number])
    return by_name


def _union(parts: Sequence[DataFrame]) -> list[Row]:
    return reduce(DataFrame.unionByName, parts).collect() if parts else []


def _narrow(df: DataFrame, cuts: Sequence[_Cut], step: int) -> None:
    """Shrinks the intervals of the cuts by one sample and one count."""

    def pivots(number: int, cut: _Cut) -> DataFrame:
        inside, share = df.where(cut.holds(df)), min(1.0, SAMPLE_ROWS / cut.inside)
        sample = inside if share == 1.0 else inside.sample(share, seed=step)
        rows = F.count(F.lit(1)).over(Window.partitionBy())
        numbered = sample.withColumns({"_at": F.row_number().over(cut.window()), "_rows": rows})
        expected, spread = F.col("_rows") * ((cut.rank - cut.before) / cut.inside), F.sqrt(F.col("_rows")) * 2 + 1
        ends = [F.greatest(F.lit(1), F.floor(expected - spread)), F.least("_rows", F.ceil(expected + spread))]
        return numbered.where(F.col("_at").isin(*ends)).withColumn("_cut", F.lit(number)).drop("_rows")

    chosen: dict[int, list[Row]] = {}
    for row in _union([pivots(number, cut) for number, cut in enumerate(cuts)]):
        chosen.setdefault(row["_cut"], []).append(row)
    counts = []
    for number, ends in chosen.items():
        ends.sort(key=lambda row: row["_at"])
        cut = cuts[number]
        below = cut.holds(df) & ~is_after(df, cut.order, ends[0])
        upto = cut.holds(df) & ~is_after(df, cut.order, ends[-1])
        counts += [F.count(F.when(below, 1)).alias(f"below_{number}"), F.count(F.when(upto, 1)).alias(f"upto_{number}")]
    if not counts:
        return
    counted = df.agg(*counts).first()
    for number, ends in chosen.items():
        cut, below, upto = cuts[number], counted[f"below_{number}"], counted[f"upto_{number}"]
        place = cut.rank - cut.before
        if place <= below:
            cut.high, cut.inside = ends[0], below
        elif place <= upto:
            cut.low, cut.high, cut.before, cut.inside = ends[0], ends[-1], cut.before + below, upto - below
        else:
            cut.low, cut.before, cut.inside = ends[-1], cut.before + upto, cut.inside - upto


def number_of_tile(df: DataFrame, order: Sequence[Term], cuts: Sequence[Row]) -> Column:
    """The tile of a row, from 1: how many cuts it comes after."""
    return reduce(lambda total, cut: total + is_after(df, order, cut).cast("int"), cuts, F.lit(1))


def ntile_ends(rows: int, tiles: int) -> list[int]:
    """The last place of each tile but the last: the first ``rows % tiles`` tiles hold one row more."""
    small, larger = divmod(rows, tiles)
    return [t * small + min(t, larger) for t in range(1, tiles)] if rows else []


def quantile_ends(rows: int, bins: int) -> list[int]:
    """The last place of each bin but the last, for bins of equal width between 1 and ``rows``, closed on the right."""
    return [1 + b * (rows - 1) // bins for b in range(1, bins)] if rows else []
