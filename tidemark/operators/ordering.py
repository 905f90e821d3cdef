"""Ranking over all rows, or over groups too large for one task.

The rows are range-partitioned and sorted once and kept in reliable storage, so that every later
pass sees the same slices. A slice is one contiguous piece of the global order; what it needs to know
about the pieces before it is one small row per slice.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.measures import exact_part, plus, rest_part, total
from tidemark.operators.skew import COPY_CHUNK, Split, collapse_copies, expand_copies, match, row_bytes
from tidemark.session import settle

#: Bytes of rows that one task may sort; more are sorted in slices of that size.
ONE_TASK_BYTES = 64_000_000
#: Slices that small rows are sorted in at most, as the driver gets some hundred sampled rows a slice; more only if bytes ask for them.
SLICES = 200


def rows_in_one_task(df: DataFrame, given: int | None = None) -> int:
    return given or max(1, ONE_TASK_BYTES // row_bytes(df))


def slices_of(split: Split) -> int:
    """How many slices the hot rows take: as many as the limit asks for, as long as that makes no swarm of tiny tasks."""
    enough = max(SLICES, ceil(split.rows * row_bytes(split.hot) / ONE_TASK_BYTES))
    return min(ceil(split.rows / split.limit), enough)


_SLICE_BITS = 33  # monotonically_increasing_id keeps the row's place in its partition in these


def ordered_slices(df: DataFrame, order: Sequence[Column], slices: int) -> DataFrame:
    """``df`` in sorted slices: ``_slice`` numbers the slice, ``_place`` the row in it from 0.

    Rows that agree on every order column share a slice, so the order should end in an id.
    """
    sorted_rows = df.repartitionByRange(slices, *order).sortWithinPartitions(*order)
    kept = settle(sorted_rows.withColumn("_at", F.monotonically_increasing_id()))
    return kept.withColumns(
        {
            "_slice": F.shiftright("_at", _SLICE_BITS),
            "_place": F.col("_at").bitwiseAND((1 << _SLICE_BITS) - 1),
        }
    ).drop("_at")


def ranked_in_slices(
    split: Split,
    keys: Sequence[str],
    value: str,
    order: Sequence[Column],
    rank: str,
    dense_rank: str,
    row_number: str,
) -> DataFrame:
    """RANK, DENSE_RANK and ROW_NUMBER within keys that have too many rows for one task.

    ``order`` starts with ``value`` and ends in tie-breakers. Each slice ranks its own rows; the
    totals of the slices before it, and the tie that runs over from the last of them, complete the ranks.
    """
    slices = _hot_slices(split, keys, order)
    in_key = Window.partitionBy("_slice", *keys).orderBy("_place")
    by_value = Window.partitionBy("_slice", *keys).orderBy(order[0])
    local = (
        slices.withColumn(
            "_before", F.coalesce(F.sum("_copies").over(in_key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        )
        .withColumn("_dense", F.dense_rank().over(by_value).cast("bigint"))
        .withColumn("_tie_start", F.min("_before").over(Window.partitionBy("_slice", *keys, value)))
    )
    # One row per slice and hot key: as few as there are slices and hot keys together.
    summary = local.groupBy("_slice", *keys).agg(
        F.sum("_copies").alias("_n"),
        F.max("_dense").alias("_values"),
        F.min_by(F.struct(value), "_place").alias("_first"),
        F.max_by(F.struct(value), "_place").alias("_last"),
        F.max("_tie_start").alias("_last_start"),
    )
    by_slice = Window.partitionBy(*keys).orderBy("_slice")
    earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        summary.withColumn("_rows_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("_tied", F.coalesce(F.col("_first").eqNullSafe(F.lag("_last").over(by_slice)), F.lit(False)))
        .withColumn(
            "_values_before",
            F.coalesce(F.sum("_values").over(earlier), F.lit(0)) - F.sum(F.col("_tied").cast("bigint")).over(by_slice),
        )
        .withColumn(
            "_own_start",
            F.when(~(F.col("_tied") & (F.col("_values") == 1)), F.col("_rows_before") + F.col("_last_start")),
        )
        .withColumn("_tie_from", F.last("_own_start", ignorenulls=True).over(earlier))
        .select("_slice", *keys, "_rows_before", "_values_before", "_tied", "_tie_from")
    )
    runs_over = F.col("_tied") & (F.col("_dense") == 1)
    start = F.when(runs_over, F.col("_tie_from")).otherwise(F.col("_rows_before") + F.col("_tie_start"))
    ranked = (
        match(local, F.broadcast(carried), ["_slice", *keys], "inner")
        .withColumn(rank, (start + 1).cast("bigint"))
        .withColumn(dense_rank, (F.col("_dense") + F.col("_values_before")).cast("bigint"))
        .withColumn(row_number, F.col("_rows_before") + F.col("_before"))
        .select(*split.hot.columns, "_copies", rank, dense_rank, row_number)
    )
    return _unfold(ranked, slices).withColumn(row_number, F.col(row_number) + F.col("_copy")).drop("_copy")


def running_sum_in_slices(
    split: Split, keys: Sequence[str], order: Sequence[Column], amount: str, out: str
) -> DataFrame:
    """Running sum of ``amount`` within keys that have too many rows for one task."""
    slices = _hot_slices(split, keys, order)
    # A product of decimals keeps all digits if the number of copies takes no more than these.
    parts = {"exact": (exact_part(amount), "decimal(12,0)"), "rest": (rest_part(amount), "double")}
    steps = {name: step * F.col("_copies").cast(kind) for name, (step, kind) in parts.items()}
    in_key = Window.partitionBy("_slice", *keys).orderBy("_place")
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice and hot key.
    carried = (
        slices.groupBy("_slice", *keys)
        .agg(*[F.sum(step).alias(f"_total_{name}") for name, step in steps.items()])
        .withColumns({f"_carried_{name}": F.sum(f"_total_{name}").over(earlier) for name in parts})
        .drop(*[f"_total_{name}" for name in parts])
    )
    own = in_key.rowsBetween(Window.unboundedPreceding, -1)
    slices_before = slices.withColumns({f"_own_{name}": F.sum(step).over(own) for name, step in steps.items()})
    before = {f"_before_{name}": plus(F.col(f"_carried_{name}"), F.col(f"_own_{name}")) for name in parts}
    summed = (
        match(slices_before, F.broadcast(carried), ["_slice", *keys], "inner")
        .withColumns(before)
        .select(*split.hot.columns, "_copies", *before)
    )
    unfolded = _unfold(summed, slices)
    reached = [
        plus(F.col(f"_before_{name}"), step * F.col("_copy").cast(kind)) for name, (step, kind) in parts.items()
    ]
    return unfolded.withColumn(out, total(*reached)).drop(*before, "_copy")


def _hot_slices(split: Split, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Hot rows in slices by key and order; the other columns settle ties, so that any two rows can part."""
    collapsed = collapse_copies(split.hot, "_copies", split.limit)
    columns = [*map(F.col, keys), *order, *map(F.col, split.hot.columns)]
    return ordered_slices(collapsed, columns, slices_of(split))


def _unfold(collapsed: DataFrame, slices: DataFrame) -> DataFrame:
    most = slices.agg(F.max("_copies")).first()[0]
    if most == 1:
        return collapsed.withColumn("_copy", F.lit(1).cast("bigint")).drop("_copies")
    return expand_copies(collapsed, "_copies", "_copy", COPY_CHUNK)
