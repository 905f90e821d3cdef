"""Keeping one hot key from becoming one hot task.

A key is *hot* when it has more rows than one task should take. At most ``rows / HOT_ROWS`` keys can
be hot, so the list of them is always small enough to broadcast. Cold rows take the plain plan; hot
rows take a plan that does not bring a key together in one place.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

HOT_ROWS = 5_000_000
BROADCAST_BYTES = 64_000_000
SALTS = 64
COPY_CHUNK = 100_000
SEARCH_ROWS = 5_000  # rows that a hot key has in the sample it is looked for in


class Split(NamedTuple):
    """Rows divided by whether their key is hot. ``hot`` and ``keys`` are None when no key is."""

    cold: DataFrame
    hot: DataFrame | None = None
    keys: DataFrame | None = None
    rows: int = 0  # about how many rows are hot
    limit: int = 0  # rows that a task should take


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> tuple[DataFrame | None, int]:
    """The keys with more than ``hot_rows`` rows (NULL counts as a key), and about how many rows they have.

    Only the key columns are read. Where ``hot_rows`` is large, keys are looked for in a sample in which a
    hot key still has some thousand rows, so that hardly anything is shuffled. The sample decides which plan
    a key takes and nothing else; both plans use all rows and give the same result.
    """
    share = min(1.0, SEARCH_ROWS / hot_rows)
    looked_at = df.select(*keys) if share == 1.0 else df.select(*keys).sample(share, seed=1)
    counted = looked_at.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    found = counted.where(F.col("_rows") > hot_rows * share).collect()
    if not found:
        return None, 0
    hot = df.sparkSession.createDataFrame(found, schema=counted.schema)
    return hot.drop("_rows"), ceil(sum(row["_rows"] for row in found) / share)


def split_hot(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> Split:
    """``df`` is read for the search, and again for each part that is used: pass a table or a settled result."""
    hot, rows = hot_keys(df, keys, hot_rows)
    if hot is None:
        return Split(df)
    small = F.broadcast(hot)
    return Split(match(df, small, keys, "left_anti"), match(df, small, keys, "left_semi"), hot, rows, hot_rows)


def match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on equal keys where NULL equals NULL, keeping one copy of the keys."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    condition: Column = reduce(
        lambda both, one: both & one,
        [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys],
    )
    return left.join(renamed, condition, how).drop(*[f"_right_{key}" for key in keys])


def left_join_lookups(
    rows: DataFrame,
    lookups: Sequence[DataFrame],
    key: str,
    hot_rows: int = HOT_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """LEFT JOIN of ``rows`` with several tables that hold one row per key.

    Cold rows: one shuffle of each input on the key, shared by all the joins. A hot key (often NULL)
    stays where it is, and the few lookup rows that it needs are broadcast to it; should they be more than
    ``broadcast_bytes``, hot rows are spread over salts instead, and the lookup rows repeated for each.
    """
    split = split_hot(rows, [key], hot_rows)
    joined = reduce(lambda left, right: left.join(right, key, "left"), lookups, split.cold)
    if split.hot is None:
        return joined
    hot = split.hot
    for lookup in lookups:
        needed = lookup.join(F.broadcast(split.keys), key, "left_semi")
        most = broadcast_bytes // row_bytes(needed)
        if needed.limit(most + 1).count() <= most:
            hot = hot.join(F.broadcast(needed), key, "left")
        else:
            salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
            salted = hot.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(name) for name in hot.columns]), F.lit(SALTS)).cast("int"))
            hot = salted.join(needed.withColumn("_salt", salts), [key, "_salt"], "left").drop("_salt")
    return joined.unionByName(hot)


def row_bytes(df: DataFrame) -> int:
    """About how many bytes a row takes: 8 for a number or date, 64 for anything longer, 16 for the row."""
    short = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return 16 + sum(8 if isinstance(field.dataType, short) else 64 for field in df.schema)


def collapse_copies(df: DataFrame, copies: str, limit: int) -> DataFrame:
    """One row per distinct row, and how many there were; copies meet before the shuffle.

    Where no row has more than ``limit`` copies, all rows stay as they are and count as one each.
    """
    repeated, _ = hot_keys(df, df.columns, limit)
    if repeated is None:
        return df.withColumn(copies, F.lit(1).cast("bigint"))
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(copies))


def expand_copies(df: DataFrame, copies: str, index: str, chunk: int = COPY_CHUNK) -> DataFrame:
    """Turn each row into ``copies`` rows numbered 1, 2, ... in ``index``.

    Long runs are cut into chunks that spread over the tasks before they unfold.
    """
    first, step = f"{index}_first", F.lit(chunk).cast("bigint")
    runs = df.withColumn(first, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(copies), step)))
    spread = runs.repartition(*[F.col(name) for name in runs.columns])
    last = F.least(F.col(first) + step - 1, F.col(copies))
    return spread.withColumn(index, F.explode(F.sequence(F.col(first), last))).drop(first, copies)
