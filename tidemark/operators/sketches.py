"""Small tables that stand for many rows and add up over any range of days: value buckets and distinct-value sketches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Bits that a bucket keeps of a value; its ends are less than a part in 2**7 apart.
KEPT_BITS = 8
#: Distinct values that a sketch holds exactly, as a power of two. Beyond it keeps a sample of that many hashes.
DISTINCT_BITS = 14


def value_buckets(df: DataFrame, by: Sequence[str], value: Column, kept_bits: int = KEPT_BITS) -> DataFrame:
    """Rows (*by, low, high, n): how many whole numbers lie in each bucket; NULL values are left out.

    Small numbers have a bucket each; of greater ones the leading ``kept_bits`` bits count, so the ends of a bucket
    differ by less than low / 2**(kept_bits - 1). A 64-bit number falls into one of some 15,000 buckets, whatever the rows. Buckets
    are the same everywhere, so tables of buckets add up in any order to that of all rows.
    """
    known = df.select(*by, value.cast("bigint").alias("_value")).where("_value IS NOT NULL")
    size = F.abs("_value")
    shift = F.greatest(F.length(F.bin(size)) - kept_bits, F.lit(0))
    least = F.call_function("shiftleft", F.call_function("shiftright", size, shift), shift)
    most = least + (F.call_function("shiftleft", F.lit(1).cast("bigint"), shift) - 1)
    negative = F.col("_value") < 0
    low, high = F.when(negative, -most).otherwise(least), F.when(negative, -least).otherwise(most)
    return known.select(*by, low.alias("low"), high.alias("high")).groupBy(*by, "low", "high").agg(F.count(F.lit(1)).alias("n"))


def quantile_bounds(buckets: DataFrame, by: Sequence[str], percentages: Mapping[str, int]) -> DataFrame:
    """For each group the number of values and, for each named percentage, the ends of the bucket that has the quantile.

    The quantile is the least value that so many percent of the values do not exceed. Its rank is exact; its value is known to
    lie from ``<name>_low`` to ``<name>_high``.
    """
    summed = buckets.groupBy(*by, "low", "high").agg(F.sum("n").alias("n"))
    ordered = Window.partitionBy(*by).orderBy("low")
    placed = summed.withColumns({"_upto": F.sum("n").over(ordered), "_all": F.sum("n").over(Window.partitionBy(*by))})
    ends = [
        F.min(F.when(F.col("_upto") * 100 >= F.col("_all") * percentage, F.col(end))).alias(f"{name}_{end}")
        for name, percentage in percentages.items()
        for end in ("low", "high")
    ]
    return placed.groupBy(*by).agg(F.sum("n").alias("n"), *ends)


def distinct_sketches(df: DataFrame, by: Sequence[str], value: str, bits: int = DISTINCT_BITS) -> DataFrame:
    """One sketch of the distinct values (NULL is none) for each group, combined before the shuffle."""
    return df.groupBy(*by).agg(F.theta_sketch_agg(value, bits).alias("sketch"))


def distinct_over(sketches: DataFrame, by: Sequence[str], bits: int = DISTINCT_BITS) -> DataFrame:
    """The number of distinct values behind all sketches of a group; no raw rows are read.

    The number is exact up to 2**bits values, and beyond that has a relative standard error of about 2**(-bits / 2).
    """
    return sketches.groupBy(*by).agg(F.theta_sketch_estimate(F.theta_union_agg("sketch", bits)).alias("distinct_values"))
