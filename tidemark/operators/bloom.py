"""Bloom filters as small tables: rows that can find no partner are dropped before they are moved.

A filter has one row per word of 64 bits and at most ``MOST_WORDS`` rows, however many keys it holds, so it can always be
broadcast. A key sets four bits of one word, so a lookup is one hash join and a test of bits. A filter never loses a
row that has a partner; where it holds more keys than it has room for, it only lets more rows pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Rows of a filter at most: about 32 MB as a broadcast table.
MOST_WORDS = 1 << 20
#: Bits of room for each key, where that stays below ``MOST_WORDS``.
BITS_PER_KEY = 16
BITS = 4


def _word(keys: Sequence[str], words: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(words)).alias("_word")


def _mask(keys: Sequence[str]) -> Column:
    second = F.xxhash64(F.lit("mask"), *keys)
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(second, 6 * i).bitwiseAND(63).cast("int")) for i in range(BITS)]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return mask.alias("_mask")


def filter_words(rows: int, most_words: int = MOST_WORDS) -> int:
    """How many words a filter for so many keys has."""
    return max(1, min(most_words, rows * BITS_PER_KEY // 64))


def bloom_filter(keys: DataFrame, columns: Sequence[str], words: int) -> DataFrame:
    """The filter (_word, _bits) of the values of ``columns``; bits of a word are combined before the shuffle."""
    return keys.select(_word(columns, words), _mask(columns)).groupBy("_word").agg(F.bit_or("_mask").alias("_bits"))


def may_have(df: DataFrame, columns: Sequence[str], bits: DataFrame, words: int, out: str = "_may_have") -> DataFrame:
    """``df`` with a column that is false only where the filter surely holds no row's values; NULL equals NULL."""
    hit = F.coalesce(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask"), F.lit(False))
    probed = df.select("*", _word(columns, words), _mask(columns))
    return probed.join(F.broadcast(bits), "_word", "left").select(*df.columns, hit.alias(out))


def sift(df: DataFrame, columns: Sequence[str], bits: DataFrame, words: int) -> DataFrame:
    """The rows of ``df`` whose values may be among the filter's."""
    probed = df.select("*", _word(columns, words), _mask(columns)).join(F.broadcast(bits), "_word")
    return probed.where(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask")).select(*df.columns)
