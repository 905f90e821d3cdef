"""Activity as bits: one row per customer holds every month or day on which they were active.

A period is a whole number (months or days since the start of the calendar). Numbers are kept in words of 64 bits; a bit
is set by OR, so rows of a customer meet before the shuffle, repeats cost nothing, and two tables of bitmaps merge into
the bitmaps of all their rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import day

#: With at most so many words in use in the whole table, a customer's words are columns of one aggregation.
WORD_COLUMNS = 8
WORDS = "array<struct<word:int,bits:bigint>>"


def month_number(date: str | Column) -> Column:
    date = F.col(date) if isinstance(date, str) else date
    return F.year(date) * 12 + F.month(date) - 1


def month_of(number: str | Column) -> Column:
    """The first day of the month with a number."""
    number = F.col(number) if isinstance(number, str) else number
    return F.make_date(F.floor(number / 12).cast("int"), F.pmod(number, F.lit(12)) + 1, F.lit(1))


def day_number(date: str | Column) -> Column:
    return F.unix_date(day(date))


def activity_bitmaps(df: DataFrame, customer: str, number: Column, word_columns: int = WORD_COLUMNS) -> DataFrame:
    """One row per customer (NULL is one): ``first`` number, ``words`` (word, bits) in order, and whether any row is ``undated``.

    Which words are in use is read first, from the numbers alone. If they are few, each is a column of one aggregation, so
    there is one shuffle, of one row per customer and task; else customers are first combined word by word.
    """
    rows = df.select(customer, number.alias("_number"))
    word = F.floor(F.col("_number") / 64).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("_number", F.lit(64)).cast("int"))
    undated = F.max(F.col("_number").isNull()).alias("undated")
    used = rows.where("_number IS NOT NULL").select(word.alias("_word")).distinct().limit(word_columns + 1).collect()
    if len(used) <= word_columns:
        names = {f"_bits_{n}": row["_word"] for n, row in enumerate(sorted(used))}
        bits = [F.bit_or(F.when(word == value, bit)).alias(name) for name, value in names.items()]
        combined = rows.groupBy(customer).agg(F.min("_number").alias("first"), undated, *bits)
        words = F.array(*[F.struct(F.lit(value).alias("word"), F.col(name).alias("bits")) for name, value in names.items()]).cast(WORDS)
        return combined.select(customer, "first", F.filter(words, lambda w: w["bits"].isNotNull()).alias("words"), "undated")
    by_word = rows.groupBy(customer, word.alias("_word")).agg(F.min("_number").alias("_first"), F.bit_or(bit).alias("_bits"), undated)
    return _collected(by_word, customer)


def merge_bitmaps(left: DataFrame, right: DataFrame, customer: str) -> DataFrame:
    """The bitmaps of the rows of both tables, whatever rows they share."""
    columns = [customer, "first", "words", "undated"]
    words = left.select(columns).unionByName(right.select(columns)).select(customer, "first", F.explode_outer("words").alias("_w"), "undated")
    by_word = words.groupBy(customer, F.col("_w.word").alias("_word")).agg(
        F.min("first").alias("_first"), F.bit_or("_w.bits").alias("_bits"), F.max("undated").alias("undated")
    )
    return _collected(by_word, customer)


def _collected(by_word: DataFrame, customer: str) -> DataFrame:
    pair = F.when(F.col("_word").isNotNull(), F.struct(F.col("_word").alias("word"), F.col("_bits").alias("bits")))
    return by_word.groupBy(customer).agg(
        F.min("_first").alias("first"), F.sort_array(F.collect_list(pair)).cast(WORDS).alias("words"), F.max("undated").alias("undated")
    )


def active_numbers(words: str = "words") -> Column:
    """The numbers of the set bits, in order."""
    places = F.sequence(F.lit(0), F.lit(63))

    def of_word(w: Column) -> Column:
        return F.transform(F.filter(places, lambda i: F.getbit(w["bits"], i) == 1), lambda i: w["word"] * 64 + i)

    return F.flatten(F.transform(words, of_word))


def active_between(low: Column, high: Column, words: str = "words") -> Column:
    """Whether any number from ``low`` to ``high`` is set, found by shifts and masks."""

    def in_word(w: Column) -> Column:
        start, end = F.greatest(low - w["word"] * 64, F.lit(0)), F.least(high - w["word"] * 64, F.lit(63))
        ones = F.lit(-1).cast("bigint")
        mask = F.call_function("shiftleft", ones, start.cast("int")).bitwiseAND(F.call_function("shiftrightunsigned", ones, (63 - end).cast("int")))
        return (start <= end) & (w["bits"].bitwiseAND(mask) != 0)

    return F.exists(words, in_word)
